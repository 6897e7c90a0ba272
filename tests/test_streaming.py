"""A stream must give what the batch job gives on the same rows."""

import pytest
from pyspark.sql import functions as F

from panelflow.operators import regimes
from panelflow.plans.series import Series, public
from panelflow.session import scratch_path
from panelflow.sources import ticks as tick_source
from panelflow.streaming import ticks as tick_stream
from panelflow.streaming.changes import ChangeStream

S = Series(("instrument",), ("ts", "event_id"), plan="blocks", rows=64)


@pytest.fixture(scope="module")
def ticks(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet")
    return e.select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"),
        F.when(F.col("event_id") % 3 == 0, "hot").otherwise(F.col("event_type")).alias("instrument"),
        F.col("value").alias("mid"),
    )


def in_time_slices(spark, ticks, n):
    """One file per time slice, oldest first."""
    path = scratch_path(spark, "slices")
    lo, hi = ticks.agg(F.min("event_id"), F.max("event_id")).first()
    step = (hi - lo) // n + 1
    for i in range(n):
        part = ticks.where((F.col("event_id") >= lo + i * step) & (F.col("event_id") < lo + (i + 1) * step))
        part.coalesce(1).write.mode("append").parquet(path)
    return path


def scores(df):
    return {r["event_id"]: (r["is_change"], pytest.approx(r["score"], rel=1e-6, abs=1e-6)) for r in df.collect()}


def test_change_stream_equals_batch(spark, ticks):
    path = in_time_slices(spark, ticks, 4)
    job = ChangeStream(S, "mid", scratch_path(spark, "changes"))
    stream = spark.readStream.schema(ticks.schema).option("maxFilesPerTrigger", 1).parquet(path)
    job.run(stream, scratch_path(spark, "checkpoint"))
    out = spark.read.parquet(job.output)
    assert out.select("batch_id").distinct().count() == 4
    want = public(regimes.cusum(ticks, S, "mid"))
    got = out.collect()
    assert len(got) == want.count()
    assert {r["event_id"]: (r["is_change"], r["score"]) for r in got} == scores(want)
    assert spark.read.parquet(job.late).count() == 0


def test_change_stream_replay_and_late_rows(spark, ticks):
    job = ChangeStream(S, "mid", scratch_path(spark, "changes"))
    early, late = ticks.where("event_id < 500"), ticks.where("event_id >= 500")
    job.process(early, 0)
    for _ in range(2):  # a batch that runs again replaces its own output
        job.process(late, 1)
        assert spark.read.parquet(job.output).count() == regimes.cusum(ticks, S, "mid").count()
    job.process(early.limit(7), 2)
    assert spark.read.parquet(job.late).where("batch_id = 2").count() == 7
    assert spark.read.parquet(job.output).where("batch_id = 2").count() == 0


def test_ingest_grows_with_the_logs(spark, ticks):
    logs, out, cp = (scratch_path(spark, n) for n in ("logs", "ticks", "checkpoint"))
    line = F.concat_ws("|", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), "instrument", "mid", F.col("mid") + 1)
    lines = ticks.select("event_id", line.alias("value"))
    for cond in ("event_id < 300", "event_id >= 300"):
        lines.where(cond).select("value").write.mode("append").text(logs)
        tick_stream.drain(tick_stream.tick_log_stream(spark, logs), out, cp, ("instrument",))
    tick_stream.drain(tick_stream.tick_log_stream(spark, logs), out, cp, ("instrument",))
    batch = tick_source.read_tick_logs(spark, logs)
    cols = ["ts", "instrument", "bid", "ask", "mid", "spread", "source"]
    got = spark.read.parquet(out).select(cols)
    assert got.count() == batch.count() and got.exceptAll(batch.select(cols)).count() == 0


def test_distinct_and_bar_streams(spark, ticks):
    path = in_time_slices(spark, ticks.unionByName(ticks), 2)
    stream = spark.readStream.schema(ticks.schema).parquet(path)
    out = scratch_path(spark, "distinct")
    tick_stream.drain(tick_stream.distinct_ticks(stream, "40 days"), out, scratch_path(spark, "checkpoint"))
    got = spark.read.parquet(out)
    assert got.count() == ticks.select("instrument", "ts").distinct().count()
    bars = scratch_path(spark, "bars")
    tick_stream.drain(
        tick_stream.bar_stream(spark.readStream.schema(ticks.schema).parquet(path), "1 day", "1 minute"),
        bars, scratch_path(spark, "checkpoint"),
    )
    from panelflow.operators.features import bars as batch_bars

    want = batch_bars(ticks.unionByName(ticks), ["instrument"], "ts", "mid", "1 day")
    got = spark.read.parquet(bars)
    # The newest window stays open until the watermark passes it.
    assert 0 < got.count() < want.count() + 1
    assert got.exceptAll(want.select(got.columns)).count() == 0
