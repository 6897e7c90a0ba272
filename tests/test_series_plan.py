"""The block plan must equal the plain window on every row, at any block size."""

import datetime
import random
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from panelflow.operators import profile
from panelflow.plans.grid import complete_grid, missing_cells
from panelflow.plans.series import Series, frames, positions, public, scan


@pytest.fixture(scope="module")
def ticks(spark, sf):
    """Skewed: one key holds most rows; some buckets are empty, one is crowded."""
    e = spark.read.parquet(f"{sf}/events.parquet")
    return e.select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_id").alias("id"),
        F.when(F.col("event_id") % 10 < 7, "hot").otherwise(F.col("event_type")).alias("k"),
        F.when(F.col("event_id") % 11 == 0, None).otherwise(F.col("value")).alias("v"),
    )


def same(a, b, keys):
    a = a.toPandas().sort_values(keys).reset_index(drop=True)
    b = b.toPandas().sort_values(keys).reset_index(drop=True)
    pd.testing.assert_frame_equal(a, b[a.columns], check_dtype=False)


@pytest.mark.parametrize("bucket", [900.0, 86400.0, 1e9])
def test_scan(ticks, bucket):
    s = Series(("k",), ("ts", "id"), plan="blocks", bucket=bucket)
    kw = dict(
        sums={"c": F.coalesce("v", F.lit(0.0)), "n": F.lit(1)},
        prev={"p": F.col("v"), "pt": F.col("ts")},
        totals={"t": F.lit(1)},
    )
    got = public(scan(ticks, s, **kw)).withColumn("c", F.round("c", 6))
    plain = scan(ticks, Series(("k",), ("ts", "id")), **kw).withColumn("c", F.round("c", 6))
    same(got, plain, ["id"])


@pytest.mark.parametrize("rows", [5, 64, 4000])
def test_frames(ticks, rows):
    s = Series(("k",), ("ts", "id"), plan="blocks", bucket=3600.0, rows=rows)

    def first(w):
        return {
            "m": F.avg("v").over(w.rowsBetween(-3, 0)),
            "f": F.sum("v").over(w.rowsBetween(1, 4)),
            "l": F.lag("v", 2).over(w),
        }

    def second(w):
        return {"mm": F.max("m").over(w.rowsBetween(-2, 0))}

    got = public(frames(ticks, s, first, second, back=5, ahead=4))
    plain = frames(ticks, Series(("k",), ("ts", "id")), first, second)
    same(got, plain, ["id"])


def test_positions_and_block_scan(ticks):
    s = Series(("k",), ("ts", "id"), plan="blocks", bucket=3600.0, rows=7)
    got = positions(ticks, s, count="n")
    w = W.partitionBy("k").orderBy("ts", "id")
    plain = ticks.withColumn("_pos", F.row_number().over(w) - 1).withColumn(
        "n", F.count(F.lit(1)).over(W.partitionBy("k"))
    )
    same(got.drop("_bkt"), plain, ["id"])

    flag = (F.col("id") % 5 == 0).cast("long")
    blk = frames(ticks, s, lambda w: {"lead": F.lead("v").over(w)}, ahead=1, keep_blocks=True)
    got = public(scan(blk, s, sums={"seg": flag}, prev={"p": F.col("v")}, part="_blk"))
    plain = ticks.select(
        "*",
        F.lead("v").over(w).alias("lead"),
        F.sum(flag).over(w.rowsBetween(W.unboundedPreceding, 0)).alias("seg"),
        F.lag("v").over(w).alias("p"),
    )
    same(got, plain, ["id"])


def test_no_window_over_a_whole_key(ticks):
    s = Series(("k",), ("ts", "id"), plan="blocks")
    plan = frames(ticks, s, lambda w: {"x": F.lag("v").over(w)}, back=1)._jdf.queryExecution().toString()
    windows = [x for x in plan.split("== Physical Plan ==")[1].splitlines() if " Window " in x]
    assert windows
    for line in windows:
        # The only group by key alone is the carry table, one row per bucket.
        assert "_bkt" in line or "_blk" in line


def test_missing_cells(spark):
    df = spark.createDataFrame(
        [("a", 1), ("a", 2), ("a", 5), ("b", 2), ("c", 5), ("c", 5)], "e string, t int"
    )
    got = {tuple(r) for r in missing_cells(df, "e", "t").collect()}
    assert got == {("b", 1), ("b", 5), ("c", 1), ("c", 2)}
    assert complete_grid(df.distinct(), "e", "t").count() == 9
    plan = missing_cells(df, "e", "t")._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def _direct_missing(rows):
    periods = {t for _, t in rows if t is not None}
    have = {(e, t) for e, t in rows if e is not None and t is not None}
    return {(e, t) for e in {e for e, _ in have} for t in periods} - have


@pytest.mark.parametrize("kind", ["int", "bigint", "date", "string", "timestamp"])
def test_missing_cells_of_any_period(spark, kind):
    rng = random.Random(kind)
    start = datetime.datetime(1969, 11, 20)
    make = {
        "int": lambda i: i * 7 - 300, "bigint": lambda i: (i - 60) * 10**12, "date": lambda i: (start + datetime.timedelta(days=3 * i)).date(),
        "string": lambda i: f"p{i:03}", "timestamp": lambda i: start + datetime.timedelta(hours=i),
    }[kind]
    rows = [(f"e{rng.randrange(9)}", make(rng.randrange(120))) for _ in range(400)] + [(None, make(130)), ("none", None), ("e1", None)]
    df = spark.createDataFrame(rows, f"e string, t {kind}").repartition(5)
    got = [tuple(r) for r in missing_cells(df, "e", "t").collect()]
    assert len(got) == len(set(got)) and set(got) == _direct_missing(rows)
    balance = profile.panel_balance(df, "e", "t").first()
    assert balance.missing_entries == len(got) and balance.time_periods == len({t for _, t in rows if t is not None})
    assert balance.entities == 11 and balance.total_obs == len(rows)


def test_missing_cells_of_nothing(spark):
    df = spark.createDataFrame([], "e string, t int")
    assert missing_cells(df, "e", "t").count() == 0 and complete_grid(df, "e", "t").count() == 0
    assert profile.panel_balance(df, "e", "t").first().missing_entries == 0


def test_missing_cells_read_the_rows_once(spark, tmp_path):
    spark.createDataFrame([(i % 50, i % 7) for i in range(300)], "e int, t int").write.parquet(str(tmp_path / "p"))
    df = spark.read.parquet(str(tmp_path / "p"))
    out = missing_cells(df, "e", "t")
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan and "Window" not in plan and "hashpartitioning(t#" not in plan
    final = plan[: plan.rindex("== Initial Plan ==")]  # the main plan's; the subquery has its own inside
    ran = re.sub(r"== Initial Plan ==.*?(?=== Final Plan ==|\Z)", "", final, flags=re.S)
    assert ran.count("FileScan") <= 1
