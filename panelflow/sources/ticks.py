"""Tick logs and OHLC files to one tick schema, and their append-merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelflow.functions.scalars import mid, parse_ts, spread, stem
from panelflow.operators.clean import dedupe, split_tick_fields, valid_ticks
from panelflow.session import materialised
from panelflow.sources.storage import exists

# The headerless bar file's columns and the tick columns.
BAR_SCHEMA = "date string, time string, open double, high double, low double, close double, volume double"
TICK_COLUMNS = ("ts", "instrument", "bid", "ask", "mid", "spread", "source")


def _tick_fields(lines: DataFrame) -> DataFrame:
    d = split_tick_fields(lines)
    return d.withColumn("ts", parse_ts("ts_text"))


def ticks_from_lines(lines: DataFrame, source: str = "live") -> DataFrame:
    """Lines ``ts|instrument|bid|ask`` to ticks; bad lines are left out (see ``rejects``).

    Works on batch and streaming input.
    """
    d = valid_ticks(_tick_fields(lines)).where(F.col("ts").isNotNull())
    extra = [c for c in lines.columns if c != "value"]
    return d.select(
        "ts", "instrument", "bid", "ask",
        mid("bid", "ask").alias("mid"),
        spread("bid", "ask").alias("spread"),
        F.lit(source).alias("source"),
        *extra,
    )


def rejects(lines: DataFrame) -> DataFrame:
    """The lines ``ticks_from_lines`` leaves out, with the reason."""
    d = _tick_fields(lines)
    reason = (
        F.when(F.size("parts") != 4, "field count")
        .when(F.col("bid").isNull() | F.col("ask").isNull(), "price not numeric")
        .when(F.col("bid") <= 0, "bid not positive")
        .when(F.col("ask") < F.col("bid"), "ask below bid")
        .when(F.col("ts").isNull(), "bad time")
    )
    return d.select("value", reason.alias("reason")).where(F.col("reason").isNotNull())


def read_tick_logs(spark: SparkSession, path: str, source: str = "live") -> DataFrame:
    return ticks_from_lines(spark.read.text(path), source)


def ticks_from_bars(bars: DataFrame, instrument: str | Column, source: str = "historical") -> DataFrame:
    """Bars to ticks: bid = ask = mid = close, spread = high - low; bad times left out."""
    name = F.lit(instrument) if isinstance(instrument, str) else instrument
    d = bars.withColumn("ts", parse_ts(F.concat_ws(" ", F.translate("date", ".", "-"), "time")))
    close = F.col("close")
    return d.where(F.col("ts").isNotNull()).select(
        "ts", name.alias("instrument"), close.alias("bid"), close.alias("ask"), close.alias("mid"),
        (F.col("high") - F.col("low")).alias("spread"), F.lit(source).alias("source"),
    )


def read_bar_csv(spark: SparkSession, path: str, instrument: str | None = None, source: str = "historical") -> DataFrame:
    """Headerless bar files; without a name the instrument is the file stem."""
    d = spark.read.schema(BAR_SCHEMA).csv(path)
    if instrument is None:
        d = d.select("*", stem("_metadata.file_name").alias("_stem"))
    return ticks_from_bars(d, instrument if instrument is not None else F.col("_stem"), source)


def stored_prices(ticks: DataFrame) -> DataFrame:
    """Prices as float for storage; all arithmetic before this is in double."""
    return ticks.withColumns({c: F.col(c).cast("float") for c in ("bid", "ask", "mid", "spread") if c in ticks.columns})


def unique_ticks(ticks: DataFrame, keep: str = "first") -> DataFrame:
    """One row per (ts, instrument): the first or the last batch, then by bid and ask."""
    return dedupe(ticks, ["ts", "instrument"], ["seq", "bid", "ask"], keep)


# Partitions of a batch that are named in the read one by one; beyond that the range of dates is.
NAMED_PARTITIONS = 5000


def touched_partitions(batch: DataFrame) -> Column:
    """A condition on (instrument, date) that holds for every partition of the batch's rows.

    It is made of literals, so Spark leaves out all other partitions when it plans the scan. A batch with
    more partitions than ``NAMED_PARTITIONS`` gives the range of its dates, which is wider but still prunes.
    """
    pairs = batch.select("instrument", "date").distinct()
    named = pairs.limit(NAMED_PARTITIONS + 1).collect()
    if len(named) > NAMED_PARTITIONS:
        low, high = pairs.agg(F.min("date"), F.max("date")).first()
        return F.col("date").between(F.lit(low), F.lit(high)) | F.col("date").isNull()
    dates: dict = {}
    for r in named:
        dates.setdefault(r["instrument"], set()).add(r["date"])
    out = F.lit(False)
    for instrument, days in dates.items():
        known = sorted(d for d in days if d is not None)
        on = F.col("date").isin(known) if known else F.lit(False)
        on = on | F.col("date").isNull() if None in days else on
        out = out | (F.col("instrument").eqNullSafe(F.lit(instrument)) & on)
    return out


def stored_partitions(spark: SparkSession, path: str, batch: DataFrame) -> DataFrame:
    """The stored rows of the partitions that ``batch`` (with instrument and date) touches; no other file is opened."""
    # Folder names are read as the batch's types: an instrument named 007 is no number.
    kept = {f.name: f for f in batch.schema if f.name in ("instrument", "date")}
    schema = T.StructType([kept.get(f.name, f) for f in spark.read.parquet(path).schema])
    old = spark.read.schema(schema).parquet(path).where(touched_partitions(batch))
    return old.join(batch.select("instrument", "date").distinct(), ["instrument", "date"], "left_semi")


def append_merge(spark: SparkSession, new: DataFrame, path: str, keep: str = "first") -> None:
    """Merge ticks into a table partitioned by instrument and date.

    Only the partitions the new rows touch are read and rewritten. The batch is written first, so that it is evaluated
    once; the merged rows go to a staging folder too, since a table cannot be overwritten while it is read. Output
    partitions are rebalanced by size, so a large instrument is written by many tasks.
    """
    new = materialised(new.withColumn("date", F.to_date("ts")), "tick-batch")
    merged = new
    if exists(spark, path):
        merged = stored_partitions(spark, path, new).unionByName(new, allowMissingColumns=True)
    unique = materialised(unique_ticks(merged, keep), "tick-merge")
    (
        unique.hint("rebalance", "instrument", "date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("instrument", "date")
        .parquet(path)
    )
