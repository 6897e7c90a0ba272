"""Continuous tick ingest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelflow.operators.features import bars
from panelflow.sources.ticks import ticks_from_lines


def tick_log_stream(spark: SparkSession, path: str, source: str = "live", files_per_trigger: int | None = None) -> DataFrame:
    """Growing log files as a tick stream; the checkpoint takes the place of file offsets."""
    r = spark.readStream
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    return ticks_from_lines(r.text(path), source)


def event_time(df: DataFrame, ts: str) -> DataFrame:
    """Watermarks need a timestamp with a zone; zone-free input is taken as UTC."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def distinct_ticks(ticks: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """First arrival per (instrument, ts). State is kept for ``delay`` of event time."""
    return event_time(ticks, "ts").withWatermark("ts", delay).dropDuplicatesWithinWatermark(["instrument", "ts"])


def bar_stream(ticks: DataFrame, size: str, delay: str = "10 minutes") -> DataFrame:
    return bars(event_time(ticks, "ts").withWatermark("ts", delay), ["instrument"], "ts", "mid", size)


def drain(stream: DataFrame, path: str, checkpoint: str, partition_by: tuple[str, ...] = ()) -> None:
    """Process all available input into Parquet, exactly once per checkpoint."""
    w = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.trigger(availableNow=True).start(path).awaitTermination()
