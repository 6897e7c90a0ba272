"""Session helpers: time zone, and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def pin_utc(spark: SparkSession) -> None:
    """Timestamps are compared across engines as UTC instants."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints; a temp folder only on a local master."""
    named = spark.conf.get(CHECKPOINT_CONF, None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder every executor can reach")
    spark.conf.set(CHECKPOINT_CONF, tempfile.mkdtemp(prefix="panelflow-"))
    return spark.conf.get(CHECKPOINT_CONF)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialised(df: DataFrame, label: str) -> DataFrame:
    """Write a frame that several jobs will read, and read it back.

    It cuts the lineage, and the files outlive lost executors.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
