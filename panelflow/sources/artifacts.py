"""Incremental catalog of result files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelflow.functions.scalars import base_name, extension, relative_path
from panelflow.operators.clean import skip_present
from panelflow.sources.storage import exists

# Extensions by class.
IMAGE = ("png", "jpg", "jpeg", "gif")
TEXT = ("txt", "csv", "json", "log")


def list_artifacts(spark: SparkSession, root: str) -> DataFrame:
    """(path, file_path, file_name, file_type, size_bytes) of every file below the root; no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length")
    ext = extension("path")
    kind = F.when(ext.isin(*IMAGE), "image").when(ext.isin(*TEXT), "text").otherwise("unsupported")
    return files.select(
        "path",
        relative_path("path", root).alias("file_path"),
        base_name("path").alias("file_name"),
        kind.alias("file_type"),
        F.col("length").alias("size_bytes"),
    )


def with_contents(spark: SparkSession, root: str, listed: DataFrame, whole: bool = False) -> DataFrame:
    """The listed files with their content; the scan is given only their paths, or the root if most files are listed (`whole`).

    Every path that a scan is given costs a look-up of its own.
    """
    names = [] if whole else [r["path"] for r in listed.select("path").toLocalIterator()]
    if whole:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    else:
        files = spark.read.format("binaryFile").load(names) if names else spark.read.format("binaryFile").load(root).where("false")
    d = listed.join(files.select("path", F.col("content").alias("_bytes")), "path")
    # Text that is not valid UTF-8 keeps its bytes instead of failing the other files.
    text = F.when(F.col("file_type") == "text", F.try_validate_utf8(F.col("_bytes").cast("string")))
    return d.select(
        "file_path", "file_name", "file_type", "size_bytes",
        text.alias("content"),
        F.when(text.isNull(), F.col("_bytes")).alias("binary"),
        F.current_timestamp().alias("created_at"),
    )


def scan_artifacts(spark: SparkSession, root: str) -> DataFrame:
    """Every file below the root with its class, size and content."""
    return with_contents(spark, root, list_artifacts(spark, root), whole=True)


def sync_artifacts(spark: SparkSession, root: str, catalog: str) -> int:
    """Add files whose path is not cataloged yet; returns how many were added.

    Files are told apart by their listing, and only those to add are opened. Their paths pass
    the driver, as the paths of any scan do. The first time all are to add, so the root is scanned.
    """
    found, old = list_artifacts(spark, root).where(F.col("file_type") != "unsupported"), exists(spark, catalog)
    if old:
        found = skip_present(found, spark.read.parquet(catalog).select("file_path"), ["file_path"])
    found = found.cache()
    try:
        added = found.count()
        if added:
            with_contents(spark, root, found, whole=not old).write.mode("append").parquet(catalog)
    finally:
        found.unpersist()
    return added
