"""Table scans: CSV, Parquet, JSON documents, directories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelflow.functions.scalars import as_text, stem
from panelflow.sources.storage import require

BOM = "﻿"


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing means NULL only."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, sep: str = ",") -> DataFrame:
    """CSV with a header. Give a schema in production: inference reads the data twice."""
    r = spark.read.option("header", True).option("sep", sep).option("nanValue", "NaN")
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    return nan_to_null(r.csv(require(spark, path)))


def read_csv_sniffed(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with ',' or ';' and an optional byte-order mark, told from the header line."""
    head = spark.read.text(require(spark, path)).limit(1).collect()
    line = head[0][0].lstrip(BOM) if head else ""
    sep = ";" if ";" in line and "," not in line else ","
    df = read_csv(spark, path, schema, sep)
    return df.toDF(*[c.lstrip(BOM) for c in df.columns])


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Column subset of a Parquet table. Order belongs to the window that needs it."""
    df = spark.read.parquet(require(spark, path))
    return df.select(*columns) if columns else df


def read_documents(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    where: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """JSON documents with filter and limit; ``_id`` becomes text."""
    r = spark.read.schema(schema) if schema is not None else spark.read
    df = r.json(require(spark, path))
    if "_id" in df.columns:
        df = df.withColumn("_id", as_text("_id"))
    if where:
        df = df.where(where)
    return df.limit(limit) if limit else df


def parse_documents(df: DataFrame, column: str, schema: str, where: str | None = None, limit: int | None = None) -> DataFrame:
    """JSON text in a column to its fields."""
    d = df.withColumn("_doc", F.from_json(column, schema)).select(*[c for c in df.columns if c != column], "_doc.*")
    if where:
        d = d.where(where)
    return d.limit(limit) if limit else d


def read_directory(spark: SparkSession, pattern: str, schema: T.StructType | str, name: str = "instrument", **options) -> DataFrame:
    """All CSV files of a directory, with the file stem as a column."""
    df = spark.read.options(**options).schema(schema).csv(pattern)
    return df.select("*", stem("_metadata.file_name").alias(name))
