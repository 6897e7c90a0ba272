"""Shared helpers of the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Rows that one Arrow batch brings to a Python worker; documents may be very long.
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound what a Python worker holds at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def batch(names: list[str], columns: list, types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names
    )


def texts(b: pa.RecordBatch, column: int = 1) -> Iterator[str | None]:
    """The texts of a batch, one at a time."""
    return (v.as_py() for v in b.column(column))
