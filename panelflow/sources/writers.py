"""Sinks: versioned saves, run registry, exports."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelflow.sources.storage import children, exists, is_local, publish


def next_name(taken, name: str) -> str:
    """``name``, else ``name_1``, ``name_2`` and so on."""
    if not taken(name):
        return name
    i = 1
    while taken(f"{name}_{i}"):
        i += 1
    return f"{name}_{i}"


def save_csv(df: DataFrame, folder: str, name: str) -> str:
    """Write a CSV dataset under a name that is still free; returns its path.

    The name is claimed by a file that only one writer can create. A writer that dies leaves its claim, and the name unused.
    """
    if not name:
        raise ValueError("a CSV save needs a name")
    spark = df.sparkSession
    base = name.removesuffix(".csv")
    free = next_name(lambda n: exists(spark, f"{folder}/{n}.csv") or not publish(spark, f"{folder}/_claims/{n}", n), base)
    path = f"{folder}/{free}.csv"
    df.write.mode("errorifexists").option("header", True).csv(path)
    return path


def _text_files(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        disk, top = fs.FileSystem.from_uri(folder)
        at, out, written = None, None, 0

        def close():
            out.close()
            disk.move(f"{top}/.{at}", f"{top}/{at}.txt")  # a task that runs twice leaves one whole file

        for b in batches:
            for name, value in zip(b.column(0), b.column(1), strict=True):
                if (name := name.as_py()) != at:
                    if out:
                        close()
                    at, out, written = name, disk.open_output_stream(f"{top}/.{name}"), written + 1
                out.write((value.as_py() + "\n").encode("utf-8"))
        if out:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([written], pa.int64())], names=["files"])

    return run


def save_texts(df: DataFrame, folder: str, by: str) -> int:
    """One text file below the folder for each value of `by` (null is one too), a line for each row's `value` (null: empty); how many files.

    Spark's writer makes a folder for each value. On a local disk every folder, file and checksum costs it a process, and a
    listing reads folder by folder; so there the tasks write the files into one folder themselves.
    """
    if not is_local(df.sparkSession, folder):
        df.repartition(by).write.partitionBy(by).text(folder)
        return df.select(F.coalesce(F.col(by).cast("string"), F.lit(""))).distinct().count()
    uri = folder if "://" in folder else f"file://{folder}" if folder.startswith("/") else folder
    disk, top = fs.FileSystem.from_uri(uri)
    disk.create_dir(top)
    d = df.select(F.concat(F.lit(f"{by}-"), F.coalesce(F.col(by).cast("string"), F.lit("null"))).alias("name"), F.coalesce("value", F.lit("")))
    d = d.repartition("name").sortWithinPartitions("name")
    return d.mapInArrow(_text_files(uri), "files long").agg(F.sum("files")).first()[0] or 0


def save_table(df: DataFrame, name: str) -> str:
    """Save as a catalog table under a free name; an empty frame is an error."""
    if df.isEmpty():
        raise ValueError("refusing to save an empty table")
    free = next_name(df.sparkSession.catalog.tableExists, name)
    df.write.mode("errorifexists").saveAsTable(free)
    return free


def next_run_id(spark: SparkSession, path: str) -> int:
    """One above the highest run; ids of removed runs are not used again."""
    runs = [int(n.split("=")[1]) for n in children(spark, path) if n.startswith("run_id=")]
    return max(runs, default=0) + 1


def first_free_run_id(spark: SparkSession, path: str) -> int:
    """The lowest unused id, filling holes."""
    runs = {int(n.split("=")[1]) for n in children(spark, path) if n.startswith("run_id=")}
    i = 1
    while i in runs:
        i += 1
    return i


def save_run(df: DataFrame, path: str, parameters: dict[str, str] | None = None) -> int:
    """Store results, and their parameters, below the next run id.

    The id is claimed by a file that only one writer can create, so two writers never share one.
    """
    spark = df.sparkSession
    run = next_run_id(spark, f"{path}/results")
    while not publish(spark, f"{path}/_claims/{run}", str(run)):
        run += 1
    df.write.mode("errorifexists").parquet(f"{path}/results/run_id={run}")
    if parameters:
        rows = [(k, str(v)) for k, v in parameters.items()]
        spark.createDataFrame(rows, "name string, value string").write.mode("errorifexists").parquet(
            f"{path}/parameters/run_id={run}"
        )
    return run


def flat_text(df: DataFrame) -> DataFrame:
    """Sorted columns, all as text; nested values as JSON."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    out = []
    for f in sorted(df.schema.fields, key=lambda f: f.name):
        c = F.to_json(f.name) if isinstance(f.dataType, nested) else F.col(f.name).cast("string")
        out.append(c.alias(f.name))
    return df.select(*out)


def export_documents(spark: SparkSession, source: str, target: str) -> str:
    """Documents with differing keys to CSV: the union of keys, sorted."""
    df = spark.read.json(source)
    flat_text(df).write.mode("errorifexists").option("header", True).csv(target)
    return target
