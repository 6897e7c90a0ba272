"""Catalog operations: listing, idempotent loads, refresh copies, entity search."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelflow.sources.readers import read_csv
from panelflow.sources.storage import children


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, rows) for every table, as one query."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        out = one if out is None else out.unionByName(one)
    return out


def catalog_tables(spark: SparkSession, database: str | None = None) -> dict[str, DataFrame]:
    listed = spark.catalog.listTables(database) if database else spark.catalog.listTables()
    return {t.name: spark.table(f"{database}.{t.name}" if database else t.name) for t in listed if not t.isTemporary}


def load_if_absent(spark: SparkSession, df: DataFrame, table: str, protected: Iterable[str] = ()) -> str:
    """Create a table unless it has rows already. Returns what was done."""
    if table in set(protected):
        return "protected"
    if spark.catalog.tableExists(table) and not spark.table(table).isEmpty():
        return "present"
    if df.isEmpty():
        return "empty"
    df.write.mode("overwrite").saveAsTable(table)
    return "loaded"


MANIFEST_SCHEMA = "file string, table string, rows long, columns int, loaded_at timestamp"


def record_load(spark: SparkSession, manifest: str, file: str, table: str) -> None:
    """Append one manifest row; readers take the newest row per file."""
    row = spark.table(table).agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(file).alias("file"),
        F.lit(table).alias("table"),
        "rows",
        F.lit(len(spark.table(table).columns)).alias("columns"),
        F.current_timestamp().alias("loaded_at"),
    )
    row.write.mode("append").saveAsTable(manifest)


def read_manifest(spark: SparkSession, manifest: str) -> DataFrame:
    d = spark.table(manifest)
    rest = [c for c in d.columns if c != "file"]
    latest = d.groupBy("file").agg(F.max_by(F.struct(*rest), "loaded_at").alias("_m"))
    return latest.select("file", "_m.*")


def sync_csv_files(
    spark: SparkSession,
    files: Mapping[str, str],
    manifest: str,
    protected: Iterable[str] = (),
    reader: Callable[[SparkSession, str], DataFrame] = read_csv,
) -> dict[str, str]:
    """Load each path into its table once; the outcome per path."""
    done = {}
    for path, table in files.items():
        done[path] = load_if_absent(spark, reader(spark, path), table, protected)
        if done[path] == "loaded":
            record_load(spark, manifest, path.rsplit("/", 1)[-1], table)
    return done


def sync_csv_directory(
    spark: SparkSession, folder: str, manifest: str, protected: Iterable[str] = (), prefix: str = ""
) -> dict[str, str]:
    """Load every ``*.csv`` of a folder into the table of its name; the outcome per path."""
    names = [n for n in children(spark, folder) if n.endswith(".csv")]
    files = {f"{folder}/{n}": prefix + n.removesuffix(".csv") for n in names}
    return sync_csv_files(spark, files, manifest, protected)


def refresh_copy(source: Mapping[str, DataFrame], target: str) -> dict[str, bool]:
    """Replace each target table by its source; an empty source keeps the target."""
    done = {}
    for name, df in source.items():
        done[name] = not df.isEmpty()
        if done[name]:
            df.write.mode("overwrite").parquet(f"{target}/{name}")
    return done


def tables_with_entity(tables: Mapping[str, DataFrame], column: str, name: str) -> DataFrame:
    """(table, rows) of the tables that hold the entity, as one query."""
    out = None
    for t, df in tables.items():
        if column not in df.columns:
            continue
        one = df.where(F.col(column) == name).agg(F.count(F.lit(1)).alias("rows"))
        one = one.select(F.lit(t).alias("table"), "rows")
        out = one if out is None else out.unionByName(one)
    if out is None:
        raise ValueError(f"no table has a column {column}")
    return out.where(F.col("rows") > 0)


def entity_rows(df: DataFrame, column: str, name: str, time: str) -> DataFrame:
    return df.where(F.col(column) == name).orderBy(time)


def entity_stats(df: DataFrame, column: str, name: str, value: str) -> DataFrame:
    return df.where(F.col(column) == name).agg(
        F.min(value).alias("min"), F.max(value).alias("max"), F.avg(value).alias("avg")
    )
