"""Filters, membership, set operations and splits."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from panelflow.functions.scalars import is_finite, safe_double
from panelflow.plans.series import Series, positions, public
from panelflow.session import materialised


def require_columns(df: DataFrame, needed: Iterable[str]) -> DataFrame:
    absent = [c for c in needed if c not in df.columns]
    if absent:
        raise ValueError(f"missing columns: {', '.join(absent)}")
    return df


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def features_and_target(df: DataFrame) -> tuple[list[str], str]:
    """The last numeric column is the target, the others are features."""
    numeric = numeric_columns(df)
    if not numeric:
        raise ValueError("no numeric column to use as target")
    return numeric[:-1], numeric[-1]


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return require_columns(df, columns).select(*columns)


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull())


def finite(df: DataFrame, column: str) -> DataFrame:
    return df.where(is_finite(column))


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def predicate_counts(df: DataFrame, predicates: dict[str, Column]) -> DataFrame:
    return df.agg(*[F.count_if(p).alias(name) for name, p in predicates.items()])


def valid_ticks(fields: DataFrame) -> DataFrame:
    """Keep lines of four fields with numeric prices, bid > 0 and ask >= bid."""
    return fields.where(
        (F.size("parts") == 4) & (F.col("bid") > 0) & (F.col("ask") >= F.col("bid"))
    )


def split_tick_fields(lines: DataFrame, column: str = "value") -> DataFrame:
    parts = F.split(F.trim(F.col(column)), r"\|")
    d = lines.withColumn("parts", parts)
    return d.withColumns(
        {
            "ts_text": F.get("parts", F.lit(0)),
            "instrument": F.get("parts", F.lit(1)),
            "bid": safe_double(F.get("parts", F.lit(2))),
            "ask": safe_double(F.get("parts", F.lit(3))),
        }
    )


def drop_all_missing(df: DataFrame, entity: str, critical: Sequence[str]) -> DataFrame:
    """Remove entities for which a critical column has no value at all."""
    critical = [c for c in critical if c in df.columns]
    if not critical:
        return df
    keep = df.groupBy(entity).agg(*[F.count(c).alias(f"_n_{c}") for c in critical])
    for c in critical:
        keep = keep.where(F.col(f"_n_{c}") > 0)
    return df.join(keep.select(entity), entity, "left_semi")


def min_observations(df: DataFrame, entity: str, least: int) -> DataFrame:
    keep = df.groupBy(entity).count().where(F.col("count") >= least).select(entity)
    return df.join(keep, entity, "left_semi")


def year_split(df: DataFrame, time: str, split: int) -> DataFrame:
    return df.withColumn("is_train", F.col(time) <= split)


def fraction_split(df: DataFrame, s: Series, fraction: float, least: int = 0) -> DataFrame:
    """First ``floor(n * fraction)`` rows of each key are training rows.

    Keys with fewer than ``least`` training rows are left out.
    """
    d = positions(df, s, count="_n")
    cut = F.floor(F.col("_n") * F.lit(fraction))
    d = d.where(cut >= least).withColumn("is_train", F.col("_pos") < cut)
    return public(d).drop("_n")


def holdout_split(df: DataFrame, s: Series, last: int, least: int = 3) -> DataFrame:
    """The last ``last`` rows of each key are held out; keys need ``least`` others."""
    d = positions(df, s, count="_n")
    cut = F.col("_n") - F.lit(last)
    d = d.where(cut >= least).withColumn("is_train", F.col("_pos") < cut)
    return public(d).drop("_n")


def period_split(df: DataFrame, time: str, test: int, validation: int) -> DataFrame:
    """Last ``test`` distinct periods are test, the ``validation`` before them validation."""
    periods = df.select(time).distinct()
    w = W.orderBy(F.col(time).desc())  # one row per distinct period
    r = F.row_number().over(w)
    named = periods.select(
        time,
        F.when(r <= test, "test").when(r <= test + validation, "validation").otherwise("train").alias("part"),
    )
    return df.join(materialised(named, "periods"), time)


def members_only(df: DataFrame, column: str, names: DataFrame | Sequence | None) -> DataFrame:
    """Keep rows whose entity is in the list; an empty list keeps everything.

    A table of names is not broadcast by hint: its size is unknown here, so Spark
    decides from statistics at run time.
    """
    if names is None:
        return df
    if isinstance(names, DataFrame):
        if names.isEmpty():
            return df
        col = names.columns[0]
        return df.join(names.select(F.col(col).alias(column)).distinct(), column, "left_semi")
    names = list(names)
    return df.where(F.col(column).isin(names)) if names else df


def member_match(df: DataFrame, column: str, names: DataFrame) -> DataFrame:
    """How many entries of the list occur in the data."""
    col = names.columns[0]
    wanted = names.select(F.col(col).alias(column)).distinct()
    found = wanted.join(df.select(column).distinct(), column, "left_semi")
    listed = wanted.agg(F.count(F.lit(1)).alias("listed"))
    return found.agg(F.count(F.lit(1)).alias("matched")).select(
        listed.scalar().alias("listed"), "matched"
    )


def skip_present(df: DataFrame, seen: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(seen, list(keys), "left_anti")


def assemble(tables: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Wide panel from per-indicator tables; gaps stay."""
    out = tables[0]
    for t in tables[1:]:
        out = out.join(t, list(keys), "full")
    return out


def union(*tables: DataFrame) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def entities_lost(before: DataFrame, after: DataFrame, entity: str) -> DataFrame:
    return before.select(entity).subtract(after.select(entity))


def entities_common(a: DataFrame, b: DataFrame, entity: str) -> DataFrame:
    return a.select(entity).intersect(b.select(entity))


def dedupe(
    df: DataFrame, keys: Sequence[str], sequence: Sequence[str], keep: str = "first"
) -> DataFrame:
    """One row per key: the first or last in ``sequence`` order.

    An aggregate with map-side combine rather than a window, so a key with very many
    copies is reduced before the shuffle.
    """
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    rest = [c for c in df.columns if c not in keys]
    lead = list(sequence) + [c for c in rest if c not in sequence]
    pick = F.min if keep == "first" else F.max
    out = df.groupBy(*keys).agg(pick(F.struct(*lead)).alias("_row"))
    return out.select(*[F.col(c) if c in keys else F.col(f"_row.{c}") for c in df.columns])


def sample_entities(df: DataFrame, entity: str, n: int, seed: int = 42) -> DataFrame:
    """A seeded random choice of n distinct entities, stable under repartitioning."""
    h = F.xxhash64(F.col(entity), F.lit(seed))
    return df.select(entity).distinct().orderBy(h, entity).limit(n)


def sample_per_key(df: DataFrame, keys: Sequence[str], ids: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """A random sample of n rows per key (all rows of smaller keys), by seeded hash of the ids.

    The n lowest hashes of a key are its sample. Rows whose hash is far above the expected
    n-th lowest are dropped where they lie, so only about n rows per key are shuffled and
    ranked. The margin of ten standard deviations keeps the sample at n rows.
    """
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"))
    h = F.xxhash64(*ids, F.lit(seed))
    share = h / F.lit(2.0**64) + 0.5
    d = df.join(sizes, list(keys)).withColumn("_h", h)
    d = d.where(share * F.col("_size") <= n + 10 * n**0.5)
    w = W.partitionBy(*keys).orderBy("_h", *ids)
    d = d.withColumn("_pick", F.row_number().over(w)).where(F.col("_pick") <= n)
    return d.drop("_pick", "_h", "_size")


def seeded_split(df: DataFrame, ids: Sequence[str], percent: int = 80, seed: int = 42) -> DataFrame:
    """Random split by hash of the row id: the same row always falls on the same side."""
    return df.withColumn(
        "is_train", F.pmod(F.xxhash64(*ids, F.lit(seed)), F.lit(100)) < percent
    )
