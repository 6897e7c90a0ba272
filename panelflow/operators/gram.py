"""All pairwise-complete correlations in one scan, by masked Gram matrices.

With X the values, zero where one is missing, and M the mask of present ones, the sums that a pair's rows give are entries of
matrix products: their number M'M, sums X'M, squares (X*X)'M and products X'X. Each task adds up its Arrow batches and leaves one row for
each pair of columns; rows add up. So p columns cost one scan and p (p + 1) / 2 small rows a task, whatever values are missing.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelflow.plans.series import Series

#: Rows that are looked at for a value near each column's values.
PEEK = 1000
SUMS = ("n", "sx", "sy", "sxx", "syy", "sxy")
#: A variance below this share of the mean square about the column's centre is rounding: the column is constant.
FLAT = 1e-14


def centres(df: DataFrame, columns: Sequence[str]) -> list[float]:
    """A finite value of each column, or 0. Sums are taken of differences from it, so that nothing large cancels.

    Any value does: correlations don't depend on it, and a constant column's differences are exactly 0.
    """
    number = lambda c: F.when(F.abs(F.col(c).cast("double")) < float("inf"), F.col(c).cast("double"))
    peek = df.limit(PEEK).agg(*[F.first(number(c), ignorenulls=True).alias(f"c{i}") for i, c in enumerate(columns)])
    return [v or 0.0 for v in peek.first()]


def _sums(centre: list[float]):
    shift, (i, j) = np.array(centre), np.triu_indices(len(centre))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.columns]).astype(np.float64)
            m = (~np.isnan(x)).astype(np.float64)
            x = np.where(m > 0, x - shift, 0.0)
            sx, sxx = x.T @ m, (x * x).T @ m
            one = np.stack([(m.T @ m)[i, j], sx[i, j], sx.T[i, j], sxx[i, j], sxx.T[i, j], (x.T @ x)[i, j]])
            total = one if total is None else total + one
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), *map(pa.array, total)], names=["i", "j", *SUMS])

    return run


def pair_sums(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(i, j, n, sx, sy, sxx, syy, sxy) for i <= j: sums over the rows that have both columns, about their centres.

    NaN counts as missing; an infinite value makes its pairs' sums infinite or NaN, so their correlations are NULL.
    """
    numbers = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    shape = "i int, j int, " + ", ".join(f"{s} double" for s in SUMS)
    parts = numbers.mapInArrow(_sums(centres(df, columns)), shape)
    return parts.groupBy("i", "j").agg(*[F.sum(s).alias(s) for s in SUMS])


def _r() -> Column:
    n = F.col("n")
    vx, vy = (F.col(f"s{a}{a}") - F.try_divide(F.col(f"s{a}") * F.col(f"s{a}"), n) for a in "xy")
    vary = (vx > F.col("sxx") * FLAT) & (vy > F.col("syy") * FLAT)
    r = (F.col("sxy") - F.try_divide(F.col("sx") * F.col("sy"), n)) / F.sqrt(vx * vy)
    return F.when(vary & ~F.isnan(r), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))


def pairwise_correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(var1, var2, n, r), both triangles; r is NULL if a column is constant on the pair's rows, which are n.

    An empty table gives no row.
    """
    columns = list(columns)
    names = F.array(*[F.lit(c) for c in columns])
    d = pair_sums(df, columns).select("i", "j", F.col("n").cast("long").alias("n"), _r().alias("r"))
    both = F.array(F.struct("i", "j"), F.struct(F.col("j").alias("i"), F.col("i").alias("j")))
    d = d.select(F.explode(F.array_distinct(both)).alias("at"), "n", "r")
    return d.select(F.get(names, F.col("at.i")).alias("var1"), F.get(names, F.col("at.j")).alias("var2"), "n", "r")


def best_partners(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(var1, var2, abs_r): for every column the other one with the largest |r|; of equals the first by name."""
    d = pairwise_correlations(df, columns).where("var1 != var2 and r is not null")
    best = d.groupBy("var1").agg(F.min(F.struct((-F.abs("r")).alias("least"), "var2")).alias("b"))
    return best.select("var1", F.col("b.var2").alias("var2"), (-F.col("b.least")).alias("abs_r"))


def difference_correlations(df: DataFrame, s: Series, columns: Sequence[str]) -> DataFrame:
    """Correlations of the changes from one period of an entity to its next."""
    from panelflow.operators.features import differences

    d = differences(df, s, columns)
    return pairwise_correlations(d.select(*[F.col(f"{c}_diff").alias(c) for c in columns]), columns)
