"""Least squares per group from one aggregate pass.

``moments`` collects means, centred (co)variances and the count with Spark's own
covariance aggregates. They merge partial results stably, so columns of very different
size need no pre-scaling, and a group of any length is reduced before the shuffle. Only
the small system of each group is solved in a pandas UDF.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RANK_TOLERANCE = 1e-10


def _sum(cols: Sequence[Column]) -> Column:
    out = cols[0]
    for c in cols[1:]:
        out = out + c
    return out


def complete_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    cond = None
    for c in columns:
        e = F.col(c).isNotNull()
        cond = e if cond is None else cond & e
    return df.where(cond)


def moments(df: DataFrame, keys: Sequence[str], y: str, xs: Sequence[str], extra: Sequence[Column] = ()) -> DataFrame:
    """n, means and centred second moments of complete rows, one row per group."""
    d = complete_rows(df, [y, *xs])
    v = {c: F.col(c).cast("double") for c in [y, *xs]}
    aggs = [
        F.count(F.lit(1)).alias("n"),
        F.avg(v[y]).alias("y_mean"),
        F.var_pop(v[y]).alias("y_var"),
        F.array(*[F.avg(v[x]) for x in xs]).alias("x_mean"),
        F.array(*[F.covar_pop(v[x], v[y]) for x in xs]).alias("x_y"),
        F.array(
            *[F.covar_pop(v[a], v[b]) for i, a in enumerate(xs) for b in xs[i:]]
        ).alias("x_x"),
        *extra,
    ]
    return d.groupBy(*keys).agg(*aggs)


def _full(flat: np.ndarray, k: int) -> np.ndarray:
    s = np.zeros((k, k))
    s[np.triu_indices(k)] = flat
    return s + s.T - np.diag(np.diag(s))


def solve_centred(flat, xy, k: int, ridge: float = 0.0):
    return solve_system(_full(np.asarray(flat, float), k), np.asarray(xy, float), ridge)


def solve_system(s: np.ndarray, b: np.ndarray, ridge: float = 0.0):
    """Slope vector of a centred system, or None when it is singular.

    The system is brought to correlation scale first; ``ridge`` is added on that scale.
    """
    m = len(b)
    scale = np.sqrt(np.maximum(np.diag(s), 0.0))
    if not np.all(np.isfinite(s)) or (np.any(scale <= 0) and not ridge):
        return None
    # A constant column has no slope; with a ridge it gets 0 instead of failing the group.
    used = scale > 0
    scale = np.where(used, scale, 1.0)
    c = s / np.outer(scale, scale) + ridge * np.eye(m)
    if np.linalg.eigvalsh(c)[0] < min(RANK_TOLERANCE, ridge or RANK_TOLERANCE) / 2:
        return None
    return np.where(used, np.linalg.solve(c, b / scale) / scale, 0.0)


FIT = T.StructType(
    [
        T.StructField("coef", T.ArrayType(T.DoubleType())),
        T.StructField("intercept", T.DoubleType()),
        T.StructField("sse", T.DoubleType()),
        T.StructField("r2", T.DoubleType()),
        T.StructField("se", T.ArrayType(T.DoubleType())),
    ]
)


def _fit_udf(ridge: float):
    @F.pandas_udf(FIT)
    def fit(n: pd.Series, ym: pd.Series, yv: pd.Series, xm: pd.Series, xy: pd.Series, xx: pd.Series) -> pd.DataFrame:
        rows = []
        for cnt, ybar, yvar, xbar, cxy, cxx in zip(n, ym, yv, xm, xy, xx, strict=True):
            k = len(cxy)
            beta = solve_centred(cxx, cxy, k, ridge=ridge) if cnt > k or ridge else None
            if beta is None:
                rows.append((None, None, None, None, None))
                continue
            s, b = _full(np.asarray(cxx, float), k), np.asarray(cxy, float)
            rss = max(float(yvar - 2 * beta @ b + beta @ s @ beta), 0.0)
            r2 = 1 - rss / yvar if yvar > 0 else None
            se = None
            if cnt > k + 1 and not ridge:
                inv = np.diag(np.linalg.inv(s))
                se = np.sqrt(np.maximum(inv, 0) * rss / (cnt - k - 1)).tolist()
            rows.append((beta.tolist(), float(ybar - beta @ np.asarray(xbar, float)), rss * cnt, r2, se))
        return pd.DataFrame(rows, columns=["coef", "intercept", "sse", "r2", "se"])

    return fit


def fit_moments(m: DataFrame, ridge: float = 0.0) -> DataFrame:
    fit = _fit_udf(ridge)
    cols = ["n", "y_mean", "y_var", "x_mean", "x_y", "x_x"]
    d = m.withColumn("_fit", fit(*cols))
    keep = [c for c in m.columns if c not in cols[1:]]
    return d.select(*keep, "_fit.*")


def ols(df: DataFrame, keys: Sequence[str], y: str, xs: Sequence[str], ridge: float = 0.0) -> DataFrame:
    """coef (array in the order of xs), intercept, sse, r2, se per group.

    A singular group, or one with no spare observation, gets NULLs.
    """
    return fit_moments(moments(df, keys, y, xs), ridge)


def ols_long(fit: DataFrame, keys: Sequence[str], xs: Sequence[str]) -> DataFrame:
    """(keys, term, coef) rows."""
    entries = [F.struct(F.lit("const").alias("term"), F.col("intercept").alias("coef"))]
    entries += [
        F.struct(F.lit(x).alias("term"), F.get("coef", F.lit(i)).alias("coef")) for i, x in enumerate(xs)
    ]
    return fit.select(*keys, F.inline(F.array(*entries)))


def predicted(xs: Sequence[str], coef: str = "coef", intercept: str = "intercept") -> Column:
    return F.col(intercept) + _sum([F.get(coef, F.lit(i)) * F.col(x) for i, x in enumerate(xs)])


def residuals(df: DataFrame, keys: Sequence[str], y: str, xs: Sequence[str]) -> DataFrame:
    """Rows with ``resid`` and the group's fit; rows of unsolvable groups have NULL there."""
    fit = ols(df, keys, y, xs)
    d = complete_rows(df, [y, *xs])
    d = d.join(fit.select(*keys, "coef", "intercept", "r2"), list(keys))
    return d.withColumn("resid", F.col(y) - predicted(xs)).drop("coef", "intercept")
