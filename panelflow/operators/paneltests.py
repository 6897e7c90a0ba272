"""Further panel tests: KPSS, Chow, White and cross-section dependence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelflow.functions import tails
from panelflow.operators.regression import complete_rows, ols, residuals
from panelflow.plans.series import Series, frames, scan

# KPSS (1992) critical values for the level case.
KPSS_LEVEL = ((0.10, 0.347), (0.05, 0.463), (0.025, 0.574), (0.01, 0.739))


def kpss(df: DataFrame, s: Series, value: str, nlags: int = 4) -> DataFrame:
    """Level stationarity, Bartlett weights over ``nlags`` lags; p between the tabled levels."""
    keys = list(s.keys)
    d = complete_rows(df, [value]).select(*keys, *s.order, F.col(value).cast("double").alias("_x"))
    mean = d.groupBy(*keys).agg(F.avg("_x").alias("_m"))
    d = d.join(mean, keys).withColumn("_e", F.col("_x") - F.col("_m"))
    d = scan(d, s, sums={"_cum": F.col("_e")})
    d = frames(d, s, lambda w: {f"_l{k}": F.lag("_e", k).over(w) for k in range(1, nlags + 1)}, back=nlags)
    e = F.col("_e")
    lagged = [F.coalesce(F.sum(e * F.col(f"_l{k}")), F.lit(0.0)) for k in range(1, nlags + 1)]
    spread = F.sum(e * e)
    for k, c in enumerate(lagged, 1):
        spread = spread + 2 * (1 - k / (nlags + 1)) * c
    n = F.count(F.lit(1))
    g = d.groupBy(*keys).agg(
        n.alias("n"), F.try_divide(F.sum(F.col("_cum") * F.col("_cum")) / n, spread).alias("kpss_stat")
    )
    stat, p = F.col("kpss_stat"), F.when(F.col("kpss_stat") <= KPSS_LEVEL[0][1], F.lit(KPSS_LEVEL[0][0]))
    for (p0, c0), (p1, c1) in zip(KPSS_LEVEL, KPSS_LEVEL[1:], strict=False):
        p = p.when(stat <= c1, p0 + (stat - c0) / (c1 - c0) * (p1 - p0))
    p = p.when(stat.isNotNull(), F.lit(KPSS_LEVEL[-1][0]))
    return g.withColumn("kpss_pvalue", p).withColumn(
        "is_stationary", F.coalesce(F.col("kpss_pvalue") >= 0.05, F.lit(False))
    )


def chow(df: DataFrame, keys: Sequence[str], y: str, xs: Sequence[str], time: str, split) -> DataFrame:
    """F test of one regression against two, before and from ``split`` on."""
    keys, k = list(keys), len(xs) + 1
    whole = ols(df, keys, y, xs).select(*keys, "n", F.col("sse").alias("_all"))
    halves = df.withColumn("_late", F.col(time) >= F.lit(split))
    parts = ols(halves, [*keys, "_late"], y, xs).groupBy(*keys).agg(
        F.sum("sse").alias("_two"), F.count("sse").alias("_fits")
    )
    d = whole.join(parts, keys)
    f = F.try_divide((F.col("_all") - F.col("_two")) / k, F.col("_two") / (F.col("n") - 2 * k))
    d = d.withColumn("chow_f", F.when((F.col("_fits") == 2) & (F.col("n") > 2 * k), f))
    p = tails.f_pvalue("chow_f", F.lit(float(k)), (F.col("n") - 2 * k).cast("double"))
    return d.select(*keys, "n", "chow_f", p.alias("chow_pvalue"))


def white(df: DataFrame, keys: Sequence[str], y: str, xs: Sequence[str]) -> DataFrame:
    """n * R2 of squared residuals on the regressors, their squares and products."""
    keys = list(keys)
    d = residuals(df, keys, y, xs).withColumn("_e2", F.col("resid") * F.col("resid"))
    terms = list(xs)
    for i, a in enumerate(xs):
        for b in xs[i:]:
            d = d.withColumn(f"_{a}_{b}", F.col(a) * F.col(b))
            terms.append(f"_{a}_{b}")
    fit = ols(d, keys, "_e2", terms)
    lm = F.col("n") * F.col("r2")
    return fit.select(
        *keys, "n", lm.alias("white_lm"), tails.chi2_pvalue(lm, F.lit(float(len(terms)))).alias("white_pvalue")
    )


def pesaran_cd(df: DataFrame, entity: str, time: str, value: str) -> DataFrame:
    """Mean pairwise correlation across entities of a balanced panel, scaled to N(0, 1).

    The sum over all pairs follows from one sum per period: with standardised values it is
    half of (sum over entities)^2 minus the sum of squares. No pair is ever formed. The
    statistic is NULL for an unbalanced panel or a constant entity.
    """
    d = complete_rows(df, [value])
    per = d.groupBy(entity).agg(
        F.avg(value).alias("_m"), F.stddev_pop(value).alias("_s"), F.count(F.lit(1)).alias("_n")
    )
    z = F.try_divide(F.col(value) - F.col("_m"), F.col("_s"))
    rows = d.join(per, entity).select(time, z.alias("_z"))
    by_time = rows.groupBy(time).agg(
        F.sum("_z").alias("_sum"), F.sum(F.col("_z") * F.col("_z")).alias("_sq"), F.count("_z").alias("_c")
    )
    total = by_time.agg(
        F.count(F.lit(1)).alias("t"), F.min("_c").alias("lo"), F.max("_c").alias("n"),
        (F.sum(F.col("_sum") * F.col("_sum") - F.col("_sq")) / 2).alias("pairs"),
    )
    entities = per.agg(F.count(F.lit(1)).alias("c"))
    d = total.select("*", entities.scalar().alias("entities"))
    ok = (F.col("lo") == F.col("n")) & (F.col("n") == F.col("entities")) & (F.col("n") > 1)
    t, n = F.col("t"), F.col("n")
    cd = F.sqrt(2 * t / (n * (n - 1))) * F.col("pairs") / t
    out = d.select("entities", t.alias("periods"), F.when(ok, cd).alias("cd_stat"))
    p = tails.normal_two_sided("cd_stat")
    return out.withColumn("cd_pvalue", p)
