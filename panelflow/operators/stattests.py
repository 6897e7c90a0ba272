"""Regression-based and distribution tests, for every key of a series in one job."""

from __future__ import annotations

import math
from collections.abc import Sequence
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelflow.functions import tails
from panelflow.functions.scalars import chi2_tail_even, label_below
from panelflow.operators.clean import sample_per_key
from panelflow.operators.profile import metric_report, moments_of, trend_label
from panelflow.operators.regression import _full, fit_moments, moments, ols, residuals, solve_system
from panelflow.plans.lagsums import lag_sums
from panelflow.plans.series import BUCKET, POS, Series, frames, positions, scan
from panelflow.session import materialised


def durbin_watson(df: DataFrame, s: Series, resid: str = "resid") -> DataFrame:
    """Sum of squared steps over sum of squares; flagged outside 1.5 .. 2.5."""
    d = scan(df.where(F.col(resid).isNotNull()), s, prev={"_prev": F.col(resid)})
    step = F.col(resid) - F.col("_prev")
    out = d.groupBy(*s.keys).agg(
        F.try_divide(F.sum(step * step), F.sum(F.col(resid) * F.col(resid))).alias("durbin_watson")
    )
    dw = F.col("durbin_watson")
    return out.withColumn("has_autocorrelation", (dw < 1.5) | (dw > 2.5))


def breusch_pagan(df: DataFrame, keys: Sequence[str], y: str, xs: Sequence[str]) -> DataFrame:
    """LM = n * R2 of squared residuals on the regressors; chi-square and F p-values."""
    k = len(xs)
    d = residuals(df, keys, y, xs).withColumn("_e2", F.col("resid") * F.col("resid"))
    fit = ols(d, keys, "_e2", xs)
    r2, n = F.col("r2"), F.col("n")
    f = F.try_divide(r2 / k, (1 - r2) / (n - k - 1))
    return fit.select(
        *keys, "n",
        (n * r2).alias("lm"),
        (chi2_tail_even(n * r2, k) if k % 2 == 0 else tails.chi2_pvalue(n * r2, F.lit(float(k)))).alias("lm_pvalue"),
        f.alias("f"),
        tails.f_pvalue(f, F.lit(float(k)), (n - k - 1).cast("double")).alias("f_pvalue"),
    )


class _LagSums:
    """Moments of the unit-root regression of one key for any first row and lag order.

    Over all rows, with absent steps counted as zero, the cross products of lagged steps
    form a Toeplitz matrix of the lag sums. Taking away the few rows before the first used
    row and after the last one leaves the exact sums, so every lag order and both samples
    come from one pass over the data.
    """

    def __init__(self, n, x_sum, x_sq, steps, level, head, tail):
        self.n, self.x_sum, self.x_sq = int(n), float(x_sum), float(x_sq)
        self.steps, self.level = np.asarray(steps, float), np.asarray(level, float)
        self.head, self.tail = np.asarray(head, float), np.asarray(tail, float)

    def _lagged(self, first: int, last: int, p: int) -> np.ndarray:
        """Rows ``first..last`` of (d_t, .., d_{t-p}), zero where a step does not exist."""
        edge = self.head if last < len(self.head) else self.tail
        offset = 0 if edge is self.head else self.n - len(self.tail)
        t = np.arange(first, last + 1)[:, None] - np.arange(p + 1)[None, :]
        real = (t >= 1) & (t <= self.n - 1)
        i = np.where(real, t - offset, 1)
        return np.where(real, edge[i] - edge[i - 1], 0.0)

    def centred(self, p: int, first: int):
        """(rows, covariance of (step, level, lagged steps)) for rows first..n-1."""
        m = self.n - first
        early, late = self._lagged(1, first - 1, p), self._lagged(self.n, self.n - 1 + p, p)
        k = np.abs(np.subtract.outer(np.arange(p + 1), np.arange(p + 1)))
        cross = self.steps[k] - early.T @ early - late.T @ late
        x0 = self.head[: first - 1]
        with_level = self.level[: p + 1] - x0 @ early
        last = self.tail[-1]
        total = np.empty((p + 2, p + 2))
        rest = [0, *range(2, p + 2)]
        total[np.ix_(rest, rest)] = cross
        total[1, rest] = total[rest, 1] = with_level
        total[1, 1] = self.x_sq - last**2 - x0 @ x0
        sums = np.empty(p + 2)
        j = np.arange(p + 1)
        sums[rest] = self.tail[-1 - j] - self.head[first - 1 - j]
        sums[1] = self.x_sum - last - x0.sum()
        mean = sums / m
        return m, total / m - np.outer(mean, mean)


def _unit_root(sums: _LagSums, top: int):
    """(lag, rows used, t ratio of the level) with the lag order of least AIC."""
    m, c = sums.centred(top, top + 1)
    best = (math.inf, None)
    for p in range(top + 1):
        s, b = c[1 : p + 2, 1 : p + 2], c[1 : p + 2, 0]
        beta = solve_system(s, b) if m > p + 2 else None
        if beta is None:
            continue
        rss = c[0, 0] - 2 * beta @ b + beta @ s @ beta
        best = min(best, (m * math.log(rss) + 2 * (p + 2) if rss > 0 else -math.inf, p))
    p = best[1]
    if p is None:
        return None, None, None
    m, c = sums.centred(p, p + 1)
    s, b = c[1:, 1:], c[1:, 0]
    beta = solve_system(s, b) if m > p + 2 else None
    if beta is None:
        return p, m, None
    rss = max(c[0, 0] - 2 * beta @ b + beta @ s @ beta, 0.0)
    se = math.sqrt(rss / (m - p - 2) * np.linalg.inv(s)[0, 0])
    return p, m, float(beta[0] / se) if se > 0 else None


ADF_FIT = T.StructType(
    [
        T.StructField("lag", T.IntegerType()),
        T.StructField("n_used", T.LongType()),
        T.StructField("adf_stat", T.DoubleType()),
    ]
)


@F.pandas_udf(ADF_FIT)
def _adf_fit(
    n: pd.Series, top: pd.Series, x_sum: pd.Series, x_sq: pd.Series,
    steps: pd.Series, level: pd.Series, head: pd.Series, tail: pd.Series,
) -> pd.DataFrame:
    rows = [
        _unit_root(_LagSums(*rest), int(limit))
        for limit, *rest in zip(top, n, x_sum, x_sq, steps, level, head, tail, strict=True)
    ]
    return pd.DataFrame(rows, columns=ADF_FIT.names).astype({"lag": "Int32", "n_used": "Int64", "adf_stat": "Float64"})


def default_max_lag(n: Column) -> Column:
    """ceil(12 (n/100)^(1/4)), at most n/2 - 2."""
    return F.least(F.ceil(12 * F.pow(n / 100.0, F.lit(0.25))), F.floor(n / 2) - 2).cast("int")


def adf(df: DataFrame, s: Series, value: str, max_lag: int | None = None) -> DataFrame:
    """Augmented Dickey-Fuller test with a constant, lag order by AIC.

    All orders are compared on the common sample; the chosen one is fitted again on its own
    longer sample. Both follow from one aggregate of lag sums per key, of ``2 * max_lag``
    columns, plus the first and last few values. Keys too short for the test are left out;
    constant ones get NULL and are not called stationary. Without ``max_lag`` the longest
    key decides the width, which takes one small count.
    """
    keys = list(s.keys)
    d = df.where(F.col(value).isNotNull()).select(*keys, *s.order, F.col(value).cast("double").alias("_v"))
    if max_lag is None:
        longest = d.groupBy(*keys).count().agg(F.max(default_max_lag(F.col("count")))).first()[0]
        max_lag = max(int(longest or 0), 0)
    centre = d.groupBy(*keys).agg(F.avg("_v").alias("_m"), F.count(F.lit(1)).alias("_n"))
    d = d.join(centre, keys).withColumn("_x", F.col("_v") - F.col("_m"))
    d = positions(d, s)

    def steps(w):
        return {"_before": F.lag("_x").over(w)}

    def lagged(w):
        step = F.col("_x") - F.col("_before")
        return {"_d0": step} | {f"_d{k}": F.lag(step, k).over(w) for k in range(1, max_lag + 1)}

    d = frames(d, s, steps, lagged, back=max_lag + 1)
    edge = max_lag + 2

    def kept(near: Column) -> Column:
        """Values at one end of the key, in order: at most ``edge`` of them."""
        pairs = F.array_sort(F.collect_list(F.when(near, F.struct(POS, "_x"))))
        return F.transform(pairs, lambda e: e["_x"])

    def total(e: Column) -> Column:
        return F.coalesce(F.sum(e), F.lit(0.0))

    spans = range(max_lag + 1)
    g = d.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum("_x").alias("_sum"),
        F.sum(F.col("_x") * F.col("_x")).alias("_sq"),
        F.array(*[total(F.col("_d0") * F.col(f"_d{k}")) for k in spans]).alias("_steps"),
        F.array(*[total(F.col("_before") * F.col(f"_d{k}")) for k in spans]).alias("_level"),
        kept(F.col(POS) < edge).alias("_head"),
        kept(F.col(POS) >= F.col("_n") - edge).alias("_tail"),
    )
    top = F.least(default_max_lag(F.col("_n")), F.lit(max_lag))
    g = g.withColumn("_top", top).where(F.col("_top") >= 0)
    fit = _adf_fit("_n", "_top", "_sum", "_sq", "_steps", "_level", "_head", "_tail")
    out = g.select(*keys, fit.alias("_fit")).select(*keys, "_fit.*")
    inv = 1.0 / F.col("n_used")
    crit = {
        name: F.lit(c[0]) + c[1] * inv + c[2] * inv * inv + c[3] * inv * inv * inv
        for name, c in tails.ADF_CRITICAL.items()
    }
    out = out.withColumn("adf_pvalue", tails.adf_pvalue("adf_stat"))
    return out.select(
        "*",
        *[c.alias(f"crit_{n.rstrip('%')}") for n, c in crit.items()],
        F.coalesce(F.col("adf_pvalue") < 0.05, F.lit(False)).alias("is_stationary"),
    )


# Royston (1995) polynomial coefficients, lowest power first.
SW_LAST = (0.0, 0.221157, -0.147981, -2.071190, 4.434685, -2.706056)
SW_NEXT = (0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633)
SW_SMALL_MEAN = (0.5440, -0.39978, 0.025054, -6.714e-4)
SW_SMALL_SD = (1.3822, -0.77857, 0.062767, -0.0020322)
SW_LARGE_MEAN = (-1.5861, -0.31082, -0.083751, 0.0038915)
SW_LARGE_SD = (-0.4803, -0.082676, 0.0030302)
SW_GAMMA = (-2.273, 0.459)
SW_LIMIT = 5000


def _poly(c, x):
    return float(np.polyval(c[::-1], x))


def shapiro_wilk(x: np.ndarray) -> tuple[float | None, float | None]:
    """W and p of one bounded sample (3 .. 5000 values)."""
    x = np.sort(np.asarray(x, float))
    n = len(x)
    ss = float(np.sum((x - x.mean()) ** 2)) if n else 0.0
    if n < 3 or ss <= 0:
        return None, None
    inv = NormalDist().inv_cdf
    m = np.array([inv((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)])
    mm = float(m @ m)
    u = 1 / math.sqrt(n)
    a = np.empty(n)
    if n == 3:
        a[:] = (-math.sqrt(0.5), 0.0, math.sqrt(0.5))
    else:
        last = _poly(SW_LAST, u) + m[-1] / math.sqrt(mm)
        if n > 5:
            nxt = _poly(SW_NEXT, u) + m[-2] / math.sqrt(mm)
            phi = (mm - 2 * m[-1] ** 2 - 2 * m[-2] ** 2) / (1 - 2 * last**2 - 2 * nxt**2)
            a[:] = m / math.sqrt(phi)
            a[-2], a[1] = nxt, -nxt
        else:
            phi = (mm - 2 * m[-1] ** 2) / (1 - 2 * last**2)
            a[:] = m / math.sqrt(phi)
        a[-1], a[0] = last, -last
    w = min(float(a @ x) ** 2 / ss, 1.0)
    if n == 3:
        p = 6 / math.pi * (math.asin(math.sqrt(w)) - math.asin(math.sqrt(0.75)))
        return w, max(p, 0.0)
    if w >= 1.0:
        return w, 1.0
    y = math.log(1 - w)
    if n <= 11:
        g = _poly(SW_GAMMA, n)
        if y >= g:
            return w, 0.0
        y, mean, sd = -math.log(g - y), _poly(SW_SMALL_MEAN, n), math.exp(_poly(SW_SMALL_SD, n))
    else:
        ln = math.log(n)
        mean, sd = _poly(SW_LARGE_MEAN, ln), math.exp(_poly(SW_LARGE_SD, ln))
    return w, 0.5 * math.erfc((y - mean) / sd / math.sqrt(2))


def shapiro(df: DataFrame, keys: Sequence[str], value: str, ids: Sequence[str], seed: int = 42) -> DataFrame:
    """Shapiro-Wilk per key; above 5000 values a seeded sample of 5000 is tested.

    The sample limit is part of the test and bounds each group.
    """
    d = df.where(F.col(value).isNotNull())
    d = sample_per_key(d, keys, ids, SW_LIMIT, seed).select(*keys, F.col(value).cast("double").alias("_v"))
    fields = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)

    def test(key, pdf):
        w, p = shapiro_wilk(pdf["_v"].to_numpy())
        return pd.DataFrame([[*key, len(pdf), w, p]], columns=[*keys, "n", "sw_stat", "sw_pvalue"]).astype(
            {"sw_stat": "float64", "sw_pvalue": "float64"}
        )

    out = d.groupBy(*keys).applyInPandas(test, f"{fields}, n long, sw_stat double, sw_pvalue double")
    p = F.when(~F.isnan("sw_pvalue"), F.col("sw_pvalue"))
    return out.withColumns(
        {"sw_pvalue": p, "is_normal": F.coalesce(p > 0.05, F.lit(False))}
    )


def acf_wide(df: DataFrame, s: Series, value: str, nlags: int) -> DataFrame:
    """n and the array of autocorrelations for lags 0..nlags, per key; NULL for a constant series."""
    d = lag_sums(df, s, value, nlags)
    zero = F.get("c", F.lit(0))
    r = F.transform("c", lambda c: F.when(zero > 0, c / zero))
    return d.select(*s.keys, "n", F.transform(r, lambda x, i: F.when(i == 0, F.when(zero > 0, F.lit(1.0))).otherwise(x)).alias("acf"))


def acf(df: DataFrame, s: Series, value: str, nlags: int = 50) -> DataFrame:
    """(key, lag, acf, bound) with the bound at 1.96 / sqrt(n)."""
    d = acf_wide(df, s, value, nlags)
    return d.select(
        *s.keys, F.posexplode("acf").alias("lag", "acf"), (F.lit(1.96) / F.sqrt("n")).alias("bound")
    )


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _levinson(n: pd.Series, r: pd.Series) -> pd.Series:
    """Partial autocorrelations by the Levinson-Durbin recursion."""
    out = []
    for cnt, rho in zip(n, r, strict=True):
        rho = np.asarray(rho, float)
        k = np.arange(len(rho))
        if np.isnan(rho).any() or cnt <= len(rho):
            out.append(None)
            continue
        rho = rho * cnt / (cnt - k)  # adjusted scaling: divide by the number of products
        pacf, phi, var = [1.0], np.zeros(0), 1.0
        for j in range(1, len(rho)):
            a = (rho[j] - (phi @ rho[j - 1 : 0 : -1] if j > 1 else 0.0)) / var
            phi = np.append(phi - a * phi[::-1], a)
            var *= 1 - a * a
            pacf.append(float(a))
            if var <= 0:
                break
        out.append(pacf)
    return pd.Series(out)


def pacf(df: DataFrame, s: Series, value: str, nlags: int = 10) -> DataFrame:
    """(key, lag, pacf) by Yule-Walker with adjusted autocovariances (n/(n-k) scaling)."""
    d = acf_wide(df, s, value, nlags)
    d = d.select(*s.keys, _levinson("n", "acf").alias("p"))
    return d.select(*s.keys, F.posexplode("p").alias("lag", "pacf"))


def jarque_bera(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """n/6 (S^2 + K^2/4), with the exact chi-square(2) tail; normality rejected at 1 %."""
    d = df.groupBy(*keys).agg(
        F.count(value).alias("n"), F.skewness(value).alias("_s"), F.kurtosis(value).alias("_k")
    )
    jb = F.col("n") / 6.0 * (F.col("_s") * F.col("_s") + F.col("_k") * F.col("_k") / 4.0)
    d = d.select(*keys, "n", jb.alias("jb_stat"), F.exp(-jb / 2).alias("jb_pvalue"))
    return d.withColumn("rejects_normality", F.col("jb_pvalue") < 0.01)


def arch_test(df: DataFrame, s: Series, value: str, nlags: int = 10) -> DataFrame:
    """n * R2 of the squared value on its own lags; strong < 1 %, moderate < 5 %."""
    keys = list(s.keys)
    keep = [c for c in (BUCKET,) if c in df.columns]
    d = df.where(F.col(value).isNotNull()).select(
        *keys, *s.order, *keep, (F.col(value) * F.col(value)).alias("_q")
    )
    names = [f"_q{k}" for k in range(1, nlags + 1)]
    d = frames(d, s, lambda w: {f"_q{k}": F.lag("_q", k).over(w) for k in range(1, nlags + 1)}, back=nlags)
    fit = fit_moments(moments(d, keys, "_q", names))
    stat = F.col("n") * F.col("r2")
    p = chi2_tail_even(stat, nlags) if nlags % 2 == 0 else tails.chi2_pvalue(stat, F.lit(float(nlags)))
    out = fit.select(*keys, "n", stat.alias("arch_stat"), p.alias("arch_pvalue"))
    return out.withColumn(
        "clustering", label_below("arch_pvalue", (0.01, "strong"), (0.05, "moderate"), otherwise="none")
    )


def hurst(df: DataFrame, s: Series, value: str, min_window: int = 10) -> DataFrame:
    """Rescaled-range exponent of a change series.

    Window sizes grow by a quarter decade up to the whole series. The range of the running
    sum inside a window comes from one distributed running sum, so even the window that
    spans a whole key is a plain partial aggregate.
    """
    keys = list(s.keys)
    keep = [c for c in (BUCKET,) if c in df.columns]
    d = df.where(F.col(value).isNotNull()).select(*keys, *s.order, *keep, F.col(value).alias("_r"))
    one = F.lit(1).cast("long")
    d = scan(d, s, sums={POS: one, "_cum": F.col("_r")}, totals={"_n": one})
    lowest = math.log10(min_window)
    steps = F.floor((F.log10(F.col("_n") - 1) - lowest) / 0.25 - 1e-12).cast("int")
    sizes = F.when(
        F.col("_n") > min_window + 1,
        F.array_union(
            F.transform(
                F.sequence(F.lit(0), steps),
                lambda i: F.floor(F.pow(F.lit(10.0), lowest + i * 0.25) + 1e-9).cast("long"),
            ),
            F.array("_n"),
        ),
    )
    d = d.select(
        *keys, "_r", "_cum", "_n", (F.col(POS) - 1).alias(POS), F.explode(sizes).alias("size")
    )
    chunk = F.floor(F.col(POS) / F.col("size"))
    d = d.withColumn("_chunk", chunk).where((F.col("_chunk") + 1) * F.col("size") <= F.col("_n"))
    before = F.col("_cum") - F.col("_r")
    rs = d.groupBy(*keys, "size", "_chunk").agg(
        (F.max(F.greatest("_cum", before)) - F.min(F.least("_cum", before))).alias("_range"),
        F.stddev_samp("_r").alias("_sd"),
    )
    rs = rs.where((F.col("_range") != 0) & (F.col("_sd") != 0))
    per = rs.groupBy(*keys, "size").agg(F.avg(F.col("_range") / F.col("_sd")).alias("_rs"))
    out = per.groupBy(*keys).agg(
        F.regr_slope(F.log10("_rs"), F.log10("size")).alias("hurst"), F.count(F.lit(1)).alias("sizes")
    )
    return out.withColumn(
        "regime",
        F.when(F.col("hurst") < 0.45, "mean_reverting").when(F.col("hurst") > 0.55, "trending").when(
            F.col("hurst").isNotNull(), "random_walk"
        ),
    )


def normal_fit(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(value).alias("mu"), F.stddev_pop(value).alias("sigma"))


T_BIN = 0.002
T_PARAMS = T.StructType([T.StructField(n, T.DoubleType()) for n in ("t_df", "t_loc", "t_scale")])


def _t_loglik(x, c, v, m, s):
    z2 = ((x - m) / s) ** 2
    const = math.lgamma((v + 1) / 2) - math.lgamma(v / 2) - 0.5 * math.log(v * math.pi) - math.log(s)
    return float(c.sum() * const - (v + 1) / 2 * (c @ np.log1p(z2 / v)))


def _t_score(x, v, m, s):
    """Gradient per value in (loc / scale, log scale, log df)."""
    z = (x - m) / s
    a = z * z
    w = (v + 1) / (v + a)
    const = float(tails.digamma((v + 1) / 2) - tails.digamma(v / 2) - 1 / v)
    return np.stack([w * z, w * a - 1, v / 2 * (const - np.log1p(a / v) + (v + 1) * a / (v * (v + a)))])


T_MAX_DF = 1e4


def fit_t_weighted(x, c):
    """(df, loc, scale) maximising the weighted likelihood, by scoring steps with halving."""
    x, c = np.asarray(x, float), np.asarray(c, float)
    n = c.sum()
    mean = float(c @ x / n) if n else 0.0
    var = float(c @ (x - mean) ** 2 / n) if n else 0.0
    if len(x) < 3 or not var > 0:
        return None, None, None
    order = np.argsort(x)
    cum = np.cumsum(c[order])
    q1, m, q3 = (float(x[order][np.searchsorted(cum, q * n)]) for q in (0.25, 0.5, 0.75))
    s, v = max((q3 - q1) / 1.5, math.sqrt(var) * 1e-6), 4.0
    best = _t_loglik(x, c, v, m, s)
    for _ in range(200):
        g = _t_score(x, v, m, s)
        step = solve_step(g @ c / n, ((g * c) @ g.T / n)[np.triu_indices(3)])
        if step is None:
            break
        step = step / max(1.0, float(np.abs(step).max()))
        for _ in range(30):
            trial = (min(v * math.exp(step[2]), T_MAX_DF), m + s * step[0], s * math.exp(step[1]))
            value = _t_loglik(x, c, *trial)
            if value >= best:
                break
            step = step / 2
        else:
            break
        gain, best, (v, m, s) = value - best, value, trial
        if gain < 1e-12 * n or v >= T_MAX_DF:
            break
    return v, m, s


@F.pandas_udf(T_PARAMS)
def _fit_t_binned(centers: pd.Series, counts: pd.Series) -> pd.DataFrame:
    """Bins carry their own mean and count, so the start is close to the optimum."""
    rows = [fit_t_weighted(x, c) for x, c in zip(centers, counts, strict=True)]
    return pd.DataFrame(rows, columns=T_PARAMS.names)


@F.pandas_udf(T_PARAMS)
def _score_step(df: pd.Series, loc: pd.Series, scale: pd.Series, g: pd.Series, h: pd.Series) -> pd.DataFrame:
    """One scoring step in (loc, log scale, log df) from exact sums over all rows."""
    rows = []
    for v, m, s, grad, out in zip(df, loc, scale, g, h, strict=True):
        step = solve_step(np.asarray(grad, float), np.asarray(out, float))
        if step is None or v is None or not v == v:
            rows.append((v, m, s))
            continue
        step = np.clip(step, -0.5, 0.5)
        rows.append((v * math.exp(step[2]), m + s * step[0], s * math.exp(step[1])))
    return pd.DataFrame(rows, columns=["t_df", "t_loc", "t_scale"])


def solve_step(g: np.ndarray, flat: np.ndarray):
    h = _full(flat, 3)
    if not (np.isfinite(h).all() and np.isfinite(g).all()) or np.linalg.eigvalsh(h)[0] <= 1e-14:
        return None
    return np.linalg.solve(h, g)


@F.pandas_udf(T.DoubleType())
def _nu_constant(v: pd.Series) -> pd.Series:
    """psi((v+1)/2) - psi(v/2) - 1/v"""
    x = v.to_numpy(float)
    return pd.Series(tails.digamma((x + 1) / 2) - tails.digamma(x / 2) - 1 / x)


def student_t_fit(df: DataFrame, keys: Sequence[str], value: str, passes: int = 2) -> DataFrame:
    """Maximum-likelihood Student-t (df, loc, scale) per key, with ``t_gradient`` and ``converged``.

    A fine histogram of bounded size per key gives the start; ``passes`` exact scoring
    steps over all rows follow, each one aggregate of nine sums. The values are written once,
    and each step carries its parameters through the aggregate. ``t_gradient`` is the largest mean
    score before the last step, which squares the error; ``converged`` says that it was below 0.01.
    """
    keys = list(keys)
    d = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_x"))
    d = materialised(d, "t-fit")
    box = d.groupBy(*keys).agg(F.percentile_approx("_x", [0.25, 0.5, 0.75], 1000).alias("_q"), F.stddev_pop("_x").alias("_sd"))
    box = box.select(
        *keys,
        F.get("_q", F.lit(1)).alias("_med"),
        F.coalesce(F.nullif(F.get("_q", F.lit(2)) - F.get("_q", F.lit(0)), F.lit(0.0)), "_sd").alias("_iqr"),
    )
    z = F.try_divide(F.col("_x") - F.col("_med"), F.col("_iqr"))
    binned = d.join(box, keys).groupBy(*keys, F.floor(F.asinh(z) / T_BIN).alias("_bin")).agg(
        F.avg("_x").alias("_c"), F.count(F.lit(1)).alias("_k")
    )
    # Bin count per key is bounded by the range of asinh on doubles, not by the rows.
    start = binned.groupBy(*keys).agg(F.collect_list(F.struct("_c", "_k")).alias("_b"))
    params = start.select(*keys, _fit_t_binned(F.col("_b._c"), F.col("_b._k").cast("array<double>")).alias("_p")).select(
        *keys, "_p.*"
    )
    for _ in range(passes):
        p = params.withColumn("_const", _nu_constant("t_df"))
        j = d.join(p, keys)
        v = F.col("t_df")
        zz = (F.col("_x") - F.col("t_loc")) / F.col("t_scale")
        a = zz * zz
        w = (v + 1) / (v + a)
        g = [
            w * zz,
            w * a - 1,
            v * 0.5 * (F.col("_const") - F.log1p(a / v) + (v + 1) * a / (v * (v + a))),
        ]
        g = j.select(*keys, "t_df", "t_loc", "t_scale", *[e.alias(f"_g{i}") for i, e in enumerate(g)])
        sums = g.groupBy(*keys).agg(
            *[F.first(c).alias(c) for c in ("t_df", "t_loc", "t_scale")],
            F.array(*[F.avg(f"_g{i}") for i in range(3)]).alias("_grad"),
            F.array(
                *[F.avg(F.col(f"_g{i}") * F.col(f"_g{k}")) for i in range(3) for k in range(i, 3)]
            ).alias("_outer"),
        )
        params = sums.select(
            *keys,
            _score_step("t_df", "t_loc", "t_scale", "_grad", "_outer").alias("_p"),
            F.array_max(F.transform("_grad", F.abs)).alias("t_gradient"),
        ).select(*keys, "_p.*", "t_gradient")
    if not passes:
        params = params.withColumn("t_gradient", F.lit(None).cast("double"))
    return params.withColumn("converged", F.coalesce(F.col("t_gradient") < 0.01, F.lit(False)))


def entity_report(
    df: DataFrame, s: Series, value: str, xs: Sequence[str], least: int = 5, max_lag: int | None = None
) -> DataFrame:
    """One record per entity: size, range, mean, std, trend, ADF, R2, DW and their flags.

    A test that cannot be computed gives NULL and a false flag; the entity stays.
    """
    keys, time = list(s.keys), s.order[0]
    df = materialised(df, "report")
    base = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_obs"),
        F.min(time).alias("min_period"),
        F.max(time).alias("max_period"),
        F.avg(value).alias("mean_value"),
        F.stddev_samp(value).alias("std_value"),
        trend_label(value, time).alias("trend"),
    )
    base = base.where(F.col("n_obs") >= least)
    root = adf(df, s, value, max_lag).select(*keys, "adf_pvalue", "is_stationary")
    res = materialised(residuals(df, keys, value, xs), "residuals")
    fit = res.groupBy(*keys).agg(F.max("r2").alias("ols_r2"))
    dw = durbin_watson(res, s)
    out = base.join(root, keys, "left").join(fit, keys, "left").join(dw, keys, "left")
    no = F.lit(False)
    return out.withColumns(
        {
            "is_stationary": F.coalesce("is_stationary", no),
            "has_autocorrelation": F.coalesce("has_autocorrelation", no),
        }
    )


def assumption_report(df: DataFrame, s: Series, value: str, xs: Sequence[str], ids: Sequence[str], max_lag: int | None = None) -> DataFrame:
    """ADF, Durbin-Watson, Breusch-Pagan and Shapiro-Wilk per entity, one row each."""
    keys = list(s.keys)
    df = materialised(df, "report")
    res = materialised(residuals(df, keys, value, xs), "residuals")
    parts = [
        durbin_watson(res, s),
        breusch_pagan(df, keys, value, xs).select(*keys, F.col("lm_pvalue").alias("bp_pvalue")),
        shapiro(res, keys, "resid", ids).select(*keys, "sw_pvalue"),
    ]
    out = adf(df, s, value, max_lag).select(*keys, "adf_pvalue")
    for p in parts:
        out = out.join(p, keys, "full")
    return out


# The metrics of a market report, in order.
MARKET_METRICS = (
    "mean", "std", "skewness", "excess_kurtosis", "jb_stat", "jb_pvalue", "arch_stat", "arch_pvalue",
    "hurst", "t_df", "t_loc", "t_scale",
)


def market_report(df: DataFrame, s: Series, value: str) -> DataFrame:
    """(key, metric, value) of returns: moments, normality, ARCH, Hurst and the Student-t fit.

    The returns are written once; every part reads the written rows.
    """
    keys = list(s.keys)
    r = materialised(df, "returns")
    wide = r.groupBy(*keys).agg(*moments_of(value))
    for part in (
        jarque_bera(r, keys, value).drop("n"),
        arch_test(r, s, value).drop("n"),
        hurst(r, s, value),
        student_t_fit(r, keys, value),
    ):
        wide = wide.join(part, keys, "left")
    return metric_report(wide, MARKET_METRICS, keys)


__all__ = [
    "acf", "adf", "arch_test", "assumption_report", "breusch_pagan", "durbin_watson", "entity_report",
    "hurst", "jarque_bera", "market_report", "normal_fit", "pacf", "shapiro", "student_t_fit",
]
