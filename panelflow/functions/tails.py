"""Tail probabilities on NumPy arrays, and the pandas UDFs that expose them.

Only scalar p-values run here; every statistic behind them is a Spark aggregate.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_lgamma = np.vectorize(math.lgamma, otypes=[float])
_erfc = np.vectorize(math.erfc, otypes=[float])
_TINY = 1e-300


def betainc(a, b, x):
    """Regularised incomplete beta function, by its continued fraction."""
    a, b, x = (np.asarray(v, float) for v in np.broadcast_arrays(a, b, x))
    swap = x > (a + 1) / (a + b + 2)
    p, q, z = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, 1 - x, x)
    z = np.clip(z, 0.0, 1.0)
    with np.errstate(divide="ignore", invalid="ignore"):
        front = np.exp(
            _lgamma(p + q) - _lgamma(p) - _lgamma(q)
            + p * np.log(np.maximum(z, _TINY)) + q * np.log(np.maximum(1 - z, _TINY))
        ) / p
    c = np.ones_like(z)
    d = 1 - (p + q) * z / (p + 1)
    d = 1 / np.where(np.abs(d) < _TINY, _TINY, d)
    h = d.copy()
    for m in range(1, 300):
        for num in (
            m * (q - m) * z / ((p + 2 * m - 1) * (p + 2 * m)),
            -(p + m) * (p + q + m) * z / ((p + 2 * m) * (p + 2 * m + 1)),
        ):
            d = 1 + num * d
            d = 1 / np.where(np.abs(d) < _TINY, _TINY, d)
            c = 1 + num / c
            c = np.where(np.abs(c) < _TINY, _TINY, c)
            step = c * d
            h = h * step
        if np.all(np.abs(step - 1) < 1e-15):
            break
    part = np.where(z <= 0, 0.0, front * h)
    return np.where(swap, 1 - part, part)


def t_two_sided(t, df):
    t, df = np.asarray(t, float), np.asarray(df, float)
    out = np.full(np.broadcast(t, df).shape, np.nan)
    t, df = np.broadcast_arrays(t, df)
    out[np.isinf(t)] = 0.0
    ok = np.isfinite(t) & np.isfinite(df) & (df > 0)
    out[ok] = betainc(df[ok] / 2, 0.5, df[ok] / (df[ok] + t[ok] ** 2))
    return out


def f_upper(f, d1, d2):
    f, d1, d2 = (np.asarray(v, float) for v in np.broadcast_arrays(f, d1, d2))
    out = np.full(f.shape, np.nan)
    ok = np.isfinite(f) & (d1 > 0) & (d2 > 0) & (f >= 0)
    out[ok] = betainc(d2[ok] / 2, d1[ok] / 2, d2[ok] / (d2[ok] + d1[ok] * f[ok]))
    return out


def chi2_upper(x, df):
    """Closed form for each integer df: a finite sum, plus erfc when df is odd."""
    x, df = np.broadcast_arrays(np.asarray(x, float), np.asarray(df, float))
    out = np.full(x.shape, np.nan)
    ok = np.isfinite(x) & (x >= 0) & (df >= 1)
    for k in np.unique(df[ok]):
        rows = ok & (df == k)
        h = x[rows] / 2
        with np.errstate(divide="ignore"):
            log_h = np.log(h)
        odd = int(k) % 2
        total = _erfc(np.sqrt(h)) if odd else np.exp(-h)
        for i in range(1, (int(k) + 1) // 2 if odd else int(k) // 2):
            power = i - 0.5 if odd else i
            total = total + np.exp(-h + power * log_h - math.lgamma(power + 1))
        out[rows] = total
    return out


def normal_cdf(z):
    return 0.5 * _erfc(-np.asarray(z, float) / math.sqrt(2))


def digamma(x):
    """Recurrence up to 10, then the asymptotic series."""
    x = np.array(x, float, copy=True)
    shift = np.zeros_like(x)
    for _ in range(10):
        small = x < 10
        shift = np.where(small, shift - 1 / np.where(small, x, 1.0), shift)
        x = np.where(small, x + 1, x)
    i = 1 / (x * x)
    return shift + np.log(x) - 0.5 / x - i * (1 / 12 - i * (1 / 120 - i * (1 / 252 - i / 240)))


# MacKinnon (1994) response surface for the constant-only case.
ADF_SMALL = (2.1659, 1.4412, 0.038269)
ADF_LARGE = (1.7339, 0.93202, -0.12745, -0.010368)
ADF_SPLIT, ADF_MIN, ADF_MAX = -1.61, -18.83, 2.74
# MacKinnon (2010) critical values, constant-only, powers of 1/T.
ADF_CRITICAL = {
    "1%": (-3.43035, -6.5393, -16.786, -79.433),
    "5%": (-2.86154, -2.8903, -4.234, -40.040),
    "10%": (-2.56677, -1.5384, -2.809, 0.0),
}


def adf_p(t):
    t = np.asarray(t, float)
    low = np.polyval(ADF_SMALL[::-1], t)
    high = np.polyval(ADF_LARGE[::-1], t)
    p = normal_cdf(np.where(t <= ADF_SPLIT, low, high))
    p = np.where(t > ADF_MAX, 1.0, np.where(t < ADF_MIN, 0.0, p))
    return np.where(np.isnan(t), np.nan, p)


def _series(values) -> pd.Series:
    out = pd.Series(values, dtype="float64")
    return out.astype(object).where(out.notna(), None)


@F.pandas_udf(T.DoubleType())
def t_pvalue(t: pd.Series, df: pd.Series) -> pd.Series:
    return _series(t_two_sided(t.astype(float), df.astype(float)))


@F.pandas_udf(T.DoubleType())
def f_pvalue(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return _series(f_upper(f.astype(float), d1.astype(float), d2.astype(float)))


@F.pandas_udf(T.DoubleType())
def chi2_pvalue(x: pd.Series, df: pd.Series) -> pd.Series:
    return _series(chi2_upper(x.astype(float), df.astype(float)))


@F.pandas_udf(T.DoubleType())
def adf_pvalue(t: pd.Series) -> pd.Series:
    return _series(adf_p(t.astype(float)))


@F.pandas_udf(T.DoubleType())
def normal_two_sided(z: pd.Series) -> pd.Series:
    return _series(2 * normal_cdf(-z.astype(float).abs()))
