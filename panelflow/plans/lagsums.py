"""Sums of products of a series with itself at all lags up to a bound, by convolutions of blocks.

A key is cut by position into blocks; a block also gets the first rows after it, as many as the largest lag. All its lag sums
are one convolution of the block with itself and those rows, so a thousand lags cost little more than ten, and no column is made for
a lag. A block's sums are taken about its own mean, and moved to the key's mean when the blocks are added up: only a
row per block meets others of its key.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from panelflow.plans.series import BLOCK, HALO, POS, Series, positions


def block_lag_sums(own: np.ndarray, after: np.ndarray, lags: int) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """The centre c, and by lag k: sums of (x_t - c)(x_t+k - c), of both factors, and their number, for t in the block."""
    c = float(own.mean())
    z, every = own - c, np.concatenate([own, after]) - c
    size = 1 << (len(z) + len(every) - 1).bit_length()
    spectrum = np.conj(np.fft.rfft(z, size)) * np.fft.rfft(every, size)
    reach = min(lags, len(every) - 1)
    products, factors, pairs = np.zeros(lags + 1), np.zeros(lags + 1), np.zeros(lags + 1)
    products[: reach + 1] = np.fft.irfft(spectrum, size)[: reach + 1]
    k = np.arange(reach + 1)
    number = np.minimum(len(z), len(every) - k)
    upto = np.concatenate([[0.0], np.cumsum(every)])
    factors[: reach + 1] = upto[number] + upto[k + number] - upto[k]
    pairs[: reach + 1] = number
    return c, products, factors, pairs


def lag_sums(df: DataFrame, s: Series, value: str, lags: int) -> DataFrame:
    """(keys, n, c): per key the rows with a value, and the sums of (x_t - m)(x_t+k - m) for lags k from 0, m being its mean.

    Rows follow each other without regard to gaps. A lag beyond the key's length has the sum 0.
    """
    keys = list(s.keys)
    d = df.where(F.col(value).isNotNull())
    keep = [c for c in d.columns if c in keys or c in s.order or c.startswith("_")]
    d = positions(d.select(*dict.fromkeys([*keep, value])), s)
    width = max(s.rows, lags, 1)
    block, rest = F.floor(F.col(POS) / width), F.col(POS) % width
    place = lambda b, halo: F.struct(b.alias(BLOCK), F.lit(halo).alias(HALO))
    targets = F.array_compact(F.array(place(block, False), F.when((rest < lags) & (block > 0), place(block - 1, True))))
    d = d.select(*keys, POS, F.col(value).cast("double").alias("_x"), F.inline(targets))
    fields = ", ".join(f"`{k}` {d.schema[k].dataType.simpleString()}" for k in keys)

    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(POS)
        own = g.loc[~g[HALO], "_x"].to_numpy()
        if len(own) == 0:
            return pd.DataFrame(columns=[*keys, "_n", "_c", "_sum", "_at"])
        c, products, factors, pairs = block_lag_sums(own, g.loc[g[HALO], "_x"].to_numpy(), lags)
        at = [{"p": p, "f": f, "k": k} for p, f, k in zip(products, factors, pairs, strict=True)]
        return pd.DataFrame({**{k: [g[k].iloc[0]] for k in keys}, "_n": [len(own)], "_c": [c], "_sum": [float(own.sum())], "_at": [at]})

    shape = f"{fields}, _n long, _c double, _sum double, _at array<struct<p: double, f: double, k: double>>"
    blocks = d.groupBy(*keys, BLOCK).applyInPandas(run, shape)
    whole = W.partitionBy(*keys)  # one row per block
    n = F.sum("_n").over(whole)
    b = blocks.select(*keys, n.alias("n"), (F.col("_c") - F.sum("_sum").over(whole) / n).alias("_off"), "_at")
    b = b.select(*keys, "n", "_off", F.posexplode("_at").alias("_k", "_at"))
    moved = F.col("_at.p") + F.col("_off") * F.col("_at.f") + F.col("_at.k") * F.col("_off") * F.col("_off")
    by_lag = b.groupBy(*keys, "n", "_k").agg(F.sum(moved).alias("_v"))
    out = by_lag.groupBy(*keys, "n").agg(F.array_sort(F.collect_list(F.struct("_k", "_v"))).alias("c"))
    return out.select(*keys, "n", F.transform("c", lambda e: e["_v"]).alias("c"))
