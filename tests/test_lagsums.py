"""Lag sums by blocks against direct sums."""

import numpy as np
import pytest

from panelflow.operators import stattests
from panelflow.plans.lagsums import block_lag_sums, lag_sums
from panelflow.plans.series import tick_series


def direct(x, lags):
    z = np.asarray(x, float) - np.mean(x)
    return [float(z[: len(z) - k] @ z[k:]) if k < len(z) else 0.0 for k in range(lags + 1)]


@pytest.mark.parametrize("lags", [0, 1, 7, 40])
def test_lag_sums(spark, lags):
    rng = np.random.default_rng(lags)
    data = {"long": 1e6 + rng.normal(size=500).cumsum(), "short": rng.normal(size=5), "one": [3.0], "flat": [2.5] * 90, "big": rng.normal(size=333) * 1e-3}
    rows = [(k, i, float(v), 1) for k, x in data.items() for i, v in enumerate(x)]
    rows += [("long", 250, None, 1), ("empty", 1, None, 1)]
    df = spark.createDataFrame(rows, "k string, t long, v double, p int").repartition(6)
    for width in (50, 4000):
        s = tick_series("k", ("t",), bucket=40.0, rows=width)
        got = {r.k: r for r in lag_sums(df, s, "v", lags).collect()}
        assert set(got) == set(data)
        for k, x in data.items():
            assert got[k].n == len(x) and len(got[k].c) == lags + 1
            scale = max(direct(x, 0)[0], 1e-30)
            assert np.allclose(np.array(got[k].c) / scale, np.array(direct(x, lags)) / scale, atol=1e-9)


def test_many_lags_cost_little_more():
    import time

    x = np.random.default_rng(1).normal(size=5000)

    def took(lags):
        best = 9.0
        for _ in range(7):
            start = time.perf_counter()
            block_lag_sums(x[:4000], x[4000 : 4000 + lags], lags)
            best = min(best, time.perf_counter() - start)
        return best

    assert took(1000) < 2 * took(50)


def test_acf_plan_has_no_column_per_lag(spark):
    df = spark.range(100).selectExpr("'a' k", "id t", "cast(id % 7 as double) v")
    text = stattests.acf(df, tick_series("k", ("t",)), "v", 30)._jdf.queryExecution().toString()
    physical = text[text.index("== Physical Plan ==") :]
    assert "lead(" not in physical and "_l30" not in physical and "Join" not in physical.split("_blk")[0]
