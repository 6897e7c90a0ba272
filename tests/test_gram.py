"""Masked Gram matrices against direct pairwise-complete correlations."""

import math

import numpy as np
import pandas as pd
import pytest

from panelflow.operators import gram
from panelflow.plans.series import panel


def direct(x):
    """{(i, j): (n, r)} by pandas on the pair's own rows."""
    out = {}
    for i in range(x.shape[1]):
        for j in range(x.shape[1]):
            ok = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            a, b = x[ok, i], x[ok, j]
            flat = len(a) == 0 or np.ptp(a) == 0 or np.ptp(b) == 0
            out[i, j] = (len(a), None if flat else np.corrcoef(a, b)[0, 1])
    return out


def check(got, want, names):
    assert len(got) == len(want)
    for r in got:
        n, rho = want[names.index(r.var1), names.index(r.var2)]
        assert r.n == n and ((r.r is None) if rho is None else math.isclose(r.r, rho, abs_tol=1e-9)), (r, n, rho)


@pytest.mark.parametrize("width", [1, 2, 100])
def test_all_pairs(spark, width):
    rng = np.random.default_rng(width)
    x = rng.normal(size=(300, width)) @ rng.normal(size=(width, width)) + 1e6 * np.arange(width)
    x[rng.random(x.shape) < 0.3] = np.nan
    x[:, 0] = 7.1  # constant
    if width > 3:
        x[:, 1] = np.nan  # all missing
        x[:, 2] = np.where(np.isnan(x[:, 3]), rng.normal(size=300), 0.3)  # constant wherever the next one is present
    names = [f"c{i}" for i in range(width)]
    df = spark.createDataFrame(pd.DataFrame(x, columns=names)).repartition(7)
    got = gram.pairwise_correlations(df, names)
    check(got.collect(), direct(x), names)
    if width == 100:
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1


def test_missing_and_infinite_values(spark):
    rows = [(1.0, 2, None), (2.0, 4, math.inf), (math.nan, 7, 1.0), (4.0, 9, 2.0), (None, None, 3.0)]
    df = spark.createDataFrame(rows, "a double, b int, c double")
    got = {(r.var1, r.var2): (r.n, r.r) for r in gram.pairwise_correlations(df, ["a", "b", "c"]).collect()}
    assert got["a", "b"][0] == 3 and math.isclose(got["a", "b"][1], np.corrcoef([1, 2, 4], [2, 4, 9])[0, 1])
    assert got["c", "c"] == (4, None) and got["a", "c"] == got["c", "a"]
    assert gram.pairwise_correlations(df.limit(0), ["a", "b"]).count() == 0


def test_best_partner(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 4))
    x[:, 3] = -x[:, 0] + 0.01 * rng.normal(size=200)
    df = spark.createDataFrame(pd.DataFrame(x, columns=list("abcd")))
    got = {r.var1: (r.var2, r.abs_r) for r in gram.best_partners(df, list("abcd")).collect()}
    assert got["a"][0] == "d" and got["d"][0] == "a" and got["a"][1] > 0.99


def test_correlations_of_differences(spark):
    rng = np.random.default_rng(4)
    rows = [(f"e{e}", t, float(rng.normal()), float(rng.normal())) for e in range(4) for t in range(9) if rng.random() < 0.8]
    df = spark.createDataFrame(rows, "e string, t int, x double, y double").repartition(3)
    d = pd.DataFrame(rows, columns=["e", "t", "x", "y"]).sort_values(["e", "t"])
    steps = d.groupby("e")[["x", "y"]].diff().to_numpy()
    check(gram.difference_correlations(df, panel("e", "t"), ["x", "y"]).collect(), direct(steps), ["x", "y"])
