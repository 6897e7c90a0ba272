"""Change points, regimes and scores against direct loops."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelflow.functions import tails
from panelflow.operators import regimes
from panelflow.plans.series import Series, public

S = Series(("k",), ("t",))
BLOCKS = Series(("k",), ("t",), plan="blocks", bucket=23.0, rows=40)


def frame(spark, **cols):
    rows = [(k, i, float(v)) for k, x in cols.items() for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "k string, t int, x double")


def data():
    r = np.random.default_rng(5)
    steps = np.concatenate([r.normal(0, 1, 60), r.normal(6, 1, 50), r.normal(6, 1, 40) + np.arange(40)])
    return {"steps": steps, "noise": r.normal(size=80), "step": np.repeat([0.0, 1.0], 20), "const": np.ones(30)}


def brute_points(x, w=10):
    out = []
    for i in range(w, len(x) - w):
        a, b = x[i - w : i], x[i : i + w]
        va, vb = a.var(ddof=1) / w, b.var(ddof=1) / w
        if va + vb == 0:
            if a.mean() != b.mean():
                out.append((i, np.inf * np.sign(a.mean() - b.mean()), 0.0))
            continue
        t = (a.mean() - b.mean()) / np.sqrt(va + vb)
        df = (va + vb) ** 2 / ((va**2 + vb**2) / (w - 1))
        p = tails.t_two_sided([t], [df])[0]
        if abs(t) > 2.5 and p < 0.01:
            out.append((i, t, p))
    return out


@pytest.mark.parametrize("series", [S, BLOCKS])
def test_change_points(spark, series):
    d = data()
    got = regimes.change_points(frame(spark, **d), series, "x").collect()
    for k, x in d.items():
        want = brute_points(x)
        mine = sorted((r["index"], r["statistic"], r["p_value"]) for r in got if r["k"] == k)
        assert [m[0] for m in mine] == [q[0] for q in want]
        for m, q in zip(mine, want, strict=True):
            assert m[1:] == pytest.approx(q[1:], abs=1e-9)
    assert any(r["k"] == "step" and np.isinf(r["statistic"]) for r in got)
    assert not any(r["k"] == "const" for r in got)


@pytest.mark.parametrize("series", [S, BLOCKS])
def test_local_max(spark, series):
    d = data()
    got = regimes.change_points(frame(spark, **d), series, "x", local_max=True).collect()
    for k, x in d.items():
        pts = {i: abs(t) for i, t, _ in brute_points(x)}
        want = {
            i for i, t in pts.items()
            if not any(abs(i - j) <= 10 and j != i and (u > t or (u == t and j < i)) for j, u in pts.items())
        }
        assert {r["index"] for r in got if r["k"] == k} == want


def brute_regimes(x):
    cps = [i for i, *_ in brute_points(x)]
    if not cps:
        return [(0, len(x), "single")]
    out, start = [], 0
    for end in [*cps, len(x)]:
        part = x[start:end]
        slope = np.polyfit(range(len(part)), part, 1)[0] if len(part) > 1 else None
        kind = "unknown" if slope is None else "increasing" if slope > 0.1 else "decreasing" if slope < -0.1 else "stable"
        out.append((start, end, kind))
        start = end
    return out


@pytest.mark.parametrize("series", [S, BLOCKS])
def test_regimes(spark, series):
    d = data()
    got = regimes.regimes(frame(spark, **d), series, "x").collect()
    for k, x in d.items():
        assert sorted((r["start"], r["end"], r["type"]) for r in got if r["k"] == k) == brute_regimes(x)


def test_short_series(spark):
    d = frame(spark, a=np.arange(19.0), one=[1.0])
    with pytest.raises(ValueError, match="at least 20"):
        regimes.check_periods(d, S)
    assert regimes.regimes(d, S, "x").count() == 0
    got = {r["k"]: r["regime"] for r in regimes.current_regime(d, S, "x").collect()}
    assert got == {"a": "increasing", "one": "insufficient_data"}


@pytest.mark.parametrize("series", [S, BLOCKS])
def test_cusum(spark, series):
    d = data()
    got = public(regimes.cusum(frame(spark, **d), series, "x")).collect()
    for k, x in d.items():
        mine = {r["t"]: r["score"] for r in got if r["k"] == k}
        want = {}
        for i in range(19, len(x)):
            h, rec = x[i - 19 : i - 9], x[i - 9 : i + 1]
            want[i] = ((rec - h.mean()) / (h.std() + 1e-10)).sum()
        assert set(mine) == set(want)
        for i, v in want.items():
            assert mine[i] == pytest.approx(v, rel=1e-6, abs=1e-6)
    norm = regimes.cusum(frame(spark, **d), series, "x", normalise=True).where("k = 'noise'")
    assert norm.agg(F.avg(F.col("is_change").cast("int"))).first()[0] < 0.7
