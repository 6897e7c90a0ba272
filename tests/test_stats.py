"""Statistical operators against brute force in NumPy and published values."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelflow.functions import tails
from panelflow.functions.scalars import chi2_tail_even
from panelflow.operators import paneltests, profile, regression, stattests
from panelflow.plans.series import Series

S = Series(("k",), ("t",))
LONG = Series(("k",), ("t",), plan="blocks", bucket=37.0, rows=64)


def frame(spark, **cols):
    rows = []
    for k, x in cols.items():
        rows += [(k, i, float(v)) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "k string, t int, x double")


def rng(seed=1):
    return np.random.default_rng(seed)


def test_tail_functions():
    assert tails.t_two_sided([2.228139, 2.0], [10, 1e9])[0] == pytest.approx(0.05, abs=1e-7)
    assert tails.t_two_sided([1.959964], [1e7])[0] == pytest.approx(0.05, abs=1e-6)
    assert tails.f_upper([4.964603], [1], [10])[0] == pytest.approx(0.05, abs=1e-7)
    assert tails.chi2_upper([7.814728], [3])[0] == pytest.approx(0.05, abs=1e-7)
    assert tails.chi2_upper([18.307038], [10])[0] == pytest.approx(0.05, abs=1e-7)
    assert tails.digamma(np.array([1.0]))[0] == pytest.approx(-0.5772156649015329, abs=1e-12)
    # Published p-values of the unit-root statistic.
    assert tails.adf_p([-2.86154])[0] == pytest.approx(0.05, abs=0.002)
    assert tails.adf_p([-3.43035])[0] == pytest.approx(0.01, abs=0.001)


def test_chi2_even_closed_form(spark):
    d = spark.range(1).select(
        chi2_tail_even(F.lit(0.7765), 10).alias("a"), chi2_tail_even(F.lit(1435.21), 10).alias("b"),
        chi2_tail_even(F.lit(0.0), 2).alias("c"),
    ).first()
    assert d.a == pytest.approx(tails.chi2_upper([0.7765], [10])[0], rel=1e-12)
    assert 0 < d.b < 1e-290 and d.c == 1.0


def test_ols_scales_and_singular(spark):
    r = rng()
    n = 60
    x1, x2 = r.normal(1e9, 1e7, n), r.normal(1e4, 2e3, n)
    y = 3 + 2e-7 * x1 - 0.5 * x2 + r.normal(0, 1, n)
    pdf = pd.DataFrame({"k": "a", "y": y, "x1": x1, "x2": x2})
    flat = pd.DataFrame({"k": "b", "y": y, "x1": x1, "x2": 2 * x1})
    d = spark.createDataFrame(pd.concat([pdf, flat]))
    got = {r_["k"]: r_ for r_ in regression.ols(d, ["k"], "y", ["x1", "x2"]).collect()}
    z = np.column_stack([(x1 - x1.mean()) / x1.std(), (x2 - x2.mean()) / x2.std()])
    beta, rss, *_ = np.linalg.lstsq(np.column_stack([np.ones(n), z]), y, rcond=None)
    assert got["a"]["coef"] == pytest.approx([beta[1] / x1.std(), beta[2] / x2.std()], rel=1e-9)
    assert got["a"]["sse"] == pytest.approx(float(rss[0]), rel=1e-8)
    assert got["b"]["coef"] is None and got["b"]["r2"] is None


def brute_adf(x):
    n = len(x)
    top = min(math.ceil(12 * (n / 100) ** 0.25), n // 2 - 2)
    dx = np.diff(x)

    def fit(p, start):
        rows = range(start, n)
        y = np.array([dx[t - 1] for t in rows])
        X = np.array([[1, x[t - 1], *[dx[t - 1 - j] for j in range(1, p + 1)]] for t in rows])
        b, *_ = np.linalg.lstsq(X, y, rcond=None)
        e = y - X @ b
        m = len(y)
        se = math.sqrt(e @ e / (m - p - 2) * np.linalg.inv(X.T @ X)[1, 1])
        return m * math.log(e @ e) + 2 * (p + 2) - m * math.log(m), b[1] / se, m

    best = min(range(top + 1), key=lambda p: fit(p, top + 1)[0])
    _, t, m = fit(best, best + 1)
    return best, t, m


@pytest.mark.parametrize("series", [S, LONG])
def test_adf(spark, series):
    r = rng(3)
    walk, ar = np.cumsum(r.normal(size=120)), np.zeros(90)
    for i in range(1, 90):
        ar[i] = 0.3 * ar[i - 1] + r.normal()
    data = {"walk": walk, "ar": ar, "flat": np.ones(40), "tiny": [1.0, 2.0], "short": r.normal(size=8)}
    got = {q["k"]: q for q in stattests.adf(frame(spark, **data), series, "x").collect()}
    for k in ("walk", "ar", "short"):
        lag, t, m = brute_adf(np.asarray(data[k]))
        assert (got[k]["lag"], got[k]["n_used"]) == (lag, m)
        assert got[k]["adf_stat"] == pytest.approx(t, rel=1e-6)
    assert got["ar"]["is_stationary"] and not got["walk"]["is_stationary"]
    assert "flat" not in got or got["flat"]["adf_stat"] is None


def test_adf_critical_values(spark):
    # T = 30: values published with the method.
    d = frame(spark, a=np.cumsum(rng(5).normal(size=31)))
    q = stattests.adf(d, S, "x", max_lag=0).first()
    assert q["n_used"] == 30
    assert (q["crit_1"], q["crit_5"], q["crit_10"]) == pytest.approx((-3.6699, -2.9641, -2.6212), abs=2e-4)


def test_breusch_pagan(spark):
    r = rng(4)
    n = 80
    x1, x2 = r.normal(size=n), r.normal(size=n)
    y = 1 + x1 + x2 + r.normal(size=n) * (1 + np.abs(x1))
    d = spark.createDataFrame(pd.DataFrame({"k": "a", "y": y, "x1": x1, "x2": x2}))
    X = np.column_stack([np.ones(n), x1, x2])
    e2 = (y - X @ np.linalg.lstsq(X, y, rcond=None)[0]) ** 2
    g = e2 - X @ np.linalg.lstsq(X, e2, rcond=None)[0]
    r2 = 1 - g @ g / ((e2 - e2.mean()) @ (e2 - e2.mean()))
    q = stattests.breusch_pagan(d, ["k"], "y", ["x1", "x2"]).first()
    assert q["lm"] == pytest.approx(n * r2, rel=1e-8)
    assert q["lm_pvalue"] == pytest.approx(math.exp(-n * r2 / 2), rel=1e-8)
    assert q["f"] == pytest.approx(r2 / 2 / ((1 - r2) / (n - 3)), rel=1e-8)


def test_shapiro_published_example():
    # The weights example of Shapiro and Wilk (1965); Royston gives W = 0.79, p = 0.007.
    w, p = stattests.shapiro_wilk(np.array([148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236]))
    assert w == pytest.approx(0.79, abs=0.005) and p == pytest.approx(0.0067, abs=3e-4)
    assert stattests.shapiro_wilk(np.ones(10)) == (None, None)
    w, p = stattests.shapiro_wilk(rng(7).normal(size=300))
    assert w > 0.98 and p > 0.01
    assert stattests.shapiro_wilk(rng(7).exponential(size=300))[1] < 1e-6


def test_shapiro_sample_is_bounded(spark):
    d = frame(spark, a=rng(8).normal(size=6000), b=rng(9).exponential(size=50))
    got = {q["k"]: q for q in stattests.shapiro(d, ["k"], "x", ["t"]).collect()}
    assert got["a"]["n"] == 5000 and got["b"]["n"] == 50
    assert not got["b"]["is_normal"]


@pytest.mark.parametrize("series", [S, LONG])
def test_acf_pacf(spark, series):
    r = rng(11)
    x = np.zeros(400)
    for i in range(2, 400):
        x[i] = 0.6 * x[i - 1] - 0.3 * x[i - 2] + r.normal()
    got = stattests.acf(frame(spark, a=x), series, "x", 10).orderBy("lag").toPandas()
    c = x - x.mean()
    want = [float(c[: len(c) - k] @ c[k:] / (c @ c)) for k in range(11)]
    assert got["acf"].tolist() == pytest.approx(want, abs=1e-10)
    pac = stattests.pacf(frame(spark, a=x), series, "x", 10).orderBy("lag").toPandas()["pacf"].tolist()
    rho = np.array([want[k] * 400 / (400 - k) for k in range(11)])
    for k in range(1, 11):
        toep = np.array([[rho[abs(i - j)] for j in range(k)] for i in range(k)])
        assert pac[k] == pytest.approx(np.linalg.solve(toep, rho[1 : k + 1])[-1], abs=1e-8)


@pytest.mark.parametrize("series", [S, LONG])
def test_arch(spark, series):
    r = rng(12)
    x, s2 = np.zeros(600), 1.0
    for i in range(1, 600):
        s2 = 0.2 + 0.7 * x[i - 1] ** 2
        x[i] = math.sqrt(s2) * r.normal()
    q = stattests.arch_test(frame(spark, a=x, b=r.normal(size=600)), series, "x", 10)
    got = {v["k"]: v for v in q.collect()}
    y = x**2
    X = np.column_stack([np.ones(590), *[y[10 - j : 600 - j] for j in range(1, 11)]])
    e = y[10:] - X @ np.linalg.lstsq(X, y[10:], rcond=None)[0]
    r2 = 1 - e @ e / ((y[10:] - y[10:].mean()) @ (y[10:] - y[10:].mean()))
    assert got["a"]["n"] == 590 and got["a"]["arch_stat"] == pytest.approx(590 * r2, rel=1e-7)
    assert got["a"]["clustering"] == "strong" and got["b"]["arch_pvalue"] > 0.001


def brute_hurst(x):
    n = len(x)
    sizes = [int(10**e) for e in np.arange(1, math.log10(n - 1), 0.25)] + [n]
    logs = []
    for w in sizes:
        rs = []
        for a in range(0, n - w + 1, w):
            part = x[a : a + w]
            path = np.concatenate([[0], np.cumsum(part)])
            rng_, sd = path.max() - path.min(), part.std(ddof=1)
            if rng_ and sd:
                rs.append(rng_ / sd)
        logs.append((math.log10(w), math.log10(np.mean(rs))))
    return np.polyfit(*zip(*logs, strict=True), 1)[0]


@pytest.mark.parametrize("series", [S, LONG])
def test_hurst(spark, series):
    r = rng(13)
    noise = r.normal(size=1500)
    trend = np.convolve(r.normal(size=1600), np.ones(100) / 100, "valid")[:1500]
    got = {v["k"]: v for v in stattests.hurst(frame(spark, a=noise, b=trend), series, "x").collect()}
    assert got["a"]["hurst"] == pytest.approx(brute_hurst(noise), abs=1e-9)
    assert got["b"]["hurst"] == pytest.approx(brute_hurst(trend), abs=1e-9)
    for v in got.values():
        h = v["hurst"]
        assert v["regime"] == ("mean_reverting" if h < 0.45 else "trending" if h > 0.55 else "random_walk")


def test_student_t_fit(spark):
    r = rng(14)
    data = {"a": 0.1 + 2 * r.standard_t(3, size=8000), "n": r.normal(size=500), "flat": np.ones(20)}
    got = {v["k"]: v for v in stattests.student_t_fit(frame(spark, **data), ["k"], "x").collect()}
    assert (got["a"]["t_df"], got["a"]["t_loc"], got["a"]["t_scale"]) == pytest.approx((3, 0.1, 2), rel=0.1, abs=0.1)
    # The gradient of the likelihood vanishes at the fit.
    g = stattests._t_score(data["a"], got["a"]["t_df"], got["a"]["t_loc"], got["a"]["t_scale"]).mean(axis=1)
    assert np.abs(g).max() < 1e-6
    assert got["n"]["t_df"] > 10
    assert got["flat"]["t_df"] is None


def test_durbin_watson_and_jarque_bera(spark):
    x = rng(15).normal(size=200)
    d = frame(spark, a=x, flat=np.zeros(5))
    got = {v["k"]: v for v in stattests.durbin_watson(d, S, "x").collect()}
    assert got["a"]["durbin_watson"] == pytest.approx(np.sum(np.diff(x) ** 2) / np.sum(x**2))
    assert got["flat"]["durbin_watson"] is None
    jb = stattests.jarque_bera(d.where("k = 'a'"), ["k"], "x").first()
    c = x - x.mean()
    s, k = (c**3).mean() / (c**2).mean() ** 1.5, (c**4).mean() / (c**2).mean() ** 2 - 3
    assert jb["jb_stat"] == pytest.approx(200 / 6 * (s**2 + k**2 / 4))


def test_entity_report_keeps_failing_entities(spark):
    r = rng(16)
    rows = []
    for k in ("a", "b", "const", "short"):
        n = {"short": 3}.get(k, 30)
        for t in range(n):
            x = r.normal(size=2)
            y = 5.0 if k == "const" else float(x.sum() + r.normal() + t * 0.1)
            rows.append((k, t, y, float(x[0]), float(x[1])))
    d = spark.createDataFrame(rows, "k string, t int, y double, x1 double, x2 double")
    got = {v["k"]: v for v in stattests.entity_report(d, S, "y", ["x1", "x2"]).collect()}
    assert set(got) == {"a", "b", "const"}
    assert got["const"]["adf_pvalue"] is None and got["const"]["is_stationary"] is False
    assert got["a"]["ols_r2"] > 0.3 and got["a"]["trend"] in ("increasing", "decreasing")


def test_summary_and_scores(spark):
    rows = [
        ("a", 33, False, True, 0.2, "increasing"), ("b", 33, True, False, 0.9, "decreasing"),
        ("c", 33, False, True, 0.4, "increasing"), ("d", 33, False, False, None, "increasing"),
    ]
    d = spark.createDataFrame(
        rows, "country string, n_obs int, is_stationary boolean, has_autocorrelation boolean, ols_r2 double, trend string"
    )
    q = profile.diagnostic_summary(d).first()
    assert (q["total_entities"], q["stationary"], q["stationary_pct"], q["autocorrelated"]) == (4, 1, 25.0, 2)
    assert q["avg_r2"] == pytest.approx(0.5) and q["median_r2"] == pytest.approx(0.4) and q["r2_below_05"] == 2
    worst = [(v["country"], v["issue_score"]) for v in profile.worst_entities(d, "country").collect()]
    assert worst == [("a", 3), ("c", 2), ("d", 1), ("b", 0)]


def test_white_and_chow(spark):
    r = rng(20)
    n = 100
    x1, x2 = r.normal(size=n), r.normal(size=n)
    y = 1 + x1 + np.where(np.arange(n) >= 50, 2, 0) * x2 + r.normal(size=n) * (1 + x1**2)
    d = spark.createDataFrame(pd.DataFrame({"k": "a", "t": range(n), "y": y, "x1": x1, "x2": x2}))

    def sse(rows, cols, target):
        X = np.column_stack([np.ones(len(rows)), *[c[rows] for c in cols]])
        e = target[rows] - X @ np.linalg.lstsq(X, target[rows], rcond=None)[0]
        return e @ e, e

    every = np.arange(n)
    whole, e = sse(every, [x1, x2], y)
    two = sse(every[:50], [x1, x2], y)[0] + sse(every[50:], [x1, x2], y)[0]
    q = paneltests.chow(d, ["k"], "y", ["x1", "x2"], "t", 50).first()
    assert q["chow_f"] == pytest.approx((whole - two) / 3 / (two / (n - 6)), rel=1e-7) and q["chow_pvalue"] < 0.01
    e2 = e * e
    rest = sse(every, [x1, x2, x1 * x1, x1 * x2, x2 * x2], e2)[0]
    lm = n * (1 - rest / ((e2 - e2.mean()) @ (e2 - e2.mean())))
    q = paneltests.white(d, ["k"], "y", ["x1", "x2"]).first()
    assert q["white_lm"] == pytest.approx(lm, rel=1e-7)
    assert q["white_pvalue"] == pytest.approx(tails.chi2_upper([lm], [5])[0])


@pytest.mark.parametrize("series", [S, LONG])
def test_kpss(spark, series):
    r = rng(21)
    data = {"noise": r.normal(size=200), "walk": np.cumsum(r.normal(size=200)), "flat": np.ones(9)}
    got = {v["k"]: v for v in paneltests.kpss(frame(spark, **data), series, "x").collect()}
    for k in ("noise", "walk"):
        e = data[k] - data[k].mean()
        s2 = e @ e + 2 * sum((1 - j / 5) * (e[j:] @ e[:-j]) for j in range(1, 5))
        assert got[k]["kpss_stat"] == pytest.approx((np.cumsum(e) ** 2).sum() / 200 / s2)
    assert got["noise"]["is_stationary"] and not got["walk"]["is_stationary"]
    assert got["walk"]["kpss_pvalue"] == 0.01 and got["flat"]["kpss_stat"] is None


def test_pesaran_cd_needs_no_pairs(spark):
    r = rng(22)
    common = r.normal(size=12)
    data = {f"e{i}": common + r.normal(size=12) for i in range(6)}
    d = frame(spark, **data)
    q = paneltests.pesaran_cd(d, "k", "t", "x").first()
    c = np.corrcoef(np.array(list(data.values())))
    want = math.sqrt(2 * 12 / 30) * c[np.triu_indices(6, 1)].sum()
    assert q["cd_stat"] == pytest.approx(want) and q["cd_pvalue"] < 0.01
    assert paneltests.pesaran_cd(d.where("not (k = 'e1' and t = 3)"), "k", "t", "x").first()["cd_stat"] is None
