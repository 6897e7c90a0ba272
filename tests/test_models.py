"""Forecasts, Spark ML operators and the estimator contract."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelflow.operators import forecast, ml
from panelflow.operators.regression import solve_centred
from panelflow.plans.series import Series

S = Series(("k",), ("t",))
BLOCKS = Series(("k",), ("t",), plan="blocks", bucket=11.0, rows=16)


@pytest.fixture(scope="module")
def panel(spark):
    r = np.random.default_rng(3)
    rows = []
    for k in "ab":
        y = [1.0, 2.0]
        for t in range(2, 50):
            y.append(0.9 * y[-1] - 0.2 * y[-2] + r.normal())
        rows += [(k, 1970 + t, v, float(r.normal())) for t, v in enumerate(y)]
    return spark.createDataFrame(rows, "k string, t int, y double, x double")


def brute_forecast(y, x, h, train, ridge, lags=3):
    X, target = [], []
    for t in range(lags - 1, train):
        if t + h < train:
            X.append([*[y[t - j] for j in range(lags)], *[x[t - j] for j in range(lags)]])
            target.append(y[t + h])
    X, target = np.array(X), np.array(target)
    c = np.cov(X.T, bias=True)
    b = (X - X.mean(0)).T @ (target - target.mean()) / len(target)
    beta = solve_centred(c[np.triu_indices(len(c))], b, len(c), ridge=ridge)
    t = train - 1
    now = np.array([*[y[t - j] for j in range(lags)], *[x[t - j] for j in range(lags)]])
    return target.mean() + beta @ (now - X.mean(0))


@pytest.mark.parametrize("series", [S, BLOCKS])
@pytest.mark.parametrize("holdout", [0, 5])
def test_direct_forecast(panel, series, holdout):
    d = forecast.direct_forecast(panel, series, "y", ["x"], holdout=holdout)
    got = d.where(F.col("origin") == 2019 - holdout).collect()
    rows = panel.where("k = 'a'").orderBy("t").collect()
    y, x = [q["y"] for q in rows], [q["x"] for q in rows]
    for q in got:
        assert q["is_forecast"] and q["ds"] == q["origin"] + q["horizon"]
        assert q["yhat"] == pytest.approx(q["trend"] + q["ar"] + q["lagged_x"])
        if q["k"] == "a":
            assert q["yhat"] == pytest.approx(brute_forecast(y, x, q["horizon"], 50 - holdout, 1e-2), rel=1e-7)
            assert q["y"] == (y[49 - holdout + q["horizon"]] if holdout else None)
    assert len(got) == 10
    scores = forecast.holdout_scores(d).collect()
    assert len(scores) == (5 if holdout else 0)
    wide = forecast.forecast_wide(d, ["k"])
    assert wide.columns == ["k", "ds", "yhat1", "yhat2", "yhat3", "yhat4", "yhat5"]


def test_forecast_frame(panel):
    d = forecast.forecast_frame(panel, "k", "t", "y", ["x"])
    future = d.where("is_future").orderBy("k", "ds").collect()
    assert [q["ds"].year for q in future] == [2020, 2021, 2022, 2023, 2024] * 2
    assert all(q["y"] is None and q["x"] is None for q in future)
    assert d.agg(F.min("ds")).first()[0] == dt.date(1970, 1, 1)


def test_blend_normalises_once(spark):
    d = spark.createDataFrame([(1.0, 2.0, 6.0, 3.0)], "a double, b double, c double, y double")
    got = forecast.blend(d, forecast.equal_weights(["a", "b", "c"])).first()
    assert got["blend"] == pytest.approx(3.0)
    with pytest.raises(ValueError):
        forecast.blend(d, {"a": 0.0})


@pytest.fixture(scope="module")
def regression_rows(spark):
    return spark.createDataFrame(
        [
            (i, float(a), float(b), float(c), float(3 * a + 2 * b))
            for i, (a, b, c) in enumerate(np.random.default_rng(0).normal(size=(600, 3)) * [10, 1, 1] + [50, 0, 0])
        ],
        "id long, strong double, weak double, noise double, y double",
    )


FEATURES = ["strong", "weak", "noise"]


def test_forest_importance_and_variants(spark, regression_rows):
    from panelflow.operators.clean import seeded_split

    d = seeded_split(regression_rows, ["id"])
    train, test = d.where("is_train"), d.where("not is_train")
    fitted, metrics = ml.train_and_score(train, test, FEATURES, "y", numTrees=20, maxDepth=6)
    assert metrics.first()["r2"] > 0.8
    top = ml.importance(spark, fitted, FEATURES).orderBy("rank").collect()
    assert top[0]["feature"] == "strong" and sum(r["importance"] for r in top) == pytest.approx(1)
    v = {r["variant"]: r for r in ml.compare_variants(
        train, test, {"all": FEATURES, "noise": ["noise"]}, "y", numTrees=5, maxDepth=3
    ).collect()}
    assert v["all"]["r2"] > v["noise"]["r2"] and v["all"]["n"] == v["noise"]["n"]
    base = {r["model"]: r for r in ml.baselines(d, FEATURES, "y", numTrees=10, maxDepth=5).collect()}
    assert base["linear"]["r2"] == pytest.approx(1, abs=1e-6)


def test_permutation(spark, regression_rows):
    p = ml.permute_column(regression_rows, ["id"], "strong", 7)
    assert p.count() == 600
    j = p.select("id", F.col("strong").alias("new")).join(regression_rows, "id")
    assert j.where("new <> strong").count() > 550
    assert p.select("strong").exceptAll(regression_rows.select("strong")).count() == 0
    fitted = ml.linear(FEATURES, "y").fit(regression_rows)
    got = ml.permutation_importance(fitted, regression_rows, FEATURES, "y", ["id"]).orderBy("rank").collect()
    assert [r["feature"] for r in got[:2]] == ["strong", "weak"]
    assert got[2]["importance"] == pytest.approx(0, abs=1e-6)


def test_linear_attribution(spark, regression_rows):
    coefs = spark.createDataFrame([(3.0, 2.0, 0.0)], "strong double, weak double, noise double")
    got = {r["feature"]: r["importance"] for r in ml.linear_attribution(regression_rows, coefs, FEATURES).collect()}
    x = np.array([r["strong"] for r in regression_rows.select("strong").collect()])
    assert got["strong"] == pytest.approx(np.abs(3 * (x - x.mean())).mean())
    assert got["noise"] == 0


def test_estimator_contract(panel, tmp_path):
    est = ml.EntityRegression(keyCols=["k"], featureCols=["x"], labelCol="y")
    est.save(str(tmp_path / "estimator"))
    model = ml.EntityRegression.load(str(tmp_path / "estimator")).fit(panel)
    model.save(str(tmp_path / "model"))
    again = ml.EntityRegressionModel.load(str(tmp_path / "model"))
    a = [r["prediction"] for r in model.transform(panel).orderBy("k", "t").collect()]
    b = [r["prediction"] for r in again.transform(panel).orderBy("k", "t").collect()]
    assert a == pytest.approx(b) and len(a) == panel.count()
    assert again.evaluate(panel).first()["n"] == 100


def test_forest_on_points(spark):
    """Of many rows a forest is fitted on weighted points: all rows count, and it predicts as the forest on the rows."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(6000, 2))
    rows = [(float(a), float(int(b * 2)), float(3 * a + int(b * 2) + e)) for (a, b), e in zip(x, rng.normal(size=6000) / 10)]
    d = spark.createDataFrame([*rows, (None, 0.0, 1.0), (0.5, float("nan"), 1.0)], "a double, b double, y double")
    plain, folded = (ml.fit_forest(d, ["a", "b"], "y", points=p, numTrees=20, maxDepth=8) for p in (10_000, 1500))
    assert len(folded.stages) == 3 and folded.stages[-1].getOrDefault("weightCol") == "weight"
    one, two = (ml.score(f, d, "y").first() for f in (plain, folded))
    assert one["n"] == two["n"] == 6000 and two["r2"] == pytest.approx(one["r2"], abs=0.02) and two["r2"] > 0.9
    assert list(folded.stages[-1].featureImportances.toArray()) == pytest.approx(list(plain.stages[-1].featureImportances.toArray()), abs=0.05)


def test_weighted_points(spark):
    """The points keep the rows' numbers and sums, whatever their cell holds."""
    rows = [(float(i % 3), float(i), i) for i in range(1000)] + [(7.0, 5.0, 5), (8.0, 1.0, 1), (8.0, 2.0, 2)]
    d = spark.createDataFrame(rows, "c double, y double, id long")
    p = ml.weighted_points(d, ["c"], ["id"], "y", 1003, 100)
    assert p.count() <= 100 + 5
    sums = p.groupBy("c").agg(F.sum("weight").alias("n"), F.sum(F.col("weight") * F.col("y")).alias("s"))
    want = {r["c"]: (r["n"], r["s"]) for r in d.groupBy("c").agg(F.count("y").alias("n"), F.sum("y").alias("s")).collect()}
    assert {r["c"]: (r["n"], pytest.approx(r["s"])) for r in sums.collect()} == want


def test_bin_borders(spark):
    d = spark.createDataFrame([(float(i % 4), float(i)) for i in range(5000)] + [(0.0, 0.0)] * 5000, "few double, many double")
    few, many = ml.bin_borders(d, ["few", "many"])
    assert few == [0.5, 1.5, 2.5] and 20 <= len(many) <= 31 and many == sorted(set(many))
    assert ml.bin_borders(d.where("few = 1"), ["few"]) == [[1.0]]
