"""Panel rules on hand-made rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelflow.operators import clean, features, impute, ml, profile
from panelflow.operators.pipeline import PanelConfig, clean_panel, prepare_panel
from panelflow.plans.series import Series

S = Series(("e",), ("t",))
BLOCKS = Series(("e",), ("t",), plan="blocks", bucket=3.0, rows=4)


def rows(spark, data, types="v double"):
    """data: {entity: [(t, v, ...)]}"""
    flat = [(e, *r) for e, rs in data.items() for r in rs]
    return spark.createDataFrame(flat, f"e string, t int, {types}")


def values(df, *cols):
    got = {}
    for r in df.orderBy("e", "t").collect():
        got.setdefault(r["e"], []).append(tuple(r[c] for c in cols) if len(cols) > 1 else r[cols[0]])
    return got


N = None
GAPPY = {
    "a": [(1, N), (2, 1.0), (3, N), (4, N), (7, 4.0), (8, N)],
    "b": [(1, N), (2, N), (3, 5.0), (4, N)],
    "c": [(1, N), (2, N)],
    "d": [(1, 3.0), (2, 4.0)],
}


@pytest.mark.parametrize("series", [S, BLOCKS])
def test_interpolation_is_by_row(spark, series):
    got = values(impute.interpolate(rows(spark, GAPPY), series, ["v"]), "v")
    assert got["a"] == [1, 1, 2, 3, 4, 4]
    assert got["b"] == [N, N, 5.0, N]
    assert got["c"] == [N, N] and got["d"] == [3, 4]


def test_long_interpolation_equals_pandas(spark):
    r = np.random.default_rng(2)
    data = {k: [(t, None if r.random() < 0.6 else float(r.normal())) for t in range(60)] for k in "xyz"}
    got = values(impute.interpolate(rows(spark, data), BLOCKS, ["v"]), "v")
    for k, rs in data.items():
        want = pd.Series([v for _, v in rs], dtype=float).interpolate(limit_direction="both")
        assert got[k] == pytest.approx(want.tolist())


@pytest.mark.parametrize("method", ["interpolate", "drop"])
def test_imputation_truth_table(spark, method):
    d = rows(spark, GAPPY)
    d = d.select("e", "t", F.col("v").alias("gdp"), F.col("v").alias("renewable_pct"), F.col("v").alias("other"),
                 F.lit(None).cast("double").alias("mean_temp"))
    full = impute.impute(d, S, method=method, drop_rest=False)
    got = values(full, "gdp", "renewable_pct", "other", "mean_temp")
    assert set(got) == {"a", "b", "d"}  # c has no gdp at all
    assert [g[0] for g in got["a"]] == [1, 1, 2, 3, 4, 4]
    assert [g[0] for g in got["b"]] == [5, 5, 5, 5]
    assert [g[1] for g in got["b"]] == [5, 5, 5, 5]
    raw = [v for _, v in GAPPY["a"]]
    assert [g[2] for g in got["a"]] == ([1, 1, 2, 3, 4, 4] if method == "interpolate" else raw)
    assert [g[2] for g in got["b"]] == [N, N, 5.0, N]
    assert all(g[3] is None for g in got["a"])
    # Zero-fill on an entity without any value.
    z = impute.impute(d.drop("gdp", "other"), S, method=method, critical=[])
    assert values(z, "renewable_pct")["c"] == [0, 0]
    # Rows with something missing leave, except for the untouched column.
    left = values(impute.impute(d, S, method=method), "other")
    assert left["b"] == [5.0] and left["d"] == [3, 4]


def test_log_rules(spark):
    d = spark.createDataFrame([(0.0, -5.0, 1.0), (1.0, 1.0, 2.0), (10.0, 2.0, 3.0)], "z double, n double, p double")
    with pytest.warns(UserWarning, match="absent"):
        got = features.log_columns(d, ["z", "n", "p", "absent"]).orderBy("z").collect()
    assert [r["log_z"] for r in got] == pytest.approx(np.log(np.array([0, 1, 10]) + 1e-6).tolist())
    assert got[0]["log_n"] is None and got[1]["log_n"] == pytest.approx(np.log(1 + 1e-6))
    assert [r["log_p"] for r in got] == pytest.approx(np.log([1, 2, 3]).tolist())


def test_differences_skip_unknown(spark):
    d = rows(spark, {"a": [(1, 1.0), (2, 4.0), (5, 9.0)]})
    with pytest.warns(UserWarning, match="nope"):
        got = values(features.differences(d, S, ["v", "nope"]), "v_diff")
    assert got["a"] == [N, 3, 5]


def test_balance(spark):
    full = [(e, t) for e in "ab" for t in (1, 2, 3)]
    d = spark.createDataFrame(full[:-1], "e string, t int")
    q = profile.panel_balance(d, "e", "t").first()
    assert (q["is_balanced"], q["missing_entries"], q["entities"], q["time_periods"]) == (False, 1, 2, 3)
    assert profile.panel_balance(spark.createDataFrame(full, "e string, t int"), "e", "t").first()["is_balanced"]
    # A duplicate row counts as an observation: not balanced, though no cell is missing.
    dup = spark.createDataFrame(full + full[:1], "e string, t int")
    q = profile.panel_balance(dup, "e", "t").first()
    assert (q["is_balanced"], q["missing_entries"], q["max_obs"]) == (False, 0, 4)


def test_membership_and_requirements(spark):
    d = rows(spark, {"a": [(1, 1.0)], "b": [(1, 2.0)]})
    names = spark.createDataFrame([("a",), ("zz",), ("a",)], "name string")
    assert clean.members_only(d, "e", names).count() == 1
    assert clean.members_only(d, "e", names.limit(0)).count() == 2
    assert clean.members_only(d, "e", []).count() == 2
    assert clean.members_only(d, "e", None).count() == 2
    assert tuple(clean.member_match(d, "e", names).first()) == (2, 1)
    with pytest.raises(ValueError, match="gone, lost"):
        clean.require_columns(d, ["e", "gone", "lost"])
    assert clean.features_and_target(d) == (["t"], "v")
    assert clean_panel(d, ["e", "v"], "e", ["b"]).columns == ["e", "v"]


def test_splits(spark):
    d = rows(spark, {"a": [(t, 1.0) for t in range(10)], "b": [(t, 1.0) for t in range(7)]})
    for s in (S, BLOCKS):
        got = clean.holdout_split(d, s, 5, least=3).groupBy("e", "is_train").count().collect()
        assert {(r[0], r[1]): r[2] for r in got} == {("a", True): 5, ("a", False): 5}
    frac = clean.fraction_split(d, S, 0.8).where("is_train").groupBy("e").count().collect()
    assert {r[0]: r[1] for r in frac} == {"a": 8, "b": 5}
    parts = {r["t"]: r["part"] for r in clean.period_split(d, "t", 2, 3).select("t", "part").distinct().collect()}
    assert [parts[t] for t in range(10)] == ["train"] * 5 + ["validation"] * 3 + ["test"] * 2
    a = {tuple(r) for r in clean.seeded_split(d, ["e", "t"]).collect()}
    b = {tuple(r) for r in clean.seeded_split(d.repartition(5), ["e", "t"]).collect()}
    assert a == b
    assert clean.sample_entities(d, "e", 1).collect() == clean.sample_entities(d.repartition(3), "e", 1).collect()


def test_dedupe_hot_key(spark):
    d = spark.range(2000).select(
        F.lit("hot").alias("k"), F.col("id").alias("seq"), (F.col("id") * 2).alias("x")
    )
    assert clean.dedupe(d, ["k"], ["seq"]).first()["x"] == 0
    assert clean.dedupe(d, ["k"], ["seq"], "last").first()["x"] == 3998
    plan = clean.dedupe(d, ["k"], ["seq"])._jdf.queryExecution().toString()
    assert "Window" not in plan


def test_sequences(spark):
    d = rows(spark, {"a": [(t, float(t)) for t in range(7)], "b": [(t, float(t)) for t in range(3)]})
    got = features.panel_sequences(d.withColumn("w", F.col("v") * 2), S, "v", length=5).orderBy("t").collect()
    assert [(r["y"], [x["w"] for x in r["x"]]) for r in got] == [
        (5.0, [0, 2, 4, 6, 8]), (6.0, [2, 4, 6, 8, 10])
    ]
    with pytest.raises(ValueError, match="not enough data"):
        features.require_samples(features.panel_sequences(d, S, "v", ["v"], length=9))
    assert features.detect_layout(d.toDF("country", "year", "v")) == ("country", "year", 5)
    with pytest.raises(ValueError):
        features.detect_layout(d)


def test_fill_forward_back(spark):
    d = rows(spark, {"a": [(t, v) for t, v in enumerate([N, N, 1.0, N, N, N, N, 2.0])]})
    assert values(impute.fill_forward_back(d, S, ["v"], 2), "v")["a"] == [1, 1, 1, 1, 1, 2, 2, 2]


def test_constant_columns_do_not_fail(spark):
    d = rows(spark, {"a": [(1, 2.0), (2, 2.0)]})
    got = {(r["var1"], r["var2"]): r["r"] for r in profile.correlation_matrix(d, ["t", "v"]).collect()}
    assert got[("t", "v")] is None and got[("t", "t")] == pytest.approx(1)
    assert profile.best_correlation(d, "v", ["t"]).count() == 0
    h = profile.histogram(d, "v", 10).collect()
    assert [(r["bin"], r["n"]) for r in h] == [(0, 2)]
    assert ml.zscores(d, ["v"]).first()["z_v"] is None
    assert d.agg(*profile.regression_metrics("v", "v")).first()["r2"] is None


def test_histogram_per_key_and_log(spark):
    d = rows(spark, {"a": [(t, float(10**t)) for t in range(4)], "b": [(t, float(t)) for t in range(4)]})
    per = profile.histogram(d, "v", 3, ["e"]).where("e = 'b'").orderBy("bin").collect()
    assert [r["n"] for r in per] == [1, 1, 2]
    assert sum(r["density"] * (r["upper"] - r["lower"]) for r in per) == pytest.approx(1)
    logs = profile.histogram(d.where("e = 'a'"), "v", 3, log=True).orderBy("bin").collect()
    assert [r["upper"] for r in logs] == pytest.approx([10, 100, 1000])


def test_suitability_verdicts(spark):
    def judged(d):
        q = profile.suitability(d).first()
        return q["linear_verdict"], q["forest_verdict"], {r["code"]: r["value"] for r in q["reasons"]}

    few = spark.createDataFrame([("x", 1.0)], "s string, v double")
    assert judged(few) == ("no", "no", {"few_rows": 1, "few_numeric": 1, "flat_target": 0})
    flat = spark.range(300).select(F.col("id").alias("a"), F.lit(1.0).alias("v"))
    assert judged(flat) == ("caveats", "no", {"flat_target": 0})
    good = spark.range(300).select(F.col("id").alias("a"), (F.col("id") * 2.0).alias("v"))
    assert judged(good) == ("yes", "yes", {})
    noise = spark.range(300).select((F.col("id") % 2).alias("a"), F.when(F.col("id") % 4 < 2, 1).alias("b"), (F.col("id") % 4 < 2).cast("int").alias("v"))
    assert judged(noise.select("a", "v"))[2] == pytest.approx({"weak_r": 0})
    assert set(judged(noise.select(F.lit(None).cast("int").alias("n"), "v"))[2]) == {"missing_share"}
    assert judged(few.limit(0))[:2] == ("no", "no")


def test_quantile_cells_are_small(spark):
    """Exact at several sizes, and no cell of a bracket holds more than 1/50 of it."""
    for n in (1, 2, 3, 7, 1000, 300_000):
        d = spark.range(n).select(
            F.rand(1).alias("uniform"), F.randn(2).alias("normal"), F.exp(3 * F.randn(3)).alias("lognormal"), F.lit(4.0).alias("constant")
        )
        names, points = d.columns, [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
        got = {r["column"]: r["q"] for r in profile.exact_quantiles(d, names, points).collect()}
        exact = d.toPandas().quantile(points)
        assert all(got[c] == pytest.approx(exact[c].tolist(), rel=1e-12) for c in names)
    box = profile.quantile_brackets(d, names, [0.25, 0.5])
    cells = profile.quantile_cells(d, names, box).where("cell >= 0").groupBy("column", "point", "cell").agg(
        F.count_distinct("value").alias("k")
    )
    worst = cells.groupBy("column", "point").agg(F.max("k").alias("k"), F.sum("k").alias("all")).collect()
    assert all(r["k"] <= max(6, r["all"] / 50) for r in worst)
    assert profile.exact_quantiles(d.limit(0), names, [0.5]).count() == 0


def test_wide_aggregates_are_split(spark):
    d = spark.range(5).select(*[(F.col("id") + i).alias(f"c{i}") for i in range(120)])
    got = profile.missing_by_column(d)
    assert got.count() == 120 and got.agg(F.sum("missing")).first()[0] == 0


def test_pipeline_end_to_end(spark):
    r = np.random.default_rng(0)
    recs = []
    for c in ("A", "B", "C"):
        for y in range(2000, 2010):
            v = [float(abs(x)) + 1 for x in r.normal(size=5)]
            if c == "B" and y == 2004:
                v[2] = None
            if c == "C":
                v[1] = None
            recs.append((c, y, *v, None))
    cols = "country string, year int, emissions double, energy_use double, gdp double, population double, renewable_pct double, mean_temp double"
    d = spark.createDataFrame(recs, cols)
    out = prepare_panel(d, PanelConfig())
    assert {x[0] for x in out.select("country").distinct().collect()} == {"A", "B"}
    assert out.count() == 20  # lag gaps at the start are filled as well
    for c in ("emissions_lag2", "gdp_diff", "population_diff_lag1", "log_gdp"):
        assert out.where(F.col(c).isNull()).count() == 0
    first = prepare_panel(d, PanelConfig(impute_first=True, entities=["A"]))
    assert first.count() == 10 and first.where("emissions_lag2 is null").count() == 2


def test_exact_quantiles(spark):
    r = np.random.default_rng(4)
    x = np.concatenate([r.lognormal(3, 2, 500), np.repeat(7.0, 400), [1e12, -1e9]])
    pdf = pd.DataFrame({"x": x, "few": np.where(np.arange(len(x)) < 3, 1.5, np.nan), "i": np.arange(len(x))})
    d = spark.createDataFrame(pdf).withColumn("few", F.when(~F.isnan("few"), F.col("few")))
    points = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = {q["column"]: q for q in profile.exact_quantiles(d, ["x", "few", "i"], points).collect()}
    for c in ("x", "i"):
        assert got[c]["q"] == pytest.approx(np.quantile(pdf[c], points).tolist(), rel=1e-12)
    assert got["few"]["n"] == 3 and got["few"]["q"] == [1.5] * 7
    big = spark.range(60_000).select(F.round(F.exp(F.randn(3)), 2).alias("v"))
    got = profile.exact_quantiles(big, ["v"], points).first()["q"]
    assert got == pytest.approx(np.quantile(big.toPandas()["v"], points).tolist(), rel=1e-12)
    plan = profile.exact_quantiles(d, ["x"], [0.5])._jdf.queryExecution().toString()
    assert "percentile(" not in plan
    full = profile.describe(d, ["x"]).first()
    near = profile.describe(d, ["x"], approximate=True).first()
    assert full["q50"] == pytest.approx(np.median(x)) and near["q50"] == pytest.approx(np.median(x), rel=0.05)
    assert full.asDict().keys() == near.asDict().keys()


def test_matrix_has_all_observed_years(spark, tmp_path):
    from panelflow.suite import QUERIES

    orders = [(1, 10.0, "1991-05-01"), (1, 20.0, "1996-05-01"), (2, 5.0, "2007-01-31")]
    df = spark.createDataFrame(orders, "o_custkey long, o_totalprice double, day string")
    df.selectExpr("o_custkey", "o_totalprice", "cast(day as timestamp_ntz) o_orderdate").write.parquet(str(tmp_path / "orders.parquet"))
    got = QUERIES["a14_matrix_by_mean"](spark, str(tmp_path))
    assert got.columns == ["entity", "y1991", "y1996", "y2007", "row_mean"]
    assert [tuple(r) for r in got.collect()] == [(1, 10.0, 20.0, None, 15.0), (2, None, None, 5.0, 5.0)]
