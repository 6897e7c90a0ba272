"""Statistical tests, models, forecasts, streaming."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelflow.operators import clean, forecast, ml, paneltests, profile, regression, stattests
from panelflow.session import materialised, scratch_path
from panelflow.streaming import ticks as tick_stream
from panelflow.streaming.changes import ChangeStream
from panelflow.suite.registry import (
    DENSE, SQL_DENSE, SQL_OBS, SQL_RETURNS, SQL_TICKS, TICKS, case, micros, rnd, rounded,
)
from panelflow.suite.series import SQL_CUSUM, valid_returns, flagship
from panelflow.suite.tables import SQL_GOOD, tick_rows

KEY = ["instrument"]


# --- tests ---------------------------------------------------------------------------

@case(
    "d01_ols_simple",
    """select l_suppkey, count(*) n, round(regr_slope(l_extendedprice, l_quantity), 4) slope,
       round(regr_intercept(l_extendedprice, l_quantity), 3) intercept,
       round(regr_r2(l_extendedprice, l_quantity), 6) r2 from lineitem group by 1""",
)
def d01(t):
    d = regression.ols(t.lineitem, ["l_suppkey"], "l_extendedprice", ["l_quantity"])
    return d.select(
        "l_suppkey", "n", rnd(F.get("coef", F.lit(0)), 4).alias("slope"),
        rnd("intercept", 3).alias("intercept"), rnd("r2").alias("r2"),
    )


# Two regressors: the normal equations in closed form.
@case(
    "d01_ols_multi",
    f"""with {SQL_DENSE}, m as (
      select nation, count(*) n, avg(y) my, avg(x1) m1, avg(x2) m2, var_pop(y) vy, var_pop(x1) s11, var_pop(x2) s22,
             covar_pop(x1, x2) s12, covar_pop(x1, y) s1, covar_pop(x2, y) s2 from dense group by 1),
    b as (select *, (s1 * s22 - s2 * s12) / (s11 * s22 - s12 * s12) b1, (s2 * s11 - s1 * s12) / (s11 * s22 - s12 * s12) b2 from m)
    select nation, n, round(b1, 2) b1, round(b2, 4) b2, round(my - b1 * m1 - b2 * m2, 1) intercept,
           round((b1 * s1 + b2 * s2) / vy, 6) r2 from b""",
)
def d01m(t):
    d = regression.ols(t.dense(), ["nation"], "y", ["x1", "x2"])
    return d.select(
        "nation", "n", rnd(F.get("coef", F.lit(0)), 2).alias("b1"), rnd(F.get("coef", F.lit(1)), 4).alias("b2"),
        rnd("intercept", 1).alias("intercept"), rnd("r2").alias("r2"),
    )


SQL_RESID = f"""with {SQL_DENSE}, c as (
      select nation, regr_slope(y, x1) b, regr_intercept(y, x1) a from dense group by 1),
    res as (select d.*, y - a - b * x1 e from dense d join c using (nation))"""


@case(
    "d02_durbin_watson",
    SQL_RESID
    + """, s as (select *, e - lag(e) over (partition by nation order by ym) d from res)
    select nation, round(sum(d * d) / sum(e * e), 6) durbin_watson,
           sum(d * d) / sum(e * e) < 1.5 or sum(d * d) / sum(e * e) > 2.5 has_autocorrelation from s group by 1""",
)
def d02(t):
    return rounded(stattests.durbin_watson(regression.residuals(t.dense(), ["nation"], "y", ["x1"]), DENSE))


@case(
    "d03_breusch_pagan_single",
    SQL_RESID
    + """, g as (select nation, count(*) n, regr_r2(e * e, x1) r2 from res group by 1)
    select nation, n, round(n * r2, 5) lm, round(r2 / ((1 - r2) / (n - 2)), 5) f from g""",
)
def d03s(t):
    d = stattests.breusch_pagan(t.dense(), ["nation"], "y", ["x1"])
    return rounded(d.select("nation", "n", "lm", "f"), 5)


# Two regressors in closed form; both p-values are elementary for two of them.
@case(
    "d03_breusch_pagan",
    f"""with {SQL_DENSE}, m as (
      select nation, avg(y) my, avg(x1) m1, avg(x2) m2, var_pop(x1) s11, var_pop(x2) s22,
             covar_pop(x1, x2) s12, covar_pop(x1, y) s1, covar_pop(x2, y) s2 from dense group by 1),
    b as (select *, (s1 * s22 - s2 * s12) / (s11 * s22 - s12 * s12) b1, (s2 * s11 - s1 * s12) / (s11 * s22 - s12 * s12) b2 from m),
    q as (select d.nation, x1, x2, power(y - my - b1 * (x1 - m1) - b2 * (x2 - m2), 2) e from dense d join b on d.nation = b.nation),
    g as (select nation, count(*) n, var_pop(e) v, var_pop(x1) s11, var_pop(x2) s22, covar_pop(x1, x2) s12,
            covar_pop(x1, e) s1, covar_pop(x2, e) s2 from q group by 1),
    r as (select nation, n, ((s1 * s22 - s2 * s12) * s1 + (s2 * s11 - s1 * s12) * s2) / (s11 * s22 - s12 * s12) / v r2 from g)
    select nation, n, round(n * r2, 5) lm, round(exp(-n * r2 / 2), 6) lm_pvalue,
      round(r2 / 2 / ((1 - r2) / (n - 3)), 5) f, round(power(1 + r2 / (1 - r2), -(n - 3) / 2.0), 6) f_pvalue from r""",
)
def d03(t):
    return rounded(stattests.breusch_pagan(t.dense(), ["nation"], "y", ["x1", "x2"]), 6, lm=5, f=5)


@case("d04_adf")
def d04(t):
    return rounded(stattests.adf(t.dense(), DENSE, "y"))


# With no lags the test is one simple regression of the step on the level.
@case(
    "d04_adf_no_lags",
    f"""with {SQL_DENSE}, s as (
      select nation, y - lag(y) over w d, lag(y) over w l from dense window w as (partition by nation order by ym)),
    m as (select nation, count(*) n, covar_pop(l, d) / var_pop(l) b, var_pop(l) sl, var_pop(d) sd, covar_pop(l, d) c
      from s where d is not null group by 1)
    select nation, n n_used, round(b / sqrt((sd - b * c) * n / (n - 2) / (n * sl)), 5) adf_stat from m""",
)
def d04s(t):
    d = stattests.adf(t.dense(), DENSE, "y", max_lag=0)
    return rounded(d.select("nation", "n_used", "adf_stat"), 5)


@case("d05_shapiro")
def d05(t):
    return rounded(stattests.shapiro(valid_returns(t), KEY, "log_return", ["event_id"]), 6)


SQL_ACF = f"""with {SQL_RETURNS}, c as (select *, r - avg(r) over (partition by instrument) x from valid),
    l as (select instrument, n, x, """ + ", ".join(
    f"lead(x, {k}) over (partition by instrument order by pos) l{k}" for k in range(1, 11)
) + " from c)"


@case(
    "d06_acf",
    SQL_ACF
    + " select instrument, 0 lag, 1.0::double acf, round(1.96 / sqrt(any_value(n)), 6) bound from l group by 1 union all "
    + " union all ".join(
        f"select instrument, {k}, round(sum(x * l{k}) / sum(x * x), 6), round(1.96 / sqrt(any_value(n)), 6) from l group by 1"
        for k in range(1, 11)
    ),
)
def d06(t):
    return rounded(stattests.acf(valid_returns(t), TICKS, "log_return", 10))


@case("d07_pacf")
def d07(t):
    return rounded(stattests.pacf(valid_returns(t), TICKS, "log_return", 10))


# The first two partial autocorrelations in closed form.
@case(
    "d07_pacf_two_lags",
    SQL_ACF
    + """, r as (select instrument, sum(x * l1) / sum(x * x) * any_value(n) / (any_value(n) - 1) r1,
             sum(x * l2) / sum(x * x) * any_value(n) / (any_value(n) - 2) r2 from l group by 1)
    select instrument, 0 lag, 1.0::double pacf from r union all select instrument, 1, round(r1, 6) from r
    union all select instrument, 2, round((r2 - r1 * r1) / (1 - r1 * r1), 6) from r""",
)
def d07s(t):
    return rounded(stattests.pacf(valid_returns(t), TICKS, "log_return", 2))


SQL_SHAPE = """avg(r) m, stddev_pop(r) s,
      (avg(r * r * r) - 3 * avg(r) * var_pop(r) - power(avg(r), 3)) / power(stddev_pop(r), 3) g, kurtosis_pop(r) k, count(*) c"""


@case(
    "a15_moments",
    f"""with {SQL_RETURNS}, m as (select instrument, {SQL_SHAPE} from valid group by 1)
    select instrument, c n, round(m, 6) mean, round(s, 6) std, round(g, 5) skewness, round(k, 5) excess_kurtosis from m""",
)
def a15(t):
    d = valid_returns(t).groupBy("instrument").agg(*profile.moments_of("log_return"))
    return rounded(d, 6, skewness=5, excess_kurtosis=5)


@case(
    "d08_jarque_bera",
    f"""with {SQL_RETURNS}, m as (select instrument, {SQL_SHAPE} from valid group by 1),
    j as (select instrument, c n, c / 6.0 * (g * g + k * k / 4) jb from m)
    select instrument, n, round(jb, 4) jb_stat, round(exp(-jb / 2), 8) jb_pvalue, exp(-jb / 2) < 0.01 rejects_normality from j""",
)
def d08(t):
    return rounded(stattests.jarque_bera(valid_returns(t), KEY, "log_return"), 4, jb_pvalue=8)


@case(
    "d09_arch_one_lag",
    f"""with {SQL_RETURNS}, q as (select instrument, r * r q, lag(r * r) over (partition by instrument order by pos) p from valid)
    select instrument, count(*) n, round(count(*) * regr_r2(q, p), 5) arch_stat from q where p is not null group by 1""",
)
def d09s(t):
    return rounded(stattests.arch_test(valid_returns(t), TICKS, "log_return", 1).select("instrument", "n", "arch_stat"), 5)


@case("d09_arch")
def d09(t):
    return rounded(stattests.arch_test(valid_returns(t), TICKS, "log_return", 10))


@case(
    "d10_hurst",
    f"""with {SQL_RETURNS}, c as (
      select instrument, pos, n, r, sum(r) over (partition by instrument order by pos) cum from valid),
    sizes as (
      select instrument, n, unnest(list_concat(list_transform(
        range(0, cast(floor((log10(n - 1) - 1) / 0.25 - 1e-12) as bigint) + 1),
        lambda i: cast(floor(pow(10.0, 1 + i * 0.25) + 1e-9) as bigint)), [n])) size
      from (select distinct instrument, n from c)),
    k as (select c.instrument, s.size, c.pos // s.size chunk, max(greatest(cum, cum - r)) - min(least(cum, cum - r)) rng,
            stddev_samp(r) sd, count(*) m
      from c join sizes s using (instrument) group by 1, 2, 3),
    rs as (select instrument, size, avg(rng / sd) rs from k where m = size and rng <> 0 and sd <> 0 group by 1, 2)
    select instrument, round(regr_slope(log10(rs), log10(size)), 6) hurst, count(*) sizes,
      case when regr_slope(log10(rs), log10(size)) < 0.45 then 'mean_reverting'
           when regr_slope(log10(rs), log10(size)) > 0.55 then 'trending' else 'random_walk' end regime
    from rs group by 1""",
)
def d10(t):
    return rounded(stattests.hurst(valid_returns(t), TICKS, "log_return"))


@case(
    "d11_normal_fit",
    f"with {SQL_RETURNS} select instrument, round(avg(r), 6) mu, round(stddev_pop(r), 6) sigma from valid group by 1",
)
def d11(t):
    return rounded(stattests.normal_fit(valid_returns(t), KEY, "log_return"))


@case("d12_t_fit")
def d12(t):
    return rounded(stattests.student_t_fit(valid_returns(t), KEY, "log_return"))


def entity_records(t):
    return stattests.entity_report(t.dense(), DENSE, "y", ["x1", "x2"])


@case("d14_entity_report")
def d14(t):
    return rounded(entity_records(t), 4)


@case("d14_assumptions")
def d14a(t):
    return rounded(stattests.assumption_report(t.dense(), DENSE, "y", ["x1", "x2"], ["nation", "ym"]))


@case("a23_diag_summary")
def a23(t):
    return rounded(profile.diagnostic_summary(entity_records(t)), 4)


@case("a24_issue_score")
def a24(t):
    return profile.worst_entities(entity_records(t), "nation").select("nation", "issue_score")


@case("a25_violations")
def a25(t):
    return profile.violation_counts(
        stattests.assumption_report(t.dense(), DENSE, "y", ["x1", "x2"], ["nation", "ym"])
    )


@case(
    "a26_metric_report",
    """with m as (select event_type instrument, avg(value) mean, stddev_pop(value) std, kurtosis_pop(value) k from events group by 1)
    select instrument, 'mean' metric, round(mean, 5) "value" from m union all select instrument, 'std', round(std, 5) from m
    union all select instrument, 'excess_kurtosis', round(k, 5) from m""",
)
def a26(t):
    wide = t.ticks().groupBy("instrument").agg(*profile.moments_of("mid"))
    return rounded(profile.metric_report(wide, ["mean", "std", "excess_kurtosis"], KEY), 5)


@case("d15_market_report")
def d15(t):
    return rounded(stattests.market_report(valid_returns(t), TICKS, "log_return"))


# --- declared panel tests ------------------------------------------------------------

@case(
    "c06_kpss",
    f"""with {SQL_DENSE}, e as (select *, y - avg(y) over (partition by nation) e from dense),
    l as (select *, sum(e) over w c, lag(e, 1) over w l1, lag(e, 2) over w l2, lag(e, 3) over w l3, lag(e, 4) over w l4
      from e window w as (partition by nation order by ym))
    select nation, count(*) n, round(sum(c * c) / count(*) / (sum(e * e) + 2 * (0.8 * sum(e * l1) + 0.6 * sum(e * l2)
      + 0.4 * sum(e * l3) + 0.2 * sum(e * l4))), 6) kpss_stat from l group by 1""",
)
def c06k(t):
    return rounded(paneltests.kpss(t.dense(), DENSE, "y").select("nation", "n", "kpss_stat"))


@case(
    "c06_chow",
    f"""with {SQL_DENSE}, s as (
      select nation, 'all' part, count(*) n, count(*) * (var_pop(y) - power(covar_pop(x1, y), 2) / var_pop(x1)) sse from dense group by 1
      union all select nation, (ym >= date '1998-06-01')::varchar, count(*), count(*) * (var_pop(y) - power(covar_pop(x1, y), 2) / var_pop(x1))
      from dense group by 1, 2)
    select nation, max(n) n, round(((max(sse) filter (part = 'all') - sum(sse) filter (part <> 'all')) / 2)
      / (sum(sse) filter (part <> 'all') / (max(n) - 4)), 4) chow_f from s group by 1""",
)
def c06c(t):
    import datetime as dt

    d = paneltests.chow(t.dense(), ["nation"], "y", ["x1"], "ym", dt.date(1998, 6, 1))
    return rounded(d.select("nation", "n", "chow_f"), 4)


@case("c06_white")
def c06w(t):
    return rounded(paneltests.white(t.dense(), ["nation"], "y", ["x1", "x2"]))


@case(
    "c06_pesaran_cd",
    """with p as (select c_nationkey nation, year(o_orderdate) yr, round(sum(o_totalprice), 2) y
      from orders join customer on o_custkey = c_custkey group by 1, 2),
    r as (select a.nation, b.nation other, corr(a.y, b.y) r from p a join p b on a.yr = b.yr and a.nation < b.nation group by 1, 2),
    k as (select count(distinct nation) n, count(distinct yr) t, count(*) cells from p)
    select any_value(n) entities, any_value(t) periods,
      case when any_value(cells = n * t) then round(sqrt(2.0 * any_value(t) / (any_value(n) * (any_value(n) - 1))) * sum(r), 6) end cd_stat
    from r, k""",
)
def c06p(t):
    j = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    d = j.groupBy(F.col("c_nationkey").alias("nation"), F.year("o_orderdate").alias("yr")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("y")
    )
    return rounded(paneltests.pesaran_cd(d, "nation", "yr", "y").select("entities", "periods", "cd_stat"))


# --- models --------------------------------------------------------------------------

@case(
    "m01_zscore",
    f"""with {SQL_OBS}, s as (select avg(v) m, stddev_pop(v) d, avg(n) mn, stddev_pop(n) dn from obs where yr <= 1998)
    select entity, yr, round((v - m) / d, 5) z_v, round((n - mn) / dn, 5) z_n from obs, s""",
)
def m01(t):
    d = ml.zscores(t.obs(), ["v", "n"], F.col("yr") <= 1998)
    return rounded(d.select("entity", "yr", "z_v", "z_n"), 5)


@case(
    "m01_zscore_within",
    f"""with {SQL_OBS}, s as (select entity, avg(v) m, nullif(stddev_pop(v), 0) d from obs group by 1)
    select entity, yr, round((v - m) / d, 4) z_v from obs join s using (entity)""",
)
def m01w(t):
    d = ml.zscores(t.obs(), ["v"], keys=["entity"])
    return rounded(d.select("entity", "yr", "z_v"), 4)


FEATURES = ["v_lag1", "v_diff_lag1", "n_lag1", "n_diff_lag1"]


def model_frame(t):
    return materialised(clean.year_split(flagship(t), "yr", 1999), "model-frame")


@case("m02_forest")
def m02(t):
    d = model_frame(t)
    _, metrics = ml.train_and_score(d.where("is_train"), d.where(~F.col("is_train")), FEATURES, "v_diff")
    return rounded(metrics, 4)


@case("m03_baselines")
def m03(t):
    d = materialised(clean.seeded_split(flagship(t), ["entity", "yr"]), "split")
    return rounded(ml.baselines(d, FEATURES, "v_diff"), 4)


@case("m04_importance")
def m04(t):
    d = model_frame(t)
    fitted = ml.fit_forest(d.where("is_train"), FEATURES, "v_diff")
    return rounded(ml.importance(t.spark, fitted, FEATURES))


@case("m05_covariate_ablation")
def m05(t):
    d = model_frame(t)
    variants = {"with_n": FEATURES, "without_n": FEATURES[:2]}
    m = ml.compare_variants(d.where("is_train"), d.where(~F.col("is_train")), variants, "v_diff")
    return rounded(m, 4)


@case(
    "m06_attribution_linear",
    """with c as (select regr_slope(l_extendedprice, l_quantity) a, regr_slope(l_extendedprice, l_discount) b,
        regr_slope(l_extendedprice, l_tax) d, avg(l_quantity) mq, avg(l_discount) md, avg(l_tax) mt from lineitem),
    i as (select avg(abs(a * (l_quantity - mq))) q, avg(abs(b * (l_discount - md))) s, avg(abs(d * (l_tax - mt))) x from lineitem, c),
    u as (select 'l_quantity' feature, q importance from i union all select 'l_discount', s from i union all select 'l_tax', x from i)
    select feature, round(importance, 3) importance, cast(rank() over (order by importance desc) as int) rank from u""",
)
def m06(t):
    names = ["l_quantity", "l_discount", "l_tax"]
    coefs = t.lineitem.agg(*[F.regr_slope("l_extendedprice", c).alias(c) for c in names])
    return rounded(ml.linear_attribution(t.lineitem, coefs, names), 3)


@case("m06_permutation")
def m06p(t):
    d = model_frame(t).dropna()
    fitted = ml.linear(FEATURES, "v_diff").fit(d.where("is_train"))
    return rounded(ml.permutation_importance(fitted, d, FEATURES, "v_diff", ["entity", "yr"]), 2)


@case(
    "m07_forecast_frame",
    f"""with {SQL_OBS} select entity, make_date(yr, 1, 1) ds, round(v, 4) y, n, false is_future from obs
    union all select entity, make_date(cast(last + h as int), 1, 1), null, null, true
    from (select entity, max(yr) last from obs group by 1), range(1, 6) r(h)""",
)
def m07(t):
    return rounded(forecast.forecast_frame(t.obs(), "entity", "yr", "v", ["n"]), 4)


def _forecast(t, holdout=0):
    return forecast.direct_forecast(
        t.dense(), DENSE, "y", ["x1"], holdout=holdout, step=forecast.next_months
    )


@case("m08_forecast")
def m08(t):
    d = _forecast(t).where("is_forecast")
    return rounded(d.select("nation", "ds", "horizon", "yhat"), 3)


@case("m08_holdout_scores")
def m08h(t):
    return rounded(forecast.holdout_scores(_forecast(t, holdout=5)), 3)


@case("m09_components")
def m09(t):
    return rounded(_forecast(t), 3)


@case("m09_forecast_wide")
def m09w(t):
    return rounded(forecast.forecast_wide(_forecast(t), ["nation"]), 3)


@case(
    "m10_blend",
    """with p as (select l_extendedprice y, 1500 * l_quantity p1, 38000.0 + 100 * l_discount p2 from lineitem),
    b as (select *, 0.75 * p1 + 0.25 * p2 blend from p), u as (
      select 'p1' model, y, p1 p from b union all select 'p2', y, p2 from b union all select 'blend', y, blend from b)
    select model, count(*) n, round(avg(abs(y - p)), 3) mae, round(avg((y - p) * (y - p)), 1) mse,
      round(sqrt(avg((y - p) * (y - p))), 3) rmse, round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) r2
    from u group by 1""",
)
def m10(t):
    d = t.lineitem.select(
        F.col("l_extendedprice").alias("y"), (1500 * F.col("l_quantity")).alias("p1"),
        (38000.0 + 100 * F.col("l_discount")).alias("p2"),
    )
    d = forecast.blend(d, {"p1": 3.0, "p2": 1.0})
    return rounded(forecast.model_scores(d, "y", ["p1", "p2", "blend"]), 3, mse=1, r2=6)


# --- streaming -----------------------------------------------------------------------

@case("x01_stream_ingest", SQL_GOOD)
def x01(t):
    logs, out = scratch_path(t.spark, "stream-logs"), scratch_path(t.spark, "stream-ticks")
    t.tick_lines().write.text(logs)
    stream = tick_stream.tick_log_stream(t.spark, logs)
    tick_stream.drain(stream, out, scratch_path(t.spark, "checkpoint"), ("instrument",))
    return tick_rows(t.spark.read.parquet(out))


def event_stream(t, log=None):
    r = t.spark.readStream.schema(t.events.schema)
    e = r.parquet(log) if log else r.option("pathGlobFilter", "events.parquet").parquet(t.root)
    return e.select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("instrument"),
        F.col("value").alias("mid"),
    )


@case("x02_stream_dedupe", f"with {SQL_TICKS} select distinct epoch_us(ts) ts_us, instrument from ticks")
def x02(t):
    out = scratch_path(t.spark, "stream-distinct")
    twice = event_stream(t).select("ts", F.explode(F.array("instrument", "instrument")).alias("instrument"))
    tick_stream.drain(
        tick_stream.distinct_ticks(twice), out, scratch_path(t.spark, "checkpoint")
    )
    return t.spark.read.parquet(out).select(micros(), "instrument")


@case("x03_stream_change", SQL_CUSUM)
def x03(t):
    # The events arrive in three slices of time, each a micro-batch on the state of the one before.
    job, log = ChangeStream(TICKS, "mid", scratch_path(t.spark, "changes")), scratch_path(t.spark, "event-log")
    checkpoint = scratch_path(t.spark, "checkpoint")
    lo, hi = t.events.agg(F.min(F.unix_micros(F.col("ts").cast("timestamp"))), F.max(F.unix_micros(F.col("ts").cast("timestamp")))).first()
    lo, hi = lo or 0, hi or 0  # of an empty table: one empty slice after the other
    at = F.floor((F.unix_micros(F.col("ts").cast("timestamp")) - lo) * 3 / (hi - lo + 1))
    for k in range(3):
        t.events.where(at == k).write.mode("append").parquet(log)
        job.run(event_stream(t, log), checkpoint)
    return rounded(t.spark.read.parquet(job.output).select("event_id", "score", "is_change"), 5)


@case(
    "x04_bar_stream",
    """with t as (select event_type instrument, value, event_id, ts, time_bucket(interval '1 hour', ts) bar from events)
    select instrument, epoch_us(bar) bar_us, arg_min(value, (ts, value)) open, max(value) high, min(value) low,
      arg_max(value, (ts, value)) "close", count(*) volume
    from t where bar + interval '1 hour' <= (select max(ts) - interval '10 minutes' from events) group by 1, 2""",
)
def x04(t):
    out = scratch_path(t.spark, "stream-bars")
    tick_stream.drain(tick_stream.bar_stream(event_stream(t), "1 hour"), out, scratch_path(t.spark, "checkpoint"))
    return t.spark.read.parquet(out).select("instrument", micros("bar_start", "bar_us"), "open", "high", "low", "close", "volume")
