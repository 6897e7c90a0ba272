"""Panel features, imputation, tick features, change points."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelflow.operators import clean, features, impute, regimes
from panelflow.plans.series import public
from panelflow.sources.ticks import unique_ticks
from panelflow.suite.registry import (
    GAP, PANEL, SQL_OBS, SQL_PANEL, SQL_RETURNS, SQL_TICKS, TICKS, case, micros, rnd, rounded,
)
from panelflow.suite.tables import SQL_SPARSE, repeated_ticks, sparse


@case(
    "w01_lags",
    f"""with {SQL_PANEL} select entity, yr, round(lag(v, 1) over w, 4) v_lag1, round(lag(v, 2) over w, 4) v_lag2,
    lag(n, 1) over w n_lag1, lag(n, 2) over w n_lag2 from panel window w as (partition by entity order by yr)""",
)
def w01(t):
    return rounded(features.lags(t.panel(), PANEL, ["v", "n"], [1, 2]).drop("v", "n"), 4)


@case(
    "w02_complete_cases",
    f"""with {SQL_PANEL}, l as (
      select lag(v, 2) over w a, lag(n, 2) over w b from panel window w as (partition by entity order by yr))
    select count(*) "rows", count_if(a is not null and b is not null) complete,
           count_if(a is null or b is null) lost from l""",
)
def w02(t):
    return features.complete_cases(features.lags(t.panel(), PANEL, ["v", "n"], [1, 2]), ["v", "n"], 2)


@case(
    "w03_diff",
    f"""with {SQL_PANEL} select entity, yr, round(v - lag(v) over w, 4) v_diff, n - lag(n) over w n_diff
    from panel window w as (partition by entity order by yr)""",
)
def w03(t):
    return rounded(features.differences(t.panel(), PANEL, ["v", "n"]).drop("v", "n"), 4)


@case(
    "w04_lagged_diff",
    f"""with {SQL_PANEL} select entity, yr, round(lag(v, 1) over w - lag(v, 2) over w, 4) v_diff_lag1
    from panel window w as (partition by entity order by yr)""",
)
def w04(t):
    return rounded(features.lagged_differences(t.panel(), PANEL, ["v"]).select("entity", "yr", "v_diff_lag1"), 4)


@case(
    "w05_log",
    """select c_custkey,
       round(case when c_acctbal + e > 0 then ln(c_acctbal + e) end, 6) log_c_acctbal
    from customer, (select case when min(c_acctbal) <= 0 then 1e-6 else 0 end e from customer)""",
)
def w05(t):
    d = features.log_columns(t.customer.select("c_custkey", "c_acctbal"), ["c_acctbal"])
    return rounded(d.select("c_custkey", "log_c_acctbal"))


def _interp_sql(col: str, source: str, name: str) -> str:
    """Position-based interpolation of one column as three CTEs ending in ``name``."""
    return f"""{name}_a as (select *, row_number() over (partition by entity order by yr) rn from {source}),
    {name}_b as (select *,
      last_value({col} ignore nulls) over b pv, last_value(case when {col} is not null then rn end ignore nulls) over b pr,
      first_value({col} ignore nulls) over f nv, first_value(case when {col} is not null then rn end ignore nulls) over f nr,
      count({col}) over (partition by entity) known
      from {name}_a
      window b as (partition by entity order by yr rows between unbounded preceding and current row),
             f as (partition by entity order by yr rows between current row and unbounded following)),
    {name} as (select * exclude (rn, pv, pr, nv, nr, known), known {name}_known,
      coalesce({col}, case when pv is not null and nv is not null then pv + (nv - pv) * (rn - pr) / (nr - pr) end, pv, nv) {name}_fill
      from {name}_b)"""


@case(
    "w06_interpolate",
    f"""with {SQL_PANEL}, {_interp_sql('v', 'panel', 'x')}
    select entity, yr, round(case when x_known >= 2 then x_fill else v end, 6) v from x""",
)
def w06(t):
    return rounded(impute.interpolate(t.panel().drop("n"), PANEL, ["v"]), 6)


SQL_IMPUTE = f"""with {SQL_SPARSE}, wide as (
      select s.*, case when s.v < 300000 then s.v / 2 end z, case when s.v > 200000 then s.v / 3 end o
      from sparse s where entity in (select entity from sparse group by 1 having count(m) > 0)),
    {_interp_sql('v', 'wide', 'a')}, {_interp_sql('m', 'a', 'b')}, {_interp_sql('z', 'b', 'c')}, {_interp_sql('o', 'c', 'd')}"""


def wide_panel(t):
    """v and m critical, z zero-fill, o other."""
    v = F.col("v")
    return sparse(t).drop("n").withColumns(
        {"z": F.when(v < 300000, v / 2), "o": F.when(v > 200000, v / 3)}
    )


@case(
    "w07_impute",
    SQL_IMPUTE
    + """ select * from (select entity, yr, round(a_fill, 6) v, round(b_fill, 6) m, round(coalesce(c_fill, 0), 6) z,
      round(case when d_known >= 2 then d_fill else o end, 6) o from d)
      where o is not null and v is not null and m is not null""",
)
def w07(t):
    d = impute.impute(wide_panel(t), PANEL, critical=["v", "m"], zero_fill=["z"], untouched=[])
    return rounded(d.select("entity", "yr", "v", "m", "z", "o"), 6)


@case(
    "w07_impute_drop",
    SQL_IMPUTE
    + """ select * from (select entity, yr, round(a_fill, 6) v, round(b_fill, 6) m, round(coalesce(c_fill, 0), 6) z,
      round(o, 6) o from d) where o is not null and v is not null and m is not null""",
)
def w07d(t):
    d = impute.impute(wide_panel(t), PANEL, method="drop", critical=["v", "m"], zero_fill=["z"], untouched=[])
    return rounded(d.select("entity", "yr", "v", "m", "z", "o"), 6)


def flagship(t):
    """Panel features, entity removal, imputation: the panel flow's core."""
    d = features.lag_family(t.panel().withColumn("n", F.col("n").cast("double")), PANEL, ["v", "n"], [1])
    return impute.impute(d, PANEL, critical=["v", "n"], zero_fill=[], untouched=[])


@case(
    "panel_features_imputed",
    f"""with {SQL_PANEL}, f0 as (
      select entity, yr, v, lag(v) over w v_lag1, v - lag(v) over w v_diff,
             lag(v) over w - lag(v, 2) over w v_diff_lag1
      from panel window w as (partition by entity order by yr)),
    {_interp_sql('v', 'f0', 'a')}, {_interp_sql('v_lag1', 'a', 'b')}, {_interp_sql('v_diff', 'b', 'c')},
    {_interp_sql('v_diff_lag1', 'c', 'd')}
    select * from (select entity, yr, round(a_fill, 6) v,
      round(case when b_known >= 2 then b_fill else v_lag1 end, 6) v_lag1,
      round(case when c_known >= 2 then c_fill else v_diff end, 6) v_diff,
      round(case when d_known >= 2 then d_fill else v_diff_lag1 end, 6) v_diff_lag1 from d)
    where v is not null and v_lag1 is not null and v_diff is not null and v_diff_lag1 is not null""",
)
def panel_features(t):
    d = flagship(t)
    return rounded(d.select("entity", "yr", "v", "v_lag1", "v_diff", "v_diff_lag1"), 6)


# --- ticks ---------------------------------------------------------------------------

@case(
    "w08_gaps",
    f"""with {SQL_TICKS}, d as (
      select event_id, (epoch_us(ts) - lag(epoch_us(ts)) over (partition by instrument order by ts, event_id)) / 1e6 dt from ticks)
    select event_id, round(dt, 6) dt, coalesce(dt > 3600, false) is_gap from d""",
)
def w08(t):
    d = features.gaps(t.ticks().select("event_id", "ts", "instrument"), TICKS, "ts", GAP)
    return rounded(d.select("event_id", "dt", "is_gap"))


def returns(t, gap=None):
    d = t.ticks().select("event_id", "ts", "instrument", "mid")
    return features.log_returns(d, TICKS, "mid", "ts", gap)


def valid_returns(t):
    return returns(t, GAP)


@case("w09_log_return", f"with {SQL_RETURNS} select event_id, round(r, 6) log_return from valid")
def w09(t):
    return rounded(valid_returns(t).select("event_id", "log_return"))


@case(
    "w10_rolling",
    f"""with {SQL_RETURNS}, f as (
      select event_id, stddev_samp(abs(r)) over w s, avg(abs(r)) over w a, count(*) over w c
      from rets window w as (partition by instrument order by ts, event_id rows between 19 preceding and current row))
    select event_id, round(s, 6) volatility, round(a, 6) activity from f where c = 20""",
)
def w10(t):
    d = features.rolling_features(returns(t), TICKS)
    d = d.where(F.col("volatility").isNotNull())
    return rounded(d.select("event_id", "volatility", "activity"))


@case(
    "w11_sequences",
    f"""with {SQL_RETURNS}, f as (
      select *, stddev_samp(abs(r)) over w s, avg(abs(r)) over w a, count(*) over w c
      from rets window w as (partition by instrument order by ts, event_id rows between 19 preceding and current row)),
    g as (select *, count(*) over k size, sum(r::float::double) over k sum_return, sum(s::float::double) over k sum_vol,
            lead(r::float) over (partition by instrument order by ts, event_id) y
      from f where c = 20
      window k as (partition by instrument order by ts, event_id rows between 29 preceding and current row))
    select event_id, cast(size as int) size, round(sum_return, 4) sum_return, round(sum_vol, 4) sum_vol, round(y::double, 5) y
    from g where size = 30 and y is not null""",
)
def w11(t):
    d = t.ticks().select("event_id", "ts", "instrument", "mid")
    d = features.tick_samples(d, TICKS, "mid", "ts")

    def total(name):
        return F.aggregate(
            F.transform("x", lambda e: e[name].cast("double")), F.lit(0.0), lambda acc, e: acc + e
        )

    return d.select(
        "event_id", F.size("x").alias("size"), rnd(total("log_return"), 4).alias("sum_return"),
        rnd(total("volatility"), 4).alias("sum_vol"), rnd("y", 5).alias("y"),
    )


@case(
    "w12_panel_sequences",
    f"""with {SQL_OBS}, s as (
      select entity, yr, sum(n) over w sum_n, count(*) over w c, v
      from obs window w as (partition by entity order by yr rows between 3 preceding and 1 preceding))
    select entity, yr, cast(sum_n as bigint) sum_n, round(v, 4) y from s where c = 3""",
)
def w12(t):
    d = features.panel_sequences(t.obs(), PANEL, "v", ["n"], 3)
    total = F.aggregate("x", F.lit(0).cast("long"), lambda acc, e: acc + e["n"])
    return d.select("entity", "yr", total.alias("sum_n"), rnd("y", 4).alias("y"))


def _dedupe_sql(direction: str) -> str:
    return f"""with {SQL_TICKS}, u as (
      select *, 0 seq from ticks
      union all select event_id, ts, instrument, mid + 1, bid + 1, ask + 1, 1 from ticks where event_id % 7 = 0)
    select epoch_us(ts) ts_us, instrument, round(mid, 6) mid from (
      select *, row_number() over (partition by ts, instrument order by seq {direction}, bid {direction}) r from u) where r = 1"""


def _repeated(t):
    first = t.ticks().withColumn("seq", F.lit(0).cast("long"))
    return first.unionByName(repeated_ticks(t)).drop("event_id")


@case("w13_dedupe_first", _dedupe_sql("asc"))
def w13f(t):
    return rounded(unique_ticks(_repeated(t), "first").select(micros(), "instrument", "mid"))


@case("w13_dedupe_last", _dedupe_sql("desc"))
def w13l(t):
    return rounded(unique_ticks(_repeated(t), "last").select(micros(), "instrument", "mid"))


@case(
    "w14_jumps",
    f"""with {SQL_TICKS}, d as (select event_id, mid, lag(mid) over (partition by instrument order by ts, event_id) previous from ticks)
    select event_id, round(previous, 6) previous, round(abs(mid - previous), 6) jump from d where abs(mid - previous) > 5""",
)
def w14(t):
    d = features.jumps(t.ticks().select("event_id", "ts", "instrument", "mid"), TICKS, "mid", 5.0)
    return rounded(d.select("event_id", "previous", "jump"))


@case(
    "w15_fraction_split",
    f"""with {SQL_TICKS}, p as (
      select *, row_number() over (partition by instrument order by ts, event_id) rn, count(*) over (partition by instrument) n from ticks)
    select event_id, rn <= floor(n * 0.8) is_train from p""",
)
def w15(t):
    d = clean.fraction_split(t.ticks().select("event_id", "ts", "instrument"), TICKS, 0.8)
    return d.select("event_id", "is_train")


SQL_WELCH = f"""with {SQL_TICKS}, f as (
      select event_id, ts, instrument, mid,
        row_number() over o - 1 pos, count(*) over (partition by instrument) n,
        avg(mid) over p m1, var_samp(mid) over p v1, avg(mid) over q m2, var_samp(mid) over q v2
      from ticks
      window o as (partition by instrument order by ts, event_id),
             p as (partition by instrument order by ts, event_id rows between 10 preceding and 1 preceding),
             q as (partition by instrument order by ts, event_id rows between current row and 9 following)),
    w as (select *, case when pos >= 10 and pos < n - 10 then (m1 - m2) / sqrt(v1 / 10 + v2 / 10) end t,
            case when pos >= 10 and pos < n - 10 then power(v1 / 10 + v2 / 10, 2) / ((power(v1 / 10, 2) + power(v2 / 10, 2)) / 9) end dof
      from f)"""


def _mids(t):
    return t.ticks().select("event_id", "ts", "instrument", "mid")


@case(
    "w16_welch",
    SQL_WELCH
    + """ select epoch_us(ts) ts_us, instrument, pos "index", round(t, 6) statistic, round(dof, 6) dof,
    round(m1, 6) mean_before, round(m2, 6) mean_after from w where abs(t) > 2.5""",
)
def w16(t):
    d = regimes.welch_scores(_mids(t), TICKS, "mid", 10).where(F.abs("statistic") > 2.5)
    return rounded(
        d.select(micros(), "instrument", F.col("_pos").alias("index"), "statistic", "dof", "mean_before", "mean_after")
    )


@case("w16_change_points")
def w16c(t):
    return rounded(regimes.change_points(_mids(t), TICKS, "mid").drop("ts"), 6, p_value=9)


@case("w16_change_points_local_max")
def w16m(t):
    return rounded(regimes.change_points(_mids(t), TICKS, "mid", local_max=True).drop("ts"), 6, p_value=9)


# The segment rule itself, on change flags that SQL can also compute: |t| > 2.5.
@case(
    "w17_segments",
    SQL_WELCH
    + """, g as (select *, coalesce(abs(t) > 2.5, false) flag from w),
    h as (select *, sum(flag::int) over (partition by instrument order by ts, event_id) segment,
            sum(flag::int) over (partition by instrument) changes from g)
    select instrument, min(pos) "start", max(pos) + 1 "end", case when any_value(changes) = 0 then 'single'
      when count(*) < 2 then 'unknown' when regr_slope(mid, pos) > 0.1 then 'increasing'
      when regr_slope(mid, pos) < -0.1 then 'decreasing' else 'stable' end "type"
    from h group by instrument, segment""",
)
def w17s(t):
    d = regimes.welch_scores(_mids(t), TICKS, "mid", 10)
    d = d.withColumn("is_change", F.coalesce(F.abs("statistic") > 2.5, F.lit(False)))
    return regimes.segments(d, TICKS, "mid", part="_blk")


@case("w17_regimes")
def w17(t):
    return regimes.regimes(_mids(t), TICKS, "mid")


SQL_CUSUM = f"""with {SQL_TICKS}, f as (
      select event_id, ts, instrument, mid, sum(mid) over r s, avg(mid) over h m, stddev_pop(mid) over h sd, count(*) over h c
      from ticks
      window r as (partition by instrument order by ts, event_id rows between 9 preceding and current row),
             h as (partition by instrument order by ts, event_id rows between 19 preceding and 10 preceding))
    select event_id, round((s - 10 * m) / (sd + 1e-10), 5) score, abs((s - 10 * m) / (sd + 1e-10)) > 2.5 is_change
    from f where c = 10"""


@case("w18_cusum", SQL_CUSUM)
def w18(t):
    return rounded(public(regimes.cusum(_mids(t), TICKS, "mid")).select("event_id", "score", "is_change"), 5)


@case(
    "w19_current_regime",
    f"""with {SQL_TICKS}, r as (
      select *, row_number() over (partition by instrument order by ts desc, event_id desc) r from ticks)
    select instrument, case when count(*) < 10 then 'insufficient_data' when regr_slope(mid, -r) > 0.1 then 'increasing'
      when regr_slope(mid, -r) < -0.1 then 'decreasing' else 'stable' end regime
    from r where r <= 10 group by 1""",
)
def w19(t):
    return regimes.current_regime(_mids(t), TICKS, "mid")


# --- declared extras -----------------------------------------------------------------

@case(
    "c01_per_capita",
    f"with {SQL_OBS} select entity, yr, round(v / n, 6) v_per_capita from obs",
)
def c01(t):
    return rounded(features.per_capita(t.obs(), ["v"], "n").select("entity", "yr", "v_per_capita"))


@case(
    "c03_fill_forward_back",
    f"""with {SQL_PANEL}, f as (
      select *, last_value(v ignore nulls) over (partition by entity order by yr rows between 3 preceding and current row) f from panel)
    select entity, yr, round(coalesce(f, first_value(f ignore nulls) over (
      partition by entity order by yr rows between current row and 3 following)), 4) v from f""",
)
def c03(t):
    return rounded(impute.fill_forward_back(t.panel().drop("n"), PANEL, ["v"]), 4)


@case(
    "c04_interactions",
    f"with {SQL_OBS} select entity, yr, round(v * n, 2) v_x_n from obs",
)
def c04(t):
    return rounded(features.interactions(t.obs(), [("v", "n")]).select("entity", "yr", "v_x_n"), 2)


@case(
    "c05_period_split",
    f"""with {SQL_OBS}, p as (select yr, row_number() over (order by yr desc) r from (select distinct yr from obs))
    select entity, yr, case when r <= 1 then 'test' when r <= 3 then 'validation' else 'train' end part
    from obs join p using (yr)""",
)
def c05(t):
    return clean.period_split(t.obs().select("entity", "yr"), "yr", 1, 2)


@case(
    "c07_bars",
    """with t as (select event_id, event_type, value, date_trunc('minute', ts) ts from events)
    select event_type instrument, epoch_us(time_bucket(interval '15 minutes', ts)) bar_us, arg_min(value, (ts, event_id)) open,
       max(value) high, min(value) low, arg_max(value, (ts, event_id)) "close", count(*) volume from t group by 1, 2""",
)
def c07(t):
    # whole minutes, so that ticks of equal time occur
    d = t.ticks().withColumn("ts", F.date_trunc("minute", "ts"))
    b = features.bars(d, ["instrument"], "ts", "mid", "15 minutes", tiebreak=["event_id"])
    return b.select("instrument", micros("bar_start", "bar_us"), "open", "high", "low", "close", "volume")


@case(
    "w06_interpolate_ticks",
    f"""with {SQL_TICKS}, holed as (
      select event_id, instrument, ts, case when event_id % 3 > 0 then mid end v from ticks),
    r as (select *, row_number() over w pos, count(v) over (partition by instrument) known from holed
      window w as (partition by instrument order by ts, event_id)),
    a as (select *,
      last_value(v ignore nulls) over p pv, last_value(case when v is not null then pos end ignore nulls) over p pp,
      first_value(v ignore nulls) over f nv, first_value(case when v is not null then pos end ignore nulls) over f np
      from r window p as (partition by instrument order by pos rows between unbounded preceding and current row),
        f as (partition by instrument order by pos rows between current row and unbounded following))
    select event_id, instrument, round(case when known < 2 then v
      else coalesce(v, pv + (nv - pv) * (pos - pp) / (np - pp), pv, nv) end, 6) v from a""",
)
def w06t(t):
    d = t.ticks().select("event_id", "instrument", "ts", F.when(F.col("event_id") % 3 > 0, F.col("mid")).alias("v"))
    return rounded(impute.interpolate(d, TICKS, ["v"]).select("event_id", "instrument", "v"), 6)
