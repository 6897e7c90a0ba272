"""Filters, joins, sets, profiles and sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelflow.functions.scalars import entity_code, safe_name, slug
from panelflow.operators import clean, gram, profile
from panelflow.session import scratch_path
from panelflow.sources import catalog, directory, readers, ticks, writers
from panelflow.suite.registry import PANEL, SQL_LINES, SQL_PANEL, SQL_OBS, SQL_TICKS, case, micros, rnd, rounded

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# Their columns and types, for the SQL twins.
TABLE_COLUMNS = {
    name: dict(c.split(" ") for c in columns.split(", "))
    for name, columns in {
        "region": "r_regionkey int, r_name string",
        "nation": "n_nationkey int, n_name string, n_regionkey int",
        "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
        "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
        "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
        "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
        "o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
        "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
        "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
        "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
        "embeddings": "vec_id bigint, embedding array<float>, label int",
        "pages": "page_id bigint, url string, html string",
        "benchmark": "item_id bigint, text string",
        "labels": "doc_id bigint, quality int, toxic int",
        "conversations": "conv_id bigint, turn bigint, role string, text string",
    }.items()
}


def _column_sql(table: str, c: str, kind: str) -> list[str]:
    row = lambda m, e, frm=table: f"""select '{table}' dataset, '{c}' as "column", '{m}' metric, {e} as "value" from {frm}"""
    out = [row("type", f"'{kind}'", "(select 1)"), row("missing", f"count_if({c} is null)::varchar")]
    out.append(row("distinct", f"(count(distinct {c}) + coalesce(max(({c} is null)::int), 0))::varchar"))
    if kind in NUMERIC_TYPES:
        for m, e in {
            "mean": f"avg({c})", "std": f"stddev_samp({c})", "min": f"min({c})", "q25": f"quantile_cont({c}, 0.25)",
            "q50": f"quantile_cont({c}, 0.5)", "q75": f"quantile_cont({c}, 0.75)", "max": f"max({c})",
        }.items():
            out.append(row(m, f"(({e})::double)::decimal(38,4)::varchar"))
    return out


NUMERIC_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double")


def _shown_sql(c: str, kind: str) -> str:
    if kind in ("float", "double"):
        return f"({c}::double)::decimal(38,4)::varchar"
    if kind.startswith("timestamp"):
        return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"
    return f"len({c})::varchar" if kind.startswith("array") else f"substring({c}::varchar, 1, 60)"


def _suitability_sql(table: str, columns: dict[str, str]) -> str:
    """The measured numbers and the codes of ``profile.suitability`` as one row."""
    numeric = [c for c, kind in columns.items() if kind in NUMERIC_TYPES]
    y = numeric[-1] if numeric else "null"
    rs = [
        f"case when regr_sxx({c}, {y}) > 0 and regr_syy({c}, {y}) > 0 then abs(regr_sxy({c}, {y}) / sqrt(regr_sxx({c}, {y}) * regr_syy({c}, {y}))) end"
        for c in numeric[:-1]
    ]
    cells = " + ".join(f"count_if({c} is null)" for c in columns)
    r = f"greatest({', '.join(rs)})" if len(rs) > 1 else rs[0] if rs else "null::double"
    spread = f"var_pop({y}::double)" if numeric else "null::double"
    return f"""(select '{table}' dataset, n, {len(numeric)} k, share,
      list_filter([
        case when n < 200 then {{'code': 'few_rows', 'value': n::double}} end,
        case when {len(numeric)} < 2 then {{'code': 'few_numeric', 'value': {len(numeric)}::double}} end,
        case when share > 0.3 then {{'code': 'missing_share', 'value': share}} end,
        case when spread = 0 then {{'code': 'flat_target', 'value': spread}} end,
        case when n >= 200 and {len(numeric)} >= 2 and r < 0.1 then {{'code': 'weak_r', 'value': r}} end], lambda x: x is not null) reasons
      from (select count(*) n, ({cells})::double / nullif(count(*) * {len(columns)}, 0) share, {spread} spread, {r} r from {table}))"""


UNFIT_SQL = "list_contains(list_transform(reasons, lambda x: x.code), 'few_numeric')"
FLAT_SQL = "list_contains(list_transform(reasons, lambda x: x.code), 'flat_target')"
LINEAR_SQL = f"case when {UNFIT_SQL} then 'no' when {FLAT_SQL} then 'caveats' else 'yes' end"
FOREST_SQL = f"case when {UNFIT_SQL} or {FLAT_SQL} then 'no' else 'yes' end"


def _profile_sql(table: str, columns: dict[str, str], name: str | None = None) -> str:
    """The SQL twin of ``profile.table_profile``."""
    row = lambda m, e, frm: f"""select '{table}' dataset, '' as "column", '{m}' metric, {e} as "value" from {frm}"""
    every = ", ".join(columns)
    fit = _suitability_sql(table, columns)
    parts = [
        row("rows", "count(*)::varchar", table), row("columns", f"'{len(columns)}'", "(select 1)"),
        row("duplicates", "coalesce(cast(sum(n - 1) as bigint), 0)::varchar", f"(select count(*) n from {table} group by {every})"),
        row("linear_verdict", LINEAR_SQL, fit), row("forest_verdict", FOREST_SQL, fit),
        row("reasons", "array_to_string(list_transform(reasons, lambda x: x.code), ',')", fit),
    ]
    for c, kind in columns.items():
        parts += _column_sql(table, c, kind)
    order = ", ".join(f"{c} nulls first" for c, kind in columns.items() if not kind.startswith("array"))
    head = f"(select *, row_number() over (order by {order}) i from {table} qualify i <= 5)"
    parts += [f"""select '{table}', '{c}', concat('first_', i), {_shown_sql(c, kind)} from {head}""" for c, kind in columns.items()]
    out = " union all ".join(parts)
    return out if name is None else f"""select '{name}' dataset, "column", metric, "value" from ({out})"""


# --- sources -------------------------------------------------------------------------

@case("s01_csv_scan", "select n_nationkey, n_name, n_regionkey from nation")
def s01(t):
    path = writers.save_csv(t.nation, scratch_path(t.spark, "csv"), "nation")
    return readers.read_csv(t.spark, path, t.nation.schema)


@case("s02_csv_sniffed", "select s_suppkey, s_name, s_nationkey, s_acctbal from supplier")
def s02(t):
    path = scratch_path(t.spark, "csv-semicolon")
    t.supplier.write.option("header", True).option("sep", ";").csv(path)
    return readers.read_csv_sniffed(t.spark, path, t.supplier.schema)


SQL_BARS = """bars as (
  select event_type instrument, date_trunc('hour', ts) h, arg_min(value, ts) o, max(value) hi,
         min(value) lo, arg_max(value, ts) c, count(*) vol
  from events group by 1, 2)"""


def hourly_bars(t):
    from panelflow.operators.features import bars

    return bars(t.ticks(), ["instrument"], "ts", "mid", "1 hour")


@case(
    "s03_ohlc_scan",
    f"""with {SQL_BARS}
    select epoch_us(h) ts_us, instrument, c bid, c ask, c mid, round(hi - lo, 6) spread, 'historical' source
    from bars""",
)
def s03(t):
    path = scratch_path(t.spark, "bars")
    b = hourly_bars(t)
    # The bar files carry no instrument column: it is the folder the file lies in.
    b.select(
        "instrument",
        F.date_format("bar_start", "yyyy.MM.dd").alias("date"),
        F.date_format("bar_start", "HH:mm").alias("time"),
        "open", "high", "low", "close", "volume",
    ).write.partitionBy("instrument").csv(path)
    raw = t.spark.read.schema(ticks.BAR_SCHEMA + ", instrument string").csv(path)
    d = ticks.ticks_from_bars(raw, F.col("instrument"))
    return d.select(micros(), "instrument", "bid", "ask", "mid", rnd("spread").alias("spread"), "source")


SQL_GOOD = f"""with {SQL_LINES}
    select epoch_us(ts) ts_us, instrument, round(bid, 6) bid, round(ask, 6) ask,
           round((bid + ask) / 2, 6) mid, round(ask - bid, 6) spread, 'live' source from good"""


def tick_rows(d):
    return rounded(d.select(micros(), "instrument", "bid", "ask", "mid", "spread", "source"))


@case("s04_tick_log_scan", SQL_GOOD)
def s04(t):
    path = scratch_path(t.spark, "tick-log")
    t.tick_lines().write.text(path)
    return tick_rows(ticks.read_tick_logs(t.spark, path))


@case("s05_parquet_columns", "select epoch_us(ts) ts_us, value from events")
def s05(t):
    return readers.read_parquet(t.spark, f"{t.root}/events.parquet", ["ts", "value"]).select(
        F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"), "value"
    )


@case(
    "s06_document_scan",
    """select event_id, k from (
      select event_id, cast(regexp_extract(props, '"k": ([0-9]+)', 1) as bigint) k from events) where k > 50""",
)
def s06(t):
    return readers.parse_documents(t.events.select("event_id", "props"), "props", "k long", "k > 50")


@case(
    "s13_append_merge",
    f"""with {SQL_TICKS}, batches as (
      select *, 0 seq from ticks
      union all select event_id, ts, instrument, mid + 1, bid + 1, ask + 1, 1 from ticks where event_id % 7 = 0),
    ranked as (
      select *, row_number() over (partition by instrument, ts order by seq desc, bid desc, ask desc) r from batches)
    select epoch_us(ts) ts_us, instrument, round(bid, 6) bid, round(ask, 6) ask, round(mid, 6) mid, cast(seq as bigint) seq
    from ranked where r = 1""",
)
def s13(t):
    path = scratch_path(t.spark, "tick-store")
    first = t.ticks().withColumn("seq", F.lit(0).cast("long")).drop("event_id")
    again = repeated_ticks(t).drop("event_id")
    ticks.append_merge(t.spark, first, path, keep="last")
    ticks.append_merge(t.spark, again, path, keep="last")
    d = t.spark.read.parquet(path)
    return rounded(d.select(micros(), "instrument", "bid", "ask", "mid", "seq"))


def repeated_ticks(t):
    """A later batch that repeats some ticks at a shifted price."""
    d = t.ticks().where(F.col("event_id") % 7 == 0)
    return d.withColumns({c: F.col(c) + 1 for c in ("mid", "bid", "ask")} | {"seq": F.lit(1).cast("long")})


@case(
    "s15_table_counts",
    " union all ".join(f"select '{n}' as \"table\", count(*) as \"rows\" from {n}" for n in DRIVER_TABLES),
)
def s15(t):
    return catalog.table_counts({n: getattr(t, n) for n in DRIVER_TABLES})


@case(
    "s16_entity_tables",
    """select * from (select 'customer' as "table", count(*) as "rows" from customer where c_nationkey = 7
       union all select 'supplier', count(*) from supplier where s_nationkey = 7) where "rows" > 0""",
)
def s16(t):
    tables = {
        "customer": t.customer.withColumnRenamed("c_nationkey", "nation"),
        "supplier": t.supplier.withColumnRenamed("s_nationkey", "nation"),
        "region": t.region,
    }
    return catalog.tables_with_entity(tables, "nation", 7)


# --- filters and joins ---------------------------------------------------------------

@case("p01_projection", "select o_orderkey, o_custkey, o_totalprice from orders")
def p01(t):
    return clean.project(t.orders, ["o_orderkey", "o_custkey", "o_totalprice"])


@case("p02_not_null", f"with {SQL_PANEL} select entity, yr, round(v, 4) v from panel where v is not null")
def p02(t):
    return clean.not_null(t.panel(), "v").select("entity", "yr", rnd("v", 4).alias("v"))


@case(
    "p04_threshold_counts",
    """select count_if(c_acctbal < -20) below, count_if(c_acctbal = 0) zero, count_if(c_acctbal > 0) above,
       count_if(c_acctbal < 0) negative from customer""",
)
def p04(t):
    b = F.col("c_acctbal")
    return clean.predicate_counts(t.customer, {"below": b < -20, "zero": b == 0, "above": b > 0, "negative": b < 0})


@case(
    "p05_finite",
    """select event_id, round(x, 6) x from (
      select event_id, case when event_id % 97 = 0 then null when event_id % 89 = 0 then 'inf'::double
        when event_id % 83 = 0 then 'nan'::double else value end x from events)
    where x is not null and isfinite(x)""",
)
def p05(t):
    i = F.col("event_id")
    x = (
        F.when(i % 97 == 0, F.lit(None).cast("double"))
        .when(i % 89 == 0, F.lit(float("inf")))
        .when(i % 83 == 0, F.lit(float("nan")))
        .otherwise(F.col("value"))
    )
    return rounded(clean.finite(t.events.select("event_id", x.alias("x")), "x"))


@case("p06_tick_valid", f"with {SQL_LINES} select instrument, count(*) n, round(sum(bid), 4) bids from good group by 1")
def p06(t):
    d = ticks.ticks_from_lines(t.tick_lines())
    return d.groupBy("instrument").agg(F.count(F.lit(1)).alias("n"), rnd(F.sum("bid"), 4).alias("bids"))


@case(
    "p06_tick_rejects",
    f"""with {SQL_LINES} select (select count(*) from lines) - (select count(*) from good) rejected""",
)
def p06r(t):
    return ticks.rejects(t.tick_lines()).agg(F.count(F.lit(1)).alias("rejected"))


@case("p07_dropna", f"with {SQL_PANEL} select entity, yr, n from panel where v is not null and n is not null")
def p07(t):
    return clean.drop_missing(t.panel(), ["v", "n"]).select("entity", "yr", "n")


SQL_SPARSE = f"""{SQL_PANEL}, sparse as (
  select entity, yr, v, case when v > 150000 then n end m from panel)"""


def sparse(t):
    return t.panel().withColumn("m", F.when(F.col("v") > 150000, F.col("n")))


@case(
    "p08_drop_all_missing",
    f"""with {SQL_SPARSE} select entity, yr, round(v, 4) v from sparse
    where entity in (select entity from sparse group by 1 having count(v) > 0 and count(m) > 0)""",
)
def p08(t):
    d = clean.drop_all_missing(sparse(t), "entity", ["v", "m"])
    return d.select("entity", "yr", rnd("v", 4).alias("v"))


@case(
    "p09_min_obs",
    """select o_orderkey, o_custkey from orders
    where o_custkey in (select o_custkey from orders group by 1 having count(*) >= 10)""",
)
def p09(t):
    return clean.min_observations(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", 10)


@case(
    "p11_year_split",
    f"with {SQL_OBS} select yr <= 1998 is_train, count(*) n, round(sum(v), 2) v from obs group by 1",
)
def p11(t):
    d = clean.year_split(t.obs(), "yr", 1998)
    return d.groupBy("is_train").agg(F.count(F.lit(1)).alias("n"), rnd(F.sum("v"), 2).alias("v"))


@case(
    "j01_entity_list",
    """select n_nationkey, n_name, upper(substr(n_name, 1, 3)) code, replace(lower(n_name), ' ', '_') slug,
       regexp_replace(n_name, '[^A-Za-z0-9]', '_', 'g') safe
    from nation where n_name in (select n_name from nation where n_regionkey in (1, 3))""",
)
def j01(t):
    names = t.nation.where(F.col("n_regionkey").isin(1, 3)).select("n_name")
    d = clean.members_only(t.nation, "n_name", names)
    return d.select(
        "n_nationkey", "n_name", entity_code("n_name").alias("code"),
        slug("n_name").alias("slug"), safe_name("n_name").alias("safe"),
    )


@case(
    "j02_missing_cells",
    f"with {SQL_PANEL} select entity, yr from panel where v is null",
)
def j02(t):
    from panelflow.plans.grid import missing_cells

    return missing_cells(t.obs(), "entity", "yr")


@case(
    "j03_group_stat",
    """select o_orderkey, o_custkey, count(*) over (partition by o_custkey) n,
       round(round(sum(o_totalprice) over (partition by o_custkey), 2) / count(*) over (partition by o_custkey), 6) m
       from orders""",
)
def j03(t):
    d = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    d = profile.group_stat(d, ["o_custkey"], {"n": F.count(F.lit(1)), "s": F.round(F.sum("o_totalprice"), 2)})
    return d.select("o_orderkey", "o_custkey", "n", rnd(F.col("s") / F.col("n"), 6).alias("m"))


@case("j04_skip_present", "select doc_id, lang from documents where doc_id not in (select doc_id from labels)")
def j04(t):
    return clean.skip_present(t.documents.select("doc_id", "lang"), t.labels, ["doc_id"])


@case(
    "j05_assemble",
    f"""with {SQL_OBS}, late as (
      select o_custkey entity, cast(year(l_shipdate) as int) yr, sum(l_quantity) q
      from lineitem join orders on l_orderkey = o_orderkey group by 1, 2)
    select entity, yr, round(v, 4) v, round(q, 4) q from obs full join late using (entity, yr)""",
)
def j05(t):
    shipped = (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("o_custkey").alias("entity"), F.year("l_shipdate").alias("yr"))
        .agg(F.sum("l_quantity").alias("q"))
    )
    d = clean.assemble([t.obs().drop("n"), shipped], ["entity", "yr"])
    return rounded(d, 4)


@case(
    "u01_union",
    """select 'c' kind, c_nationkey nation, c_acctbal bal from customer
       union all select 's', s_nationkey, s_acctbal from supplier""",
)
def u01(t):
    a = t.customer.select(F.lit("c").alias("kind"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("bal"))
    b = t.supplier.select(F.col("s_acctbal").alias("bal"), F.lit("s").alias("kind"), F.col("s_nationkey").alias("nation"))
    return clean.union(a, b)


def big_orders(t):
    return t.orders.where(F.col("o_totalprice") > 400000)


@case(
    "u02_minus",
    "select o_custkey from orders except select o_custkey from orders where o_totalprice > 400000",
)
def u02(t):
    return clean.entities_lost(t.orders, big_orders(t), "o_custkey")


@case(
    "u03_intersect",
    "select o_custkey from orders where o_totalprice > 400000 intersect select c_custkey from customer where c_acctbal > 0",
)
def u03(t):
    good = t.customer.where(F.col("c_acctbal") > 0).select(F.col("c_custkey").alias("o_custkey"))
    return clean.entities_common(big_orders(t), good, "o_custkey")


@case("u04_distinct", "select distinct event_type, user_id from events")
def u04(t):
    return t.events.select("event_type", "user_id").distinct()


# --- profiles ------------------------------------------------------------------------

@case("a01_period_counts", "select cast(year(o_orderdate) as int) yr, count(*) n from orders group by 1")
def a01(t):
    return profile.period_counts(t.orders.select(F.year("o_orderdate").alias("yr")), "yr")


@case(
    "a02_ranges",
    """select min(year(o_orderdate))::int min_time, max(year(o_orderdate))::int max_time,
       count(distinct o_custkey) entities, count(*) total from orders""",
)
def a02(t):
    return profile.ranges(t.orders.select("o_custkey", F.year("o_orderdate").alias("yr")), "o_custkey", "yr")


DESCRIBED = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@case(
    "a03_describe",
    " union all ".join(
        f"""select '{c}' as "column", count({c}) "count", round(avg({c}), 6) mean, round(stddev_samp({c}), 6) std,
        min({c}) min, round(quantile_cont({c}, 0.25), 6) q25, round(quantile_cont({c}, 0.5), 6) q50,
        round(quantile_cont({c}, 0.75), 6) q75, max({c}) max from lineitem"""
        for c in DESCRIBED
    ),
)
def a03(t):
    return rounded(profile.describe(t.lineitem, DESCRIBED))


@case(
    "a04_missing_by_column",
    f"with {SQL_PANEL} "
    + " union all ".join(
        f"""select '{c}' as "column", count_if({c} is null) missing,
        round(count_if({c} is null) * 100.0 / count(*), 6) missing_pct from panel"""
        for c in ("entity", "yr", "v", "n")
    ),
)
def a04(t):
    return rounded(profile.missing_by_column(t.panel(), ["entity", "yr", "v", "n"]))


@case(
    "a05_missing_by_entity",
    f"with {SQL_PANEL} select entity, count_if(v is null) v_missing, count_if(n is null) n_missing from panel group by 1",
)
def a05(t):
    return profile.missing_by_entity(t.panel(), ["entity"], ["v", "n"])


@case(
    "a06_entity_profile",
    f"with {SQL_PANEL} "
    + " union all ".join(
        f"""select entity, '{c}' as "column", count({c}) non_null, round(count({c}) * 100.0 / count(*), 6) pct,
        round(avg({c}), 4) mean, round(min({c}), 4)::double min, round(max({c}), 4)::double max,
        round(stddev_samp({c}), 4) std from panel group by entity"""
        for c in ("v", "n")
    ),
)
def a06(t):
    return rounded(profile.entity_profile(t.panel(), "entity", ["v", "n"]), 4, pct=6)


@case(
    "a07_entity_periods",
    """select o_custkey, count(distinct year(o_orderdate)) periods, min(year(o_orderdate))::int first_period,
       max(year(o_orderdate))::int last_period from orders group by 1""",
)
def a07(t):
    return profile.entity_periods(t.orders.select("o_custkey", F.year("o_orderdate").alias("yr")), "o_custkey", "yr")


@case(
    "a08_duplicates",
    "select cast(sum(n - 1) as bigint) duplicates from (select count(*) n from events group by user_id, event_type)",
)
def a08(t):
    return profile.duplicates(t.events, ["user_id", "event_type"])


@case(
    "a09_distinct_with_null",
    f"with {SQL_PANEL} "
    + " union all ".join(
        f"""select '{c}' as "column", count(distinct {c}) + max(({c} is null)::int)::bigint distinct_values from panel"""
        for c in ("entity", "yr", "v", "n")
    ),
)
def a09(t):
    return profile.distinct_counts(t.panel(), ["entity", "yr", "v", "n"])


@case(
    "a10_value_counts",
    "select o_orderpriority, count(*) n from orders group by 1 order by n desc, o_orderpriority limit 3",
)
def a10(t):
    return profile.value_counts(t.orders, "o_orderpriority", 3)


@case(
    "a10_tick_gap_counts",
    f"""with {SQL_TICKS}, d as (
      select floor((epoch_us(ts) - lag(epoch_us(ts)) over (partition by instrument order by ts, event_id)) / 60000000) gap_minutes
      from ticks)
    select cast(gap_minutes as bigint) gap_minutes, count(*) n from d where gap_minutes is not null
    group by 1 order by n desc, 1 limit 5""",
)
def a10g(t):
    from panelflow.operators.features import gaps
    from panelflow.suite.registry import GAP, TICKS

    d = gaps(t.ticks(), TICKS, "ts", GAP).where(F.col("dt").isNotNull())
    d = d.select(F.floor(F.round(F.col("dt") * 1e6).cast("long") / F.lit(60000000)).alias("gap_minutes"))
    return profile.value_counts(d, "gap_minutes", 5)


@case(
    "a11_zero_share",
    """select round(avg(x), 6) mean, median(x) median, min(x) min, max(x) max, count_if(x = 0) zeros,
       round(count_if(x = 0) * 100.0 / count(*), 6) zero_pct
    from (select case when value < 1 then 0.0 else value end x from events)""",
)
def a11(t):
    d = t.events.select(F.when(F.col("value") < 1, F.lit(0.0)).otherwise(F.col("value")).alias("x"))
    return rounded(profile.zero_share(d, "x"))


@case(
    "a12_corr",
    " union all ".join(
        f"""select '{a}' var1, '{b}' var2, round(corr({a}, {b}), 6) r from lineitem"""
        for a in DESCRIBED
        for b in DESCRIBED
    ),
)
def a12(t):
    return rounded(profile.correlation_matrix(t.lineitem, DESCRIBED))


# Columns with gaps of their own, more than one pass of aggregates holds.
MASKED = [f"m{i}" for i in range(24)]
MASKED_OF = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_partkey", "l_suppkey"]
MASKED_SQL = ", ".join(
    f"case when (l_orderkey + {7 * i} * l_linenumber) % {5 + i} < {2 + i} then {MASKED_OF[i % 6]}::double * {1 + i % 4} + l_linenumber * {i} end m{i}" for i in range(24)
)


def masked(t):
    gap = lambda i: (F.col("l_orderkey") + 7 * i * F.col("l_linenumber")) % (5 + i) < 2 + i
    value = lambda i: F.col(MASKED_OF[i % 6]).cast("double") * (1 + i % 4) + F.col("l_linenumber") * i
    return t.lineitem.select(*[F.when(gap(i), value(i)).alias(f"m{i}") for i in range(24)])


def _pairs_sql(columns: list[str], frm: str) -> str:
    """(var1, var2, n, r) of every pair in SQL; a constant column's r is null."""
    return " union all ".join(
        f"""select '{a}' var1, '{b}' var2, count(case when {b} is not null then {a} end) n,
        case when regr_sxx({a}, {b}) > 0 and regr_syy({a}, {b}) > 0 then round(corr({a}, {b}), 6) end r from {frm}"""
        for a in columns
        for b in columns
    )


@case("a12_corr_masked", f"with d as materialized (select {MASKED_SQL} from lineitem) {_pairs_sql(MASKED, 'd')}")
def a12_masked(t):
    return rounded(gram.pairwise_correlations(masked(t), MASKED))


@case(
    "a12_corr_differences",
    f"""with {SQL_PANEL}, steps as materialized (
      select v - lag(v) over w v, n - lag(n) over w n from panel window w as (partition by entity order by yr))
    {_pairs_sql(["v", "n"], "steps")}""",
)
def a12_differences(t):
    return rounded(gram.difference_correlations(t.panel(), PANEL, ["v", "n"]))


@case(
    "a12_best_partners",
    f"""with d as materialized (select {MASKED_SQL} from lineitem), pairs as ({_pairs_sql(MASKED, "d")})
    select var1, round(max(abs(r)), 6) abs_r from pairs where var1 <> var2 group by 1""",
)
def a12_best(t):
    return rounded(gram.best_partners(masked(t), MASKED).select("var1", "abs_r"))


@case(
    "a13_pivot",
    """select l_suppkey, round(avg(l_quantity) filter (l_returnflag = 'A'), 6) "A",
       round(avg(l_quantity) filter (l_returnflag = 'N'), 6) "N",
       round(avg(l_quantity) filter (l_returnflag = 'R'), 6) "R" from lineitem group by 1""",
)
def a13(t):
    return rounded(profile.pivot_mean(t.lineitem, ["l_suppkey"], "l_returnflag", "l_quantity", ["A", "N", "R"]))


YEARS = tuple(range(1995, 2002))


@case(
    "a14_matrix_by_mean",
    f"with {SQL_OBS} select entity, "
    + ", ".join(f'round(avg(v) filter (yr = {y}), 4) "y{y}"' for y in YEARS)
    + ", round(avg(v), 4) row_mean from obs group by 1",
)
def a14(t):
    # the observed years: one row each, bounded by the calendar
    years = [r["yr"] for r in t.obs().select("yr").where(F.col("yr").isNotNull()).distinct().orderBy("yr").collect()]
    d = profile.matrix_by_mean(t.obs(), "entity", "yr", "v", years)
    return rounded(d.select("entity", *[F.col(str(y)).alias(f"y{y}") for y in years], "row_mean"), 4)


@case(
    "a16_histogram",
    """with s as (select min(value) lo, (max(value) - min(value)) / 50.0 w, count(*) c from events),
    b as (select least(floor((value - lo) / w), 49)::int bin, lo, w, c from events, s)
    select bin, round(lo + bin * w, 6) lower, round(lo + (bin + 1) * w, 6) upper, count(*) n,
           round(count(*) / (c * ((lo + (bin + 1) * w) - (lo + bin * w))), 8) density
    from b group by bin, lo, w, c""",
)
def a16(t):
    return rounded(profile.histogram(t.events, "value", 50), density=8)


@case(
    "a17_suitability",
    " union all ".join(
        f"""select dataset, n as "rows", {sum(k in NUMERIC_TYPES for k in c.values())} numeric_columns, round(share, 6) missing_ratio,
        {LINEAR_SQL} linear_verdict, {FOREST_SQL} forest_verdict,
        array_to_string(list_transform(reasons, lambda x: concat(x.code, ' ', x.value::decimal(18,4))), ', ') reasons
        from {_suitability_sql(n, c)}"""
        for n, c in TABLE_COLUMNS.items()
    ),
)
def a17(t):
    d = None
    for name in DRIVER_TABLES:
        one = profile.suitability(getattr(t, name), name)
        d = one if d is None else d.unionByName(one)
    told = F.transform("reasons", lambda r: F.concat_ws(" ", r["code"], r["value"].cast("decimal(18,4)").cast("string")))
    return rounded(d.withColumn("reasons", F.array_join(told, ", ")))


@case(
    "a18_argmin_argmax",
    f"""with {SQL_OBS}, c as (select entity, yr, round(v, 2) v from obs)
    select entity, arg_min(yr, (v, yr)) min_period, min(v) min_value, arg_max(yr, (v, -yr)) max_period,
           max(v) max_value from c group by 1""",
)
def a18(t):
    return profile.extremes(t.obs().withColumn("v", F.round("v", 2)), "entity", "yr", "v")


@case(
    "a19_trend",
    f"""with {SQL_OBS} select entity, round(arg_min(v, yr), 4) first_value, round(arg_max(v, yr), 4) last_value,
    case when arg_max(v, yr) > arg_min(v, yr) then 'increasing' else 'decreasing' end trend from obs group by 1""",
)
def a19(t):
    return rounded(profile.trend(t.obs(), "entity", "yr", "v"), 4)


SQL_PRED = "pred as (select l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice y, 1500 * l_quantity p, 38000.0 c from lineitem)"


def predictions(t):
    return t.lineitem.select(
        "l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.col("l_extendedprice").alias("y"), (1500 * F.col("l_quantity")).alias("p"), F.lit(38000.0).alias("c"),
    )


@case(
    "a20_metrics",
    f"""with {SQL_PRED} select l_returnflag, count(*) n, round(avg(abs(y - p)), 4) mae, round(avg((y - p) * (y - p)), 2) mse,
    round(sqrt(avg((y - p) * (y - p))), 4) rmse, round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) r2
    from pred group by 1""",
)
def a20(t):
    d = predictions(t).groupBy("l_returnflag").agg(*profile.regression_metrics("y", "p"))
    return rounded(d, 4, mse=2, r2=6)


@case(
    "a21_pred_summary",
    f"""with {SQL_PRED} select count(*) n, round(avg(y), 4) mean_actual, round(avg(p), 4) mean_predicted,
    round(avg(y - p), 4) mean_error from pred""",
)
def a21(t):
    return rounded(profile.prediction_summary(predictions(t), "y", "p"), 4)


@case(
    "a22_balance",
    f"""with {SQL_PANEL}, per as (select entity, count(*) n from obs group by 1),
    m as (select count_if(v is null) missing from panel)
    select min(per.n) = max(per.n) and any_value(missing) = 0 is_balanced, count(*) entities,
           (select count(distinct yr) from obs) time_periods, min(per.n) min_obs, max(per.n) max_obs,
           round(avg(per.n), 6) avg_obs, cast(sum(per.n) as bigint) total_obs, any_value(missing) missing_entries
    from per, m""",
)
def a22(t):
    return rounded(profile.panel_balance(t.obs(), "entity", "yr"))


@case(
    "a27_gaussian_nll",
    f"""with {SQL_TICKS}, f as (select instrument, mid, 50.0 m, 45.0 + bid / 100 s from ticks)
    select instrument, round(avg(0.5 * ln(2 * pi() * s * s) + (mid - m) * (mid - m) / (2 * s * s)), 6) nll from f group by 1""",
)
def a27(t):
    d = t.ticks().withColumns({"m": F.lit(50.0), "s": 45.0 + F.col("bid") / 100})
    return rounded(d.groupBy("instrument").agg(profile.gaussian_nll("mid", "m", "s").alias("nll")))


@case(
    "a28_tick_quality",
    f"""with {SQL_TICKS}, u as (select * from ticks union all select * from ticks where event_id % 7 = 0)
    select count(*) "rows", epoch_us(min(ts)) first_us, epoch_us(max(ts)) last_us,
           count(*) - count(distinct (ts, instrument)) duplicate_keys, count_if(bid is null) null_bid,
           count_if(ask is null) null_ask, count_if(mid is null) null_mid from u""",
)
def a28(t):
    d = t.ticks().unionByName(t.ticks().where(F.col("event_id") % 7 == 0))
    q = profile.tick_quality(d, "ts", "instrument")
    return q.select(
        "rows", micros("first_ts", "first_us"), micros("last_ts", "last_us"),
        "duplicate_keys", "null_bid", "null_ask", "null_mid",
    )


BROKEN_SQL = """select 'nation_with_a_broken_file' dataset, 'part' as "column", 'error' metric, 'CANNOT_READ_FILE_FOOTER' as "value"
    union all select 'only_a_broken_file', 'part', 'error', 'CANNOT_READ_FILE_FOOTER'"""


@case(
    "a29_dataset_profile",
    " union all ".join(
        [*(_profile_sql(n, c) for n, c in TABLE_COLUMNS.items()), _profile_sql("nation", TABLE_COLUMNS["nation"], "nation_with_a_broken_file"), BROKEN_SQL]
    ),
)
def a29(t):
    """All tables, one of them again with a broken file among its files, and a dataset that is nothing but broken."""
    mixed, broken = scratch_path(t.spark, "mixed"), scratch_path(t.spark, "broken")
    t.nation.repartition(3).write.parquet(mixed)
    words = t.region.select(F.col("r_name").alias("value")).coalesce(1)
    words.write.mode("append").text(mixed)
    words.write.text(broken)
    datasets = {n: f"{t.root}/{n}.parquet" for n in DRIVER_TABLES}
    datasets |= {"nation_with_a_broken_file": mixed, "only_a_broken_file": broken}
    d = directory.profile_directory(t.spark, datasets)
    return d.withColumn("column", F.when(F.col("metric") == "error", F.regexp_replace("column", "^part-.*", "part")).otherwise(F.col("column")))


# --- top-k and samples ---------------------------------------------------------------

@case("k01_sorted", f"with {SQL_OBS} select entity, yr, n from obs order by entity, yr")
def k01(t):
    return t.obs().select("entity", "yr", "n").orderBy("entity", "yr")


@case(
    "k02_top_groups",
    """select o_custkey, round(avg(o_totalprice), 4) mean_value from orders group by 1
    order by avg(o_totalprice) desc, o_custkey limit 10""",
)
def k02(t):
    return rounded(profile.top_groups(t.orders, "o_custkey", "o_totalprice", 10), 4)


@case(
    "k03_top_errors",
    f"""with {SQL_PRED} select l_orderkey, l_linenumber, round(y, 4) y, round(p, 4) p, round(abs(y - p), 4) abs_error
    from pred order by abs(y - p) desc, l_orderkey, l_linenumber, l_partkey, l_suppkey limit 5""",
)
def k03(t):
    d = profile.top_errors(predictions(t), "y", "p", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])
    return rounded(d.select("l_orderkey", "l_linenumber", "y", "p", "abs_error"), 4)


@case("k06_seeded_sample")
def k06(t):
    return clean.sample_entities(t.orders, "o_custkey", 26)


@case(
    "w20_top_per_period",
    f"""with {SQL_OBS}, r as (
      select entity, yr, v, row_number() over (partition by yr order by round(v, 2) desc, entity) rank from obs)
    select entity, yr, round(v, 2) v, cast(rank as int) rank from r where rank <= 30""",
)
def w20(t):
    d = t.obs().select("entity", "yr", F.round("v", 2).alias("v"))
    return profile.top_per_period(d, "yr", "v", ["entity"], 30)


@case(
    "w21_top_entity_series",
    f"""with {SQL_OBS} select entity, yr, round(v, 2) v from obs where entity in (
      select entity from obs group by 1 order by round(avg(v), 4) desc, entity limit 5)""",
)
def w21(t):
    return rounded(profile.top_group_rows(t.obs().drop("n"), "entity", "v", 5), 2)


