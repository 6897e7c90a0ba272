"""Registered queries: a Spark plan over whole tables and, where possible, its SQL twin."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelflow.plans.grid import complete_grid
from panelflow.plans.series import Series
from panelflow.session import pin_utc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


@dataclass
class Tables:
    """The driver tables of one scale factor, and the series views over them."""

    spark: SparkSession
    root: str
    _seen: dict[str, DataFrame] = field(default_factory=dict)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._seen:
            self._seen[name] = self.spark.read.parquet(f"{self.root}/{name}.parquet")
        return self._seen[name]

    def obs(self) -> DataFrame:
        """Customer x year observations; money in whole cents, so that sums are exact."""
        return self.orders.groupBy(
            F.col("o_custkey").alias("entity"), F.year("o_orderdate").alias("yr")
        ).agg(F.round(F.sum("o_totalprice"), 2).alias("v"), F.count(F.lit(1)).alias("n"))

    def panel(self) -> DataFrame:
        """The same on the full customer x year grid, with NULL in absent cells."""
        return complete_grid(self.obs(), "entity", "yr")

    def dense(self) -> DataFrame:
        """Nation x month: y order value, x1 orders, x2 mean order value, pos month number."""
        j = self.orders.join(self.customer, F.col("o_custkey") == F.col("c_custkey"))
        month = F.trunc(F.col("o_orderdate").cast("date"), "month")
        return j.groupBy(F.col("c_nationkey").alias("nation"), month.alias("ym")).agg(
            F.sum("o_totalprice").alias("y"),
            F.count(F.lit(1)).cast("double").alias("x1"),
            F.avg("o_totalprice").alias("x2"),
        )

    def ticks(self) -> DataFrame:
        return self.events.select(
            "event_id",
            F.col("ts").cast("timestamp").alias("ts"),
            F.col("event_type").alias("instrument"),
            F.col("value").alias("mid"),
            (F.col("value") * 0.999).alias("bid"),
            (F.col("value") * 1.001).alias("ask"),
        )

    def tick_lines(self) -> DataFrame:
        """Raw log lines, some of them broken."""
        e = self.events
        i = F.col("event_id")
        ts = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
        bid, ask = F.col("value") * 0.999, F.col("value") * 1.001
        return e.select(
            F.when(i % 50 == 0, F.concat_ws("|", ts, "event_type", ask, bid))
            .when(i % 51 == 0, F.concat_ws("|", ts, "event_type", F.lit("abc"), ask))
            .when(i % 52 == 0, F.concat_ws("|", ts, "event_type", bid))
            .when(i % 53 == 0, F.concat_ws("|", F.lit("no time"), "event_type", bid, ask))
            .when(i % 54 == 0, F.concat_ws("|", ts, "event_type", F.lit("nan"), F.lit("nan")))
            .otherwise(F.concat_ws("|", ts, "event_type", bid, ask))
            .alias("value")
        )


PANEL = Series(("entity",), ("yr",))
DENSE = Series(("nation",), ("ym",))
TICKS = Series(("instrument",), ("ts", "event_id"), plan="blocks")
GAP = 3600.0

SQL_OBS = """obs as (
  select o_custkey entity, cast(year(o_orderdate) as int) yr, round(sum(o_totalprice), 2) v, count(*) n
  from orders group by 1, 2)"""
SQL_PANEL = (
    SQL_OBS
    + """, panel as (
  select e.entity, p.yr, o.v, o.n
  from (select distinct entity from obs) e cross join (select distinct yr from obs) p
  left join obs o on o.entity = e.entity and o.yr = p.yr)"""
)
SQL_DENSE = """dense as (
  select c_nationkey nation, cast(date_trunc('month', o_orderdate) as date) ym,
         sum(o_totalprice) y, cast(count(*) as double) x1, avg(o_totalprice) x2
  from orders join customer on o_custkey = c_custkey group by 1, 2)"""
SQL_TICKS = """ticks as (
  select event_id, ts, event_type instrument, value mid, value * 0.999 bid, value * 1.001 ask
  from events)"""
SQL_LINES = """lines as (
  select case
    when event_id % 50 = 0 then concat_ws('|', ts::varchar, event_type, value * 1.001, value * 0.999)
    when event_id % 51 = 0 then concat_ws('|', ts::varchar, event_type, 'abc', value * 1.001)
    when event_id % 52 = 0 then concat_ws('|', ts::varchar, event_type, value * 0.999)
    when event_id % 53 = 0 then concat_ws('|', 'no time', event_type, value * 0.999, value * 1.001)
    when event_id % 54 = 0 then concat_ws('|', ts::varchar, event_type, 'nan', 'nan')
    else concat_ws('|', ts::varchar, event_type, value * 0.999, value * 1.001) end line
  from events),
fields as (select string_split(trim(line), '|') p from lines),
parsed as (
  select try_cast(p[1] as timestamp) ts, p[2] instrument, try_cast(p[3] as double) bid,
         try_cast(p[4] as double) ask
  from fields where len(p) = 4),
good as (
  select * from parsed
  where ts is not null and bid is not null and ask is not null
    and not isnan(bid) and not isnan(ask) and bid > 0 and ask >= bid)"""
# Log returns, first row of each key dropped; and those that do not follow a gap.
SQL_RETURNS = (
    SQL_TICKS
    + """, steps as (
  select *, ln(mid) - lag(ln(mid)) over w r,
         (epoch_us(ts) - lag(epoch_us(ts)) over w) / 1e6 dt
  from ticks window w as (partition by instrument order by ts, event_id)),
rets as (select * from steps where r is not null),
valid as (
  select *, row_number() over (partition by instrument order by ts, event_id) - 1 pos,
         count(*) over (partition by instrument) n
  from rets where dt <= 3600)"""
)


def case(name: str, sql: str | None = None):
    """Register a query by name; ``sql`` gives the same rows in DuckDB."""

    def add(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, root: str) -> DataFrame:
            pin_utc(spark)
            return fn(Tables(spark, root))

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def rnd(c: str | Column, digits: int = 6) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col.cast("double"), digits)


def rounded(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """Round every double column, so that summation order does not show."""
    return df.select(
        *[
            rnd(c, special.get(c, digits)).alias(c) if t in ("double", "float") else F.col(c)
            for c, t in df.dtypes
        ]
    )


def micros(c: str = "ts", name: str = "ts_us") -> Column:
    return F.unix_micros(c).alias(name)
