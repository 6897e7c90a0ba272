"""Entity x period grids without a cross join, by bitmaps of periods.

A period is a position on the number line: a whole number or a date is one already, other types take their rank
in the calendar. An entity's periods are one bitmap, 64 positions a word, made by an
aggregate that combines before the shuffle; the calendar is the union of all bitmaps, and an
entity's missing cells are the calendar's bits that its own bitmap lacks. So only missing cells are ever produced,
nothing is dealt out by period, and no window is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from panelflow.session import materialised

WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def calendar(df: DataFrame, time: str) -> DataFrame:
    """Distinct periods and their 1-based rank.

    One row per period: the window has no key because it ranks the calendar itself.
    """
    periods = df.select(time).where(F.col(time).isNotNull()).distinct()
    return periods.select(time, F.row_number().over(W.orderBy(time)).cast("long").alias("_rank"))


def _positions(df: DataFrame, entity: str, time: str) -> tuple[DataFrame, DataFrame | None]:
    """(entity, _at) of every row, and the calendar if positions are ranks in it."""
    kind = df.schema[time].dataType
    if isinstance(kind, WHOLE):
        return df.select(entity, F.col(time).cast("long").alias("_at")), None
    if isinstance(kind, T.DateType):
        return df.select(entity, F.unix_date(time).cast("long").alias("_at")), None
    # Written once: a calendar's size is then known, so Spark broadcasts it if it is small.
    cal = materialised(calendar(df, time), "calendar")
    return df.select(entity, time).join(cal, time, "left").select(entity, F.col("_rank").alias("_at")), cal


def period_bitmaps(positions: DataFrame, entity: str) -> DataFrame:
    """(entity, _own, _n, _calendar): an entity's bitmap by word, its rows, and the calendar's words.

    Rows without a period count as rows; rows without an entity count for the calendar, and as one entity that is null.
    """
    word = F.shiftright("_at", 6)
    bit = F.expr("shiftleft(1L, cast(_at & 63 as int))")
    words = positions.groupBy(entity, word.alias("_word")).agg(F.bit_or(bit).alias("_bits"), F.count(F.lit(1)).alias("_rows"))
    pair = F.when(F.col("_word").isNotNull(), F.struct("_word", "_bits"))
    own = words.groupBy(entity).agg(F.map_from_entries(F.collect_list(pair)).alias("_own"), F.sum("_rows").alias("_n"))
    union = words.groupBy("_word").agg(F.bit_or("_bits").alias("_bits")).agg(F.array_sort(F.collect_list(pair)).alias("c"))
    return own.select("*", union.scalar().alias("_calendar"))


def _lacking(word: Column) -> Column:
    """The calendar's bits of a word that the entity lacks."""
    own = F.coalesce(F.try_element_at("_own", word["_word"]), F.lit(0).cast("long"))
    return word["_bits"].bitwiseAND(F.bitwise_not(own))


def missing_count() -> Column:
    """Missing cells of a row of ``period_bitmaps``; an entity without any period has none."""
    total = F.aggregate("_calendar", F.lit(0).cast("long"), lambda n, w: n + F.bit_count(_lacking(w)))
    return F.when(F.size("_own") > 0, total).otherwise(0)


def period_count() -> Column:
    """Periods of the calendar of ``period_bitmaps``."""
    return F.aggregate("_calendar", F.lit(0).cast("long"), lambda n, w: n + F.bit_count(w["_bits"]))


def entity_bitmaps(df: DataFrame, entity: str, time: str) -> DataFrame:
    """``period_bitmaps`` of a panel."""
    return period_bitmaps(_positions(df, entity, time)[0], entity)


def missing_cells(df: DataFrame, entity: str, time: str) -> DataFrame:
    """(entity, period) pairs of the full grid that have no row."""
    positions, cal = _positions(df, entity, time)
    # One condition on the aggregate's result: split, half of it would go below the aggregate, and the calendar would
    # not share the exchange of the bitmaps.
    maps = period_bitmaps(positions, entity).where(F.when(F.col(entity).isNull(), 0).otherwise(F.size("_own")) > 0)
    lacks = F.transform("_calendar", lambda w: F.struct(w["_word"].alias("w"), _lacking(w).alias("b")))
    words = maps.select(entity, F.inline(F.filter(lacks, lambda x: x["b"] != 0)))
    bits = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda i: F.call_function("getbit", F.col("b"), i) == 1)
    at = words.select(entity, "w", F.explode(bits).alias("i")).select(entity, (F.col("w") * 64 + F.col("i")).alias("_at"))
    if cal is not None:
        return at.join(cal, F.col("_at") == F.col("_rank")).select(entity, time)
    kind = df.schema[time].dataType
    back = F.date_from_unix_date(F.col("_at").cast("int")) if isinstance(kind, T.DateType) else F.col("_at").cast(kind)
    return at.select(entity, back.alias(time))


def complete_grid(df: DataFrame, entity: str, time: str) -> DataFrame:
    """The panel with one row per grid cell; absent cells have NULL values."""
    return df.unionByName(missing_cells(df, entity, time), allowMissingColumns=True)
