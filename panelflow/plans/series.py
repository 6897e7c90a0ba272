"""Window work over keyed, ordered series, safe for keys of any length.

A ``Series`` names the key and the total order inside it. It offers two plans:

``entity``
    One window group per key. Right for panels, where a key holds at most one row per
    period, so the group is bounded by the calendar.

``blocks``
    For ticks, where one key may hold a third of all rows. No window group is ever a
    whole key:

    * ``scan`` (running sums, previous value, position, totals) groups by
      (key, time bucket). A table of one row per bucket, built with map-side combine,
      carries totals and last values over bucket borders.
    * ``frames`` (bounded row frames) cuts each key by exact position into blocks of
      ``rows`` rows. The rows next to a border are copied into the neighbour block, so
      every frame is complete, and the copies are removed after the window.

    Buckets and blocks are functions of the data alone, so a task that is run again
    after a lost executor gives the same rows. Default blocks, copies included, stay
    within the 4096 rows a window operator holds before it spills.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

BUCKET = "_bkt"
BLOCK = "_blk"
POS = "_pos"
HALO = "_halo"
INTERNAL = (BUCKET, BLOCK, POS, HALO)

# Bucket rows merged into one group when a carry table itself needs a two-step scan.
CARRY_FANOUT = 4096

Stage = Callable[[WindowSpec], dict[str, Column]]


@dataclass(frozen=True)
class Series:
    keys: tuple[str, ...]
    order: tuple[str, ...]
    plan: str = "entity"
    bucket: float = 3600.0
    rows: int = 4000

    def __post_init__(self):
        if self.plan not in ("entity", "blocks"):
            raise ValueError(f"unknown plan {self.plan!r}")
        if not self.order:
            raise ValueError("a series needs an order column")

    def window(self) -> WindowSpec:
        return W.partitionBy(*self.keys).orderBy(*self.order)

    def blocks(self, bucket: float | None = None, rows: int | None = None) -> Series:
        return replace(self, plan="blocks", bucket=bucket or self.bucket, rows=rows or self.rows)


def panel(entity: str, time: str) -> Series:
    return Series((entity,), (time,))


def tick_series(instrument: str = "instrument", order: Sequence[str] = ("ts",), **kw) -> Series:
    return Series((instrument,), tuple(order), plan="blocks", **kw)


def _bucket_column(df: DataFrame, s: Series) -> Column:
    name = s.order[0]
    kind = df.schema[name].dataType
    c = F.col(name)
    if isinstance(kind, T.TimestampNTZType):
        c, kind = c.cast("timestamp"), T.TimestampType()
    if isinstance(kind, T.TimestampType):
        return F.floor(F.unix_micros(c) / F.lit(s.bucket * 1e6))
    if isinstance(kind, T.DateType):
        return F.floor(F.unix_date(c) / F.lit(s.bucket / 86400.0))
    if isinstance(kind, T.NumericType):
        return F.floor(c / F.lit(float(s.bucket)))
    raise TypeError(f"cannot cut {name} of type {kind.simpleString()} into buckets")


def bucketed(df: DataFrame, s: Series) -> DataFrame:
    """Add the bucket column once; later steps reuse it and so its partitioning.

    Rows without key or time belong to no series and are left out here, as a grouping
    by key leaves them out in the entity plan's source operators.
    """
    if BUCKET in df.columns:
        return df
    present = [F.col(c).isNotNull() for c in (*s.keys, s.order[0])]
    keep = present[0]
    for p in present[1:]:
        keep = keep & p
    return df.where(keep).withColumn(BUCKET, _bucket_column(df, s))


def _last_by(value: Column, order: Sequence[str]) -> Column:
    by = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    return F.max_by(value, by)


def _carry_table(heads: DataFrame, keys, part: str, sums, lasts, levels: int) -> DataFrame:
    """Exclusive sums and previous last values over the bucket rows of each key.

    With ``levels`` = 2 the bucket rows of a key are themselves grouped, so a key with
    very many buckets does not become one long window group either.
    """
    if levels == 1:
        w = W.partitionBy(*keys).orderBy(part)
        before = w.rowsBetween(W.unboundedPreceding, -1)
        return heads.select(
            *keys,
            part,
            *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in sums],
            *[F.lag(c).over(w).alias(c) for c in lasts],
        )
    group = "_grp"
    grouped = heads.withColumn(group, F.floor(F.col(part) / F.lit(CARRY_FANOUT)))
    tops = grouped.groupBy(*keys, group).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(c).alias(c) for c in sums],
        *[F.max_by(c, part).alias(c) for c in lasts],
    )
    tops = _carry_table(tops, keys, group, sums, lasts, levels - 1)
    tops = tops.select(*keys, group, *[F.col(c).alias(f"_top{c}") for c in (*sums, *lasts)])
    w = W.partitionBy(*keys, group).orderBy(part)
    before = w.rowsBetween(W.unboundedPreceding, -1)
    first = F.row_number().over(w) == 1
    return grouped.join(tops, [*keys, group]).select(
        *keys,
        part,
        *[
            (F.col(f"_top{c}") + F.coalesce(F.sum(c).over(before), F.lit(0))).alias(c)
            for c in sums
        ],
        *[
            F.when(first, F.col(f"_top{c}")).otherwise(F.lag(c).over(w)).alias(c)
            for c in lasts
        ],
    )


def scan(
    df: DataFrame,
    s: Series,
    *,
    sums: dict[str, Column] | None = None,
    prev: dict[str, Column] | None = None,
    totals: dict[str, Column] | None = None,
    part: str | None = None,
    levels: int | None = None,
) -> DataFrame:
    """Add running sums (inclusive), previous-row values and per-key totals.

    ``sums`` inputs must not be NULL. ``part`` names an existing column that cuts each
    key into ordered pieces (for example the block column of ``frames``); without it the
    time bucket is used. The carry table is scanned in two steps when ``part`` is given,
    since its pieces grow with the data, unless ``levels`` says 1.
    """
    sums, prev, totals = sums or {}, prev or {}, totals or {}
    whole = W.unboundedPreceding
    if s.plan == "entity":
        w = s.window()
        full = W.partitionBy(*s.keys)
        return df.select(
            "*",
            *[F.sum(e).over(w.rowsBetween(whole, 0)).alias(n) for n, e in sums.items()],
            *[F.lag(e).over(w).alias(n) for n, e in prev.items()],
            *[F.sum(e).over(full).alias(n) for n, e in totals.items()],
        )

    levels = levels or (1 if part is None else 2)
    if part is None:
        df, part = bucketed(df, s), BUCKET
    group = [*s.keys, part]
    heads = df.groupBy(*group).agg(
        *[F.sum(e).alias(f"_s_{n}") for n, e in sums.items()],
        *[_last_by(e, s.order).alias(f"_l_{n}") for n, e in prev.items()],
        *[F.sum(e).alias(f"_t_{n}") for n, e in totals.items()],
        F.count(F.lit(1)).alias("_rows"),
    )
    if sums or prev:
        carry = _carry_table(
            heads, s.keys, part, [f"_s_{n}" for n in sums], [f"_l_{n}" for n in prev], levels
        )
    else:
        carry = heads.select(*group)
    if totals:
        # Totals come from the heads and reach the rows by the same join on (key, bucket).
        per_key = heads.groupBy(*s.keys).agg(*[F.sum(f"_t_{n}").alias(n) for n in totals])
        carry = carry.join(per_key, list(s.keys))
    out = df.join(carry, group)
    w = W.partitionBy(*group).orderBy(*s.order)
    if prev:
        out = out.withColumn("_first", F.row_number().over(w) == 1)
    first = F.col("_first")
    return out.select(
        *df.columns,
        *[
            (F.col(f"_s_{n}") + F.sum(e).over(w.rowsBetween(whole, 0))).alias(n)
            for n, e in sums.items()
        ],
        *[
            F.when(first, F.col(f"_l_{n}")).otherwise(F.lag(e).over(w)).alias(n)
            for n, e in prev.items()
        ],
        *totals,
    )


def positions(df: DataFrame, s: Series, *, count: str | None = None) -> DataFrame:
    """Add the 0-based position inside the key, and the key's row count if named."""
    one = F.lit(1).cast("long")
    out = scan(
        df.drop(POS), s, sums={POS: one}, totals={count: one} if count else None
    )
    return out.withColumn(POS, F.col(POS) - 1)


def frames(
    df: DataFrame,
    s: Series,
    *stages: Stage,
    back: int = 0,
    ahead: int = 0,
    keep_blocks: bool = False,
) -> DataFrame:
    """Add columns from bounded row frames.

    Each stage maps the window to named columns; a later stage sees the columns of the
    earlier ones. ``back`` / ``ahead`` are the total reach of all stages together.
    """
    if s.plan == "entity":
        for stage in stages:
            df = df.withColumns(stage(s.window()))
        return df
    if max(back, ahead) > s.rows:
        raise ValueError("a block must be at least as long as the frame's reach")
    if POS not in df.columns:
        df = positions(df, s)
    width = F.lit(s.rows)
    block = F.floor(F.col(POS) / width)
    rest = F.col(POS) % width

    def target(b: Column, halo: bool) -> Column:
        return F.struct(b.alias(BLOCK), F.lit(halo).alias(HALO))

    targets = [target(block, False)]
    if back:
        targets.append(F.when(rest >= width - back, target(block + 1, True)))
    if ahead:
        targets.append(F.when((rest < ahead) & (block > 0), target(block - 1, True)))
    spread = df.select("*", F.inline(F.array_compact(F.array(*targets))))
    w = W.partitionBy(*s.keys, BLOCK).orderBy(POS)
    for stage in stages:
        spread = spread.withColumns(stage(w))
    out = spread.where(~F.col(HALO)).drop(HALO)
    return out if keep_blocks else out.drop(BLOCK)


def public(df: DataFrame) -> DataFrame:
    """Drop the plan's helper columns."""
    return df.drop(*INTERNAL)
