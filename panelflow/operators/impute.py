"""Gap filling per entity, by row position."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from panelflow.operators.clean import drop_all_missing, drop_missing, numeric_columns
from panelflow.plans.series import Series, positions

# The variable classes of the panel.
CRITICAL = ("emissions", "gdp", "energy_use", "population")
ZERO_FILL = ("renewable_pct",)
UNTOUCHED = ("mean_temp",)


def _anchors(group: Sequence[str], pos: str, columns: Sequence[str]) -> dict[str, Column]:
    """Value and position of the nearest known neighbours on both sides, per column.

    They become columns of their own: a window expression written twice runs twice. The later
    neighbour is the last one seen from the end: a frame that grows from its start is kept up
    row by row, one that reaches to the end would be computed anew for each row.
    """
    past = W.partitionBy(*group).orderBy(pos).rowsBetween(W.unboundedPreceding, 0)
    future = W.partitionBy(*group).orderBy(F.desc(pos)).rowsBetween(W.unboundedPreceding, 0)
    out = {}
    for i, c in enumerate(columns):
        v = F.col(c).cast("double")
        at = F.when(v.isNotNull(), F.col(pos))
        out[f"_pv{i}"] = F.last(v, ignorenulls=True).over(past)
        out[f"_pr{i}"] = F.last(at, ignorenulls=True).over(past)
        out[f"_nv{i}"] = F.last(v, ignorenulls=True).over(future)
        out[f"_nr{i}"] = F.last(at, ignorenulls=True).over(future)
    return out


def _drop_anchors(df: DataFrame, n: int) -> DataFrame:
    return df.drop(*[f"_{k}{i}" for i in range(n) for k in ("pv", "pr", "nv", "nr", "n")])


def _line(pv: Column, pr: Column, nv: Column, nr: Column, pos: Column) -> Column:
    """Linear between known neighbours; edge gaps take the nearest known value."""
    inside = pv + F.try_divide((nv - pv) * (pos - pr), (nr - pr).cast("double"))
    return F.coalesce(inside, pv, nv)


def _anchored(df: DataFrame, s: Series, columns: Sequence[str]) -> DataFrame:
    """Entity plan: row number, anchors and known-value count of each column."""
    d = df.withColumn("_row", F.row_number().over(s.window()))
    d = d.withColumns(_anchors(s.keys, "_row", columns))
    whole = W.partitionBy(*s.keys)
    return d.withColumns({f"_n{i}": F.count(c).over(whole) for i, c in enumerate(columns)})


def _filled(i: int, c: str) -> Column:
    line = _line(*[F.col(f"_{k}{i}") for k in ("pv", "pr", "nv", "nr")], F.col("_row"))
    return F.coalesce(F.col(c).cast("double"), line)


def impute(
    df: DataFrame,
    s: Series,
    *,
    method: str = "interpolate",
    critical: Sequence[str] = CRITICAL,
    zero_fill: Sequence[str] = ZERO_FILL,
    untouched: Sequence[str] = UNTOUCHED,
    drop_rest: bool = True,
) -> DataFrame:
    """Fill panel gaps by column class.

    ==============  ==============  ============  ==================
    class           no value        one value     two or more values
    ==============  ==============  ============  ==================
    critical        entity removed  constant      interpolated
    zero-fill       zero            constant      interpolated
    other numeric   unchanged       unchanged     interpolated
    untouched       unchanged       unchanged     unchanged
    ==============  ==============  ============  ==================

    ``method='drop'`` leaves only the class *other numeric* alone. At the end, rows with a
    missing value outside the untouched columns are dropped.
    """
    if method not in ("interpolate", "drop"):
        raise ValueError("method must be 'interpolate' or 'drop'")
    entity = s.keys[0]
    known = [c for c in numeric_columns(df) if c not in (*s.keys, *s.order, *untouched)]
    d = drop_all_missing(df, entity, critical)
    open_ = [c for c in known if method == "interpolate" or c in zero_fill or c in critical]
    if open_:
        d = _anchored(d, s, open_)
        filled = {}
        for i, c in enumerate(open_):
            if c in zero_fill:
                filled[c] = F.coalesce(_filled(i, c), F.lit(0.0))
            elif c in critical:
                filled[c] = _filled(i, c)
            else:
                filled[c] = F.when(F.col(f"_n{i}") >= 2, _filled(i, c)).otherwise(F.col(c).cast("double"))
        d = _drop_anchors(d.withColumns(filled), len(open_)).drop("_row")
    if drop_rest:
        d = drop_missing(d, [c for c in df.columns if c not in untouched])
    return d


def interpolate(df: DataFrame, s: Series, columns: Sequence[str]) -> DataFrame:
    """Interpolate columns of keys that have at least two known values."""
    if s.plan == "blocks":
        return _interpolate_long(df, s, columns)
    d = _anchored(df, s, columns)
    d = d.withColumns(
        {
            c: F.when(F.col(f"_n{i}") >= 2, _filled(i, c)).otherwise(F.col(c).cast("double"))
            for i, c in enumerate(columns)
        }
    )
    return _drop_anchors(d, len(columns)).drop("_row")


def _interpolate_long(df: DataFrame, s: Series, columns: Sequence[str]) -> DataFrame:
    """The same rule for keys of any length: bucket-wise anchors plus a carry per bucket."""
    d = positions(df, s)
    part = "_bkt"
    group = [*s.keys, part]
    aggs = []
    for i, c in enumerate(columns):
        has = F.col(c).isNotNull()
        at = F.when(has, F.col("_pos"))
        aggs += [
            F.count(c).alias(f"_n{i}"),
            F.max_by(F.col(c).cast("double"), at).alias(f"_lv{i}"),
            F.max(at).alias(f"_lr{i}"),
            F.min_by(F.col(c).cast("double"), at).alias(f"_fv{i}"),
            F.min(at).alias(f"_fr{i}"),
        ]
    heads = d.groupBy(*group).agg(*aggs)
    before = W.partitionBy(*s.keys).orderBy(part).rowsBetween(W.unboundedPreceding, -1)
    after = W.partitionBy(*s.keys).orderBy(F.desc(part)).rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*s.keys)
    carry = heads.select(
        *group,
        *[
            e
            for i in range(len(columns))
            for e in (
                F.sum(f"_n{i}").over(whole).alias(f"_n{i}"),
                F.last(f"_lv{i}", ignorenulls=True).over(before).alias(f"_bpv{i}"),
                F.last(f"_lr{i}", ignorenulls=True).over(before).alias(f"_bpr{i}"),
                F.last(f"_fv{i}", ignorenulls=True).over(after).alias(f"_bnv{i}"),
                F.last(f"_fr{i}", ignorenulls=True).over(after).alias(f"_bnr{i}"),
            )
        ],
    )
    d = d.join(carry, group)
    d = d.withColumns(_anchors(group, "_pos", columns))
    out = {}
    for i, c in enumerate(columns):
        v = F.col(c).cast("double")
        near = [F.coalesce(f"_{k}{i}", f"_b{k}{i}") for k in ("pv", "pr", "nv", "nr")]
        out[c] = F.when(F.col(f"_n{i}") >= 2, F.coalesce(v, _line(*near, F.col("_pos")))).otherwise(v)
    return d.withColumns(out).select(*df.columns)


def fill_forward_back(df: DataFrame, s: Series, columns: Sequence[str], max_gap: int = 3) -> DataFrame:
    """Forward fill then backward fill, at most ``max_gap`` rows from a known value."""
    w = s.window()
    past = w.rowsBetween(-max_gap, 0)
    future = w.rowsBetween(0, max_gap)
    if s.plan == "blocks":
        raise ValueError("use the entity plan; panels are bounded by their calendar")
    d = df.withColumns({f"_f_{c}": F.last(c, ignorenulls=True).over(past) for c in columns})
    d = d.withColumns({f"_b_{c}": F.first(f"_f_{c}", ignorenulls=True).over(future) for c in columns})
    return d.withColumns({c: F.coalesce(f"_f_{c}", f"_b_{c}") for c in columns}).drop(
        *[f"_{k}_{c}" for k in "fb" for c in columns]
    )
