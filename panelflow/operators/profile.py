"""Aggregation and profiling. Each report is one pass with map-side combine."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from panelflow.functions.scalars import ratio
from panelflow.operators.clean import numeric_columns
from panelflow.plans.grid import entity_bitmaps, missing_count, period_count
from panelflow.plans.series import Series, scan

# Aggregates per pass; wider sets are split so that one stage stays compiled.
AGGS_PER_PASS = 96


def _wide_agg(df: DataFrame, aggs: Sequence[Column]) -> DataFrame:
    """One-row aggregate of many columns, in as few passes as the codegen limit allows."""
    chunks = [aggs[i : i + AGGS_PER_PASS] for i in range(0, len(aggs), AGGS_PER_PASS)]
    out = df.agg(*chunks[0])
    for chunk in chunks[1:]:
        part = df.agg(*chunk)
        out = out.select("*", *[part.select(c).scalar().alias(c) for c in part.columns])
    return out


def _rows(wide: DataFrame, entries: Sequence[Column]) -> DataFrame:
    """Turn the one wide row into one row per struct entry."""
    return wide.select(F.inline(F.array(*entries)))


def period_counts(df: DataFrame, time: str) -> DataFrame:
    return df.groupBy(time).agg(F.count(F.lit(1)).alias("n"))


def ranges(df: DataFrame, entity: str, time: str) -> DataFrame:
    return df.agg(
        F.min(time).alias("min_time"),
        F.max(time).alias("max_time"),
        F.countDistinct(entity).alias("entities"),
        F.count(F.lit(1)).alias("total"),
    )


# Rank error of the sketch that brackets a quantile, as a share of the rows: 1 / accuracy.
SKETCH_ACCURACY = 10000
# Rows of a bracket that one cell should hold, and the fewest cells of a bracket.
CELL_ROWS = 1000
LEAST_CELLS = 256


def quantile_brackets(df: DataFrame, columns: Sequence[str], points: Sequence[float]) -> DataFrame:
    """(column, n, point, h, lo, hi, cells): a value interval that holds the wanted ranks, in one pass.

    ``h`` is the wanted rank from 0, with a fraction. Its two neighbours lie at most 2 / n from the point, so from
    ``SKETCH_ACCURACY`` rows on the sketch's values at four times its error bound to either side are
    outside of them; below that the smallest and the largest value are the ends. Columns without a value have no row.
    """
    aggs, entries, slack = [], [], 2.0 / SKETCH_ACCURACY
    sides = [min(max(p + side * 2 * slack, 0.0), 1.0) for side in (-1, 1) for p in points]
    for i, c in enumerate(columns):
        v, n = F.col(c).cast("double"), F.col(f"n{i}")
        aggs += [F.count(c).alias(f"n{i}"), F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}")]
        aggs.append(F.percentile_approx(v, sides, SKETCH_ACCURACY).alias(f"b{i}"))
        cells = F.greatest(F.lit(LEAST_CELLS), F.ceil(n * (4 * slack / CELL_ROWS))).cast("long")
        for k, p in enumerate(points):
            ends = []
            for shift, whole, outside in ((0, f"lo{i}", p <= 2 * slack), (len(points), f"hi{i}", p >= 1 - 2 * slack)):
                near = F.col(whole) if outside else F.get(f"b{i}", F.lit(k + shift))
                ends.append(F.when(n < SKETCH_ACCURACY, F.col(whole)).otherwise(near))
            named = {"column": F.lit(c), "n": n, "point": F.lit(k), "h": (n - 1) * F.lit(p), "lo": ends[0], "hi": ends[1], "cells": cells}
            entries.append(F.struct(*[v.alias(name) for name, v in named.items()]))
    return _rows(_wide_agg(df, aggs), entries).where("n > 0")


def quantile_cells(df: DataFrame, columns: Sequence[str], brackets: DataFrame) -> DataFrame:
    """(column, point, value, cell): the rows up to each bracket's end, cut into cells.

    Cells have equal widths inside the bracket. Rows below it are all in cell -1, without a value.
    """
    entries = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]
    v = df.select(F.inline(F.array(*entries))).where(F.col("value").isNotNull())
    # One row per column of the schema and point: always small enough to broadcast.
    d = v.join(F.broadcast(brackets), "column").where("value <= hi")
    place = F.floor(F.try_divide(F.col("value") - F.col("lo"), F.col("hi") - F.col("lo")) * F.col("cells"))
    inside = F.col("value") >= F.col("lo")
    cell = F.when(inside, F.least(F.coalesce(place, F.lit(0)), F.col("cells") - 1)).otherwise(-1)
    return d.select("column", "point", F.when(inside, F.col("value")).alias("value"), cell.cast("long").alias("cell"))


def exact_quantiles(df: DataFrame, columns: Sequence[str], points: Sequence[float]) -> DataFrame:
    """(column, n, q array) with linearly interpolated quantiles, exact at any size.

    A bounded sketch gives a narrow bracket around each quantile. Its rows are counted per cell,
    which tells the one or two cells that hold the wanted ranks; only the rows of these are
    counted per value and put in order. The number of cells follows the number of rows, so a
    cell stays small. A rank outside its bracket is an error, never a wrong value.
    """
    columns, points = list(columns), [float(p) for p in points]
    box = quantile_brackets(df, columns, points)
    d = quantile_cells(df, columns, box)
    at = ["column", "point"]
    w = W.partitionBy(*at).orderBy("cell")
    cells = d.groupBy(*at, "cell").agg(F.count(F.lit(1)).alias("k")).withColumn("upto", F.sum("k").over(w))
    cells = cells.join(F.broadcast(box), at)
    first, second = F.floor("h") + 1, F.ceil("h") + 1
    holds = (F.col("upto") >= first) & (F.col("upto") - F.col("k") < second)
    wanted = cells.where(holds & (F.col("cell") >= 0)).select(*at, "cell", "n", "h", (F.col("upto") - F.col("k")).alias("below"))
    # At most two cells for each column and point.
    values = d.where("cell >= 0").join(F.broadcast(wanted), [*at, "cell"])
    values = values.groupBy(*at, "cell", "n", "h", "below", "value").agg(F.count(F.lit(1)).alias("k"))
    inner = W.partitionBy(*at, "cell").orderBy("value")
    values = values.withColumn("upto", F.col("below") + F.sum("k").over(inner))

    def ranked(rank: Column) -> Column:
        """The value with the given 1-based rank."""
        return F.max(F.when((F.col("upto") - F.col("k") < rank) & (rank <= F.col("upto")), F.col("value")))

    ends = values.groupBy(*at, "n", "h").agg(ranked(first).alias("a"), ranked(second).alias("b"))
    lost = F.raise_error("a quantile's rank is outside of its bracket").cast("double")
    q = F.coalesce(F.col("a") + (F.col("b") - F.col("a")) * (F.col("h") - F.floor("h")), lost)
    found = box.select(*at, "n").join(ends.select(*at, q.alias("q")), at, "left").withColumn("q", F.coalesce("q", lost))
    out = found.groupBy("column", "n").agg(F.array_sort(F.collect_list(F.struct("point", "q"))).alias("q"))
    return out.select("column", "n", F.transform("q", lambda e: e["q"]).alias("q"))


def _medians(df: DataFrame, column: str) -> Column:
    """The exact median as a scalar; NULL for an empty column."""
    q = exact_quantiles(df, [column], [0.5])
    return q.select(F.get("q", F.lit(0))).scalar()


def describe(df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False) -> DataFrame:
    """count, mean, std, min, quartiles, max per numeric column.

    Quartiles are exact by default (``exact_quantiles``); ``approximate`` takes them from a
    bounded sketch in the same pass as the rest.
    """
    columns = list(columns or numeric_columns(df))
    points = [0.25, 0.5, 0.75]
    aggs, entries = [], []
    for i, c in enumerate(columns):
        v = F.col(c).cast("double")
        aggs += [
            F.count(c).alias(f"n{i}"),
            F.avg(v).alias(f"m{i}"),
            F.stddev_samp(v).alias(f"s{i}"),
            F.min(v).alias(f"lo{i}"),
            F.max(v).alias(f"hi{i}"),
        ]
        if approximate:
            aggs.append(F.percentile_approx(v, points).alias(f"q{i}"))
        entries.append(
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"n{i}").alias("count"),
                F.col(f"m{i}").alias("mean"),
                F.col(f"s{i}").alias("std"),
                F.col(f"lo{i}").alias("min"),
                *([F.col(f"q{i}").alias("_q")] if approximate else []),
                F.col(f"hi{i}").alias("max"),
            )
        )
    d = _rows(_wide_agg(df, aggs), entries)
    if not approximate:
        q = exact_quantiles(df, columns, points).select("column", F.col("q").alias("_q"))
        d = d.join(q, "column", "left")
    quartiles = [F.get("_q", F.lit(i)).alias(f"q{p:.0%}".rstrip("%")) for i, p in enumerate(points)]
    return d.select("column", "count", "mean", "std", "min", *quartiles, "max")


def missing_by_column(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    columns = list(columns or df.columns)
    aggs = [F.count(F.lit(1)).alias("_rows")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"m{i}") for i, c in enumerate(columns)]
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"m{i}").alias("missing"),
            (ratio(f"m{i}", "_rows") * 100).alias("missing_pct"),
        )
        for i, c in enumerate(columns)
    ]
    return _rows(_wide_agg(df, aggs), entries)


def missing_by_entity(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(
        *[F.count_if(F.col(c).isNull()).alias(f"{c}_missing") for c in columns]
    )


def entity_profile(df: DataFrame, entity: str, columns: Sequence[str]) -> DataFrame:
    """Per entity and column: non-null n and %, mean, min, max, std."""
    parts = [
        F.struct(
            F.count(c).alias("non_null"),
            (ratio(F.count(c), F.count(F.lit(1))) * 100).alias("pct"),
            F.avg(c).cast("double").alias("mean"),
            F.min(c).cast("double").alias("min"),
            F.max(c).cast("double").alias("max"),
            F.stddev_samp(c).alias("std"),
        ).alias(f"_p{i}")
        for i, c in enumerate(columns)
    ]
    wide = df.groupBy(entity).agg(*parts)
    return wide.select(
        entity,
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column"), F.col(f"_p{i}").alias("p"))
                    for i, c in enumerate(columns)
                ]
            )
        ),
    ).select(entity, "column", "p.*")


def entity_periods(df: DataFrame, entity: str, time: str) -> DataFrame:
    return df.groupBy(entity).agg(
        F.countDistinct(time).alias("periods"),
        F.min(time).alias("first_period"),
        F.max(time).alias("last_period"),
    )


def duplicates(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Rows beyond the first of each group of equals."""
    groups = df.groupBy(*(keys or df.columns)).count()
    return groups.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("duplicates"))


def distinct_counts(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct values per column, NULL counted as one value."""
    entries = []
    if approximate:
        aggs = []
        for i, c in enumerate(columns):
            aggs += [
                F.approx_count_distinct(c).alias(f"d{i}"),
                F.max(F.col(c).isNull().cast("long")).alias(f"z{i}"),
            ]
            entries.append(
                F.struct(
                    F.lit(c).alias("column"),
                    (F.col(f"d{i}") + F.coalesce(f"z{i}", F.lit(0))).alias("distinct_values"),
                )
            )
        return _rows(_wide_agg(df, aggs), entries)
    # One (column, value) row per distinct value: partial distinct runs before the shuffle,
    # and the plan does not multiply rows once per column inside a single aggregate.
    stacked = df.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v"))
                    for c in columns
                ]
            )
        )
    )
    return stacked.distinct().groupBy("column").agg(F.count(F.lit(1)).alias("distinct_values"))


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    out = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return out.orderBy(F.desc("n"), column).limit(top) if top else out


def zero_share(df: DataFrame, column: str) -> DataFrame:
    v = F.col(column)
    return df.agg(
        F.avg(v).alias("mean"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
        F.count_if(v == 0).alias("zeros"),
        (ratio(F.count_if(v == 0), F.count(F.lit(1))) * 100).alias("zero_pct"),
    ).select("mean", _medians(df, column).alias("median"), "min", "max", "zeros", "zero_pct")


def correlation(a, b) -> Column:
    """Pairwise-complete correlation; NULL when either side is constant."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.try_divide(F.regr_sxy(a, b), F.sqrt(F.regr_sxx(a, b) * F.regr_syy(a, b)))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Long form (var1, var2, r), both triangles."""
    columns = list(columns)
    d = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    aggs = [correlation(columns[i], columns[j]).alias(f"r{i}_{j}") for i, j in pairs]
    entries = []
    for i in range(len(columns)):
        for j in range(len(columns)):
            a, b = min(i, j), max(i, j)
            entries.append(
                F.struct(
                    F.lit(columns[i]).alias("var1"),
                    F.lit(columns[j]).alias("var2"),
                    F.col(f"r{a}_{b}").alias("r"),
                )
            )
    return _rows(_wide_agg(d, aggs), entries)


def best_correlation(df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    """The column with the largest |r| to the target."""
    wide = df.agg(*[F.abs(correlation(c, target)).alias(f"r{i}") for i, c in enumerate(columns)])
    rows = _rows(
        wide,
        [F.struct(F.lit(c).alias("column"), F.col(f"r{i}").alias("abs_r")) for i, c in enumerate(columns)],
    )
    return rows.where(F.col("abs_r").isNotNull()).orderBy(F.desc("abs_r"), "column").limit(1)


def pivot_mean(df: DataFrame, keys: Sequence[str], name: str, value: str, names: Sequence[str]) -> DataFrame:
    """Long to wide over an explicit name list; duplicates are averaged."""
    return df.groupBy(*keys).pivot(name, list(names)).agg(F.avg(value))


def matrix_by_mean(df: DataFrame, entity: str, time: str, value: str, periods: Sequence) -> DataFrame:
    """Entity x period matrix with the entity's mean, highest first."""
    wide = df.groupBy(entity).pivot(time, list(periods)).agg(F.avg(value))
    means = df.groupBy(entity).agg(F.avg(value).alias("row_mean"))
    return wide.join(means, entity).orderBy(F.desc("row_mean"), entity)


def moments_of(value: str) -> list[Column]:
    """Mean, population std, skewness and excess kurtosis of one column."""
    return [
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.stddev_pop(value).alias("std"),
        F.skewness(value).alias("skewness"),
        F.kurtosis(value).alias("excess_kurtosis"),
    ]


def histogram(df: DataFrame, column: str, bins: int, keys: Sequence[str] = (), log: bool = False) -> DataFrame:
    """Counts and density per linear (or log-spaced) bin; the top edge is in the last bin."""
    keys = list(keys)
    v = F.ln(F.col(column)) if log else F.col(column).cast("double")
    d = df.select(*keys, v.alias("_v")).where(F.col("_v").isNotNull())
    span = d.groupBy(*keys).agg(
        F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count(F.lit(1)).alias("_n")
    )
    if keys:
        d = d.join(span, keys)
    else:
        one = lambda c: span.select(c).scalar().alias(c)
        d = d.select("_v", one("_lo"), one("_hi"), one("_n"))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    raw = F.floor(F.try_divide(F.col("_v") - F.col("_lo"), width))
    b = F.least(F.coalesce(raw, F.lit(0)), F.lit(bins - 1)).cast("int")
    out = d.groupBy(*keys, b.alias("bin"), "_lo", width.alias("_w"), "_n").agg(
        F.count(F.lit(1)).alias("n")
    )
    edge = lambda k: F.col("_lo") + (F.col("bin") + k) * F.col("_w")
    lower, upper = (F.exp(edge(0)), F.exp(edge(1))) if log else (edge(0), edge(1))
    return out.select(
        *keys,
        "bin",
        lower.alias("lower"),
        upper.alias("upper"),
        "n",
        F.try_divide(F.col("n").cast("double"), F.col("_n") * (upper - lower)).alias("density"),
    )


# Least rows, numeric columns and |r|, and most missing cells, of a table fit for a baseline model.
FIT_ROWS, FIT_NUMERIC, FIT_MISSING, FIT_CORRELATION = 200, 2, 0.3, 0.1


def suitability(df: DataFrame, name: str = "table") -> DataFrame:
    """One row: is the table fit for a linear baseline and for a forest? The last numeric column is the target.

    ``reasons`` holds a code and the measured number for everything that speaks against it:
    ``few_rows``, ``few_numeric``, ``missing_share``, ``flat_target``, ``weak_r``. The verdicts follow
    from the codes: a flat target leaves a linear model with caveats and rules a forest out;
    too few numeric columns rule out both.
    """
    numeric = numeric_columns(df)
    measured = {"rows": F.count(F.lit(1)), "cells": F.lit(0).cast("long")}
    for c in df.columns:
        measured["cells"] = measured["cells"] + F.count_if(F.col(c).isNull())
    y = F.col(numeric[-1]).cast("double") if numeric else F.lit(None).cast("double")
    measured["spread"] = F.var_pop(y)
    others = [F.abs(correlation(F.col(c).cast("double"), y)) for c in numeric[:-1]]
    measured["r"] = F.greatest(*others) if len(others) > 1 else others[0] if others else F.lit(None).cast("double")
    one = df.agg(*[v.alias(k) for k, v in measured.items()])
    one = one.withColumn("share", ratio("cells", F.col("rows") * len(df.columns))).withColumn("numeric", F.lit(len(numeric)))
    enough = (F.col("rows") >= FIT_ROWS) & (F.col("numeric") >= FIT_NUMERIC)
    against = {
        "few_rows": (F.col("rows") < FIT_ROWS, "rows"),
        "few_numeric": (F.col("numeric") < FIT_NUMERIC, "numeric"),
        "missing_share": (F.col("share") > FIT_MISSING, "share"),
        "flat_target": (F.col("spread") == 0, "spread"),
        "weak_r": (enough & (F.col("r") < FIT_CORRELATION), "r"),
    }
    codes = [F.when(test, F.struct(F.lit(code).alias("code"), F.col(by).cast("double").alias("value"))) for code, (test, by) in against.items()]
    one = one.withColumn("reasons", F.filter(F.array(*codes), lambda x: x.isNotNull()))

    def has(code: str) -> Column:
        return F.exists("reasons", lambda x: x["code"] == code)

    unfit = has("few_numeric")
    return one.select(
        F.lit(name).alias("dataset"),
        "rows",
        F.col("numeric").alias("numeric_columns"),
        F.col("share").alias("missing_ratio"),
        F.when(unfit, "no").when(has("flat_target"), "caveats").otherwise("yes").alias("linear_verdict"),
        F.when(unfit | has("flat_target"), "no").otherwise("yes").alias("forest_verdict"),
        "reasons",
    )


def extremes(df: DataFrame, entity: str, time: str, value: str) -> DataFrame:
    """Period of the minimum and of the maximum; the earliest one on ties."""
    v = F.col(value)
    back = F.struct(v.alias("v"), (-F.col(time)).alias("t"))
    return (
        df.where(v.isNotNull())
        .groupBy(entity)
        .agg(
            F.min_by(time, F.struct(v.alias("v"), F.col(time).alias("t"))).alias("min_period"),
            F.min(v).alias("min_value"),
            F.max_by(time, back).alias("max_period"),
            F.max(v).alias("max_value"),
        )
    )


def trend_label(value: str, time: str) -> Column:
    """Label from the last against the first row, as an aggregate."""
    return F.when(
        F.coalesce(F.max_by(value, time) > F.min_by(value, time), F.lit(False)), "increasing"
    ).otherwise("decreasing")


def trend(df: DataFrame, entity: str, time: str, value: str) -> DataFrame:
    return df.groupBy(entity).agg(
        F.min_by(value, time).alias("first_value"),
        F.max_by(value, time).alias("last_value"),
        trend_label(value, time).alias("trend"),
    )


def regression_metrics(actual: str, predicted: str) -> list[Column]:
    """MAE, MSE, RMSE and R2 as aggregates. Complete pairs only."""
    y, p = F.col(actual), F.col(predicted)
    both = p.isNotNull() & y.isNotNull()
    e = y - p
    sst = F.regr_syy(y, p)
    return [
        F.count_if(both).alias("n"),
        F.avg(F.abs(e)).alias("mae"),
        F.avg(e * e).alias("mse"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        (1 - F.try_divide(F.sum(e * e), sst)).alias("r2"),
    ]


def prediction_summary(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(actual).alias("mean_actual"),
        F.avg(predicted).alias("mean_predicted"),
        F.avg(F.col(actual) - F.col(predicted)).alias("mean_error"),
    )


def top_errors(df: DataFrame, actual: str, predicted: str, ids: Sequence[str], n: int = 5) -> DataFrame:
    d = df.withColumn("abs_error", F.abs(F.col(actual) - F.col(predicted)))
    return d.orderBy(F.desc("abs_error"), *ids).limit(n)


def panel_balance(df: DataFrame, entity: str, time: str) -> DataFrame:
    """Balanced flag, sizes and the count of missing cells.

    Duplicate cells count as observations, as in a plain row count per entity.
    """
    per = entity_bitmaps(df, entity, time)
    missing = F.when(F.col(entity).isNotNull(), missing_count()).otherwise(0)
    d = per.agg(
        F.count(F.lit(1)).alias("entities"),
        F.min("_n").alias("min_obs"),
        F.max("_n").alias("max_obs"),
        F.avg("_n").alias("avg_obs"),
        F.sum("_n").alias("total_obs"),
        F.coalesce(F.max(period_count()), F.lit(0)).alias("time_periods"),
        F.coalesce(F.sum(missing), F.lit(0)).alias("missing_entries"),
    )
    return d.select(
        ((F.col("min_obs") == F.col("max_obs")) & (F.col("missing_entries") == 0)).alias("is_balanced"),
        "entities", "time_periods", "min_obs", "max_obs", "avg_obs", "total_obs", "missing_entries",
    )


def diagnostic_summary(records: DataFrame) -> DataFrame:
    """Summary over per-entity diagnostic records."""
    n = F.count(F.lit(1))
    return records.agg(
        n.alias("total_entities"),
        F.avg("n_obs").alias("avg_obs"),
        F.min("n_obs").alias("min_obs"),
        F.max("n_obs").alias("max_obs"),
        F.count_if("is_stationary").alias("stationary"),
        (ratio(F.count_if("is_stationary"), n) * 100).alias("stationary_pct"),
        F.count_if("has_autocorrelation").alias("autocorrelated"),
        (ratio(F.count_if("has_autocorrelation"), n) * 100).alias("autocorrelated_pct"),
        F.avg("ols_r2").alias("avg_r2"),
        F.count_if(F.col("ols_r2") < 0.5).alias("r2_below_05"),
        F.count_if(F.col("trend") == "increasing").alias("increasing"),
        F.count_if(F.col("trend") == "decreasing").alias("decreasing"),
    ).withColumn("median_r2", _medians(records, "ols_r2"))


def issue_score() -> Column:
    yes = lambda c: F.coalesce(c.cast("int"), F.lit(0))
    return (
        yes(~F.col("is_stationary")) + yes(F.col("has_autocorrelation")) + yes(F.col("ols_r2") < 0.3)
    )


def worst_entities(records: DataFrame, entity: str, n: int = 10) -> DataFrame:
    d = records.withColumn("issue_score", issue_score())
    return d.orderBy(F.desc("issue_score"), entity).limit(n)


def violation_counts(records: DataFrame) -> DataFrame:
    """How many entities fail each assumption; columns absent from the record are skipped."""
    tests = {
        "non_stationary": ("adf_pvalue", lambda c: c >= 0.05),
        "autocorrelated": ("durbin_watson", lambda c: (c < 1.5) | (c > 2.5)),
        "heteroskedastic": ("bp_pvalue", lambda c: c < 0.05),
        "non_normal": ("sw_pvalue", lambda c: c <= 0.05),
    }
    return records.agg(
        F.count(F.lit(1)).alias("entities"),
        *[F.count_if(f(F.col(c))).alias(n) for n, (c, f) in tests.items() if c in records.columns],
    )


def metric_report(wide: DataFrame, metrics: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """(keys, metric, value) rows from a wide aggregate."""
    d = wide.select(*keys, *[F.col(m).cast("double").alias(m) for m in metrics])
    return d.unpivot(list(keys), list(metrics), "metric", "value")


def gaussian_nll(y: str, mean: str, sigma: str) -> Column:
    e, s2 = F.col(y) - F.col(mean), F.col(sigma) * F.col(sigma)
    return F.avg(
        F.lit(0.5) * F.ln(2 * F.pi() * s2) + F.try_divide(e * e, 2 * s2)
    )


def tick_quality(df: DataFrame, ts: str, instrument: str) -> DataFrame:
    """Range, missing prices and repeated (ts, instrument) keys, via one key-level aggregate."""
    prices = [c for c in ("bid", "ask", "mid") if c in df.columns]
    per = df.groupBy(ts, instrument).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in prices],
    )
    return per.agg(
        F.sum("_n").alias("rows"),
        F.min(ts).alias("first_ts"),
        F.max(ts).alias("last_ts"),
        F.sum(F.col("_n") - 1).alias("duplicate_keys"),
        *[F.sum(f"null_{c}").alias(f"null_{c}") for c in prices],
    )


# A value longer than this is compared by its digest, so that texts are not shuffled.
LONG_VALUE = 32
# Characters of a value that a profile shows.
SHOWN = 60


def narrow(df: DataFrame) -> DataFrame:
    """The same equalities between rows and columns with long text and nested values as digests."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.StringType):
            c = F.when(F.length(c) > LONG_VALUE, F.sha2(c, 256)).otherwise(c)
        elif isinstance(f.dataType, T.BinaryType):
            c = F.sha2(c, 256)
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            c = F.sha2(F.to_json(F.struct(c.alias("v")), {"ignoreNullFields": "false"}), 256)
        out.append(c.alias(f.name))
    return df.select(*out)


def shown(field: T.StructField) -> Column:
    """A value as a short text; nested values as their size."""
    c = F.col(field.name)
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return c.cast("decimal(38,4)").cast("string")
    if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    if isinstance(field.dataType, (T.ArrayType, T.MapType)):
        return F.when(c.isNotNull(), F.size(c)).cast("string")
    return F.substring((F.to_json(c) if isinstance(field.dataType, T.StructType) else c.cast("string")), 1, SHOWN)


def first_rows(df: DataFrame, n: int = 5) -> DataFrame:
    """(column, metric, value): the first rows in the order of all plain columns, as ``first_1`` and so on.

    Each task keeps its n first rows, so nothing is sorted as a whole.
    """
    nested = (T.ArrayType, T.MapType, T.StructType, T.BinaryType)
    order = [f.name for f in df.schema.fields if not isinstance(f.dataType, nested)]
    texts = [shown(f) for f in df.schema.fields]
    d = df.select(F.struct(*order).alias("at"), F.array(*texts).alias("v")).orderBy("at").limit(n)
    rows = d.agg(F.array_sort(F.collect_list(F.struct("at", "v"))).alias("r")).select(F.posexplode("r").alias("i", "r"))
    each = F.array(*[F.struct(F.lit(c).alias("column"), F.get("r.v", F.lit(k)).alias("value")) for k, c in enumerate(df.columns)])
    metric = F.concat(F.lit("first_"), (F.col("i") + 1).cast("string"))
    return rows.select(metric.alias("metric"), F.inline(each)).select("column", "metric", "value")


def table_profile(df: DataFrame, name: str) -> DataFrame:
    """(dataset, column, metric, value): shape, types, first rows, missing and distinct values, description, verdicts.

    One query. Long texts and nested values take part in duplicates and distinct counts by their digests.
    """
    text = lambda c: F.col(c).cast("string")
    fields = df.schema.fields
    entry = lambda c, m, v: F.struct(F.lit(c).alias("column"), F.lit(m).alias("metric"), v.alias("value"))
    fixed = [entry("", "columns", F.lit(str(len(fields))))]
    fixed += [entry(f.name, "type", F.lit(f.dataType.simpleString())) for f in fields]
    short = narrow(df)
    fit = suitability(df, name)
    codes = F.array_join(F.transform("reasons", lambda r: r["code"]), ",")
    parts = [
        _rows(df.agg(F.count(F.lit(1)).alias("r")), [entry("", "rows", text("r")), *fixed]),
        _rows(fit, [entry("", "linear_verdict", F.col("linear_verdict")), entry("", "forest_verdict", F.col("forest_verdict")), entry("", "reasons", codes)]),
        duplicates(short).select(F.lit("").alias("column"), F.lit("duplicates").alias("metric"), text("duplicates").alias("value")),
        missing_by_column(df).select("column", F.lit("missing").alias("metric"), text("missing").alias("value")),
        distinct_counts(short, short.columns).select("column", F.lit("distinct").alias("metric"), text("distinct_values").alias("value")),
        first_rows(df),
    ]
    if numeric_columns(df):
        stats = ["mean", "std", "min", "q25", "q50", "q75", "max"]
        described = metric_report(describe(df), stats, ["column"])
        parts.append(described.select("column", "metric", F.col("value").cast("decimal(38,4)").cast("string").alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.lit(name).alias("dataset"), "column", "metric", "value")


def dataset_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """``table_profile`` of every table; ``sources.directory`` does so for files, of which some may be broken."""
    out = None
    for name, df in tables.items():
        one = table_profile(df, name)
        out = one if out is None else out.unionByName(one)
    return out


def top_groups(df: DataFrame, group: str, value: str, n: int = 5) -> DataFrame:
    means = df.groupBy(group).agg(F.avg(value).alias("mean_value"))
    return means.orderBy(F.desc("mean_value"), group).limit(n)


def top_group_rows(df: DataFrame, group: str, value: str, n: int = 5) -> DataFrame:
    """All rows of the n groups with the highest mean. The list has n rows: safe to broadcast."""
    best = top_groups(df, group, value, n).select(group)
    return df.join(F.broadcast(best), group, "left_semi")


def top_per_period(df: DataFrame, time: str, value: str, ids: Sequence[str], n: int = 30) -> DataFrame:
    """Rank limit: Spark keeps at most n rows per period and task before the shuffle."""
    w = W.partitionBy(time).orderBy(F.desc(value), *ids)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def group_stat(df: DataFrame, keys: Sequence[str], stats: dict[str, Column]) -> DataFrame:
    """Group statistics on every row, as aggregate and join.

    Unlike a window over the key, no task has to hold a whole group.
    """
    means = df.groupBy(*keys).agg(*[c.alias(n) for n, c in stats.items()])
    return df.join(means, list(keys), "left")
