"""Change points, regime segments and change scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from panelflow.functions.tails import t_pvalue
from panelflow.plans.series import BLOCK, BUCKET, POS, Series, frames, positions, scan

SLOPE_LIMIT = 0.1


def welch_scores(df: DataFrame, s: Series, value: str, window: int = 10) -> DataFrame:
    """Welch t of the ``window`` rows before each row against those from it on.

    Only rows with two full windows inside the series (and one row to spare at the end)
    are scored. With no variance on both sides t is infinite for different means and NULL
    for equal ones.
    """
    keys = list(s.keys)
    keep = [c for c in (BUCKET,) if c in df.columns]
    d = positions(df.select(*keys, *s.order, value, *keep), s, count="_n")
    v = F.col(value).cast("double")

    def stage(w):
        past, future = w.rowsBetween(-window, -1), w.rowsBetween(0, window - 1)
        return {
            "mean_before": F.avg(v).over(past),
            "_v1": F.var_samp(v).over(past),
            "mean_after": F.avg(v).over(future),
            "_v2": F.var_samp(v).over(future),
        }

    # The row after the second window must exist too, hence one more row ahead.
    d = frames(d, s, stage, back=window, ahead=window, keep_blocks=True)
    inside = (F.col(POS) >= window) & (F.col(POS) < F.col("_n") - window)
    a, b = F.col("_v1") / window, F.col("_v2") / window
    diff = F.col("mean_before") - F.col("mean_after")
    flat = (a + b) == 0
    t = (
        F.when(flat & (diff > 0), F.lit(float("inf")))
        .when(flat & (diff < 0), F.lit(float("-inf")))
        .otherwise(F.try_divide(diff, F.sqrt(a + b)))
    )
    df_ = F.try_divide((a + b) * (a + b), (a * a + b * b) / (window - 1))
    d = d.withColumns(
        {
            "statistic": F.when(inside, t),
            "dof": F.when(inside, F.coalesce(df_, F.lit(2.0 * window - 2))),
        }
    )
    return d.drop("_v1", "_v2")


def _flagged(scores: DataFrame, threshold: float, alpha: float) -> DataFrame:
    """p-values are asked only for rows beyond the threshold; elsewhere they stay NULL."""
    far = F.abs("statistic") > threshold
    d = scores.withColumn("p_value", t_pvalue(F.when(far, F.col("statistic")), F.when(far, F.col("dof"))))
    return d.withColumn("is_change", F.coalesce(F.col("p_value") < alpha, F.lit(False)))


def change_points(
    df: DataFrame,
    s: Series,
    value: str,
    *,
    window: int = 10,
    threshold: float = 2.5,
    alpha: float = 0.01,
    local_max: bool = False,
) -> DataFrame:
    """One row per change point. ``local_max`` keeps the strongest within a window only."""
    scores = welch_scores(df, s, value, window)
    d = _flagged(scores.where(F.abs("statistic") > threshold), threshold, alpha).where("is_change")
    if local_max:
        # Rival points lie within one window: an equi-join on window-sized cells, each
        # point looking into its own and both neighbour cells.
        keys = list(s.keys)
        cell = F.floor(F.col(POS) / window)
        rivals = d.select(*keys, F.col(POS).alias("_rp"), F.abs("statistic").alias("_rt"), cell.alias("_cell"))
        own = d.select(*keys, POS, F.abs("statistic").alias("_t"), F.explode(F.array(cell - 1, cell, cell + 1)).alias("_cell"))
        beaten = own.join(rivals, [*keys, "_cell"]).where(
            (F.abs(F.col("_rp") - F.col(POS)) <= window)
            & ((F.col("_rt") > F.col("_t")) | ((F.col("_rt") == F.col("_t")) & (F.col("_rp") < F.col(POS))))
        )
        d = d.join(beaten.select(*keys, POS).distinct(), [*keys, POS], "left_anti")
    return d.select(
        *s.keys, *s.order, F.col(POS).alias("index"), "statistic", "p_value", "mean_before", "mean_after"
    )


def slope_label(slope: Column) -> Column:
    return (
        F.when(slope.isNull(), "unknown")
        .when(slope > SLOPE_LIMIT, "increasing")
        .when(slope < -SLOPE_LIMIT, "decreasing")
        .otherwise("stable")
    )


def segments(flagged: DataFrame, s: Series, value: str, flag: str = "is_change", part: str | None = None) -> DataFrame:
    """Segments between flagged rows, with start, end (exclusive) and type by slope.

    Input rows carry their position; a key without a flag is one segment of type ``single``.
    """
    keys = list(s.keys)
    one = F.col(flag).cast("long")
    d = scan(flagged, s, sums={"segment": one}, part=part)
    d = d.groupBy(*keys, "segment").agg(
        F.min(POS).alias("start"),
        (F.max(POS) + 1).alias("end"),
        F.regr_slope(F.col(value), F.col(POS)).alias("slope"),
    )
    last = flagged.groupBy(*keys).agg(F.sum(one).alias("_changes"))
    d = d.join(last, keys)
    kind = F.when(F.col("_changes") == 0, "single").otherwise(slope_label(F.col("slope")))
    return d.select(*keys, "start", "end", kind.alias("type"))


def regimes(
    df: DataFrame,
    s: Series,
    value: str,
    *,
    window: int = 10,
    threshold: float = 2.5,
    alpha: float = 0.01,
    least: int = 20,
) -> DataFrame:
    """Change points and the segments between them, for keys of at least ``least`` rows."""
    d = welch_scores(df, s, value, window).where(F.col("_n") >= least)
    d = _flagged(d, threshold, alpha)
    return segments(d, s, value, part=BLOCK if s.plan == "blocks" else None)


def check_periods(df: DataFrame, s: Series, least: int = 20) -> DataFrame:
    """Raise for keys shorter than the detector needs."""
    short = df.groupBy(*s.keys).count().where(F.col("count") < least)
    if not short.isEmpty():
        raise ValueError(f"need at least {least} rows per key")
    return df


def cusum_columns(value: str, window: int, normalise: bool = False):
    """Stage for ``frames``: the change score of the last ``window`` rows."""

    def stage(w):
        v = F.col(value).cast("double")
        recent = w.rowsBetween(-(window - 1), 0)
        history = w.rowsBetween(-(2 * window - 1), -window)
        spread = F.stddev_pop(v).over(history) + F.lit(1e-10)
        score = (F.sum(v).over(recent) - window * F.avg(v).over(history)) / spread
        if normalise:
            score = score / F.sqrt(F.lit(float(window)))
        return {"score": F.when(F.count(v).over(history) == window, score)}

    return stage


def cusum(
    df: DataFrame,
    s: Series,
    value: str,
    *,
    window: int = 10,
    threshold: float = 2.5,
    normalise: bool = False,
) -> DataFrame:
    """Sum of the last ``window`` deviations from the mean of the ``window`` rows before.

    ``normalise`` divides by sqrt(window), which gives the threshold its usual meaning.
    """
    d = frames(df, s, cusum_columns(value, window, normalise), back=2 * window - 1)
    d = d.where(F.col("score").isNotNull())
    return d.withColumn("is_change", F.abs("score") > threshold)


def current_regime(df: DataFrame, s: Series, value: str, last: int = 10) -> DataFrame:
    """Type of the last rows of each key; the rank limit runs before the shuffle."""
    keys = list(s.keys)
    w = W.partitionBy(*keys).orderBy(*[F.desc(c) for c in s.order])
    d = df.select(*keys, *s.order, value).withColumn("_r", F.row_number().over(w))
    d = d.where(F.col("_r") <= last)
    return d.groupBy(*keys).agg(
        F.when(F.count(F.lit(1)) < last, "insufficient_data")
        .otherwise(slope_label(F.regr_slope(F.col(value), -F.col("_r"))))
        .alias("regime")
    )


__all__ = ["change_points", "check_periods", "current_regime", "cusum", "regimes", "segments", "welch_scores"]
