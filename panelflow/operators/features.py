"""Lags, differences, returns, rolling features and sequence samples."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelflow.functions.scalars import ratio
from panelflow.operators.clean import numeric_columns
from panelflow.plans.series import Series, frames, public, scan


def _known(df: DataFrame, columns: Sequence[str]) -> list[str]:
    known = [c for c in columns if c in df.columns]
    for c in columns:
        if c not in known:
            warnings.warn(f"column {c!r} not found, skipped", stacklevel=3)
    return known


def lags(df: DataFrame, s: Series, columns: Sequence[str], ks: Sequence[int] = (1,)) -> DataFrame:
    """``{v}_lag{k}``: the value k rows back, counted in rows and not in periods."""

    def stage(w):
        return {f"{c}_lag{k}": F.lag(c, k).over(w) for c in columns for k in ks}

    return public(frames(df, s, stage, back=max(ks)))


def complete_cases(df: DataFrame, columns: Sequence[str], k: int) -> DataFrame:
    """Rows complete in the deepest lag, and rows lost."""
    full = F.lit(True)
    for c in columns:
        full = full & F.col(f"{c}_lag{k}").isNotNull()
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(full).alias("complete"),
        F.count_if(~full).alias("lost"),
    )


def differences(df: DataFrame, s: Series, columns: Sequence[str]) -> DataFrame:
    """``{v}_diff``; unknown columns are skipped with a warning."""
    columns = _known(df, columns)
    d = scan(df, s, prev={f"_p_{c}": F.col(c) for c in columns})
    d = d.withColumns({f"{c}_diff": F.col(c) - F.col(f"_p_{c}") for c in columns})
    return public(d.drop(*[f"_p_{c}" for c in columns]))


def lagged_differences(df: DataFrame, s: Series, columns: Sequence[str]) -> DataFrame:
    def stage(w):
        return {f"{c}_diff_lag1": F.lag(c, 1).over(w) - F.lag(c, 2).over(w) for c in columns}

    return public(frames(df, s, stage, back=2))


def lag_family(df: DataFrame, s: Series, columns: Sequence[str], ks: Sequence[int] = (1, 2)) -> DataFrame:
    """Lags, differences and lagged differences of all columns in one window pass."""
    columns = _known(df, columns)

    def back_values(w):
        return {f"_b{k}_{c}": F.lag(c, k).over(w) for c in columns for k in {1, 2, *ks}}

    d = frames(df, s, back_values, back=max(2, *ks))
    out: dict[str, Column] = {}
    for c in columns:
        out |= {f"{c}_lag{k}": F.col(f"_b{k}_{c}") for k in ks}
        out[f"{c}_diff"] = F.col(c) - F.col(f"_b1_{c}")
        out[f"{c}_diff_lag1"] = F.col(f"_b1_{c}") - F.col(f"_b2_{c}")
    d = d.withColumns(out).drop(*[f"_b{k}_{c}" for c in columns for k in {1, 2, *ks}])
    return public(d)


def log_columns(df: DataFrame, columns: Sequence[str], epsilon: float = 1e-6) -> DataFrame:
    """``log_{v}``; if any value is <= 0, epsilon is added on every row.

    The minimum is a scalar subquery of one aggregate, so the plan stays lazy. The log of
    a negative number is NULL.
    """
    columns = _known(df, columns)
    low = df.agg(*[F.min(c).alias(c) for c in columns])
    shift = {
        c: F.when(low.select(c).scalar() <= 0, F.lit(epsilon)).otherwise(F.lit(0.0)) for c in columns
    }
    return df.withColumns({f"log_{c}": F.ln(F.col(c) + shift[c]) for c in columns})


def gaps(df: DataFrame, s: Series, ts: str, threshold: float) -> DataFrame:
    """Seconds since the previous row, and whether they exceed the threshold."""
    d = scan(df, s, prev={"_pt": F.col(ts)})
    return d.withColumn(
        "dt", (F.unix_micros(ts) - F.unix_micros("_pt")) / F.lit(1e6)
    ).withColumn("is_gap", F.coalesce(F.col("dt") > threshold, F.lit(False))).drop("_pt")


def bar_gap_threshold(minutes: float) -> float:
    """Gap limit for bars: one and a half bar lengths, in seconds."""
    return minutes * 60.0 * 1.5


def log_returns(
    df: DataFrame, s: Series, price: str, ts: str, gap_seconds: float | None = None
) -> DataFrame:
    """``log_return`` per row; the first row of a key is dropped.

    With ``gap_seconds`` the returns that follow a gap are dropped too: they measure the
    interruption and not the market.
    """
    lp = F.ln(F.col(price).cast("double"))
    d = scan(df, s, prev={"_pl": lp, "_pt": F.col(ts)})
    d = d.withColumns(
        {
            "dt": (F.unix_micros(ts) - F.unix_micros("_pt")) / F.lit(1e6),
            "log_return": lp - F.col("_pl"),
        }
    ).drop("_pl", "_pt")
    d = d.where(F.col("log_return").isNotNull())
    if gap_seconds is not None:
        d = d.where(F.col("dt") <= gap_seconds)
    return d


def rolling_stages(value: str, n: int):
    """Two stages: the frame aggregates, then NULL where the frame was not full."""

    def sums(w):
        v, frame = F.abs(F.col(value)), w.rowsBetween(-(n - 1), 0)
        return {
            "_full": F.count(v).over(frame) == n,
            "volatility": F.stddev_samp(v).over(frame),
            "activity": F.avg(v).over(frame),
        }

    def masked(_):
        return {c: F.when(F.col("_full"), F.col(c)) for c in ("volatility", "activity")}

    return sums, masked


def rolling_features(df: DataFrame, s: Series, value: str = "log_return", n: int = 20) -> DataFrame:
    """Volatility (sample std) and activity (mean) of |value|, full windows only."""
    return frames(df, s, *rolling_stages(value, n), back=n - 1).drop("_full")


def sequence_samples(
    df: DataFrame,
    s: Series,
    features: Sequence[str],
    target: str,
    window: int,
    horizon: int = 1,
) -> DataFrame:
    """One row per sample: the ``window`` feature rows, and the target ``horizon`` rows later."""

    def stage(w):
        frame = w.rowsBetween(-(window - 1), 0)
        return {
            "x": F.collect_list(F.struct(*[F.col(c).cast("float").alias(c) for c in features])).over(frame),
            "y": F.lead(F.col(target).cast("float"), horizon).over(w),
        }

    d = frames(df, s, stage, back=window - 1, ahead=horizon)
    return d.where((F.size("x") == window) & F.col("y").isNotNull())


def tick_samples(
    df: DataFrame,
    s: Series,
    price: str,
    ts: str,
    window: int = 30,
    vol_window: int = 20,
    horizon: int = 1,
) -> DataFrame:
    """Returns, rolling features and sequences in one halo pass over the blocks."""
    d = log_returns(df, s, price, ts)

    def samples(w):
        frame = w.rowsBetween(-(window - 1), 0)
        row = F.when(
            F.col("volatility").isNotNull(),
            F.struct(*[F.col(c).cast("float").alias(c) for c in ("log_return", "volatility", "activity")]),
        )
        return {
            "x": F.collect_list(row).over(frame),
            "y": F.lead(F.col("log_return").cast("float"), horizon).over(w),
        }

    d = frames(
        d, s, *rolling_stages("log_return", vol_window), samples,
        back=window + vol_window - 2, ahead=horizon,
    )
    return d.where((F.size("x") == window) & F.col("y").isNotNull()).drop("_full")


def require_samples(samples: DataFrame) -> DataFrame:
    if samples.isEmpty():
        raise ValueError("not enough data for the given window and horizon")
    return samples


def panel_sequences(
    df: DataFrame,
    s: Series,
    target: str,
    features: Sequence[str] | None = None,
    length: int = 5,
) -> DataFrame:
    """``length`` earlier rows of each key and the target of the row that follows them."""
    features = list(
        features
        or [c for c in numeric_columns(df) if c not in (*s.keys, *s.order, target)]
    )

    def stage(w):
        frame = w.rowsBetween(-length, -1)
        return {"x": F.collect_list(F.struct(*features)).over(frame), "y": F.col(target)}

    d = frames(df, s, stage, back=length)
    return public(d.where(F.size("x") == length))


def detect_layout(df: DataFrame) -> tuple[str, str, int]:
    """(entity, time, sequence length) by the columns present: panel first, then ticks."""
    names = set(df.columns)
    for entity, time, length in (("country", "year", 5), ("symbol", "timestamp", 20), ("instrument", "ts", 20)):
        if {entity, time} <= names:
            return entity, time, length
    raise ValueError("cannot tell a panel from ticks by column names")


def jumps(df: DataFrame, s: Series, value: str, limit: float) -> DataFrame:
    """Rows whose value moved by more than ``limit`` since the row before."""
    d = scan(df, s, prev={"previous": F.col(value)})
    d = d.withColumn("jump", F.abs(F.col(value) - F.col("previous")))
    return public(d.where(F.col("jump") > limit))


def per_capita(df: DataFrame, columns: Sequence[str], population: str) -> DataFrame:
    return df.withColumns({f"{c}_per_capita": ratio(c, population) for c in columns})


def interactions(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    return df.withColumns({f"{a}_x_{b}": F.col(a) * F.col(b) for a, b in pairs})


def bars(
    df: DataFrame, keys: Sequence[str], ts: str, price: str, size: str, volume: Column | None = None, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """OHLCV bars per key and time slot; works on streams with a watermark too.

    Rows of equal time are ordered by ``tiebreak``, then by price, so open and close are defined.
    """
    order = F.struct(ts, *tiebreak, price)
    return (
        df.groupBy(*keys, F.window(ts, size).alias("_w"))
        .agg(
            F.min_by(price, order).alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max_by(price, order).alias("close"),
            F.sum(volume if volume is not None else F.lit(1)).alias("volume"),
        )
        .select(*keys, F.col("_w.start").alias("bar_start"), "open", "high", "low", "close", "volume")
    )
