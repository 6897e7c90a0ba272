"""Forecast frames, direct multi-horizon forecasts with components, and blends."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelflow.functions.scalars import year_start
from panelflow.operators.profile import regression_metrics
from panelflow.operators.regression import complete_rows, fit_moments, moments
from panelflow.plans.series import POS, Series, frames, positions

Step = Callable[[Column, Column], Column]


def next_years(t: Column, h: Column) -> Column:
    return t + h


def next_months(t: Column, h: Column) -> Column:
    return F.add_months(t, h)


def forecast_frame(
    df: DataFrame, entity: str, year: str, target: str, regressors: Sequence[str], periods: int = 5
) -> DataFrame:
    """(entity, ds, y, regressors) and ``periods`` future rows per entity without values."""
    history = df.select(
        entity, year_start(year).alias("ds"), F.col(target).alias("y"), *regressors, F.lit(False).alias("is_future")
    )
    last = df.groupBy(entity).agg(F.max(year).alias("_last"))
    ahead = F.sequence(F.col("_last") + 1, F.col("_last") + periods)
    future = last.select(entity, F.explode(ahead).alias("_y"))
    future = future.select(entity, year_start("_y").alias("ds"), F.lit(True).alias("is_future"))
    return history.unionByName(future, allowMissingColumns=True)


def direct_forecast(
    df: DataFrame,
    s: Series,
    target: str,
    regressors: Sequence[str] = (),
    *,
    lags: int = 3,
    horizon: int = 5,
    ridge: float = 1e-2,
    holdout: int = 0,
    step: Step = next_years,
) -> DataFrame:
    """One regression per (key, horizon) on the last ``lags`` rows of target and regressors.

    Output is long: key, ds, origin, horizon, y, yhat, component columns and is_forecast.
    With ``holdout`` the last rows take no part in fitting; the forecasts over them carry
    the actual y and so can be scored. All keys and horizons are fitted in one aggregate.
    """
    keys, time = list(s.keys), s.order[0]
    inputs = [target, *regressors]
    d = df.select(*keys, *s.order, *[F.col(c).cast("double").alias(c) for c in inputs])
    d = complete_rows(d, inputs)
    d = positions(d, s, count="_n")
    names = {c: [f"_{c}_{k}" for k in range(lags)] for c in inputs}
    xs = [n for c in inputs for n in names[c]]

    def design(w):
        out = {names[c][k]: F.lag(c, k).over(w) for c in inputs for k in range(lags)}
        return out | {f"_t{h}": F.lead(target, h).over(w) for h in range(1, horizon + 1)}

    d = frames(d, s, design, back=lags - 1, ahead=horizon)
    train_rows = F.col("_n") - F.lit(holdout)
    d = d.where(F.col(POS) < train_rows)
    targets = F.array(
        *[F.struct(F.lit(h).alias("horizon"), F.col(f"_t{h}").alias("y")) for h in range(1, horizon + 1)]
    )
    d = d.select(*keys, time, POS, train_rows.alias("_train"), *xs, F.inline(targets))
    fit_rows = d.where(F.col(POS) + F.col("horizon") < F.col("_train"))
    fit = fit_moments(moments(fit_rows, [*keys, "horizon"], "y", xs), ridge)
    origins = complete_rows(d, xs).join(fit.select(*keys, "horizon", "coef", "intercept"), [*keys, "horizon"])

    def part(c: str) -> Column:
        first = xs.index(names[c][0])
        out = F.lit(0.0)
        for k in range(lags):
            out = out + F.get("coef", F.lit(first + k)) * F.col(names[c][k])
        return out

    origins = origins.withColumns(
        {"ar": part(target), "trend": F.col("intercept")}
        | {f"lagged_{c}": part(c) for c in regressors}
    )
    parts = ["trend", "ar", *[f"lagged_{c}" for c in regressors]]
    total = F.col("trend")
    for p in parts[1:]:
        total = total + F.col(p)
    return origins.where(F.col("intercept").isNotNull()).select(
        *keys,
        step(F.col(time), F.col("horizon")).alias("ds"),
        F.col(time).alias("origin"),
        "horizon",
        "y",
        total.alias("yhat"),
        *parts,
        (F.col(POS) + F.col("horizon") >= F.col("_train")).alias("is_forecast"),
    )


def forecast_wide(long: DataFrame, keys: Sequence[str], horizon: int = 5) -> DataFrame:
    """One row per (key, ds) with yhat1..yhatH."""
    out = long.groupBy(*keys, "ds").pivot("horizon", list(range(1, horizon + 1))).agg(F.max("yhat"))
    return out.select(*keys, "ds", *[F.col(str(h)).alias(f"yhat{h}") for h in range(1, horizon + 1)])


def holdout_scores(long: DataFrame, by: Sequence[str] = ("horizon",)) -> DataFrame:
    """Metrics of the held-out forecasts."""
    scored = long.where(F.col("is_forecast") & F.col("y").isNotNull())
    return scored.groupBy(*by).agg(*regression_metrics("y", "yhat"))


def blend(df: DataFrame, weights: Mapping[str, float]) -> DataFrame:
    """Weighted sum of prediction columns; weights are normalised once."""
    total = float(sum(weights.values()))
    if total <= 0:
        raise ValueError("weights must have a positive sum")
    out = F.lit(0.0)
    for c, w in weights.items():
        out = out + F.lit(w / total) * F.col(c)
    return df.withColumn("blend", out)


def equal_weights(columns: Sequence[str]) -> dict[str, float]:
    return {c: 1.0 for c in columns}


def model_scores(df: DataFrame, actual: str, columns: Sequence[str]) -> DataFrame:
    """One metrics row per prediction column, in one pass over the rows."""
    stacked = df.select(
        actual, F.inline(F.array(*[F.struct(F.lit(c).alias("model"), F.col(c).alias("_p")) for c in columns]))
    )
    return stacked.groupBy("model").agg(*regression_metrics(actual, "_p"))
