"""The panel flow end to end, as one lazy plan."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from panelflow.operators.clean import members_only, project
from panelflow.operators.features import lag_family, log_columns
from panelflow.operators.impute import CRITICAL, UNTOUCHED, ZERO_FILL, impute
from panelflow.plans.series import Series

# The panel's variables.
VARIABLES = ("emissions", "energy_use", "gdp", "population", "renewable_pct")


@dataclass(frozen=True)
class PanelConfig:
    entity: str = "country"
    time: str = "year"
    variables: Sequence[str] = VARIABLES
    lags: Sequence[int] = (1, 2)
    log: bool = True
    epsilon: float = 1e-6
    method: str = "interpolate"
    critical: Sequence[str] = CRITICAL
    zero_fill: Sequence[str] = ZERO_FILL
    untouched: Sequence[str] = UNTOUCHED
    impute_first: bool = False
    entities: Sequence = field(default_factory=tuple)

    def series(self) -> Series:
        return Series((self.entity,), (self.time,))


def prepare_panel(df: DataFrame, config: PanelConfig) -> DataFrame:
    """Select entities, derive lags, differences and logs, fill gaps.

    By default the features come before the imputation, which then also fills the first lag
    rows of each entity; ``impute_first`` fills the base columns before deriving.
    """
    s = config.series()
    fill = dict(
        method=config.method, critical=config.critical, zero_fill=config.zero_fill, untouched=config.untouched
    )
    d = members_only(df, config.entity, config.entities)
    if config.impute_first:
        d = impute(d, s, **fill)
    d = lag_family(d, s, config.variables, config.lags)
    if config.log:
        d = log_columns(d, [v for v in config.variables if v not in config.untouched], config.epsilon)
    return d if config.impute_first else impute(d, s, **fill)


def clean_panel(df: DataFrame, columns: Sequence[str], entity: str, entities: DataFrame | Sequence | None) -> DataFrame:
    return project(members_only(df, entity, entities), columns)
