"""Analytics over keyed, ordered series (panels and ticks) as Spark DataFrames."""

from panelflow.plans.series import Series

__all__ = ["Series"]
