"""All registered queries."""

from panelflow.suite import models, series, storage, tables  # noqa: F401
from panelflow.suite.registry import ORACLES, QUERIES, Tables

__all__ = ["ORACLES", "QUERIES", "Tables"]
