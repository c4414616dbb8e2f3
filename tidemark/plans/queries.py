"""All registered queries of the forecasting operators."""

from . import facts, fitted, forecasts, ladder, replays, reports, runs  # noqa: F401
from .registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
