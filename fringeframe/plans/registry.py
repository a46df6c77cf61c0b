"""Queries by operator id, each with its checking SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..views import GRID_SQL, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def op(key: str, sql: str | None = None):
    """Register a query; ``@grid`` in the SQL stands for the dense spectra."""

    def add(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate query {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = with_views(sql.replace("@grid", GRID_SQL))
        return fn

    return add


#: Added before rounding on both sides, so that a sum that falls on a tie (half of
#: the last digit) is not rounded by its last bit, and -0.0 never shows.
NUDGE = 3.1e-9


def r6(c, digits: int = 6) -> Column:
    """Rounded for comparison."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double") + F.lit(NUDGE), digits)
