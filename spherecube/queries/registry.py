"""Named queries and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name``, with its DuckDB text where SQL can express it."""

    def register(func):
        if name in QUERIES:
            raise ValueError(f"two queries called {name}")
        QUERIES[name] = func
        if sql is not None:
            ORACLES[name] = sql
        return func

    return register


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Round for comparison across engines, which add doubles in different orders."""
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


def r(column: Column | str, digits: int = 6) -> Column:
    return F.round(column, digits)
