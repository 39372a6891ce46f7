"""Registry of named queries, each with its SQL twin where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stpanel.plans.fixtures import CTES

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` may use the tables of ``CTES``."""

    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            # A query with further CTEs starts with a comma.
            ORACLES[name] = CTES + sql
        return fn

    return add


def rounded(df: DataFrame, cols: Sequence[str], digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


def r(expr: str, digits: int = 6) -> str:
    """SQL rounding without negative zero."""
    return f"CASE WHEN round({expr}, {digits}) = 0 THEN 0.0 ELSE round({expr}, {digits}) END"
