"""Registry used by ``__spark_entry__``: query builders and their DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lathe.functions.columns import rnd

from lathe.sources.fixtures import PASSENGERS_CTE

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

# Computed doubles are rounded to this many decimals in both engines, so the
# order of floating point additions cannot change a compared value.
DP = 6


def register(name: str, sql: str | None = None):
    """Decorator: register a query builder and (optionally) its oracle SQL."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query key {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def with_passengers(body: str, extra_ctes: str = "") -> str:
    """Oracle SQL over the shared ``passengers`` view (plus optional CTEs)."""
    extra = f",\n{extra_ctes}" if extra_ctes.strip() else ""
    return f"{PASSENGERS_CTE}{extra}\n{body}"


def r(x: Column | str, dp: int = DP) -> Column:
    col = F.col(x) if isinstance(x, str) else x
    return rnd(col, dp)
