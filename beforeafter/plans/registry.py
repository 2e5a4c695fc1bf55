"""Registry of named queries and their DuckDB oracle SQL.

Every query takes ``(spark, sf_dir)``, reads the given parquet tables through
a binding and returns a DataFrame.  Per-row doubles are presented at 6 decimals;
sums and means add rows as decimals of 6 places, so two engines can be compared
value by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from beforeafter.plans import queries_checks, queries_core, queries_rfm, queries_sources, queries_text, queries_views  # noqa: F401
