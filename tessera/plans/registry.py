"""Registry of the queries checked by the driver.

Each query is a ``(spark, sf_dir) -> DataFrame`` callable registered under a
with the DuckDB SQL that must produce the same rows (omitted for operators
whose output is random or iterative: those get the driver's rows-only check).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Decorator: add a query and, when SQL-checkable, its oracle SQL."""

    def deco(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn

    return deco
