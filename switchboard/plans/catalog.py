"""Registry of named queries: a Spark callable and, where an exact answer
exists, the DuckDB SQL that computes the same rows.

Each callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole input tables. Modules register their queries on import.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    # Importing the query modules fills the registry.
    from switchboard.plans import (  # noqa: F401
        q_aggregates, q_conversions, q_history, q_incremental, q_joins, q_keys, q_layout, q_rollups, q_sessions,
    )
