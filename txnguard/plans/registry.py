"""

Each entry is ``fn(spark, sf_dir) -> DataFrame`` over the whole driver tables,
plus (where SQL can express it) the DuckDB text that must give the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import oracle

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None, raw_sql: bool = False):
    """Register a query; ``sql`` is the oracle body (adapter CTEs are prepended)."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql if raw_sql else oracle.q(sql)
        return fn

    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from . import (  # noqa: F401
        q_batch,
        q_ingest,
        q_profile,
        q_joins,
        q_ml,
        q_streaming,
        q_serving,
    )
