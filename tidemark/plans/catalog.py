"""Registry of named queries: each takes (spark, sf_dir) -> DataFrame.

Queries are registered with their DuckDB oracle SQL (``tidemark.plans.oracle``)
so every operator is checked against an independent engine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        return fn

    return deco


def queries() -> dict[str, Query]:
    # import for the side effect of registration
    from tidemark.plans import queries as _q  # noqa: F401

    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    from tidemark.plans.oracle import ORACLE_SQL

    return dict(ORACLE_SQL)
