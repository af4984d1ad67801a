"""Registry of named queries and their DuckDB oracle SQL.

A query is ``fn(spark, sf_dir) -> DataFrame``. Its oracle, when the result can be
stated in SQL, is a DuckDB statement over the raw views; ``None`` marks a query
checked by rows and invariants only (model fits, iterative algorithms).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}
HEADLINE: list[str] = []


def register(name: str, sql: str | None = None, headline: bool = False):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        if headline:
            HEADLINE.append(name)
        return fn

    return deco


def load_all() -> None:
    """Import every query module so the registry is complete."""
    from marquee.plans import (  # noqa: F401
        eval_queries,
        feature_queries,
        model_queries,
        relational_queries,
        stream_queries,
        user_queries,
        vector_queries,
    )
