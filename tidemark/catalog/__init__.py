"""Registered queries: name -> (Spark function, oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import tune

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query that takes an ``Inputs`` and returns a DataFrame."""
    from tidemark.catalog.base import Inputs

    def register(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Inputs(tune(spark), sf_dir))

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def load() -> None:
    """Import every module that registers queries."""
    from tidemark.catalog import (  # noqa: F401
        ingest_queries, lake_queries, mart_queries, metric_queries, quality_queries, state_queries,
    )
