"""Where the plan modules record their queries."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from strandwise.adapters import for_duckdb, view

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(v)``; ``v(view_name)`` loads an adapter view as a DataFrame."""

    def register(fn: Callable):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(lambda v: view(spark, sf_dir, v))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = for_duckdb(sql.strip())
        return fn

    return register
