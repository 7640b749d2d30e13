"""Named queries and, beside each, the SQL another engine can check it with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tideline.plans.feeds import Lake

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Register ``fn(lake)`` under ``name`` with its checking SQL."""

    def register(fn: Callable[[Lake], DataFrame]) -> Callable[[Lake], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = lambda spark, folder: fn(Lake(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
