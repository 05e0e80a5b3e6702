"""Registered queries: each operator on the star-schema tables, with its SQL equivalent."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can express it, the statement it must equal."""
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load() -> tuple[dict[str, Query], dict[str, str]]:
    """Import every family of queries and return both registries."""
    from panelspark.catalog import boosted, chain, columns, forecasting, learning, relations, statistics, storage, streams  # noqa: F401
    return QUERIES, ORACLES
