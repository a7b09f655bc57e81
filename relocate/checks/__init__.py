"""Registered queries and, where SQL can say the same, the SQL to compare them with."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

GROUPS = ("catalogs", "rows", "metrics", "staging", "ledgers", "texts", "streams", "partitions", "upkeep", "watches", "waves")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with its SQL for the same tables."""

    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def load_all() -> None:
    for group in GROUPS:
        import_module(f"relocate.checks.{group}")
