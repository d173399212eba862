"""Collects queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
#: Queries whose rows come in an order: the SQL of that order over their columns, and the
#: columns it decides.
ORDERS: dict[str, tuple[str, tuple[str, ...]]] = {}


def check(name: str, sql: str | None = None, order: tuple[str, tuple[str, ...]] | None = None) -> Callable[[Query], Query]:
    """Register a query, with its SQL where SQL can say it, and its order if it has one."""

    def add(query: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"registered twice: {name}")
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        if order is not None:
            ORDERS[name] = order
        return query

    return add
