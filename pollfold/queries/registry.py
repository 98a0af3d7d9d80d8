"""The two dictionaries that queries register in."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFunction = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFunction] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[QueryFunction], QueryFunction]:
    """Register a function as query, with the SQL for the same result if SQL can say it."""

    def add(function: QueryFunction) -> QueryFunction:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add
