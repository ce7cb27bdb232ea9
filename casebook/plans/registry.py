"""The catalogue: each query next to the SQL that gives the same answer."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} exists")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add
