"""Where query modules put their queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str) -> Callable[[Query], Query]:
    """Registers a query with SQL that gives the same rows."""

    def add(function: Query) -> Query:
        QUERIES[name], SQL[name] = function, sql
        return function

    return add
