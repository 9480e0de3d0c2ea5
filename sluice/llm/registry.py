"""The queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a query, with SQL that gives the same rows where SQL can."""

    def add(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return add


# Bytes of rows handed to a Python worker at once, where the session does not say. Spark's own
# 64 MB are held several times over, by executor and worker, for every running task.
BATCH_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", "4m")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if spark.conf.get(BATCH_BYTES[0], None) is None:
        spark.conf.set(*BATCH_BYTES)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
