"""Reading endpoints as DataFrames: raw pages, records, typed rows."""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from numbers import Real

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from sluice.operators import filters
from sluice.operators.infer import first_record, infer_schema
from sluice.operators.paging import failed_pages, with_outcome
from sluice.operators.records import project_values, records_at
from sluice.operators.sinks import page_incidents
from sluice.session import configure, shared_folder


def read_pages(
    spark: SparkSession, base_url: str, where: Sequence[tuple] = (), **options
) -> DataFrame:
    """Raw pages through the `restpages` source; lists and dicts are passed as JSON.

    `where` takes filter triples. Those on `endpoint` (=, in) and `page` (=, >,
    >=, <, <=) narrow what is requested, all of them are applied to the rows.
    """
    reader = configure(spark).read.format("restpages").option("base_url", base_url)
    for name, value in _narrowed(options, where).items():
        reader = reader.option(name, value if isinstance(value, (str, int, float)) else json.dumps(value))
    return filters.where(reader.load(), where)


def _narrowed(options: dict, where: Sequence[tuple]) -> dict:
    endpoints = options.pop("endpoints", None) or [options.pop("endpoint", "")]
    first = int(options.get("start_page", 1))
    stop = first + int(options.get("max_pages", 1))
    for column, op, wanted in where:
        if column == "endpoint" and op in ("=", "in"):
            names = wanted if op == "in" else [wanted]
            endpoints = [e for e in endpoints if e in names]
        elif column == "page" and op in ("=", ">", ">=", "<", "<=") and isinstance(wanted, Real) and math.isfinite(wanted):
            if op in ("=", ">", ">="):
                first = max(first, math.floor(wanted) + 1 if op == ">" else math.ceil(wanted))
            if op in ("=", "<", "<="):
                stop = min(stop, math.ceil(wanted) if op == "<" else math.floor(wanted) + 1)
    if not endpoints:
        endpoints, stop = [""], first
    return options | {"endpoints": endpoints, "start_page": first, "max_pages": max(0, stop - first)}


def land(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Raw pages with `error` and `n_items`, written once and read back.

    A written table instead of a cache: requests are not repeated when an
    executor is lost, and later steps read only the columns they need.
    """
    spark = pages.sparkSession
    path = path or shared_folder(spark, "raw_pages")
    with_outcome(pages).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def read_table(
    spark: SparkSession,
    base_url: str,
    endpoint: str = "",
    schema: T.StructType | None = None,
    json_path: str | None = None,
    infer_types: bool = False,
    from_first_record: bool = False,
    scalar_page: str = "skip",
    **options,
) -> DataFrame:
    """Typed rows of one endpoint, flattened.

    A given schema wins. Otherwise the pages are landed once and the schema is
    taken from all records, or from the first one of the first page as asked;
    every column is STRING unless `infer_types`. A page that cannot be read fails
    the query.
    """
    pages = read_pages(spark, base_url, endpoint=endpoint, **options)
    if schema is None:
        landed = land(pages)
        failed = page_incidents(failed_pages(landed)).first()
        if failed:
            raise RuntimeError(failed["description"])
        records = records_at(landed, json_path, keep=("endpoint", "page"), scalar_page=scalar_page)
        sample = records
        if from_first_record:
            page = landed.orderBy("page").limit(1)
            sample = first_record(records_at(page, json_path, keep=("endpoint", "page"), scalar_page=scalar_page))
        schema = infer_schema(sample, infer_types=infer_types)
    else:
        records = records_at(pages, json_path, keep=("endpoint", "page"), scalar_page=scalar_page)
    return project_values(records, schema)
