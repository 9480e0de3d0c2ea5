"""Pages: how they are spread over partitions and where an endpoint ends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sluice.operators.records import with_items


def succeeded() -> Column:
    return F.coalesce(F.col("status").between(200, 299), F.lit(False))


def plan_partitions(
    endpoints: DataFrame, n_pages: str, concurrency: int, start_page: int = 1
) -> DataFrame:
    """Consecutive inclusive page ranges, `part`, `start_page`, `end_page` per row.

    A range has max(1, n // concurrency) pages, so a row becomes fewer than
    2 * concurrency ranges however many pages it has.
    """
    if concurrency < 1:
        raise ValueError("concurrency must be at least 1")
    n = F.col(n_pages)
    chunk = F.greatest(F.lit(1), F.floor(n / concurrency)).cast("bigint")
    last = F.lit(start_page) + n - 1
    parts = F.when(n > 0, F.sequence(F.lit(0).cast("bigint"), F.ceil(n / F.col("_chunk")).cast("bigint") - 1))
    first = F.lit(start_page) + F.col("part") * F.col("_chunk")
    return (
        endpoints.withColumn("_chunk", chunk)
        .withColumn("part", F.explode(parts))
        .withColumn("start_page", first.cast("bigint"))
        .withColumn("end_page", F.least(first + F.col("_chunk") - 1, last).cast("bigint"))
        .drop("_chunk")
    )


def with_outcome(pages: DataFrame, keep_items: bool = False) -> DataFrame:
    """Adds `n_items INT` for readable pages and completes `error` for unreadable ones.

    With `keep_items` their records stay too, as `items ARRAY<VARIANT>`: once written, they
    need not be parsed again (`records.records_of`).
    """
    read = with_items(pages)
    good = succeeded() & F.col("error").isNull() & F.col("problem").isNull()
    return read.select(
        *[c for c in pages.columns if c != "error"],
        F.coalesce("error", F.when(succeeded(), F.coalesce("problem", _no_body()))).alias("error"),
        F.when(good, F.size("items")).alias("n_items"),
        *([F.when(good, F.col("items")).alias("items")] if keep_items else []),
    )


def _no_body() -> Column:
    return F.when(F.col("body").isNull(), F.lit("empty response"))


def endpoint_stops(pages: DataFrame) -> DataFrame:
    """`endpoint`, `stop_page`: the first page that is empty or answers 404.

    The minimum is taken per task first, so an endpoint with most of the pages
    costs one row per task.
    """
    stops = (F.col("status") == 404) | (succeeded() & (F.col("n_items") == 0))
    return pages.where(stops).groupBy("endpoint").agg(F.min("page").alias("stop_page"))


def trim_pages(pages: DataFrame) -> DataFrame:
    """Pages before their endpoint's first empty or missing page.

    Reads `pages` twice, the first time only its narrow columns, so it wants a
    written table. Adaptive execution broadcasts the stops where their size allows it
    and otherwise splits endpoints with most of the pages.
    """
    stops = endpoint_stops(pages)
    return (
        pages.join(stops, "endpoint", "left")
        .where(F.col("stop_page").isNull() | (F.col("page") < F.col("stop_page")))
        .drop("stop_page")
    )


def failed_pages(trimmed: DataFrame) -> DataFrame:
    """Pages that should have been read but were not: other statuses, errors."""
    return trimmed.where(F.col("error").isNotNull() | ~succeeded())


def good_pages(trimmed: DataFrame) -> DataFrame:
    return trimmed.where(F.col("error").isNull() & succeeded())
