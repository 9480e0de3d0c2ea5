"""Given tables, and payloads made from their rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sluice.session import configure, shared_folder

# Records in a staged page: about `TARGET_PAGES` pages, within these bounds.
TARGET_PAGES = 10_000
SMALLEST_PAGE, LARGEST_PAGE = 1_000, 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def as_json(*columns: Column | str) -> Column:
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def json_list(*texts: Column) -> Column:
    return F.concat(F.lit("["), F.concat_ws(",", *texts), F.lit("]"))


def json_string(text: Column) -> Column:
    """The text as a quoted JSON string."""
    return F.to_json(text.cast("variant"))


def pick(key: Column, choices: list[str]) -> Column:
    """The choice with number `key` modulo their count."""
    return F.element_at(F.array(*[F.lit(c) for c in choices]), F.pmod(key, F.lit(len(choices))).cast("int") + 1)


def stage_pages(records: DataFrame, base_url: str, endpoint: str) -> int:
    """Writes a table as the numbered pages of a file endpoint; returns their count.

    Stands in for a remote API. Rows are dealt to pages by a hash of their
    position, so a page is as small as any other whatever values repeat.
    """
    n = records.count()
    size = min(max(n // TARGET_PAGES, SMALLEST_PAGE), LARGEST_PAGE)
    pages = max(1, math.ceil(n / size))
    page = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(pages)) + 1
    (
        records.select(page.cast("int").alias("page"), F.struct("*").alias("record"))
        .groupBy("page")
        .agg(F.collect_list("record").alias("data"))
        .select("page", as_json("data").alias("body"))
        .write.partitionBy("page")
        .text(f"{base_url}/{endpoint}")
    )
    return pages


def new_base(spark: SparkSession, name: str) -> str:
    return shared_folder(configure(spark), name)


def scan_options(spark: SparkSession, pages: int) -> dict[str, int]:
    """All `pages`, in about two ranges per core."""
    return {"max_pages": pages, "concurrency": spark.sparkContext.defaultParallelism * 2}
