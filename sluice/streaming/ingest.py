"""Endpoints as a stream: new pages to a table of raw pages."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from sluice.operators.paging import with_outcome
from sluice.session import configure


def stream_pages(spark: SparkSession, base_url: str, **options) -> DataFrame:
    """Streaming raw pages; takes the options of the batch source, `max_pages_per_trigger`,
    `max_gap`, and `state_path`, a folder that driver and tasks share and that belongs to one
    checkpoint (see `PageStreamReader`)."""
    reader = configure(spark).readStream.format("restpages").option("base_url", base_url)
    for name, value in options.items():
        reader = reader.option(name, value if isinstance(value, (str, int, float)) else json.dumps(value))
    return reader.load()


def stream_to_table(
    spark: SparkSession, base_url: str, path: str, checkpoint: str, **options
) -> None:
    """Appends the pages not read so far to the parquet table `path` and returns.

    A rerun with the same checkpoint reads the pages that have come since, also between
    those read, each page being written exactly once. With `max_pages_per_trigger` one run
    reads one step. Open pages are kept beside the checkpoint, in `CHECKPOINT-pages`.
    """
    options = {"state_path": f"{checkpoint.rstrip('/')}-pages"} | options
    pages = with_outcome(stream_pages(spark, base_url, **options))
    pages.writeStream.format("parquet").option("path", path).option(
        "checkpointLocation", checkpoint
    ).trigger(availableNow=True).start().awaitTermination()
