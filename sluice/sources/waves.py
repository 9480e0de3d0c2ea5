"""Fetching endpoints in waves: as far as each goes, and failed pages again when they may be.

A frontier table holds one row per endpoint: the next page to ask for, and the bound that its
first empty or missing page sets. Each wave asks every open endpoint for as many pages as all waves
before it did, so that the pages asked for are at most twice those that exist (and one page of
an endpoint without any), however large `max_pages` is. A page that may be tried again goes to a
table of retries with the earliest time for it, and joins the first wave after that time;
tasks never sleep for it. Every wave's pages are written before the next is planned.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, Observation, functions as F

from sluice.operators.paging import endpoint_stops, with_outcome
from sluice.session import shared_folder
from sluice.sources.options import BACKOFF_SECONDS, RETRIES
from sluice.sources.requests_table import fetch_pages, with_pages

# Longest sleep between looks at the retries, in seconds.
_LOOK = 1.0


def _written(df: DataFrame, name: str) -> DataFrame:
    folder = shared_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def fetch_in_waves(
    endpoints: DataFrame,
    path: str,
    tasks: int,
    start_page: int = 1,
    max_pages: int = 1,
    retries: int = RETRIES,
    backoff: float = BACKOFF_SECONDS,
    **fetch_options,
) -> DataFrame:
    """Landed raw pages (see `readers.land`) of `endpoints`, rows of `endpoint_requests` with
    distinct names, written with their records below the new folder `path`, as `wave=N`.

    Pages behind an endpoint's end may be among them (`paging.trim_pages`). A page that still fails
    after `retries` further tries is there once, with its last answer.
    """
    spark = endpoints.sparkSession
    plan = _written(endpoints, "endpoints")
    start = F.lit(start_page)
    frontier = plan.select("endpoint", start.alias("next"), F.lit(start_page + max_pages).alias("bound"))
    reach = F.least(F.col("next") + F.greatest(F.col("next") - start, F.lit(1)), "bound")
    waiting = None
    wave = 0
    while True:
        size = frontier.agg(F.sum(F.greatest(reach - F.col("next"), F.lit(0)))).first()[0] or 0
        asks = with_pages(frontier, F.col("next"), reach).select("endpoint", "page", F.lit(0).alias("attempt"))
        if waiting is not None:
            now = time.time()
            ready = waiting.where(F.col("not_before") <= now)
            due, first = waiting.agg(F.count_if(F.col("not_before") <= now), F.min("not_before")).first()
            if not size and not due and first is not None:
                time.sleep(min(first - now, _LOOK))
                continue
            size += due
            asks = asks.union(ready.select("endpoint", "page", "attempt"))
        if not size:
            break
        answers = fetch_pages(asks.join(plan, "endpoint"), min(tasks, size), retries=retries, backoff=backoff, **fetch_options)
        seen = Observation()
        folder = f"{path}/wave={wave}"
        with_outcome(answers, keep_items=True).observe(seen, F.count("not_before").alias("again")).write.parquet(folder)
        found = spark.read.parquet(folder)
        stops = endpoint_stops(found.where(F.col("not_before").isNull()))
        frontier = _written(
            frontier.join(stops, "endpoint", "left").select(
                "endpoint", reach.alias("next"), F.least("bound", "stop_page").alias("bound")
            ),
            "frontier",
        )
        again = found.where(F.col("not_before").isNotNull()).select(
            "endpoint", "page", (F.col("attempt") + 1).alias("attempt"), "not_before"
        )
        if waiting is not None:
            again = waiting.where(F.col("not_before") > now).union(again)
        if waiting is not None or seen.get["again"]:
            # What lies behind an end found meanwhile is not asked for again.
            bounds = frontier.select("endpoint", "bound")
            waiting = _written(again.join(bounds, "endpoint").where("page < bound").drop("bound"), "retries")
        wave += 1
    if not wave:
        none = plan.limit(0).withColumns({"page": F.lit(1), "attempt": F.lit(0)})
        return _final(with_outcome(fetch_pages(none, 1), keep_items=True))
    return _final(spark.read.parquet(path).drop("wave"))


def _final(pages: DataFrame) -> DataFrame:
    return pages.where(F.col("not_before").isNull()).drop("attempt", "not_before")
