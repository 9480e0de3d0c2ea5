"""A catalogue of endpoints to requests, and requests to raw pages, as table work."""

from __future__ import annotations

import os
import time
from collections import deque
from collections.abc import Callable, Iterator

from pyspark import BarrierTaskContext, TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from sluice.sources.fetch import Fetcher
from sluice.sources.options import BACKOFF_SECONDS, RETRIES, TIMEOUT_SECONDS, Request
from sluice.sources.pacing import paced
from sluice.sources.pages import ATTEMPTS, RAW_PAGES, in_batches


def url_of(base: Column, endpoint: Column) -> Column:
    """Base and endpoint with exactly one slash between them."""
    base = F.rtrim(base, F.lit("/"))
    endpoint = F.trim(F.coalesce(endpoint, F.lit("")), F.lit("/"))
    return F.when(endpoint == "", base).otherwise(F.concat(base, F.lit("/"), endpoint))


def request_params(params: Column, enabled: Column, start: Column, end: Column) -> Column:
    """Query parameters; an enabled history window sets `start` and `end`."""
    params = F.coalesce(params, F.create_map().cast("map<string,string>"))
    others = F.map_filter(params, lambda k, _: ~k.isin("start", "end"))
    window = F.create_map(F.lit("start"), start, F.lit("end"), end)
    return F.when(F.coalesce(enabled, F.lit(False)), F.map_concat(others, window)).otherwise(params)


def endpoint_requests(catalogue: DataFrame) -> DataFrame:
    """How to ask each endpoint of a catalogue (see `plans.catalogue`) for its pages."""
    return catalogue.select(
        "endpoint",
        url_of(F.col("base_url"), F.col("endpoint")).alias("url"),
        request_params(
            F.col("params"), F.col("history_enabled"), F.col("start_date"), F.col("end_date")
        ).alias("params"),
        "headers",
        "auth_username",
        "auth_password_env",
    )


# Pages that one row is unfolded into at a time.
_UNFOLDED = 10_000


def with_pages(df: DataFrame, first: Column, stop: Column) -> DataFrame:
    """Each row once for every page from `first` up to `stop`, in two steps, so that no row
    carries a list of all its pages."""
    some = F.explode(F.expr(f"IF(_first < _stop, sequence(_first, _stop - 1, {_UNFOLDED}), array())"))
    page = F.explode(F.expr(f"sequence(_some, least(_some + {_UNFOLDED}, _stop) - 1)"))
    spread = df.withColumns({"_first": first.cast("int"), "_stop": stop.cast("int")}).withColumn("_some", some)
    return spread.withColumn("page", page).drop("_first", "_stop", "_some")


def plan_requests(catalogue: DataFrame, start_page: int = 1, max_pages: int = 1) -> DataFrame:
    """One row per endpoint and page of a catalogue."""
    found = with_pages(endpoint_requests(catalogue), F.lit(start_page), F.lit(start_page + max_pages))
    return found.select("endpoint", "page", *[c for c in found.columns if c not in ("endpoint", "page")])


def fetch_pages(
    requests: DataFrame,
    tasks: int,
    page_param: str = "page",
    timeout: float = TIMEOUT_SECONDS,
    retries: int = RETRIES,
    backoff: float = BACKOFF_SECONDS,
    rate_per_sec: float = 0.0,
    rate_capacity: float | None = None,
    new_session: Callable | None = None,
) -> DataFrame:
    """Raw pages of `requests`, fetched by `tasks` tasks.

    Requests are ranged by endpoint and page: an endpoint with most of the pages
    is spread over most tasks, and yet each task's pages belong to few endpoints,
    so that writing them by endpoint needs no shuffle of the bodies. Each
    evaluation asks again: write the result before using it more than once.

    Requests with a column `attempt` are tried once; the answers then are `ATTEMPTS`, with
    the time from which on another try makes sense (null: none, or no retry is left).

    A rate is held by a barrier stage, in which tasks with work share it (see `pacing`); it
    has at most as many tasks as can run at once. Spark runs no barrier stages with dynamic
    allocation: there each task gets an equal part of the rate.
    """
    single = "attempt" in requests.columns
    conf = requests.sparkSession.sparkContext.getConf()
    barrier = rate_per_sec > 0 and conf.get("spark.dynamicAllocation.enabled", "false").lower() != "true"
    if barrier:
        tasks = min(tasks, requests.sparkSession.sparkContext.defaultParallelism)
    capacity = rate_capacity or rate_per_sec or 1.0

    def fetch(batches: Iterator) -> Iterator:
        index = TaskContext.get().partitionId()
        fetcher = Fetcher(0.0 if barrier else rate_per_sec, capacity, index, tasks, new_session)
        asked = (row for batch in batches for row in batch.to_pylist())
        work: deque = deque(asked) if barrier else deque()
        turns = paced(work, rate_per_sec, capacity, BarrierTaskContext.get()) if barrier else asked

        def answers():
            for row in turns:
                tried = row.get("attempt") or 0
                request = _request(row)
                if barrier or single:
                    answer, wait = fetcher.ask(request, row["page"], tried)
                else:
                    answer, wait = fetcher.page(request, row["page"]), None
                if wait is not None and tried >= retries:
                    wait = None
                if wait is not None and not single:
                    # Another try takes its turn after what is left.
                    work.append(row | {"attempt": tried + 1})
                    continue
                later = (tried, None if wait is None else time.time() + wait) if single else ()
                yield (row["endpoint"], row["page"], *answer, *later)

        return in_batches(answers())

    def _request(row: dict) -> Request:
        variable = row["auth_password_env"]
        user = row["auth_username"]
        if user and not variable:
            raise ValueError(f"user {user!r} of {row['url']} has no password-env, the environment variable of its password")
        if user and variable not in os.environ:
            raise ValueError(f"environment variable {variable} is not set")
        return Request(
            url=row["url"],
            page_param=page_param,
            params=dict(row["params"] or {}),
            headers=dict(row["headers"] or {}),
            auth=(user, os.environ[variable]) if user else None,
            timeout=timeout,
            retries=retries,
            backoff=backoff,
        )

    ranged = requests.repartitionByRange(tasks, "endpoint", "page")
    return ranged.mapInArrow(fetch, ATTEMPTS if single else RAW_PAGES, barrier=barrier)
