"""The ingestion job: catalogue, waves of requests, raw pages, records, typed tables, incidents.

Bodies are parsed once, when the pages are landed. Records, typed rows and incidents all come
from the landed table; the checks of a typed row are columns beside it, written in the same pass, and
counts are observed while tables are written. A run writes into a folder of its own and
is entered in the table of finished runs last, so that readers see either all of its tables or
those of the run before.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from sluice.functions import values as V
from sluice.operators.paging import failed_pages, good_pages, trim_pages
from sluice.operators.records import records_of
from sluice.operators.sinks import (
    conversion_problems,
    gathered,
    null_problems,
    page_incidents,
    record_incidents,
    write_records,
)
from sluice.plans.catalogue import read_catalogue
from sluice.session import configure
from sluice.sources.requests_table import endpoint_requests
from sluice.sources.waves import fetch_in_waves

RUNS = "run STRING, finished DOUBLE, paths STRING, counts STRING"
PROBLEMS = "_problems"


class IngestFailed(RuntimeError):
    """Pages or values could not be read; the incident rows tell which."""


def _check(catalogue: DataFrame, schemas: Mapping[str, T.StructType]) -> None:
    """Refuses catalogues that would fetch the wrong pages or mix them up.

    Pages are told apart by endpoint name, so a name may stand for one address only.
    """
    dates = [F.coalesce(F.trim(c), F.lit("")) == "" for c in ("start_date", "end_date")]
    undated = catalogue.where(F.coalesce("history_enabled", F.lit(False)) & (dates[0] | dates[1])).first()
    if undated:
        raise ValueError(f"history load of {undated['endpoint']!r} needs a start and an end date")
    unnamed = catalogue.where(F.col("endpoint").isNull()).first()
    if unnamed:
        raise ValueError(f"an endpoint of {unnamed['base_url']!r} has no endpoint-name")
    twice = catalogue.groupBy("endpoint").count().where("count > 1").first()
    if twice:
        raise ValueError(f"{twice['count']} configurations name the endpoint {twice['endpoint']!r}; ingest them in jobs of their own")
    for endpoint, schema in schemas.items():
        if catalogue.where(F.col("endpoint") == endpoint).isEmpty():
            raise ValueError(f"a schema is given for {endpoint!r}, which is no endpoint of the catalogue")
        taken = {PROBLEMS, "endpoint", "page", "pos"} & set(schema.names)
        if taken:
            raise ValueError(f"the schema of {endpoint!r} has columns of the job: {sorted(taken)}")


def typed_rows(records: DataFrame, schema: T.StructType) -> DataFrame:
    """endpoint, page, pos, the columns of `schema`, and a list of the row's problems: values that
    are present but do not convert (they become null), and nulls in columns declared without.

    Each member is looked up and converted once, for its column and its check alike.
    """
    keep = ("endpoint", "page", "pos")
    members = [V.flattened(F.col("value"), f.name).alias(f"_member{n}") for n, f in enumerate(schema.fields)]
    found = [F.col(f"_member{n}") for n in range(len(members))]
    converted = [F.col(f"_converted{n}") for n in range(len(members))]
    columns = [V.convert(m, f.dataType).alias(f"_converted{n}") for n, (m, f) in enumerate(zip(found, schema.fields))]
    lost = gathered(conversion_problems(found, schema, converted)).alias("_lost")
    named = [c.alias(f.name) for c, f in zip(converted, schema.fields)]
    rows = records.select(*keep, *members).select(*keep, *found, *columns).select(*keep, *named, lost)
    # A value that was there but did not convert is reported as that, and not as a null too.
    nulls = F.when(F.size("_lost") == 0, gathered(null_problems(schema))).otherwise(F.col("_lost"))
    return rows.select(*keep, *[f"`{n}`" for n in schema.names], nulls.alias(PROBLEMS))


def run_ingest(
    spark: SparkSession,
    catalogue: DataFrame | str,
    out: str,
    start_page: int = 1,
    max_pages: int = 1,
    on_error: str = "fail",
    tasks: int | None = None,
    schemas: Mapping[str, T.StructType] | None = None,
    **fetch_options,
) -> dict[str, str]:
    """Ingests all endpoints of a catalogue table, or of configuration documents.

    Writes into a new folder below `out`: `raw_pages` (parquet), `records` (JSON Lines by
    endpoint), `incidents` (parquet), and for each endpoint with a schema a typed table
    (parquet; `read_typed`). The folders are returned, and with the counts of their rows
    entered in the finished runs (`finished_runs`) when all is written. Endpoints are
    fetched as far as they go, up to `max_pages` (see `waves`).

    Pages that cannot be read, values that do not convert and nulls in columns declared
    without become incident rows; the rows themselves stay, with null there. With
    `on_error="fail"` the job raises when there are incidents, and the run does not count as finished; its
    tables stay for a look. History windows, endpoint names and schemas are checked before
    anything is fetched.
    """
    if on_error not in ("fail", "quarantine"):
        raise ValueError(f"on_error must be fail or quarantine, not {on_error!r}")
    configure(spark)
    schemas = dict(schemas or {})
    if isinstance(catalogue, str):
        catalogue = read_catalogue(spark, catalogue)
    _check(catalogue, schemas)
    run = f"{int(time.time())}-{uuid.uuid4().hex[:12]}"
    paths = {name: f"{out}/runs/{run}/{name}" for name in ("raw_pages", "records", "incidents", "typed")}
    tasks = tasks or spark.sparkContext.defaultParallelism * 4
    landed = fetch_in_waves(endpoint_requests(catalogue), paths["raw_pages"], tasks, start_page, max_pages, **fetch_options)
    pages = trim_pages(landed)
    counts = {}

    def counted(df: DataFrame, name: str) -> DataFrame:
        counts[name] = Observation()
        return df.observe(counts[name], F.count(F.lit(1)).alias("rows"))

    # Landed pages lie clustered by endpoint, as they were requested.
    records = records_of(good_pages(pages))
    write_records(counted(records, "records"), paths["records"], gather=False)
    incidents = [page_incidents(failed_pages(pages))]
    for n, (endpoint, schema) in enumerate(schemas.items()):
        folder = typed_folder(paths, n)
        own = records_of(good_pages(pages.where(F.col("endpoint") == endpoint)))
        counted(typed_rows(own, schema), f"typed {endpoint}").write.parquet(folder)
        incidents.append(record_incidents(spark.read.parquet(folder).where(F.size(PROBLEMS) > 0), F.col(PROBLEMS)))
    counted(reduce(DataFrame.unionByName, incidents), "incidents").write.parquet(paths["incidents"])
    found = {name: observed.get["rows"] for name, observed in counts.items()}
    if found["incidents"] and on_error == "fail":
        raise IngestFailed(f"{found['incidents']} pages or values could not be read, see {paths['incidents']}")
    paths["schemas"] = json.dumps({e: typed_folder(paths, n) for n, e in enumerate(schemas)})
    entry = spark.createDataFrame([(run, time.time(), json.dumps(paths), json.dumps(found))], RUNS)
    entry.coalesce(1).write.mode("append").json(f"{out}/finished")
    return paths


def typed_folder(paths: Mapping[str, str], n: int) -> str:
    return f"{paths['typed']}/{n}"


def finished_runs(spark: SparkSession, out: str) -> DataFrame:
    """run, finished (seconds since 1970), paths and counts (JSON) of all finished runs."""
    return spark.read.schema(RUNS).json(f"{out}/finished")


def last_run(spark: SparkSession, out: str) -> dict[str, str]:
    """The folders of the run that finished last."""
    row = finished_runs(spark, out).orderBy(F.desc("finished"), F.desc("run")).first()
    if row is None:
        raise ValueError(f"no finished run below {out}")
    return json.loads(row["paths"])


def read_typed(spark: SparkSession, paths: Mapping[str, str], endpoint: str) -> DataFrame:
    """The typed rows of an endpoint, without the job's own columns."""
    return spark.read.parquet(json.loads(paths["schemas"])[endpoint]).drop("endpoint", "page", "pos", PROBLEMS)
