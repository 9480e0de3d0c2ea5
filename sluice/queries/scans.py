"""Queries through the sources: paged scans, filters, pruning, streams, the job."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, functions as F, types as T

from sluice.operators import filters, records as R
from sluice.operators.paging import (
    failed_pages,
    good_pages,
    plan_partitions,
    trim_pages,
)
from sluice.operators.sinks import page_incidents, read_records, write_json, write_records
from sluice.plans.catalogue import catalogue_rows, history_violations, in_history_window
from sluice.plans.job import read_typed, run_ingest
from sluice.queries.registry import query
from sluice.queries.tables import as_json, new_base, scan_options, stage_pages, table
from sluice.sources.readers import land, read_pages, read_table
from sluice.sources.requests_table import plan_requests

ORDER_FIELDS = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderdate", T.TimestampType()),
        T.StructField("o_orderpriority", T.StringType()),
    ]
)
ORDER_COLUMNS = ", ".join(ORDER_FIELDS.names)


def _scan(spark, sf_dir, schema: T.StructType = ORDER_FIELDS) -> DataFrame:
    """Orders staged as the pages of an endpoint, beside another endpoint, and read back."""
    base = new_base(spark, "scan")
    n = stage_pages(table(spark, sf_dir, "orders"), base, "orders")
    stage_pages(table(spark, sf_dir, "nation"), base, "nation")
    pages = read_pages(
        spark,
        base,
        where=[("endpoint", "=", "orders"), ("page", "<=", n)],
        endpoints=["orders", "nation"],
        **scan_options(spark, n + 1),
    )
    return R.project_values(R.records_at(pages, "data"), schema)


def _without_zone(df: DataFrame) -> DataFrame:
    return df.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))


@query("paged_scan", f"SELECT {ORDER_COLUMNS} FROM orders")
def paged_scan(spark, sf_dir):
    return _without_zone(_scan(spark, sf_dir))


@query("filter_eq", f"SELECT {ORDER_COLUMNS} FROM orders WHERE o_orderstatus = 'F'")
def filter_eq(spark, sf_dir):
    return _without_zone(filters.where(_scan(spark, sf_dir), [("o_orderstatus", "=", "F")]))


@query("filter_in", f"SELECT {ORDER_COLUMNS} FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def filter_in(spark, sf_dir):
    wanted = [("o_orderpriority", "in", ["1-URGENT", "2-HIGH"])]
    return _without_zone(filters.where(_scan(spark, sf_dir), wanted))


@query(
    "filter_conj",
    f"""SELECT {ORDER_COLUMNS} FROM orders
        WHERE o_orderstatus = 'O' AND o_orderpriority IN ('3-MEDIUM', '5-LOW') AND o_custkey IN (7, 77, 770)""",
)
def filter_conj(spark, sf_dir):
    wanted = [
        ("o_orderstatus", "=", "O"),
        ("o_orderpriority", "in", ["3-MEDIUM", "5-LOW"]),
        ("o_custkey", "in", [7, 77, 770]),
    ]
    return _without_zone(filters.where(_scan(spark, sf_dir), wanted))


@query(
    "filter_residual",
    f"SELECT {ORDER_COLUMNS} FROM orders WHERE o_totalprice > 100000.5 AND o_orderstatus = 'P'",
)
def filter_residual(spark, sf_dir):
    wanted = [("o_totalprice", ">", 100000.5), ("o_orderstatus", "=", "P")]
    return _without_zone(filters.where(_scan(spark, sf_dir), wanted))


@query(
    "filter_nested",
    """SELECT event_id FROM events WHERE event_type = 'click' AND json_extract(props, '$.k')::BIGINT IN (1, 2, 3)""",
)
def filter_nested(spark, sf_dir):
    body = F.concat(F.lit('{"e":{"type":"'), "event_type", F.lit('","props":'), "props", F.lit("}}"))
    records = R.decode(table(spark, sf_dir, "events").select("event_id", body.alias("body")), "body")
    wanted = [("e.type", "=", "click"), ("e.props.k", "in", [1, 2, 3])]
    return filters.where_value(records, wanted).select("event_id")


@query("column_pruning", "SELECT o_orderkey, o_orderpriority FROM orders")
def column_pruning(spark, sf_dir):
    return _scan(spark, sf_dir).select("o_orderkey", "o_orderpriority")


@query("pushed_filters", "SELECT 'customer' AS endpoint, c_custkey, c_name FROM customer")
def pushed_filters(spark, sf_dir):
    base = new_base(spark, "pushed")
    n = stage_pages(table(spark, sf_dir, "customer"), base, "customer")
    stage_pages(table(spark, sf_dir, "supplier"), base, "supplier")
    pages = read_pages(
        spark, base, endpoints=["customer", "supplier"], filter_pushdown="true", **scan_options(spark, n + 1)
    )
    # Both filters are taken by the source: neither the other endpoint nor a page n + 1 is read.
    pages = pages.where((F.col("endpoint") == "customer") & (F.col("page") <= n))
    fields = T.StructType().add("c_custkey", T.LongType()).add("c_name", T.StringType())
    return R.project_values(R.records_at(pages, "data", keep=("endpoint",)), fields, keep=("endpoint",))


@query(
    "inferred_table",
    """SELECT c_acctbal, c_custkey, c_mktsegment, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey FROM customer""",
)
def inferred_table(spark, sf_dir):
    base = new_base(spark, "inferred")
    n = stage_pages(table(spark, sf_dir, "customer"), base, "customer")
    return read_table(
        spark, base, "customer", json_path="data", infer_types=True, **scan_options(spark, n)
    )


@query(
    "partition_plan",
    """WITH e AS (SELECT o_custkey, count(*) AS n_pages, greatest(1, count(*) // 4) AS chunk FROM orders GROUP BY 1),
       p AS (SELECT *, unnest(range(0, (n_pages + chunk - 1) // chunk)) AS part FROM e)
       SELECT o_custkey, n_pages, part, part * chunk + 1 AS start_page,
         least(part * chunk + chunk, n_pages) AS end_page FROM p""",
)
def partition_plan(spark, sf_dir):
    endpoints = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n_pages"))
    return plan_partitions(endpoints, "n_pages", concurrency=4)


@query(
    "history_window",
    """SELECT o_orderkey, o_orderdate FROM orders
       WHERE o_orderdate >= DATE '1996-01-01' AND o_orderdate < DATE '1997-01-01'""",
)
def history_window(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.where(in_history_window(F.col("o_orderdate"), "1996-01-01", "1996-12-31")).select(
        "o_orderkey", "o_orderdate"
    )


def _fetched(spark, sf_dir) -> DataFrame:
    """One raw page per order, numbered within its customer's endpoint by order key."""
    key = F.col("o_orderkey")
    body = (
        F.when(key % 23 == 0, F.lit('{"data":[]}'))
        .when(key % 19 == 0, F.lit('{"data":[{"o_orderkey":'))
        .otherwise(F.concat(F.lit('{"data":['), as_json("o_orderkey"), F.lit("]}")))
    )
    status = F.when(key % 29 == 0, 404).when(key % 17 == 0, 500).when(key % 13 != 0, 200)
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("customer/"), "o_custkey").alias("endpoint"),
        key.alias("page"),
        status.alias("status"),
        F.when(status == 200, body).alias("body"),
        F.when(status.isNull(), F.lit("ReadTimeout: no answer")).alias("error"),
    )


FETCHED_SQL = """WITH p AS (
         SELECT o_custkey, o_orderkey, CASE WHEN o_orderkey % 29 = 0 THEN 404 WHEN o_orderkey % 17 = 0 THEN 500
                  WHEN o_orderkey % 13 <> 0 THEN 200 END AS status FROM orders),
       s AS (SELECT o_custkey, min(o_orderkey) AS stop_page FROM p
             WHERE status = 404 OR (status = 200 AND o_orderkey % 23 = 0) GROUP BY 1),
       t AS (SELECT p.* FROM p LEFT JOIN s USING (o_custkey) WHERE stop_page IS NULL OR o_orderkey < stop_page)"""


@query(
    "page_termination",
    FETCHED_SQL + " SELECT 'customer/' || o_custkey AS endpoint, o_orderkey AS page, status FROM t",
)
def page_termination(spark, sf_dir):
    return trim_pages(land(_fetched(spark, sf_dir))).select("endpoint", "page", "status")


@query(
    "incidents",
    FETCHED_SQL
    + """ SELECT 'customer/' || o_custkey AS endpoint, o_orderkey AS page, status,
            'API Ingestion Job Failed' AS short_description,
            'customer/' || o_custkey || ' page ' || o_orderkey || ': ' || CASE WHEN status IS NULL
              THEN 'ReadTimeout: no answer' WHEN status = 200 THEN 'invalid JSON' ELSE 'HTTP ' || status END AS description
          FROM t WHERE status IS NULL OR status <> 200 OR o_orderkey % 19 = 0""",
)
def incidents(spark, sf_dir):
    return page_incidents(failed_pages(trim_pages(land(_fetched(spark, sf_dir)))))


@query(
    "union_endpoints",
    """SELECT 'customer' AS endpoint, c_custkey, c_name, NULL::BIGINT AS o_orderkey, NULL::VARCHAR AS o_orderstatus
       FROM customer UNION ALL
       SELECT 'orders', NULL, NULL, o_orderkey, o_orderstatus FROM orders""",
)
def union_endpoints(spark, sf_dir):
    base = new_base(spark, "union")
    frames = []
    for name, schema in (
        ("customer", "c_custkey BIGINT, c_name STRING"),
        ("orders", "o_orderkey BIGINT, o_orderstatus STRING"),
    ):
        fields = T.StructType.fromDDL(schema)
        n = stage_pages(table(spark, sf_dir, name).select(*fields.names), base, name)
        pages = read_pages(spark, base, endpoint=name, **scan_options(spark, n))
        frames.append(R.project_values(R.unwrap(pages), fields, keep=("endpoint",)))
    return R.append_endpoints(*frames)


@query(
    "ingest_job",
    """SELECT 'customer' AS endpoint, to_json({'c_custkey': c_custkey, 'c_name': c_name})::VARCHAR AS record FROM customer
       UNION ALL SELECT 'orders', to_json({'o_custkey': o_custkey, 'o_orderkey': o_orderkey})::VARCHAR FROM orders""",
)
def ingest_job(spark, sf_dir):
    base = new_base(spark, "job")
    pages = max(
        stage_pages(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), base, "customer"),
        stage_pages(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey"), base, "orders"),
    )
    document = {
        "ingest-souce-config": {
            "app-name": "shop",
            "base-url": base,
            "history-load": {"enabled": False},
            "endpoints": [{"endpoint-name": "customer"}, {"endpoint-name": "orders"}],
        }
    }
    documents = spark.createDataFrame([(json.dumps(document),)], "value STRING")
    # How far an endpoint goes is found out by the job.
    paths = run_ingest(spark, catalogue_rows(documents, "value"), new_base(spark, "out"), max_pages=1000 * pages)
    return read_records(spark, paths["records"])


def _typed_job(spark, sf_dir) -> dict[str, str]:
    """Customers and orders as one endpoint each, some values of which are wrong."""
    base = new_base(spark, "typed")
    key = F.col("o_orderkey")
    price = F.when(key % 11 == 0, F.lit("n/a")).when(key % 7 != 0, F.col("o_totalprice").cast("string"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", price.alias("o_totalprice"), F.struct("o_custkey", "o_orderstatus").alias("o"))
    stage_pages(table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_name"), base, "customer")
    stage_pages(orders, base, "orders")
    document = {
        "ingest-souce-config": {
            "app-name": "shop",
            "base-url": base,
            "endpoints": [{"endpoint-name": "customer"}, {"endpoint-name": "orders"}, {"endpoint-name": "nothing"}],
        }
    }
    documents = spark.createDataFrame([(json.dumps(document),)], "value STRING")
    order = T.StructType().add("o_orderkey", T.LongType(), False).add("o_totalprice", T.DoubleType(), False)
    schemas = {
        "customer": T.StructType().add("c_custkey", T.LongType(), False).add("c_acctbal", T.DoubleType()),
        "orders": order.add("o.o_custkey", T.LongType()).add("o.o_orderstatus", T.StringType()),
    }
    return run_ingest(
        spark, catalogue_rows(documents, "value"), new_base(spark, "out"), max_pages=1_000_000, on_error="quarantine", schemas=schemas
    )


@query(
    "typed_ingest",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 11 <> 0 AND o_orderkey % 7 <> 0 THEN o_totalprice END AS o_totalprice,
         o_custkey, o_orderstatus, c_acctbal FROM orders LEFT JOIN customer ON c_custkey = o_custkey""",
)
def typed_ingest(spark, sf_dir):
    paths = _typed_job(spark, sf_dir)
    orders = read_typed(spark, paths, "orders").withColumnsRenamed({"o.o_custkey": "o_custkey", "o.o_orderstatus": "o_orderstatus"})
    customers = read_typed(spark, paths, "customer")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left").drop("c_custkey")


@query(
    "job_incidents",
    """SELECT 'orders' AS endpoint, 'API Ingestion Job Failed' AS short_description,
         CASE WHEN o_orderkey % 11 = 0 THEN 'o_totalprice is not double: n/a' ELSE 'o_totalprice is null' END AS problem,
         count(*) AS n FROM orders WHERE o_orderkey % 11 = 0 OR o_orderkey % 7 = 0 GROUP BY ALL""",
)
def job_incidents(spark, sf_dir):
    found = spark.read.parquet(_typed_job(spark, sf_dir)["incidents"])
    problem = F.regexp_replace("description", r"^orders page \d+: ", "")
    return found.groupBy("endpoint", "short_description", problem.alias("problem")).agg(F.count("*").alias("n"))


def _configurations(spark, sf_dir) -> DataFrame:
    """One configuration document per customer."""
    key = F.col("c_custkey")
    history = F.struct(
        F.when(key % 3 == 0, F.lit(" Yes ")).otherwise(F.lit("false")).alias("enabled"),
        F.lit("2020-01-01").alias("start_date"),
        F.lit("2020-12-31").alias("end-date"),
    )
    customer = F.struct(
        F.concat(F.lit("/customers/"), key).alias("endpoint-name"),
        F.create_map(F.lit("segment"), "c_mktsegment", F.lit("start"), F.lit("never")).alias("params"),
        F.create_map(F.lit("Accept"), F.lit("application/json")).alias("headers"),
        F.struct(F.lit("reader").alias("username"), F.lit("API_PASSWORD").alias("password-env")).alias("auth"),
    )
    root = F.struct(
        F.lit("").alias("endpoint-name"),
        F.create_map().cast("map<string,string>").alias("params"),
        F.create_map().cast("map<string,string>").alias("headers"),
        F.lit(None).cast("struct<username:string,`password-env`:string>").alias("auth"),
    )
    document = F.struct(
        F.col("c_name").alias("app-name"),
        F.concat(F.lit("https://api.test/"), key, F.lit("/")).alias("base-url"),
        history.alias("history-load"),
        F.array(customer, root).alias("endpoints"),
    )
    return table(spark, sf_dir, "customer").select(as_json(document.alias("ingest-souce-config")).alias("document"))


@query(
    "endpoint_catalogue",
    """SELECT c_name AS app_name, 'https://api.test/' || c_custkey || '/' AS base_url,
         CASE WHEN n = 0 THEN '/customers/' || c_custkey ELSE '' END AS endpoint,
         CASE WHEN n = 0 THEN c_mktsegment END AS segment, CASE WHEN n = 0 THEN 'application/json' END AS accept,
         CASE WHEN n = 0 THEN 'API_PASSWORD' END AS auth_password_env,
         c_custkey % 3 = 0 AS history_enabled, '2020-01-01' AS start_date, '2020-12-31' AS end_date
       FROM (SELECT *, unnest([0, 1]) AS n FROM customer)""",
)
def endpoint_catalogue(spark, sf_dir):
    return catalogue_rows(_configurations(spark, sf_dir), "document").select(
        "app_name",
        "base_url",
        "endpoint",
        F.col("params")["segment"].alias("segment"),
        F.col("headers")["Accept"].alias("accept"),
        "auth_password_env",
        "history_enabled",
        "start_date",
        "end_date",
    )


@query(
    "request_plan",
    """SELECT 'https://api.test/' || c_custkey || CASE WHEN n = 0 THEN '/customers/' || c_custkey ELSE '' END AS url,
         CAST(page AS INTEGER) AS page, CASE WHEN n = 0 THEN c_mktsegment END AS segment,
         CASE WHEN c_custkey % 3 = 0 THEN '2020-01-01' WHEN n = 0 THEN 'never' END AS "start",
         CASE WHEN c_custkey % 3 = 0 THEN '2020-12-31' END AS "end"
       FROM (SELECT *, unnest([2, 3, 4]) AS page FROM (SELECT *, unnest([0, 1]) AS n FROM customer))""",
)
def request_plan(spark, sf_dir):
    requests = plan_requests(catalogue_rows(_configurations(spark, sf_dir), "document"), 2, 3)
    params = F.col("params")
    return requests.select(
        "url", "page", *[params[name].alias(name) for name in ("segment", "start", "end")]
    )


@query(
    "history_violations",
    """SELECT c_custkey, CASE WHEN c_custkey % 6 = 5 THEN 'invalid flag' ELSE 'missing dates' END AS problem,
         CASE c_custkey % 6 WHEN 1 THEN 'end-date' WHEN 2 THEN 'start-date' WHEN 3 THEN 'start-date,end-date' ELSE '' END
           AS missing
       FROM customer WHERE c_custkey % 6 IN (1, 2, 3, 5)""",
)
def history_violations_(spark, sf_dir):
    kind = F.col("c_custkey") % 6
    configs = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(kind == 4, F.lit("no")).when(kind == 5, F.lit("maybe")).otherwise(F.lit("Y")).alias("enabled"),
        F.when(kind < 2, F.lit("2020-01-01")).when(kind == 2, F.lit("")).alias("start_date"),
        F.when(kind.isin(0, 2), F.lit("2020-12-31")).alias("end_date"),
    )
    return history_violations(configs).select(
        "c_custkey", "problem", F.array_join("missing", ",").alias("missing")
    )


@query("json_sink", "SELECT o_orderkey, o_orderstatus, o_orderpriority, o_totalprice FROM orders")
def json_sink(spark, sf_dir):
    path = new_base(spark, "json")
    columns = ("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    write_json(table(spark, sf_dir, "orders").select(*columns), path)
    schema = "o_orderkey BIGINT, o_orderstatus STRING, o_orderpriority STRING, o_totalprice DOUBLE"
    return spark.read.schema(schema).json(path)


@query(
    "endpoint_sink",
    """SELECT o_orderstatus AS endpoint, to_json({'o_custkey': o_custkey, 'o_orderkey': o_orderkey})::VARCHAR AS record
       FROM orders""",
)
def endpoint_sink(spark, sf_dir):
    path = new_base(spark, "endpoints")
    records = table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("endpoint"), as_json("o_custkey", "o_orderkey").alias("body")
    )
    write_records(R.decode(records, "body"), path)
    return read_records(spark, path)


@query("stream_pages", f"SELECT {ORDER_COLUMNS} FROM orders")
def stream_pages(spark, sf_dir):
    from sluice.streaming.ingest import stream_to_table

    base, out = new_base(spark, "stream"), new_base(spark, "streamed")
    n = stage_pages(table(spark, sf_dir, "orders"), base, "orders")
    half = max(1, n // 2)
    for pages in (half, n, n):
        # The second run goes on where the first ended, the third finds nothing new.
        options = scan_options(spark, pages)
        stream_to_table(spark, base, f"{out}/pages", f"{out}/checkpoint", endpoint="orders", **options)
    landed = spark.read.parquet(f"{out}/pages")
    return _without_zone(R.project_values(R.records_at(good_pages(landed), "data"), ORDER_FIELDS))
