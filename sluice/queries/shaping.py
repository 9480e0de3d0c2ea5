"""Queries on record shaping: envelopes, paths, flattening, projection."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from sluice.functions import values as V
from sluice.operators import records as R
from sluice.operators.flatten import flatten_long as to_leaves, flatten_struct
from sluice.queries.registry import query
from sluice.queries.tables import as_json, json_list, json_string, table
from sluice.sources.rows import POSTS_SCHEMA


@query(
    "raw_records",
    """SELECT json_object('o_orderkey', o_orderkey, 'o_orderstatus', o_orderstatus,
                          'o_orderpriority', o_orderpriority)::VARCHAR AS skema FROM orders
       UNION ALL
       SELECT '{"o_orderkey":' || o_orderkey || ',"rate":1.0}' FROM orders WHERE o_orderkey % 2 = 0""",
)
def raw_records(spark, sf_dir):
    first = as_json("o_orderkey", "o_orderstatus", "o_orderpriority")
    second = as_json("o_orderkey", F.lit("1.0").cast("decimal(2,1)").alias("rate"))
    body = F.when(F.col("o_orderkey") % 2 == 0, json_list(first, second)).otherwise(first)
    pages = table(spark, sf_dir, "orders").select(body.alias("body"))
    return R.raw_records(pages, "skema")


@query(
    "fixed_projection",
    """SELECT CAST(user_id % 2147483647 AS INTEGER) AS "userId", CAST(event_id % 2147483647 AS INTEGER) AS id,
         event_type AS title, CAST(NULL AS VARCHAR) AS body FROM events""",
)
def fixed_projection(spark, sf_dir):
    record = as_json(
        (F.col("user_id") % 2147483647).alias("userId"),
        (F.col("event_id") % 2147483647).alias("id"),
        F.col("event_type").alias("title"),
        F.col("value").alias("unknown"),
    )
    return R.project(table(spark, sf_dir, "events").select(record.alias("record")), POSTS_SCHEMA, "record")


@query(
    "envelope_unwrap",
    """SELECT o_orderkey, pos, o_custkey, CASE WHEN pos = 0 THEN o_orderpriority END AS priority
       FROM (SELECT *, unnest(CASE WHEN o_orderkey % 7 = 6 THEN [0] ELSE [0, 1] END) AS pos FROM orders)""",
)
def envelope_unwrap(spark, sf_dir):
    first = as_json("o_custkey", F.col("o_orderpriority").alias("priority"))
    both = json_list(first, as_json("o_custkey"))

    def under(*keys):
        return F.concat(F.lit("{" + ",".join(keys)), both, F.lit("}"))

    shapes = [
        both,
        under('"results":'),
        under('"count":2', '"data":'),
        under('"items":'),
        under('"records":'),
        # Two known members; the one tried first holds no list.
        under('"results":"none"', '"data":'),
        first,
    ]
    shape = F.lit(None).cast("string")
    for n, body in enumerate(shapes):
        shape = F.when(F.col("o_orderkey") % len(shapes) == n, body).otherwise(shape)
    pages = table(spark, sf_dir, "orders").select("o_orderkey", shape.alias("body"))
    schema = T.StructType().add("o_custkey", T.LongType()).add("priority", T.StringType())
    return R.project_values(R.unwrap(pages), schema, keep=("o_orderkey", "pos"))


@query(
    "double_encoded",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 7 NOT IN (0, 3) THEN o_custkey END AS o_custkey,
         CASE WHEN o_orderkey % 7 = 0 THEN 'no json ' || o_custkey WHEN o_orderkey % 7 = 3 THEN '1.5' END AS raw_response
       FROM orders WHERE o_orderkey % 7 <> 4""",
)
def double_encoded(spark, sf_dir):
    key = F.col("o_orderkey")
    text = json_list(as_json("o_custkey"))
    body = (
        F.when(key % 7 == 0, json_string(F.concat(F.lit("no json "), "o_custkey")))
        .when(key % 7 == 1, json_string(json_string(json_string(text))))
        .when(key % 7 == 2, json_string(json_string(text)))
        .when(key % 7 == 3, F.lit("1.5"))
        .when(key % 7 == 4, json_string(F.lit("null")))
        .otherwise(json_string(text))
    )
    pages = table(spark, sf_dir, "orders").select("o_orderkey", body.alias("body"))
    schema = T.StructType().add("o_custkey", T.LongType()).add("raw_response", T.StringType())
    return R.project_values(R.unwrap(pages), schema, keep=("o_orderkey",))


@query(
    "json_path",
    """SELECT event_id, CASE WHEN event_id % 5 NOT IN (0, 1, 2) THEN json_extract(props, '$.k')::BIGINT END AS k
       FROM events""",
)
def json_path(spark, sf_dir):
    inner = F.col("event_id") % 5
    body = (
        F.when(inner == 0, F.lit('{"a":{}}'))
        .when(inner == 1, F.lit('{"a":{"b":null}}'))
        .when(inner == 2, F.concat(F.lit('{"a":[{"b":'), "props", F.lit("}]}")))
        .otherwise(F.concat(F.lit('{"a":{"b":'), "props", F.lit("}}")))
    )
    records = R.decode(table(spark, sf_dir, "events").select("event_id", body.alias("body")), "body")
    found = records.select("event_id", V.at_path(F.col("value"), "a.b.k").alias("found"))
    return found.select("event_id", V.to_long(F.col("found")).alias("k"))


@query(
    "path_records",
    """SELECT o_orderkey, pos, o_custkey + pos AS n
       FROM (SELECT *, unnest(CASE o_orderkey % 3 WHEN 0 THEN [0, 1] ELSE [0] END) AS pos
             FROM orders WHERE o_orderkey % 3 < 2)""",
)
def path_records(spark, sf_dir):
    return _path_records(spark, sf_dir, "skip")


@query(
    "scalar_page_records",
    """SELECT o_orderkey, pos, o_custkey + pos AS n
       FROM (SELECT *, unnest(CASE o_orderkey % 3 WHEN 0 THEN [0, 1] ELSE [0] END) AS pos FROM orders)""",
)
def scalar_page_records(spark, sf_dir):
    return _path_records(spark, sf_dir, "record")


def _path_records(spark, sf_dir, scalar_page):
    one, two = F.col("o_custkey").cast("string"), (F.col("o_custkey") + 1).cast("string")
    kind = F.col("o_orderkey") % 3
    found = (
        F.when(kind == 0, F.concat(F.lit('[{"n":'), one, F.lit('},{"n":'), two, F.lit("}]")))
        .when(kind == 1, F.concat(F.lit('{"n":'), one, F.lit("}")))
        .otherwise(one)
    )
    body = F.concat(F.lit('{"page":{"found":'), found, F.lit("}}"))
    pages = table(spark, sf_dir, "orders").select("o_orderkey", body.alias("body"))
    records = R.records_at(pages, "page.found", scalar_page=scalar_page)
    value = F.col("value")
    found = records.select("o_orderkey", "pos", F.coalesce(V.at_path(value, "n"), value).alias("found"))
    return found.select("o_orderkey", "pos", V.to_long(F.col("found")).alias("n"))


def _nested(spark, sf_dir):
    body = F.concat(
        F.lit('{"user":{"id":'),
        F.col("user_id").cast("string"),
        F.lit(',"kind":{"type":'),
        json_string(F.col("event_type")),
        F.lit('}},"props":'),
        "props",
        F.lit(',"tags":["a",'),
        F.col("event_id").cast("string"),
        F.lit('],"empty":{},"none":null}'),
    )
    return table(spark, sf_dir, "events").select("event_id", body.alias("record"))


@query(
    "flatten_long",
    """SELECT event_id, 'user.id' AS path, CAST(user_id AS VARCHAR) AS value_json FROM events
       UNION ALL SELECT event_id, 'user.kind.type', '"' || event_type || '"' FROM events
       UNION ALL SELECT event_id, 'props.k', json_extract(props, '$.k')::VARCHAR FROM events
       UNION ALL SELECT event_id, 'tags', '["a",' || event_id || ']' FROM events
       UNION ALL SELECT event_id, 'none', 'null' FROM events""",
)
def flatten_long(spark, sf_dir):
    records = R.decode(_nested(spark, sf_dir), "record")
    return to_leaves(records, keep=("event_id",))


FLAT_SQL = """SELECT event_id, user_id AS "user.id", event_type AS "user.kind.type",
                json_extract(props, '$.k')::BIGINT AS "props.k", '["a",' || event_id || ']' AS tags FROM events"""


@query("flatten_wide", FLAT_SQL)
def flatten_wide(spark, sf_dir):
    schema = """user STRUCT<id: BIGINT, kind: STRUCT<type: STRING>>, props STRUCT<k: BIGINT>, tags ARRAY<VARIANT>"""
    return flatten_struct(R.project(_nested(spark, sf_dir), schema, "record", keep=("event_id",)))


@query("flatten_values", FLAT_SQL)
def flatten_values(spark, sf_dir):
    schema = T.StructType(
        [
            T.StructField("user.id", T.LongType()),
            T.StructField("user.kind.type", T.StringType()),
            T.StructField("props.k", T.LongType()),
            T.StructField("tags", T.StringType()),
        ]
    )
    records = R.decode(_nested(spark, sf_dir), "record")
    return R.project_values(records, schema, keep=("event_id",))
