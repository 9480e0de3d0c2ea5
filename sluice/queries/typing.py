"""Queries on types: inference, conversion, declared schemas, strict flags."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from sluice.functions import values as V
from sluice.operators.infer import column_types
from sluice.operators.records import decode, project
from sluice.operators.sinks import conversion_incidents, null_incidents
from sluice.plans.schema_document import schema_from
from sluice.queries.registry import query
from sluice.queries.tables import as_json, pick, table

def _value(spark, sf_dir, choices: list[str]) -> DataFrame:
    """Orders with one of the JSON `choices` each, decoded from a record's member x."""
    body = F.concat(F.lit('{"x":'), pick(F.col("o_orderkey"), choices), F.lit("}"))
    records = decode(table(spark, sf_dir, "orders").select("o_orderkey", body.alias("body")), "body")
    return records.select("o_orderkey", V.at_path(F.col("value"), "x").alias("x"))


LONGS = ["3", "1.9", "true", '"3"', '"3.9"', '" 12 "', '"abc"', "-7", "null", '""', "9223372036854775808", "-2.5"]


@query(
    "convert_long",
    """SELECT o_orderkey, CASE o_orderkey % 12 WHEN 0 THEN 3 WHEN 1 THEN 1 WHEN 2 THEN 1 WHEN 3 THEN 3
         WHEN 5 THEN 12 WHEN 7 THEN -7 WHEN 11 THEN -2 END::BIGINT AS x FROM orders""",
)
def convert_long(spark, sf_dir):
    return _value(spark, sf_dir, LONGS).select("o_orderkey", V.to_long(F.col("x")).alias("x"))


DOUBLES = ["1", "1.5", '"1e3"', '"1.5d"', '"abc"', "true", "null", '" -2.25 "', '".5"', '"0x10"']


@query(
    "convert_double",
    """SELECT o_orderkey, CASE o_orderkey % 10 WHEN 0 THEN 1.0 WHEN 1 THEN 1.5 WHEN 2 THEN 1000.0
         WHEN 5 THEN 1.0 WHEN 7 THEN -2.25 WHEN 8 THEN 0.5 END::DOUBLE AS x FROM orders""",
)
def convert_double(spark, sf_dir):
    return _value(spark, sf_dir, DOUBLES).select("o_orderkey", V.to_double(F.col("x")).alias("x"))


BOOLEANS = ["true", '"TRUE"', '"yes"', "1", "1.0", '"y"', '"maybe"', "0", "null", '[true]']


@query(
    "convert_boolean",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 10 IN (0, 1, 2, 3) THEN true
         WHEN o_orderkey % 10 = 8 THEN NULL ELSE false END AS x FROM orders""",
)
def convert_boolean(spark, sf_dir):
    return _value(spark, sf_dir, BOOLEANS).select("o_orderkey", V.to_boolean(F.col("x")).alias("x"))


TIMESTAMPS = [
    '"2020-01-02"',
    '"2020-01-02T03:04:05"',
    '"2020-01-02 03:04:05.25"',
    '"2020-01-02T03:04:05Z"',
    '"2020-01-02T03:04:05+02:00"',
    '"2020-13-01"',
    '"2020"',
    '"12:00"',
    "20200102",
    "null",
]


@query(
    "convert_timestamp",
    """SELECT o_orderkey, CASE o_orderkey % 10
         WHEN 0 THEN TIMESTAMP '2020-01-02 00:00:00' WHEN 1 THEN TIMESTAMP '2020-01-02 03:04:05'
         WHEN 2 THEN TIMESTAMP '2020-01-02 03:04:05.25' WHEN 3 THEN TIMESTAMP '2020-01-02 03:04:05'
         WHEN 4 THEN TIMESTAMP '2020-01-02 01:04:05' END AS x FROM orders""",
)
def convert_timestamp(spark, sf_dir):
    converted = V.to_timestamp(F.col("x")).cast("timestamp_ntz")
    return _value(spark, sf_dir, TIMESTAMPS).select("o_orderkey", converted.alias("x"))


STRINGS = ['"a b"', "1", "1.0", "2.50", "true", "null", '[1,"é",{"x":2}]', "-3.0", '""', "12345678901234567890"]


@query(
    "convert_string",
    """SELECT o_orderkey, CASE o_orderkey % 10 WHEN 0 THEN 'a b' WHEN 1 THEN '1' WHEN 2 THEN '1.0'
         WHEN 3 THEN '2.5' WHEN 4 THEN 'true' WHEN 6 THEN '[1,"é",{"x":2}]' WHEN 7 THEN '-3.0'
         WHEN 8 THEN '' WHEN 9 THEN '12345678901234567890' END AS x FROM orders""",
)
def convert_string(spark, sf_dir):
    return _value(spark, sf_dir, STRINGS).select("o_orderkey", V.text_of(F.col("x")).alias("x"))


KINDS = [
    "null", "true", "1", "1.0", "1.5", '"2020-01-01"', '"2020-01-01T00:00:00Z"', '"2020"', '"20200101"',
    '"12:00"', '"text"', "[1]", '"2020-02-30"', "1e3",
]


@query(
    "infer_value_types",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 14 = 1 THEN 'boolean' WHEN o_orderkey % 14 = 2 THEN 'long'
         WHEN o_orderkey % 14 IN (3, 4, 13) THEN 'double' WHEN o_orderkey % 14 IN (5, 6) THEN 'timestamp'
         ELSE 'string' END AS type FROM orders""",
)
def infer_value_types(spark, sf_dir):
    return _value(spark, sf_dir, KINDS).select("o_orderkey", V.inferred_type(F.col("x")).alias("type"))


@query(
    "infer_types",
    """WITH found AS (
         SELECT unnest([
           {'path': 'o_orderkey', 'kind': 'long'},
           {'path': 'o_totalprice', 'kind': 'double'},
           {'path': 'o_orderdate', 'kind': 'timestamp'},
           {'path': 'who.id', 'kind': 'long'},
           {'path': 'who.status', 'kind': 'string'},
           {'path': 'who.open', 'kind': 'boolean'},
           {'path': 'amount', 'kind': CASE WHEN o_orderkey % 2 = 0 THEN 'long' ELSE 'double' END},
           {'path': 'mixed', 'kind': CASE WHEN o_orderkey % 2 = 0 THEN 'boolean' ELSE 'long' END},
           {'path': 'nothing', 'kind': NULL},
           {'path': 'tags', 'kind': 'string'}], recursive := true)
         FROM orders),
       kinds AS (SELECT path, list_sort(list_distinct(list(kind))) AS k FROM found GROUP BY path)
       SELECT path, CASE WHEN len(k) = 1 THEN k[1] WHEN k = ['double', 'long'] THEN 'double' ELSE 'string' END AS type
       FROM kinds""",
)
def infer_types(spark, sf_dir):
    even = F.col("o_orderkey") % 2 == 0
    steady = as_json(
        "o_orderkey",
        "o_totalprice",
        "o_orderdate",
        F.struct(
            F.col("o_custkey").alias("id"),
            F.col("o_orderstatus").alias("status"),
            (F.col("o_orderstatus") == "O").alias("open"),
        ).alias("who"),
        F.lit(None).cast("string").alias("nothing"),
        F.array("o_orderstatus").alias("tags"),
    )
    varying = F.when(even, F.lit('{"amount":1,"mixed":true,')).otherwise(F.lit('{"amount":1.5,"mixed":7,'))
    body = F.concat(varying, F.substr(steady, F.lit(2)))
    records = decode(table(spark, sf_dir, "orders").select(body.alias("body")), "body")
    return column_types(records)


DOCUMENT = {
    "fields": [
        {"name": "order_no", "type": "long", "nullable": False},
        {"name": "priority", "type": "string"},
        {"name": "amount", "type": {"type": "decimal", "precision": 12, "scale": 2}},
        {"name": "placed", "type": "timestamp"},
        {"name": "codes", "type": {"type": "array", "elementType": "string", "containsNull": False}},
        {
            "name": "facts",
            "type": {"type": "map", "keyType": "string", "valueType": "string", "valueContainsNull": True},
        },
        {
            "name": "buyer",
            "type": {
                "type": "struct",
                "fields": [{"name": "number", "type": "string"}, {"name": "copies", "type": "string"}],
            },
        },
    ]
}


def _declared_rows(spark, sf_dir) -> DataFrame:
    key = F.col("o_orderkey")
    body = as_json(
        F.when(key % 9 != 0, key).alias("order_no"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_totalprice").alias("amount"),
        F.when(key % 4 == 0, F.lit("no date")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")).alias("placed"),
        F.array("o_orderstatus", F.lit("x")).alias("codes"),
        F.create_map(F.lit("status"), "o_orderstatus").alias("facts"),
        F.struct(F.col("o_custkey").cast("string").alias("number"), F.lit(7).alias("copies")).alias("buyer"),
        F.lit(1).alias("unknown"),
    )
    pages = table(spark, sf_dir, "orders").select(
        F.lit("orders").alias("endpoint"), key.alias("page"), body.alias("record")
    )
    return project(pages, schema_from(DOCUMENT), "record", keep=("endpoint", "page"))


@query(
    "declared_schema",
    """SELECT o_orderkey AS page, CASE WHEN o_orderkey % 9 <> 0 THEN o_orderkey END AS order_no, o_orderpriority AS priority,
         CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS amount,
         CASE WHEN o_orderkey % 4 <> 0 THEN o_orderdate END AS placed,
         o_orderstatus AS tag0, 2 AS n_tags, o_orderstatus AS status, CAST(o_custkey AS VARCHAR) AS number, '7' AS copies
       FROM orders""",
)
def declared_schema(spark, sf_dir):
    return _declared_rows(spark, sf_dir).select(
        "page",
        "order_no",
        "priority",
        F.col("amount").cast("double").alias("amount"),
        F.col("placed").cast("timestamp_ntz").alias("placed"),
        F.col("codes")[0].alias("tag0"),
        F.size("codes").alias("n_tags"),
        F.col("facts")["status"].alias("status"),
        F.col("buyer.number").alias("number"),
        F.col("buyer.copies").alias("copies"),
    )


@query(
    "not_null_violations",
    """SELECT 'orders' AS endpoint, o_orderkey AS page, CAST(NULL AS INTEGER) AS status,
         'API Ingestion Job Failed' AS short_description,
         'orders page ' || o_orderkey || ': order_no is null' AS description
       FROM orders WHERE o_orderkey % 9 = 0""",
)
def not_null_violations(spark, sf_dir):
    return null_incidents(_declared_rows(spark, sf_dir), schema_from(DOCUMENT))


@query(
    "conversion_failures",
    """SELECT 'orders' AS endpoint, o_orderkey AS page, CAST(NULL AS INTEGER) AS status,
         'API Ingestion Job Failed' AS short_description,
         'orders page ' || o_orderkey || ': x is not bigint: '
           || CASE o_orderkey % 12 WHEN 4 THEN '3.9' WHEN 6 THEN 'abc' WHEN 9 THEN '' ELSE '9223372036854775808' END
           AS description
       FROM orders WHERE o_orderkey % 12 IN (4, 6, 9, 10)""",
)
def conversion_failures(spark, sf_dir):
    body = F.concat(F.lit('{"x":'), pick(F.col("o_orderkey"), LONGS), F.lit("}"))
    pages = table(spark, sf_dir, "orders").select(
        F.lit("orders").alias("endpoint"), F.col("o_orderkey").alias("page"), body.alias("body")
    )
    records = decode(pages, "body")
    return conversion_incidents(records, T.StructType([T.StructField("x", T.LongType())]))


FLAGS = ["true", " TRUE ", "1", "yes", "Y", "false", "0", "No", "n", ""]


@query("strict_boolean", "SELECT o_orderkey, o_orderkey % 10 < 5 AS flag FROM orders")
def strict_boolean(spark, sf_dir):
    flag = V.strict_boolean(pick(F.col("o_orderkey"), FLAGS))
    return table(spark, sf_dir, "orders").select("o_orderkey", flag.alias("flag"))
