"""Values: conversion, inference, paths, strict flags."""

import datetime as dt
import json
import math

import pytest
from pyspark.sql import functions as F, types as T

from sluice.functions import values as V


def column(values, expression, texts):
    rows = values(*texts).select("n", expression(F.col("value")).alias("x")).orderBy("n").collect()
    return [r["x"] for r in rows]


def test_to_long(values):
    texts = ["3", "1.9", "-1.9", "true", "false", '"3"', '"3.9"', '" 12 "', '"+5"', '"abc"', '""', "null",
             "-7", "9223372036854775808", '"9223372036854775808"', '"1_000"', "[1]", "{}"]
    assert column(values, V.to_long, texts) == [
        3, 1, -1, 1, 0, 3, None, 12, 5, None, None, None, -7, None, None, None, None, None]


def test_to_double(values):
    texts = ["1", "1.5", '"1e3"', '"inf"', '"-Infinity"', '"1.5d"', '"x"', "null", "true", '" .5 "', '"5."']
    assert column(values, V.to_double, texts) == [
        1.0, 1.5, 1000.0, math.inf, -math.inf, None, None, None, 1.0, 0.5, 5.0]
    assert all(math.isnan(x) for x in column(values, V.to_double, ['"nan"', '"NaN"', '"+NAN"']))


def test_to_boolean(values):
    texts = ["true", "false", '"TRUE"', '"yes"', "1", '"1"', "1.0", '"1.0"', '"y"', '"maybe"', "0", "null", "[1]", "{}"]
    assert column(values, V.to_boolean, texts) == [
        True, False, True, True, True, True, False, False, False, False, False, None, False, False]


def test_to_timestamp(values):
    texts = ['"2020-01-02"', '"2020-01-02T03"', '"2020-01-02 03:04"', '"2020-01-02T03:04:05.123456"',
             '"2020-01-02T03:04:05Z"', '"2020-01-02T03:04+02:00"', '"2020-01-02T03Z"', '"2020-13-01"', '"2020"',
             '"20200102"', '"12:00"', '" 2020-01-02"', "20200102", "null"]
    day = dt.datetime(2020, 1, 2)
    found = column(values, lambda v: V.to_timestamp(v).cast("timestamp_ntz"), texts)
    assert found == [
        day, day.replace(hour=3), day.replace(hour=3, minute=4),
        day.replace(hour=3, minute=4, second=5, microsecond=123456), day.replace(hour=3, minute=4, second=5),
        day.replace(hour=1, minute=4), day.replace(hour=3)] + [None] * 7


def test_text_of(values):
    texts = ['"a b"', "1", "1.0", "-2.0", "2.50", "true", "null", '[1, "é"]', '{"a": {}}', "9223372036854775808", "1e3"]
    assert column(values, V.text_of, texts) == [
        "a b", "1", "1.0", "-2.0", "2.5", "true", None, '[1,"é"]', '{"a":{}}', "9223372036854775808", "1000.0"]


def test_convert_to_declared_types(values):
    schema = {
        "1": T.IntegerType(), '"2020-01-02"': T.DateType(), "1.25": T.DecimalType(5, 2), "[1,2]": T.ArrayType(T.IntegerType()),
        '{"a":"b"}': T.MapType(T.StringType(), T.StringType()), '"aGk="': T.BinaryType(), "null": T.NullType(),
        '"x"': T.ShortType(),
    }
    found = []
    for text, data_type in schema.items():
        found += column(values, lambda v: V.convert(v, data_type), [text])
    import decimal
    assert found == [1, dt.date(2020, 1, 2), decimal.Decimal("1.25"), [1, 2], {"a": "b"}, b"hi", None, None]


def test_inferred_type(values):
    kinds = {
        "null": "string", "true": "boolean", "1": "long", "1.0": "double", "1.5": "double", "1e3": "double",
        '"2020-01-01"': "timestamp", '"2020-01-01T00:00:00Z"': "timestamp", '"2020-02-30"': "string",
        '"2020"': "string", '"20200101"': "string", '"12:00"': "string", '"text"': "string", "[1]": "string",
    }
    assert column(values, V.inferred_type, list(kinds)) == list(kinds.values())


@pytest.mark.parametrize(
    "path, text, expected",
    [
        ("", '{"a":1}', '{"a":1}'),
        (None, "[1]", "[1]"),
        ("a", '{"a":1}', "1"),
        ("a.b", '{"a":{"b":[1]}}', "[1]"),
        ("a.c", '{"a":{"b":1}}', None),
        ("a.b", '{"a":7}', None),
        ("a.b", '{"a":null}', None),
        ("a", '{"a":null}', None),
        ("a.b", '{"a":[{"b":1}]}', None),
        ("a.b", '{"a.b":1}', None),
        ("it's.b", '{"it\'s":{"b":1}}', "1"),
        ("it's \"x\"", json.dumps({"it's \"x\"": 5}), "5"),
    ],
)
def test_path(values, path, text, expected):
    assert column(values, lambda v: F.to_json(V.at_path(v, path)), [text]) == [expected]


def test_strict_boolean(spark):
    words = ["true", " TRUE ", "1", "yes", "Y", "false", "0", "no", "N", ""]
    df = spark.createDataFrame([(n, w) for n, w in enumerate(words)], "n INT, w STRING").orderBy("n")
    assert [r[0] for r in df.select(V.strict_boolean(F.col("w"))).collect()] == [True] * 5 + [False] * 5
    for bad in ("maybe", None, "2"):
        one = spark.createDataFrame([(bad,)], "w STRING")
        with pytest.raises(Exception, match="Invalid boolean value"):
            one.select(V.strict_boolean(F.col("w"))).collect()


def test_typed_rows_convert_each_member_once(values):
    from sluice.plans.job import PROBLEMS, typed_rows

    schema = T.StructType().add("a", T.DoubleType()).add("b.c", T.DoubleType(), False)
    texts = ['{"a": "1.5", "b": {"c": 2}}', '{"a": "x", "b.c": "nan"}', '{"a": null, "b": {"c": "y"}}', "{}"]
    records = values(*texts).select(F.lit("e").alias("endpoint"), F.lit(1).alias("page"), F.col("n").alias("pos"), "value")
    found = typed_rows(records, schema)
    got = {r.pos: (r.a, str(r["b.c"]), r[PROBLEMS]) for r in found.collect()}
    assert got == {
        0: (1.5, "2.0", []),
        1: (None, "nan", ["a is not double: x"]),
        2: (None, "None", ["b.c is not double: y"]),
        3: (None, "None", ["b.c is null"]),
    }
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("[+-]?nan$") == len(schema)
