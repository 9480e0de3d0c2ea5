"""Schemas: inferred and declared (R5a, R8, S4, D-rules on schemas)."""

import datetime as dt
import decimal
import json

import pytest
from pyspark.sql import functions as F, types as T

from sluice.operators.infer import column_types, first_record, infer_schema
from sluice.operators.records import project
from sluice.operators.sinks import conversion_incidents, null_incidents
from sluice.plans.schema_document import TYPE_NAMES, data_type, schema_from, schema_from_file
from sluice.queries.typing import DOCUMENT


def test_types_widen_over_records(values):
    records = values(
        '{"l":1,"d":1,"s":1,"n":null,"o":null,"t":"2020-01-01","b":true,"x":{"y":1}}',
        '{"l":2,"d":1.5,"s":"a","n":null,"o":4,"t":"2020-01-02T00:00:00Z","b":false}',
    )
    found = {r["path"]: r["type"] for r in column_types(records).collect()}
    assert found == {"l": "long", "d": "double", "s": "string", "n": "string", "o": "long",
                     "t": "timestamp", "b": "boolean", "x.y": "long"}
    schema = infer_schema(records)
    assert schema.names == sorted(found) and all(f.nullable for f in schema)
    assert {f.dataType for f in infer_schema(records, infer_types=False)} == {T.StringType()}
    with pytest.raises(ValueError, match="more than 3"):
        infer_schema(records, max_columns=3)


def test_first_record(values):
    records = values('{"a":1}', '{"b":2}').withColumns({"page": F.col("n"), "pos": F.lit(0), "endpoint": F.lit("e")})
    assert infer_schema(first_record(records)).names == ["a"]


def test_declared_types():
    simple = {
        "string": T.StringType(), "integer": T.IntegerType(), "int": T.IntegerType(), "long": T.LongType(), "short": T.ShortType(),
        "byte": T.ByteType(), "float": T.FloatType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "binary": T.BinaryType(),
        "date": T.DateType(), "timestamp": T.TimestampType(), "null": T.NullType(), "daytimeinterval": T.DayTimeIntervalType(),
        "yearmonthinterval": T.YearMonthIntervalType(), "variant": T.VariantType()}
    assert set(simple) == set(TYPE_NAMES)
    for name, expected in simple.items():
        assert data_type(name) == data_type(name.upper()) == data_type({"type": name}) == expected
    assert data_type({"type": "decimal"}) == T.DecimalType(10, 0)
    assert data_type({"type": "array", "elementType": "int"}) == T.ArrayType(T.IntegerType(), True)
    assert data_type({"type": "map", "keyType": "string", "valueType": {"type": "struct", "fields": []}}) == T.MapType(
        T.StringType(), T.StructType())
    for bad in ("decimal", "decimal(10,2)", "bigint", "timestamp_ntz", "char", {"type": "tuple"}, {}):
        with pytest.raises(ValueError, match="Unsupported type"):
            data_type(bad)


def test_schema_document(tmp_path):
    path = tmp_path / "schema.json"
    path.write_text(json.dumps(DOCUMENT))
    expected = (
        T.StructType()
        .add("order_no", T.LongType(), False)
        .add("priority", T.StringType())
        .add("amount", T.DecimalType(12, 2))
        .add("placed", T.TimestampType())
        .add("codes", T.ArrayType(T.StringType(), False))
        .add("facts", T.MapType(T.StringType(), T.StringType()))
        .add("buyer", T.StructType().add("number", T.StringType()).add("copies", T.StringType()))
    )
    assert schema_from(DOCUMENT) == schema_from(json.dumps(DOCUMENT)) == schema_from_file(str(path)) == expected


def test_every_declared_type_applies(spark):
    fields = {
        "string": ("x", "x"), "integer": (1, 1), "int": (2, 2), "long": (3, 3), "short": (4, 4), "byte": (5, 5),
        "float": (1.5, 1.5), "double": (2.5, 2.5), "boolean": (True, True), "binary": ("aGk=", b"hi"),
        "date": ("2020-01-02", dt.date(2020, 1, 2)), "timestamp": ("2020-01-02T03:04:05Z", None),
        "null": (None, None),
        "daytimeinterval": ("INTERVAL '1 02:03:04' DAY TO SECOND", dt.timedelta(days=1, seconds=7384)),
        "yearmonthinterval": ("INTERVAL '1-2' YEAR TO MONTH", None), "variant": ({"a": 1}, None),
    }
    schema = schema_from({"fields": [{"name": n, "type": n} for n in fields]})
    text = json.dumps({n: given for n, (given, _) in fields.items()})
    row = project(spark.createDataFrame([(text,)], "r STRING"), schema, "r").withColumns({
        "timestamp": F.col("timestamp").cast("string"),
        "yearmonthinterval": F.col("yearmonthinterval").cast("string"),
        "variant": F.to_json("variant"),
    }).first()
    for name, (_, expected) in fields.items():
        if expected is not None:
            assert row[name] == expected, name
    assert row["timestamp"] == "2020-01-02 03:04:05"
    assert row["yearmonthinterval"] == "INTERVAL '1-2' YEAR TO MONTH"
    assert row["variant"] == '{"a":1}'


def test_bad_fields_keep_their_row(spark):
    text = '{"order_no":"x","priority":"n","amount":12.345,"placed":"no","codes":["a"],"buyer":{"copies":7}}'
    pages = spark.createDataFrame([("e", 1, text)], "endpoint STRING, page INT, r STRING")
    rows = project(pages, schema_from(DOCUMENT), "r", keep=("endpoint", "page"))
    row = rows.first()
    assert (row["order_no"], row["priority"], row["amount"], row["placed"]) == (None, "n", decimal.Decimal("12.35"), None)
    assert (row["codes"], row["buyer"]["copies"], row["facts"]) == (["a"], "7", None)
    incident = null_incidents(rows, schema_from(DOCUMENT)).collect()
    assert [r["description"] for r in incident] == ["e page 1: order_no is null"]


def test_lost_values_are_incidents(values):
    records = values('{"a":"x","b":1}', '{"a":"7","b":null}', '{"b":"no"}').withColumns(
        {"endpoint": F.lit("e"), "page": F.col("n")})
    schema = T.StructType().add("a", T.LongType()).add("b", T.DoubleType())
    rows = conversion_incidents(records, schema).orderBy("page").collect()
    assert [r["description"] for r in rows] == ["e page 0: a is not bigint: x", "e page 2: b is not double: no"]
