"""Record shaping: envelopes, raw records, flattening, projection."""

import json
import random

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from sluice.functions import values as V
from sluice.operators import records as R
from sluice.operators.flatten import flatten_long, flatten_struct, leaves

ENVELOPES = {
    "[1,{\"a\":2}]": ["1", '{"a":2}'],
    "[]": [],
    '{"results":[1]}': ["1"],
    '{"data":[2]}': ["2"],
    '{"items":[3]}': ["3"],
    '{"records":[4]}': ["4"],
    '{"data":[2],"results":[1]}': ["1"],
    '{"results":"none","data":[2]}': ["2"],
    '{"results":{"a":1}}': ['{"results":{"a":1}}'],
    '{"a":1}': ['{"a":1}'],
    "{}": ["{}"],
    json.dumps(json.dumps([1, 2])): ["1", "2"],
    json.dumps(json.dumps(json.dumps({"data": [5]}))): ["5"],
    '"plain text"': ['{"raw_response":"plain text"}'],
    '"{\\"a\\":1} tail"': ['{"raw_response":"{\\"a\\":1} tail"}'],
    '""': ['{"raw_response":""}'],
    "7": ['{"raw_response":"7"}'],
    "1.0": ['{"raw_response":"1.0"}'],
    "true": ['{"raw_response":"true"}'],
    "null": [],
    '"null"': [],
    " [ 8 ] ": ["8"],
}


def test_unwrap(spark):
    pages = spark.createDataFrame(list(enumerate(ENVELOPES)), "n INT, body STRING")
    rows = R.unwrap(pages).select("n", "pos", F.to_json("value").alias("v")).collect()
    found = {n: [] for n in range(len(ENVELOPES))}
    for r in sorted(rows):
        found[r["n"]].append(r["v"])
    assert list(found.values()) == list(ENVELOPES.values())


def test_any_number_of_strings_is_decoded(spark):
    bodies = ['[{"a":"x\\"y"},2]']
    for _ in range(9):
        bodies.append(json.dumps(bodies[-1]))
    pages = spark.createDataFrame([(b,) for b in bodies], "body STRING")
    rows = R.unwrap(pages).select("pos", F.to_json("value").alias("v")).distinct().collect()
    assert sorted((r["pos"], json.loads(r["v"])) for r in rows) == [(0, {"a": 'x"y'}), (1, 2)]
    assert R.unwrap(pages).count() == 2 * len(bodies)


def test_unreadable_bodies_are_problems(spark):
    four_times = "[1]"
    for _ in range(4):
        four_times = json.dumps(four_times)
    bodies = {"{bad": R.INVALID_JSON, '{"a":1}{"b":2}': R.INVALID_JSON, '[1],[2]': R.INVALID_JSON, "": R.INVALID_JSON,
              "1],[2": R.INVALID_JSON, four_times: None, "[1]": None}
    pages = spark.createDataFrame(list(enumerate(bodies)), "n INT, body STRING")
    rows = R.with_items(pages).orderBy("n").collect()
    assert [r["problem"] for r in rows] == list(bodies.values())
    assert [r["items"] is None for r in rows] == [p is not None for p in bodies.values()]
    null = R.with_items(spark.createDataFrame([(None,)], "body STRING")).first()
    assert null["items"] is None and null["problem"] is None


plain_json = st.recursive(
    st.none() | st.booleans() | st.integers(-(10**6), 10**6) | st.text("ab\"{} é", max_size=5),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.text("abc", min_size=1, max_size=3), inner, max_size=3),
    max_leaves=8,
)


@settings(max_examples=8, deadline=None)
@given(st.lists(plain_json, max_size=20))
def test_wrapped_records_come_back(spark, wanted):
    pages = spark.createDataFrame([(json.dumps({"data": wanted}),)], "body STRING")
    rows = R.unwrap(pages).select("pos", F.to_json("value").alias("v")).orderBy("pos").collect()
    assert [json.loads(r["v"]) for r in rows] == wanted
    texts = R.raw_records(spark.createDataFrame([(json.dumps(wanted),)], "body STRING"), "t").collect()
    assert [json.loads(r["t"]) for r in texts] == wanted


def test_raw_records_keep_floats_and_strings(spark):
    bodies = ['[{"a": 1.0, "b": [1, 2.50]}]', '["x", 1, null, "{\\"q\\":1}", "1"]', '{"a": 1.0}', "7", '["\\u007bz"]']
    df = spark.createDataFrame([(b,) for b in bodies], "body STRING").coalesce(1)
    assert [r["t"] for r in R.raw_records(df, "t").collect()] == [
        '{"a":1.0,"b":[1,2.5]}', '"x"', "1", "null", '"{\\"q\\":1}"', '"1"', '{"a":1.0}', "7", '"{z"']


def test_records_at(spark):
    bodies = ['{"d":{"r":[1,2]}}', '{"d":{"r":{"a":1}}}', '{"d":{"r":5}}', '{"d":{"r":null}}', '{"d":{}}', "[]"]
    pages = spark.createDataFrame(list(enumerate(bodies)), "n INT, body STRING")

    def found(**options):
        rows = R.records_at(pages, "d.r", **options).select("n", "pos", F.to_json("value").alias("v"))
        return [(r["n"], r["v"]) for r in rows.orderBy("n", "pos").collect()]

    assert found() == [(0, "1"), (0, "2"), (1, '{"a":1}')]
    assert found(scalar_page="record") == [(0, "1"), (0, "2"), (1, '{"a":1}'), (2, "5")]
    with pytest.raises(ValueError):
        found(scalar_page="drop")
    with pytest.raises(Exception, match="invalid JSON"):
        R.records_at(spark.createDataFrame([("{",)], "body STRING"), "a").collect()


def long_form(values, text, **options):
    rows = flatten_long(values(text), keep=("n",), **options).collect()
    return {r["path"]: r["value_json"] for r in rows}


def test_flatten_long(values):
    text = '{"a":{"b":{"c":1}},"l":[{"x":1}],"e":{},"n":null,"p.q":2,"s":"t","d":{"e":{}}}'
    assert long_form(values, text) == {
        "a.b.c": "1", "l": '[{"x":1}]', "n": "null", "p.q": "2", "s": '"t"'}
    assert long_form(values, text, sep="/")["a/b/c"] == "1"
    assert long_form(values, "5") == {"_value": "5"}
    assert long_form(values, "[1]") == {"_value": "[1]"}
    assert long_form(values, "{}") == {}


def test_flatten_never_loses_depth(values):
    nested = "1"
    for _ in range(9):
        nested = '{"a":' + nested + "}"
    with pytest.raises(Exception, match="nested deeper than 8 levels"):
        long_form(values, nested, depth=8)
    assert long_form(values, nested) == long_form(values, nested, depth=9) == {".".join("a" * 9): "1"}


def test_flatten_opens_as_deep_as_needed(values):
    deep = '{"x":2.0,"a":' * 20 + "null" + "}" * 20
    found = long_form(values, deep)
    assert found == {".".join(["a"] * n + ["x"]): "2.0" for n in range(20)} | {".".join("a" * 20): "null"}
    rows = flatten_long(values('{"a":{"b":1}}', "7", '{"a":{}}', "{}", "not json", '{"a":{"b":{"c":[]}}}'), keep=("n",)).collect()
    assert sorted((r["n"], r["path"], r["value_json"]) for r in rows) == [(0, "a.b", "1"), (1, "_value", "7"), (5, "a.b.c", "[]")]


def test_wide_and_long_agree(spark, values):
    text = '{"u":{"id":3,"k":{"t":"x"}},"tags":[1,"a"],"ok":true}'
    long = long_form(values, text)
    schema = "u STRUCT<id: BIGINT, k: STRUCT<t: STRING>>, tags ARRAY<VARIANT>, ok BOOLEAN"
    records = spark.createDataFrame([(text,)], "body STRING")
    wide = flatten_struct(R.project(records, schema, "body")).first().asDict()
    assert wide == {"u.id": 3, "u.k.t": "x", "tags": '[1,"a"]', "ok": True}
    fields = T.StructType([T.StructField(p, T.StringType()) for p in long])
    by_value = R.project_values(values(text), fields).first().asDict()
    assert by_value == {"u.id": "3", "u.k.t": "x", "tags": '[1,"a"]', "ok": "true"}


def test_dotted_and_duplicate_names(values):
    schema = T.StructType().add("a.b", T.LongType()).add("p.q.r", T.LongType()).add("x", T.LongType())
    text = '{"a.b":1,"p":{"q.r":2},"x":1,"x":3}'
    assert R.project_values(values(text), schema).first().asDict() == {"a.b": 1, "p.q.r": 2, "x": 3}


def test_long_names(values):
    """Names of many words: all ways to cut them, against a plain walk."""
    words = "abcdefghijklmnop"
    name = ".".join(words)

    def plain(value, rest):
        if rest is None:
            return [value]
        keys = sorted(k for k in value if rest == k or rest.startswith(k + ".")) if isinstance(value, dict) else []
        return [x for k in keys for x in plain(value[k], None if rest == k else rest[len(k) + 1 :])]

    r = random.Random(8)

    def record(at=0):
        if at == len(words):
            return r.choice([1, 2, None, {"z": 1}])
        ends = r.sample(range(at + 1, len(words) + 1), k=min(len(words) - at, r.choice([1, 1, 2])))
        return {".".join(words[at:e]): record(e) if r.random() < 0.9 else r.choice([5, [1], {}]) for e in ends}

    records = [record() for _ in range(60)] + [{name: 1}, {}, 5, {"a": 1, name: 2}, {"a": {".".join(words[1:]): None}, name: 2}]
    df = values(*[json.dumps(x) for x in records]).select("n", F.to_json(V.flattened(F.col("value"), name)).alias("v"))
    found = {row["n"]: row["v"] for row in df.collect()}
    assert [found[n] and json.loads(found[n]) for n in range(len(records))] == [next(iter(plain(x, name)), None) for x in records]
    assert found[61] is None and found[64] == "null" and found[60] == "1"


def test_one_column_for_each_name(spark):
    df = spark.createDataFrame([((1, (2, "x")),), ((3, (None, None)),)], "r STRUCT<`a.b`: INT, a: STRUCT<b: INT, c: STRING>>")
    flat = flatten_struct(df.select("r.*"))
    assert flat.columns == ["a.b", "a.c"] and sorted(tuple(r)[0] for r in flat.collect()) == [2, 3]
    nested = flatten_struct(df.select("r"))
    assert nested.columns == ["r.a.b", "r.a.c"] and sorted(r["r.a.b"] for r in nested.collect()) == [2, 3]
    mixed = flatten_struct(spark.sql("SELECT struct('t' AS `a.b`, struct(CAST(null AS INT) AS b) AS a) AS r"))
    assert mixed.columns == ["r.a.b"] and mixed.first()[0] == "t"


def test_unreadable_text_is_no_row_of_nulls(spark):
    schema = "id INT, tags ARRAY<INT>"
    good = spark.createDataFrame([('{"id":1}',), ('{"id":"x","tags":[1]}',), (None,), ("{}",)], "r STRING")
    assert [tuple(r) for r in R.project(good, schema, "r").collect()] == [(1, None), (None, [1]), (None, None), (None, None)]
    for text in ("<html>", '{"id":1', "nothing"):
        with pytest.raises(Exception, match="invalid JSON"):
            R.project(spark.createDataFrame([(text,)], "r STRING"), schema, "r").collect()


def test_projection_and_union(spark):
    posts = spark.createDataFrame([('{"id":1,"title":"t","more":2}',), ("{}",)], "r STRING").coalesce(1)
    rows = R.project(posts, "userId INT, id INT, title STRING, body STRING", "r").collect()
    assert [tuple(r) for r in rows] == [(None, 1, "t", None), (None, None, None, None)]
    one, two = spark.range(2).toDF("a"), spark.sql("SELECT 'x' AS b")
    both = R.append_endpoints(one, one, two)
    assert both.columns == ["a", "b"] and both.count() == 5


def test_leaves_read_the_input_once(values):
    plan = leaves(values('{"a":1}'), keep=("n",), depth=4)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1
