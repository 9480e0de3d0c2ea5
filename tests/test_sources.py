"""Sources: planner, pushdown, options, transports, readers."""

import json

import pytest
import requests
from pyspark.sql import types as T
from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNotNull, LessThanOrEqual, StringContains

from sluice.operators import filters, records as R
from sluice.sources.fetch import Fetcher, page_location
from sluice.sources.options import PageOptions, Request, join_url, parse_request
from sluice.sources.pages import PruningPageReader, in_batches, read_range
from sluice.sources.planner import page_ranges
from sluice.sources.readers import land, read_pages, read_table

ITEMS = [{"data": [{"sku": 11, "label": "lamp"}]}, {"data": [{"sku": 12, "label": "chair"}, {"sku": 13}]}]


def test_every_page_is_planned_once():
    for n in range(51):
        for concurrency in range(1, 11):
            ranges = page_ranges(3, n, concurrency)
            assert [p for a, b in ranges for p in range(a, b + 1)] == list(range(3, 3 + n))
    assert len(page_ranges(1, 10, 4)) == 5 and len(page_ranges(1, 2, 4)) == 2 and page_ranges(1, 0, 4) == []
    with pytest.raises(ValueError):
        page_ranges(1, 1, 0)


def reader(**options):
    return PruningPageReader(PageOptions.parse({"base_url": "b", **{k: str(v) for k, v in options.items()}}))


def test_pushed_filters_prune_endpoints_and_pages():
    r = reader(endpoints=json.dumps(["a", "b", "c"]), max_pages=10, concurrency=1)
    kept = list(r.pushFilters([
        IsNotNull(("endpoint",)), In(("endpoint",), ("a", "c", "x")), GreaterThan(("page",), 3),
        LessThanOrEqual(("page",), 7), EqualTo(("status",), 200), StringContains(("endpoint",), "a")]))
    assert kept == [EqualTo(("status",), 200), StringContains(("endpoint",), "a")]
    assert [(p.endpoint, p.start_page, p.end_page) for p in r.partitions()] == [("a", 4, 7), ("c", 4, 7)]
    assert list(r.pushFilters([EqualTo(("page",), 99)])) == [] and r.partitions() == []
    assert list(r.read(None)) == []


def test_options():
    assert join_url("http://h/v1/", "/x/") == "http://h/v1/x" and join_url("http://h/v1/", "") == "http://h/v1"
    r = parse_request("u", {
        "params": '{"Q":"1","start":"old"}', "param.k": "v", "headers": '{"Accept":"json"}', "header.x": "y",
        "auth_token": "Bearer t", "auth.username": "me", "auth.password": "pw", "history_start": "2020-01-01",
        "history_end": "2020-12-31", "timeout": "5", "retries": "0"})
    assert r.params == {"Q": "1", "start": "2020-01-01", "end": "2020-12-31", "k": "v"}
    assert r.headers == {"Accept": "json", "x": "y", "Authorization": "Bearer t"}
    assert (r.auth, r.timeout, r.retries, r.backoff) == (("me", "pw"), 5.0, 0, 1.0)
    assert parse_request("u", {}).auth is None and parse_request("u", {}).timeout == 30
    for bad in ({"concurrency": 0}, {"max_pages": -1}):
        with pytest.raises(ValueError):
            reader(**bad)
    with pytest.raises(ValueError, match="base_url"):
        PageOptions.parse({})


def test_secrets_come_from_the_environment(monkeypatch):
    monkeypatch.setenv("API_TOKEN", "secret")
    assert parse_request("u", {"auth_token_env": "API_TOKEN"}).headers == {"Authorization": "secret"}
    with pytest.raises(ValueError, match="NO_SUCH"):
        parse_request("u", {"auth_token_env": "NO_SUCH"})


class Canned(requests.adapters.BaseAdapter):
    """Answers from a list, in this process; keeps the requests."""

    def __init__(self, answers):
        super().__init__()
        self.answers, self.seen = list(answers), []

    def send(self, request, **options):
        self.seen.append((request, options))
        status, body = self.answers.pop(0)
        if status is None:
            raise body
        answer = requests.Response()
        answer.status_code, answer._content, answer.url, answer.request = status, body, request.url, request
        return answer

    def close(self):
        pass


def http(answers, **options):
    fetcher, adapter = Fetcher(), Canned(answers)
    fetcher.session = requests.Session()
    fetcher.session.mount("http://", adapter)
    request = Request("http://api.test/items", backoff=0, **options)
    return fetcher, adapter, request


def test_http_request():
    fetcher, adapter, request = http(
        [(200, '["é"]'.encode())], params={"q": "x"}, headers={"Accept": "json"}, auth=("me", "pw"), timeout=7)
    assert fetcher.page(request, 3) == (200, '["é"]', None)
    sent, options = adapter.seen[0]
    assert sent.url == "http://api.test/items?q=x&page=3" and sent.headers["Accept"] == "json"
    assert sent.headers["Authorization"].startswith("Basic ") and options["timeout"] == 7


def test_http_retries_then_reports():
    fetcher, adapter, request = http([(500, b""), (429, b""), (200, b"[]")])
    assert fetcher.page(request, 1) == (200, "[]", None) and len(adapter.seen) == 3
    fetcher, adapter, request = http([(503, b"x")] * 3)
    assert fetcher.page(request, 1) == (503, "x", None) and len(adapter.seen) == 3
    for status in (404, 504, 401):
        fetcher, adapter, request = http([(status, b"")])
        assert fetcher.page(request, 1)[0] == status and len(adapter.seen) == 1
    fetcher, adapter, request = http([(None, requests.ConnectionError("gone"))] * 3)
    assert fetcher.page(request, 1) == (None, None, "ConnectionError: gone") and len(adapter.seen) == 3
    fetcher, adapter, request = http([(None, requests.ReadTimeout("slow"))] * 3)
    assert fetcher.page(request, 1) == (None, None, "ReadTimeout: slow") and len(adapter.seen) == 3
    fetcher, adapter, request = http([(None, requests.ReadTimeout("slow")), (200, b"[]")])
    assert fetcher.page(request, 1) == (200, "[]", None)
    fetcher, adapter, request = http([(None, requests.TooManyRedirects("loop"))])
    assert fetcher.page(request, 1) == (None, None, "TooManyRedirects: loop")
    fetcher, _, request = http([(200, b"\xff")])
    assert "UnicodeDecodeError" in fetcher.page(request, 1)[2]


def test_global_rate_is_never_exceeded(monkeypatch):
    """All tasks together, on a clock of their own each, started at the same time."""
    times = []
    for index in range(4):
        clock = [0.0]
        monkeypatch.setattr("time.monotonic", lambda: clock[0])
        monkeypatch.setattr("time.sleep", lambda s: clock.__setitem__(0, clock[0] + s))
        fetcher = Fetcher(rate=2.0, index=index, count=4)
        for _ in range(5):
            fetcher._wait_for_token()
            times.append(clock[0])
    times.sort()
    for n, t in enumerate(times):
        assert t >= n / 2.0 - 1e-6


def test_batches_are_bounded():
    rows = [("e", n, 200, "x" * (3 << 20), None) for n in range(5)]
    assert [b.num_rows for b in in_batches(rows)] == [2, 2, 1]
    assert [b.num_rows for b in in_batches([("e", n, 200, None, None) for n in range(1500)])] == [1024, 476]


def test_file_pages(page_files):
    base = page_files("items", ITEMS)
    options = PageOptions.parse({"base_url": base, "endpoint": "items", "max_pages": "3"})
    part = reader(endpoint="items", max_pages=3, concurrency=1).partitions()[0]
    rows = [r for b in read_range(options, part) for r in b.to_pylist()]
    assert [(r["page"], r["status"], r["error"]) for r in rows] == [(1, 200, None), (2, 200, None), (3, 404, None)]
    assert json.loads(rows[0]["body"]) == ITEMS[0]
    assert page_location(Request("/x", page_param="p"), 2) == "/x/p=2"
    assert Fetcher().page(Request(f"file:{base}/items"), 1)[0] == 200
    assert Fetcher().page(Request(f"file://{base}/items"), 1)[0] == 200


def test_scan_partitions_and_pruned_pages(spark, page_files):
    base = page_files("items", [[n] for n in range(1, 11)])
    df = read_pages(spark, base, endpoint="items", max_pages=10, concurrency=4)
    assert df.rdd.getNumPartitions() == 5
    assert df.count() == 10
    for n, condition in ((1, "page = 7 AND endpoint = 'items'"), (0, "page > 99"), (1, "endpoint = 'x' OR page = 2"), (10, "true")):
        assert df.where(condition).count() == n

    def scan(*where):
        return read_pages(spark, base, where=where, endpoints=["items", "none"], max_pages=10, concurrency=4)

    one = scan(("page", "=", 7), ("endpoint", "=", "items"))
    assert one.rdd.getNumPartitions() == 1
    assert [(r["page"], r["body"]) for r in one.collect()] == [(7, "[7]")]
    some = scan(("page", ">", 2), ("page", "<", 6), ("endpoint", "in", ["items"]), ("status", "=", 200))
    assert sorted(r["page"] for r in some.collect()) == [3, 4, 5]
    assert scan(("page", ">=", 10), ("page", "<=", 10)).count() == 2
    assert scan(("endpoint", "=", "other")).count() == 0 and scan(("page", "=", 99)).count() == 0


def test_filters_pushed_into_the_source(spark, page_files):
    base = page_files("items", [[n] for n in range(1, 11)])
    df = read_pages(spark, base, endpoint="items", max_pages=10, concurrency=4, filter_pushdown="true")
    one = df.where("page = 7 AND endpoint = 'items' AND status = 200")
    assert one.rdd.getNumPartitions() == 1
    assert [(r["page"], r["body"]) for r in one.collect()] == [(7, "[7]")]


def test_raw_record_source(spark, page_files):
    base = page_files("items", [[{"a": 1.0, "é": [1]}, "x", None], {"a": {}}])
    load = spark.read.format("restapi").option("schemaname", "skema")
    df = load.option("url", f"{base}/items/page=1").load()
    assert df.schema == T.StructType([T.StructField("skema", T.StringType(), True)])
    assert [r["skema"] for r in df.collect()] == ['{"a":1.0,"é":[1]}', '"x"', "null"]
    assert [r["skema"] for r in load.option("url", f"{base}/items/page=2").load().collect()] == ['{"a":{}}']
    with pytest.raises(Exception, match="HTTP 404"):
        load.option("url", f"{base}/items/page=9").load().collect()
    with pytest.raises(Exception, match="schemaname is required"):
        spark.read.format("restapi").option("url", "u").load()


def test_fixed_schema_source(spark, tmp_path):
    (tmp_path / "posts").write_text('[{"userId":1,"id":2,"title":"t","body":"b","x":0},{"id":3}]')
    df = spark.read.format("myrestdatasource").option("base_url", str(tmp_path)).load()
    assert df.columns == ["userId", "id", "title", "body"]
    assert [tuple(r) for r in df.collect()] == [(1, 2, "t", "b"), (None, 3, None, None)]


def test_read_table_infers(spark, page_files):
    base = page_files("items", ITEMS)
    options = {"endpoint": "items", "json_path": "data", "max_pages": 2}
    typed = read_table(spark, base, infer_types=True, **options)
    assert typed.schema.simpleString() == "struct<label:string,sku:bigint>"
    assert sorted(typed.collect(), key=lambda r: r["sku"]) == [("lamp", 11), ("chair", 12), (None, 13)]
    assert read_table(spark, base, **options).schema.simpleString() == "struct<label:string,sku:string>"
    first = read_table(spark, page_files("more", [[{"a": 1}], [{"b": 1}]]), "more", from_first_record=True, max_pages=2)
    assert first.columns == ["a"] and first.count() == 2


def test_read_table_with_schema(spark, page_files):
    base = page_files("items", ITEMS)
    schema = T.StructType().add("label", T.StringType()).add("sku", T.StringType()).add("none", T.LongType())
    df = read_table(spark, base, "items", schema=schema, json_path="data", max_pages=2)
    assert sorted(tuple(r) for r in df.select("sku", "label", "none").collect()) == [
        ("11", "lamp", None), ("12", "chair", None), ("13", None, None)]
    for infer in ({"schema": schema}, {}):
        with pytest.raises(Exception, match="items page 3: HTTP 404"):
            read_table(spark, base, "items", json_path="data", max_pages=3, **infer).collect()


def test_empty_endpoint_has_no_columns(spark, page_files):
    assert read_table(spark, page_files("none", [{"data": []}]), "none", json_path="data").columns == []


def test_filters(spark):
    df = spark.createDataFrame(
        [(1, "a", True, None), (2, "b", False, 1.0), (3, None, None, 2.5)], "id LONG, `u.name` STRING, ok BOOLEAN, x DOUBLE")

    def ids(*triples):
        return sorted(r["id"] for r in filters.where(df, triples).collect())

    assert ids() == [1, 2, 3]
    assert ids(("u.name", "=", "a")) == [1] and ids(("id", "=", "2")) == [2] and ids(("ok", "=", True)) == [1]
    assert ids(("x", "=", 1.0)) == [2] and ids(("u.name", "=", None)) == [3] and ids(("u.name", "=", "None")) == []
    assert ids(("id", "in", [1, "3"]), ("u.name", "in", ["a", "b"])) == [1]
    assert ids(("x", ">", 1)) == [3] and ids(("x", ">=", 1), ("id", "<", 3)) == [2] and ids(("id", "<=", 1)) == [1]
    for bad in (("id", "="), "id=1", (1, "=", 1), ("id", "like", "x"), ("id", "in", "abc")):
        with pytest.raises(ValueError):
            ids(bad)


def test_filters_on_values(values):
    records = values('{"u":{"n":1.0},"t":"x"}', '{"u":{"n":5},"t":null}', '{"u.n":7}')

    def ns(*triples):
        return sorted(r["n"] for r in filters.where_value(records, triples).collect())

    assert ns(("u.n", "=", "1.0")) == [0] and ns(("u.n", "in", [5, 7])) == [1, 2] and ns(("u.n", ">", 1)) == [1, 2]
    assert ns(("t", "=", None)) == [1, 2] and ns(("t", "=", "x"), ("u.n", "<", 2)) == [0]


def test_landing_asks_once(spark, page_files):
    landed = land(read_pages(spark, page_files("items", ITEMS + ["{bad", ""]), endpoint="items", max_pages=5))
    rows = landed.orderBy("page").select("page", "status", "n_items", "error").collect()
    assert [tuple(r) for r in rows] == [
        (1, 200, 1, None), (2, 200, 2, None), (3, 200, None, "invalid JSON"), (4, 200, None, "invalid JSON"),
        (5, 404, None, None)]
    assert "parquet" in landed._jdf.queryExecution().executedPlan().toString().lower()


def test_failed_pages_are_never_records(spark):
    columns = "endpoint STRING, page INT, status INT, body STRING, error STRING"
    good = ("e", 1, 200, '{"data":[{"a":1}]}', None)
    bad = [("e", 2, 500, '{"message":"boom"}', None), ("e", 2, None, None, "ReadTimeout"), ("e", 2, 200, None, None),
           ("e", 2, 200, "<html>", None)]
    for row in bad:
        pages = spark.createDataFrame([good, row], columns)
        for read in (R.unwrap, lambda p: R.records_at(p, "data"), lambda p: R.raw_records(p, "r")):
            with pytest.raises(Exception, match="e page 2|invalid JSON"):
                read(pages).collect()
    assert R.unwrap(spark.createDataFrame([good], columns)).count() == 1


def test_fractional_page_bounds(spark, page_files):
    base = page_files("items", [[n] for n in range(1, 5)])
    for op, wanted, found in (("<", 2.5, [1, 2]), ("<=", 2.5, [1, 2]), (">", 2.5, [3, 4]), (">=", 2.5, [3, 4]), ("=", 2.5, []), ("=", None, [])):
        df = read_pages(spark, base, where=[("page", op, wanted)], endpoint="items", max_pages=4)
        assert sorted(r["page"] for r in df.collect()) == found


def test_typed_filters_reach_the_scan(spark, tmp_path):
    spark.sql("SELECT CAST(id AS DOUBLE) AS x, id AS n, CAST(id AS STRING) AS s FROM range(200)").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    for triple in (("x", "=", 100), ("n", "in", [100, 100.0]), ("s", "=", "100"), ("n", "=", "100")):
        assert [r["n"] for r in filters.where(df, [triple]).collect()] == [100]
    plan = filters.where(df, [("n", "in", [7, 77])])._jdf.queryExecution().toString()
    assert "In(n, [7,77])" in plan
