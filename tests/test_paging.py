"""Stop rules, incidents, catalogue, job, stream, sinks (P, K, C, T, S5-S6, S9, U1)."""

import json
import random

import pytest
from pyspark.sql import functions as F

from sluice.operators.paging import failed_pages, good_pages, plan_partitions, trim_pages
from sluice.operators.records import decode
from sluice.operators.sinks import page_incidents, read_records, write_json, write_records
from sluice.plans.catalogue import catalogue_rows, history_violations, in_history_window, read_catalogue
from sluice.plans.job import IngestFailed, run_ingest
from sluice.sources import intervals as I
from sluice.sources.options import PageOptions
from sluice.sources.requests_table import plan_requests
from sluice.sources.planner import PageRange, page_ranges
from sluice.sources.readers import land
from sluice.streaming.ingest import stream_pages, stream_to_table
from sluice.streaming.page_stream import PageStreamReader, holds_records

PAGES = [
    # stops at the empty page 3; the failure behind it does not count
    ("empty", 1, 200, "[1]", None), ("empty", 2, 200, "[2]", None), ("empty", 3, 200, '{"data":[]}', None),
    ("empty", 4, 500, None, None), ("empty", 5, 200, "[5]", None),
    # stops at 404
    ("gone", 1, 200, "[1]", None), ("gone", 2, 404, None, None), ("gone", 3, 200, "[3]", None),
    # failures before the end do count, and do not end the endpoint
    ("bad", 1, 500, "oops", None), ("bad", 2, None, None, "ReadTimeout: x"), ("bad", 3, 200, "{", None),
    ("bad", 4, 200, None, None), ("bad", 5, 200, "[5]", None),
]


@pytest.fixture
def pages(spark):
    return land(spark.createDataFrame(PAGES, "endpoint STRING, page INT, status INT, body STRING, error STRING"))


def test_trimming(pages):
    trimmed = trim_pages(pages)
    kept = sorted((r["endpoint"], r["page"]) for r in trimmed.collect())
    assert kept == [("bad", n) for n in range(1, 6)] + [("empty", 1), ("empty", 2), ("gone", 1)]
    good = sorted((r["endpoint"], r["page"]) for r in good_pages(trimmed).collect())
    assert good == [("bad", 5), ("empty", 1), ("empty", 2), ("gone", 1)]
    incidents = page_incidents(failed_pages(trimmed)).orderBy("page").collect()
    assert [r["description"] for r in incidents] == [
        "bad page 1: HTTP 500", "bad page 2: ReadTimeout: x", "bad page 3: invalid JSON", "bad page 4: empty response"]
    assert {r["short_description"] for r in incidents} == {"API Ingestion Job Failed"}


def test_one_endpoint_with_most_pages(spark):
    """Brute force over a third of all pages in one endpoint."""
    rows = [("hot" if n % 3 == 0 else f"e{n % 50}", n, 404 if n in (700, 699, 301) else 200, "[1]", None) for n in range(900)]
    landed = land(spark.createDataFrame(rows, "endpoint STRING, page INT, status INT, body STRING, error STRING"))
    stops = {}
    for endpoint, page, status, _, _ in rows:
        if status == 404:
            stops[endpoint] = min(page, stops.get(endpoint, page))
    expected = sorted((e, p) for e, p, _, _, _ in rows if p < stops.get(e, 10**9))
    assert sorted((r["endpoint"], r["page"]) for r in trim_pages(landed).collect()) == expected


def test_partition_plan_is_the_planners(spark):
    endpoints = spark.range(0, 51).toDF("n")
    for concurrency in (1, 3, 4, 10):
        rows = plan_partitions(endpoints, "n", concurrency, start_page=2).orderBy("n", "part").collect()
        found = {}
        for r in rows:
            found.setdefault(r["n"], []).append((r["start_page"], r["end_page"]))
        assert found == {n: page_ranges(2, n, concurrency) for n in range(1, 51)}
    with pytest.raises(ValueError):
        plan_partitions(endpoints, "n", 0)


def config(base_url="https://shop.test/v2", history=None, endpoints=None):
    return {"ingest-souce-config": {
        "app-name": "app", "base-url": base_url,
        "history-load": history or {"enabled": True, "start_date": "2019-04-01", "end_date": "2019-06-30"},
        "endpoints": endpoints or [
            {"endpoint-name": "", "params": {}, "headers": {"X-Shop": "north"},
             "auth": {"username": "", "password": "clear text"}},
            {"endpoint-name": "stock", "params": {"start": "x", "q": 1}, "headers": {}}]}}


def test_catalogue_and_requests(spark, tmp_path):
    (tmp_path / "config.json").write_text(json.dumps(config(), indent=2))
    rows = read_catalogue(spark, str(tmp_path / "config.json")).orderBy("endpoint").collect()
    assert [(r["app_name"], r["endpoint"], r["headers"], r["history_enabled"], r["start_date"], r["end_date"]) for r in rows] == [
        ("app", "", {"X-Shop": "north"}, True, "2019-04-01", "2019-06-30"),
        ("app", "stock", {}, True, "2019-04-01", "2019-06-30")]
    assert "clear text" not in str(rows)
    requests = plan_requests(read_catalogue(spark, str(tmp_path)), 1, 2).orderBy("url", "page").collect()
    window = {"start": "2019-04-01", "end": "2019-06-30"}
    assert [(r["url"], r["page"], r["params"]) for r in requests] == [
        ("https://shop.test/v2", 1, window), ("https://shop.test/v2", 2, window),
        ("https://shop.test/v2/stock", 1, {"q": "1", **window}),
        ("https://shop.test/v2/stock", 2, {"q": "1", **window})]
    assert plan_requests(read_catalogue(spark, str(tmp_path)), 1, 0).count() == 0
    (tmp_path / "old.json").write_text('{"url": {"endpoints": []}}')
    with pytest.raises(Exception, match="ingest-souce-config"):
        read_catalogue(spark, str(tmp_path / "old.json")).collect()


def test_both_spellings_of_history_dates(spark):
    for history in ({"enabled": "yes", "start-date": "a", "end-date": "b"}, {"enabled": "1", "start_date": "a", "end_date": "b"}):
        df = spark.createDataFrame([(json.dumps(config(history=history)),)], "t STRING")
        assert {(r["history_enabled"], r["start_date"], r["end_date"]) for r in catalogue_rows(df, "t").collect()} == {(True, "a", "b")}
    df = spark.createDataFrame([(json.dumps(config(history={"enabled": "perhaps"})),)], "t STRING")
    with pytest.raises(Exception, match="Invalid boolean value"):
        catalogue_rows(df, "t").collect()


def test_history_violations(spark):
    rows = [(0, "true", "a", "b"), (1, "yes", "", "b"), (2, "Y", None, None), (3, "n", None, None), (4, "bad", "a", "b"), (5, None, "a", "b")]
    found = history_violations(spark.createDataFrame(rows, "n INT, enabled STRING, start_date STRING, end_date STRING"))
    assert [(r["n"], r["problem"], r["missing"]) for r in found.orderBy("n").collect()] == [
        (1, "missing dates", ["start-date"]), (2, "missing dates", ["start-date", "end-date"]),
        (4, "invalid flag", []), (5, "invalid flag", [])]


def test_history_window(spark):
    df = spark.sql("SELECT explode(array('2019-12-31 23:59:59', '2020-01-01', '2020-12-31 23:59:59.9', '2021-01-01')) AS s")
    kept = df.where(in_history_window(F.col("s").cast("timestamp"), "2020-01-01", "2020-12-31"))
    assert [r["s"] for r in kept.collect()] == ["2020-01-01", "2020-12-31 23:59:59.9"]


def test_job(spark, page_files, tmp_path):
    page_files("people", [[{"id": 1}], {"data": [{"id": 2}, {"id": 3}]}, []])
    base = page_files("", [{"name": "é"}])
    document = config(base, {"enabled": False}, [{"endpoint-name": "people"}, {"endpoint-name": ""}])
    (tmp_path / "c.json").write_text(json.dumps(document))
    paths = run_ingest(spark, str(tmp_path / "c.json"), str(tmp_path / "out"), max_pages=5, tasks=3)
    records = read_records(spark, paths["records"]).collect()
    assert sorted((r["endpoint"], r["record"]) for r in records) == [
        ("", '{"name":"é"}'), ("people", '{"id":1}'), ("people", '{"id":2}'), ("people", '{"id":3}')]
    assert spark.read.parquet(paths["incidents"]).count() == 0


def test_job_reports_and_fails(spark, page_files, tmp_path):
    base = page_files("people", [[{"id": 1}], "{bad", [{"id": 3}], []])
    (tmp_path / "c.json").write_text(json.dumps(config(base, {"enabled": False}, [{"endpoint-name": "people"}])))
    run = dict(spark=spark, catalogue=str(tmp_path / "c.json"), out=str(tmp_path / "out"), max_pages=6, tasks=2)
    with pytest.raises(IngestFailed, match="1 pages or values could not be read"):
        run_ingest(**run)
    paths = run_ingest(**run, on_error="quarantine")
    assert [r["description"] for r in spark.read.parquet(paths["incidents"]).collect()] == ["people page 2: invalid JSON"]
    assert spark.read.text(paths["records"]).count() == 2
    with pytest.raises(ValueError):
        run_ingest(**run, on_error="ignore")


def test_stream_reads_each_page_once(spark, page_files, tmp_path):
    base = page_files("items", [[n] for n in range(1, 11)])
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run(max_pages):
        stream_to_table(spark, base, out, checkpoint, endpoint="items", max_pages=max_pages)
        return sorted(r["page"] for r in spark.read.parquet(out).collect())

    assert run(4) == [1, 2, 3, 4]
    assert run(4) == [1, 2, 3, 4]
    assert run(10) == list(range(1, 11))


def test_stream_waits_for_later_pages(spark, page_files, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run(contents):
        base = page_files("items", contents)
        stream_to_table(spark, base, out, checkpoint, endpoint="items", max_pages=9)
        return sorted(r["page"] for r in spark.read.parquet(out).collect())

    assert run([[1], [2]]) == [1, 2]
    assert run([[1], [2]]) == [1, 2]
    assert run([[1], [2], [3], [4], [5], []]) == [1, 2, 3, 4, 5]
    # Pages that are gone for a while are not read again when they are back.
    assert run([[], [2], [3], [4], [5]]) == [1, 2, 3, 4, 5]
    assert run([[1], [2], [3], [4], [5], [6]]) == [1, 2, 3, 4, 5, 6]


def page_api(reader, pages, asked):
    """Makes `reader` ask for pages of a set in place of an API."""
    reader.fetcher.page = lambda _, page: (asked.append(page), (200, "[1]", None) if page in pages else (200, "[]", None))[1]


def offset(read, again="", round_=1):
    return {"": {"read": read, "again": again, "round": round_}}


def test_stream_finds_the_end(tmp_path):
    for state in ({}, {"state_path": str(tmp_path / "s")}):
        for last in range(41):
            asked = []
            reader = PageStreamReader(PageOptions.parse({"base_url": "file:/none", "max_pages": "40", **state}))
            page_api(reader, set(range(1, last + 1)), asked)
            assert reader.latestOffset() == (offset(f"1-{last}" if last > 1 else "1") if last else reader.initialOffset())
            assert len(asked) <= (30 if state else last + 4)


def test_stream_offsets_hold_the_gaps(tmp_path):
    options = PageOptions.parse({"base_url": "file:/none", "max_pages": "40", "concurrency": "1", "state_path": str(tmp_path / "s")})
    reader, there, asked = PageStreamReader(options), {1, 2, 4, 5, 6}, []
    page_api(reader, there, asked)
    first = reader.latestOffset()
    assert first == offset("1-6")
    (task,) = reader.partitions(reader.initialOffset(), first)
    # The task notes what holds nothing; what was planned is taken back out.
    reader.log.note(task, I.of_numbers([3]))
    second = reader.latestOffset()
    assert second == offset("1-2,4-6", round_=2) and reader.partitions(first, second) == []
    assert reader.latestOffset() == second
    there |= {3, 7}
    third = reader.latestOffset()
    assert third == offset("1-7", round_=3)
    assert [(p.start_page, p.end_page) for p in reader.partitions(second, third)] == [(3, 3), (7, 7)]
    # A page that is there when its gap is found is asked for again at once, also after a restart.
    reader.log.note(PageRange("", 7, 7, round=3), [(7, 7)])
    reader = PageStreamReader(options)
    page_api(reader, there, asked)
    fourth = reader.latestOffset()
    assert fourth == offset("1-7", "7", 4)
    assert [(p.start_page, p.end_page) for p in reader.partitions(third, fourth)] == [(7, 7)]
    # Offsets of earlier versions held the next page.
    assert [(p.start_page, p.end_page) for p in reader.partitions({"": 4}, fourth)] == [(4, 7)]


def test_stream_delivers_a_late_page_once(spark, page_files, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run(contents, first=1):
        base = page_files("items", contents, first)
        stream_to_table(spark, base, out, checkpoint, endpoint="items", max_pages=20)
        return sorted(r["page"] for r in spark.read.parquet(out).collect())

    assert run([[1], [2], [], [4], [5], [6]]) == [1, 2, 4, 5, 6]
    assert run([[]], 3) == [1, 2, 4, 5, 6]
    assert run([[3]], 3) == [1, 2, 3, 4, 5, 6]
    assert run([[3], [4], [5], [6], [7]], 3) == [1, 2, 3, 4, 5, 6, 7]
    # More pages missing in a row than are looked past: the endpoint waits there.
    assert run([[12]], 12) == [1, 2, 3, 4, 5, 6, 7]
    assert run([[8], [9], [10], [11]], 8) == list(range(1, 13))


def test_intervals():
    r = random.Random(2)
    for _ in range(300):
        a, b = ({r.randint(0, 30) for _ in range(r.randint(0, 20))} for _ in range(2))
        x, y = I.of_numbers(a), I.of_numbers(b)
        assert set(I.numbers(x)) == a and I.from_text(I.to_text(x)) == x and I.count(x) == len(a)
        assert I.minus(x, y) == I.of_numbers(a - b) and I.union(x, y) == I.of_numbers(a | b)
    assert I.to_text([(1, 4), (6, 6)]) == "1-4,6" and I.from_text("") == [] and I.normal([(3, 1)]) == []


def test_pages_that_hold_records():
    assert holds_records(200, '{"data":[1]}', None) and holds_records(200, "{bad", None) and holds_records(200, "{}", None)
    for body in ("[]", '"[]"', '{"data":[]}', "null", None):
        assert not holds_records(200, body, None)
    assert not holds_records(500, "[1]", None) and not holds_records(200, "[1]", "timeout")


def test_stream_admission(spark, page_files, tmp_path):
    base = page_files("items", [[n] for n in range(1, 8)])
    sizes = []
    pages = stream_pages(spark, base, endpoint="items", max_pages=7, max_pages_per_trigger=3)
    query = pages.writeStream.foreachBatch(lambda df, _: sizes.append(df.count())).option(
        "checkpointLocation", str(tmp_path / "c")).trigger(processingTime="0 seconds").start()
    query.processAllAvailable()
    query.stop()
    assert [s for s in sizes if s] == [3, 3, 1]


def test_json_sink(spark, tmp_path):
    df = spark.createDataFrame([("a/b", "é", None), ("c", "x", 1)], "endpoint STRING, s STRING, n INT")
    path = str(tmp_path / "new" / "out")
    for _ in range(2):
        write_json(df, path, ["endpoint"])
    rows = spark.read.schema("endpoint STRING, s STRING, n INT").json(path).collect()
    assert sorted((r["endpoint"], r["s"], r["n"]) for r in rows) == [("a/b", "é", None), ("c", "x", 1)]
    text = {r["value"] for r in spark.read.text(path).collect()}
    assert text == {'{"s":"é","n":null}', '{"s":"x","n":1}'}


def test_endpoint_names_survive_the_sink(spark, tmp_path):
    names = ["", "007", "2020", "1e3", "a/b c=d", "null", "__HIVE_DEFAULT_PARTITION__"]
    rows = spark.createDataFrame([(n, '{"a":1}') for n in names], "endpoint STRING, body STRING")
    write_records(decode(rows, "body"), str(tmp_path / "r"))
    assert sorted(r["endpoint"] for r in read_records(spark, str(tmp_path / "r")).collect()) == sorted(names)


def test_job_refuses_what_would_mix_up_pages(spark, tmp_path):
    two = [(json.dumps(config(f"/api/{n}", {"enabled": False}, [{"endpoint-name": "items"}])),) for n in "ab"]
    window = [(json.dumps(config("/api", {"enabled": True, "start_date": "2020-01-01"})),)]
    for documents, message in ((two, "name the endpoint 'items'"), (window, "needs a start and an end date")):
        catalogue = catalogue_rows(spark.createDataFrame(documents, "t STRING"), "t")
        with pytest.raises(ValueError, match=message):
            run_ingest(spark, catalogue, str(tmp_path / "out"))
