"""Waves of requests, retries, shared rates, the typed job and its commit (S5, S7, S8, P1-P3, C3, K3, R6f)."""

import json
import os
import sys
import time
from collections import Counter, deque

import pytest
import requests
from pyspark import cloudpickle
from pyspark.sql import functions as F, types as T

from sluice.plans import job
from sluice.plans.catalogue import catalogue_rows
from sluice.plans.job import IngestFailed, finished_runs, last_run, read_typed, run_ingest, typed_rows
from sluice.operators.paging import failed_pages, good_pages, trim_pages
from sluice.operators.records import decode, records_of
from sluice.operators.sinks import read_records
from sluice.sources.fetch import Fetcher, retry_after
from sluice.sources.pacing import paced, share_times
from sluice.sources.requests_table import endpoint_requests, fetch_pages, plan_requests
from sluice.sources.waves import fetch_in_waves

# Workers get the adapter below as code.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Logged(requests.adapters.BaseAdapter):
    """An API in the worker's process: `answer(url, times asked before)` gives status, body and headers;
    each request is a file in `folder`."""

    def __init__(self, folder, answer):
        super().__init__()
        self.folder, self.answer = folder, answer

    def send(self, request, **options):
        name = request.url.split("//")[1].replace("/", "_")
        before = sum(f.startswith(name + "@") for f in os.listdir(self.folder))
        open(f"{self.folder}/{name}@{time.time():.4f}-{os.getpid()}", "w").close()
        status, body, headers = self.answer(request.url, before)
        response = requests.Response()
        response.status_code, response._content, response.url, response.request = status, body.encode(), request.url, request
        response.headers.update(headers)
        return response

    def close(self):
        pass


def api(folder, answer):
    folder = str(folder)

    def new_session():
        session = requests.Session()
        session.mount("http://", Logged(folder, answer))
        return session

    return new_session


def asked(folder):
    """[(url, time)] in order."""
    found = [f.rsplit("@", 1) for f in os.listdir(folder)]
    return sorted(((n, float(t.split("-")[0])) for n, t in found), key=lambda x: x[1])


def catalogue(spark, *endpoints, base="http://api.test", **auth):
    listed = [{"endpoint-name": e, **({"auth": auth} if auth else {})} for e in endpoints]
    document = {"ingest-souce-config": {"app-name": "a", "base-url": base, "endpoints": listed}}
    return catalogue_rows(spark.createDataFrame([(json.dumps(document),)], "t STRING"), "t")


def counting(sizes):
    def answer(url, before):
        name, page = url.split("/")[3].split("?page=")
        return (200, f'[{{"n":{page}}}]', {}) if int(page) <= sizes[name] else (404, "", {})

    return answer


def test_waves_ask_for_twice_the_pages_at_most(spark, tmp_path):
    sizes = {"none": 0, "one": 1, "seven": 7, "eight": 8, "many": 90}
    (tmp_path / "log").mkdir()
    pages = fetch_in_waves(endpoint_requests(catalogue(spark, *sizes)), str(tmp_path / "raw"), 4, max_pages=10**9,
                           new_session=api(tmp_path / "log", counting(sizes)))
    found = Counter(r["endpoint"] for r in trim_pages(pages).collect())
    assert found == {e: n for e, n in sizes.items() if n}
    requested = Counter(n.split("_")[1].split("?")[0] for n, _ in asked(tmp_path / "log"))
    assert all(requested[e] <= max(1, 2 * n) for e, n in sizes.items())
    assert max(Counter(n for n, _ in asked(tmp_path / "log")).values()) == 1
    assert records_of(good_pages(trim_pages(pages))).count() == sum(sizes.values())


def test_waves_stay_below_the_last_page(spark, page_files, tmp_path):
    base = page_files("a", [[n] for n in range(9)], first=3)
    for most in (0, 1, 6):
        pages = fetch_in_waves(endpoint_requests(catalogue(spark, "a", base=base)), str(tmp_path / f"raw{most}"), 2, 3, most)
        assert sorted(r["page"] for r in pages.collect()) == list(range(3, 3 + most))


def test_retry_after_is_a_time_not_a_sleep(spark, tmp_path):
    """Page 2 is refused twice; pages 3 to 8 do not wait for it."""

    def answer(url, before):
        page = int(url.split("page=")[1])
        if page == 2 and before < 2:
            return 429, "", {"Retry-After": "2"}
        if page == 4:
            return 503, "down", {}
        return (200, f"[{page}]", {}) if page <= 8 else (404, "", {})

    (tmp_path / "log").mkdir()
    pages = fetch_in_waves(endpoint_requests(catalogue(spark, "x")), str(tmp_path / "raw"), 2, max_pages=1000, backoff=0.01,
                           new_session=api(tmp_path / "log", answer))
    trimmed = trim_pages(pages)
    assert sorted(r["page"] for r in good_pages(trimmed).collect()) == [1, 2, 3, 5, 6, 7, 8]
    assert [(r["page"], r["status"]) for r in failed_pages(trimmed).collect()] == [(4, 503)]
    log = asked(tmp_path / "log")
    times = [t for n, t in log if n.endswith("page=2")]
    assert len(times) == 3 and all(b - a >= 2 for a, b in zip(times, times[1:]))
    assert sum(n.endswith("page=4") for n, _ in log) == 3
    assert sum(n.split("page=")[1] not in ("2", "4") for n, _ in log) <= 16


def test_retries_behind_the_end_are_dropped(spark, tmp_path):
    def answer(url, before):
        page = int(url.split("page=")[1])
        return {1: (200, "[1]", {}), 2: (200, "[2]", {}), 3: (200, "[]", {})}.get(page, (429, "", {"Retry-After": "600"}))

    (tmp_path / "log").mkdir()
    pages = fetch_in_waves(endpoint_requests(catalogue(spark, "x")), str(tmp_path / "raw"), 2, max_pages=50,
                           new_session=api(tmp_path / "log", answer))
    assert sorted(r["page"] for r in trim_pages(pages).collect()) == [1, 2] and len(asked(tmp_path / "log")) == 4


def test_retry_after_header(monkeypatch):
    assert retry_after("3") == 3 and retry_after(None) == 0 and retry_after("soon") == 0 and retry_after("²") == 0
    assert retry_after("Wed, 21 Oct 2015 07:28:00 GMT", now=1445412470.0) == 10
    assert retry_after("Wed, 21 Oct 2015 07:28:00 GMT") == 0
    slept = []
    monkeypatch.setattr("time.sleep", slept.append)
    from sluice.sources.options import Request

    for header, waits in (("5", [5.0, 5.0]), ("0", [0.0, 2.0])):
        slept.clear()
        session = requests.Session()
        session.mount("http://", Fixed([(429, header), (429, header), (200, "0")]))
        assert Fetcher(new_session=lambda: session).page(Request("http://api.test/x"), 1)[0] == 200 and slept == waits


class Fixed(requests.adapters.BaseAdapter):
    def __init__(self, answers):
        super().__init__()
        self.answers = answers

    def send(self, request, **options):
        response = requests.Response()
        response.status_code, header = self.answers.pop(0)
        response._content, response.url, response.request = b"[]", request.url, request
        response.headers["Retry-After"] = header
        return response

    def close(self):
        pass


def test_shares_of_a_round():
    for left in ([5, 5, 5], [100, 1, 0, 7], [0, 0, 3], [1], [1, 1, 1, 1000]):
        for n in (1, 2, 9, 500):
            parts = [share_times(left, n, i) for i in range(len(left))]
            assert sorted(t for p in parts for t in p) == list(range(min(n, sum(left))))
            assert all(len(p) <= x for p, x in zip(parts, left))


class Alone:
    def allGather(self, message):
        return [message]

    def partitionId(self):
        return 0


def test_missed_times_are_given_up(monkeypatch):
    clock, taken = [0.0], []
    monkeypatch.setattr("time.monotonic", lambda: clock[0])
    monkeypatch.setattr("time.sleep", lambda s: clock.__setitem__(0, clock[0] + s))
    for item in paced(deque(range(30)), 10.0, 1.0, Alone()):
        taken.append(clock[0])
        clock[0] += 1.0 if item == 4 else 0.0  # one slow answer
    assert len(taken) == 30 and all(b - a >= 0.2 - 1e-9 for a, b in zip(taken, taken[3:]))


def test_rate_is_used_in_full_and_never_exceeded(spark, tmp_path):
    """Four times more ranges than cores, most of the pages with one endpoint."""
    (tmp_path / "log").mkdir()
    rate, n = 20.0, 240
    wanted = plan_requests(catalogue(spark, "big"), 1, n - 40).union(plan_requests(catalogue(spark, "a", "b"), 1, 20))
    cores = spark.sparkContext.defaultParallelism
    pages = fetch_pages(wanted, 4 * cores, rate_per_sec=rate, rate_capacity=1, new_session=api(tmp_path / "log", lambda u, b: (200, "[1]", {})))
    assert pages.where("status = 200").count() == n
    times = [t for _, t in asked(tmp_path / "log")]
    assert len(times) == n
    used = (n - 1) / (times[-1] - times[0]) / rate
    assert 0.9 <= used <= 1.01
    # In any span of 30 requests, but for the capacity and the one that opens it.
    assert all(times[i + 30] - times[i] >= 28 / rate for i in range(n - 30))


def test_refused_answers_take_another_turn(spark, tmp_path):
    (tmp_path / "log").mkdir()
    pages = fetch_pages(plan_requests(catalogue(spark, "x"), 1, 12), 4, rate_per_sec=50.0,
                        new_session=api(tmp_path / "log", lambda u, b: (200, "[1]", {}) if b else (500, "", {})))
    assert sorted((r["page"], r["status"]) for r in pages.collect()) == [(n, 200) for n in range(1, 13)]
    assert len(asked(tmp_path / "log")) == 24


def test_passwords_are_named_not_written(spark, monkeypatch):
    with pytest.raises(Exception, match="must be named by password-env"):
        endpoint_requests(catalogue(spark, "x", username="me", password="clear")).collect()
    with pytest.raises(Exception, match="has no password-env"):
        fetch_pages(plan_requests(catalogue(spark, "x", username="me")), 1).collect()
    monkeypatch.setenv("X_PASSWORD", "pw")
    named = endpoint_requests(catalogue(spark, "x", username="me", password="clear", **{"password-env": "X_PASSWORD"})).first()
    assert (named["auth_username"], named["auth_password_env"]) == ("me", "X_PASSWORD")


# -------------------------------------------------------------- typed job

SCHEMA = T.StructType().add("id", T.LongType(), False).add("x", T.DoubleType()).add("o.day", T.TimestampType())


def test_typed_rows_and_their_problems(spark):
    texts = ['{"id":1,"x":"2.5","o":{"day":"2020-01-01"}}', '{"id":"one","x":"n/a"}', '{"x":null,"o":{"day":5}}', "[1]", '{"id":null}']
    values = decode(spark.createDataFrame([("e", 1, i, t) for i, t in enumerate(texts)], "endpoint STRING, page INT, pos INT, body STRING"), "body")
    rows = typed_rows(values, SCHEMA).orderBy("pos").collect()
    assert [r["id"] for r in rows] == [1, None, None, None, None] and [r["x"] for r in rows] == [2.5] + [None] * 4
    assert [r["_problems"] for r in rows] == [
        [], ["id is not bigint: one", "x is not double: n/a"], ["o.day is not timestamp: 5"], ["id is null"], ["id is null"]]


def test_job_with_schemas(spark, page_files, tmp_path):
    page_files("people", [[{"id": 1, "x": 1}, {"id": 2, "x": "bad"}], "<html>", [{"id": None}]])
    base = page_files("empty", [[]])
    out = str(tmp_path / "out")
    run = dict(spark=spark, catalogue=catalogue(spark, "people", "empty", base=base), out=out, max_pages=99,
               schemas={"people": SCHEMA, "empty": SCHEMA}, tasks=2)
    paths = run_ingest(**run, on_error="quarantine")
    assert sorted((r["id"], r["x"]) for r in read_typed(spark, paths, "people").fillna(-1).collect()) == [(-1, -1), (1, 1), (2, -1)]
    assert read_typed(spark, paths, "empty").columns == SCHEMA.names and read_typed(spark, paths, "empty").count() == 0
    found = sorted(r["description"] for r in spark.read.parquet(paths["incidents"]).collect())
    assert found == ["people page 1: x is not double: bad", "people page 2: invalid JSON", "people page 3: id is null"]
    done = finished_runs(spark, out).collect()
    assert json.loads(done[0]["counts"]) == {"records": 3, "typed people": 3, "typed empty": 0, "incidents": 3}
    # A run that fails is none that readers see.
    with pytest.raises(IngestFailed, match="3 pages or values"):
        run_ingest(**run)
    assert finished_runs(spark, out).count() == 1 and last_run(spark, out) == paths
    for schemas, message in (({"other": SCHEMA}, "no endpoint of the catalogue"), ({"people": T.StructType().add("pos", T.LongType())}, "columns of the job")):
        with pytest.raises(ValueError, match=message):
            run_ingest(**run | {"schemas": schemas})


def test_a_killed_run_leaves_the_old_tables(spark, page_files, tmp_path, monkeypatch):
    base = page_files("people", [[{"id": 1}]])
    out = str(tmp_path / "out")
    run_ingest(spark, catalogue(spark, "people", base=base), out, max_pages=3)
    page_files("people", [[{"id": 2}]])

    def killed(*_, **__):
        raise KeyboardInterrupt

    for name in ("page_incidents", "write_records", "fetch_in_waves"):
        with monkeypatch.context() as m:
            m.setattr(job, name, killed)
            with pytest.raises(KeyboardInterrupt):
                run_ingest(spark, catalogue(spark, "people", base=base), out, max_pages=3)
        assert [r["record"] for r in read_records(spark, last_run(spark, out)["records"]).collect()] == ['{"id":1}']
    run_ingest(spark, catalogue(spark, "people", base=base), out, max_pages=3)
    assert [r["record"] for r in read_records(spark, last_run(spark, out)["records"]).collect()] == ['{"id":2}']
