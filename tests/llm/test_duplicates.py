"""Near duplicates, repeated word and byte spans, and the pipeline, against plain versions."""

import random

import pytest

import brute
import corpus_pipeline
from sluice.llm.chunks import chunked
from sluice.llm.debruijn import dedup_substrings, repeated_paths, repeated_spans
from sluice.llm.minhash import keep_one_of_each, near_duplicates
import sluice.llm.queries  # noqa: F401  (fills the registry)
from sluice.llm.registry import QUERIES
from sluice.llm.suffix_dedup import COVER, COVER_PERIOD, dedup_bytes

SF_DIR = "/root/testdata/sf0.001"


def corpus(seed):
    """Texts of a small vocabulary with copies, edits, shared passages, runs and odd rows."""
    r = random.Random(seed)
    sentence = lambda n, v=60: " ".join(f"w{r.randint(0, v)}é" for _ in range(n))
    base = [sentence(r.randint(1, 80)) for _ in range(25)]
    passage = sentence(40, 1000)
    texts = [None, "", " \n ", "one", "one", "ONE", *base]
    for text in base[:12]:
        words = text.split()
        for _ in range(3):
            edited = [w if r.random() > 0.04 else "new" for w in words]
            texts.append(r.choice([" ", "\n"]).join(edited))
    texts += [sentence(10) + " " + passage + "\n" + sentence(9) for _ in range(6)] + [passage] * 4 + base[3:6]
    texts += ["a a " * 60, "a a " * 90, "b" * 400, "b" * 150 + "c" + "b" * 150, passage[: len(passage) // 2] * 3]
    r.shuffle(texts)
    return list(enumerate(texts))


def frame(spark, docs):
    rows = [(k, t, "x", 3, b"y") for k, t in docs]
    return spark.createDataFrame(rows, "doc_id LONG, text STRING, kept STRING, n_words INT, spans BINARY").repartition(5)


@pytest.mark.parametrize(("seed", "size"), [(1, 2), (2, 5)])
def test_near_duplicates(spark, seed, size):
    docs = corpus(seed)
    found = near_duplicates(frame(spark, docs), shingle=size).collect()
    expected = brute.near_duplicates(docs, size)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == expected
    assert len(found) == len(docs) and all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_links_between_members_of_one_bucket(spark):
    """A chain: neighbours are linked, others are not, so stars around one centre miss links."""
    words = [f"v{i}" for i in range(300)]
    docs = [(100 + (i * 7) % 20, " ".join(words[i * 6 : i * 6 + 80])) for i in range(20)]
    found = {r.doc_id: r.component_id for r in near_duplicates(frame(spark, docs), shingle=2).collect()}
    assert found == {k: c for k, (_, c) in brute.near_duplicates(docs, 2).items()}
    assert set(found.values()) == {100}


def test_near_duplicates_of_odd_rows(spark):
    text = " ".join(f"q{i}" for i in range(30))
    docs = [(1, text), (1, text), (1, "other words"), (None, text), (None, None), (0, text), (5, "other words"), (9, "z" * 300000)]
    found = near_duplicates(frame(spark, docs)).collect()
    assert len(found) == len(docs)
    assert {(r.doc_id, r.component_id, r.kept) for r in found} == {(1, 0, False), (None, None, True), (0, 0, True), (5, 0, False), (9, 9, True)}
    assert keep_one_of_each(frame(spark, docs)).count() == 4
    assert near_duplicates(frame(spark, docs[:0] or docs).limit(0)).count() == 0


@pytest.mark.parametrize(("seed", "size"), [(3, 13), (4, 6)])
def test_word_spans(spark, seed, size):
    docs = corpus(seed)
    found = dedup_substrings(frame(spark, docs), size=size, seed=3).collect()
    assert len(found) == len(docs)
    expected, texts = brute.substring_words(docs, size), dict(docs)
    for r in found:
        n, kept = expected[r.doc_id]
        assert (r.n_words, r.n_removed) == (n, n - len(kept))
        assert r.text == (texts[r.doc_id] if len(kept) == n else " ".join(kept)) and r.kept == "x"


def test_paths_name_their_sources(spark):
    docs = corpus(5)
    chunks = chunked(frame(spark, docs).select("doc_id", "text"), size=2000)  # many chunks
    spans = repeated_spans(repeated_paths(chunks)).collect()
    texts = {k: brute.words(t) for k, t in docs}
    assert len({s.chunk for s in spans}) > 3
    for s in spans:
        assert len(texts[s.source.doc][s.source.start : s.source.start + s.n]) == s.n >= 13


def test_word_spans_of_odd_rows(spark):
    text = " ".join(f"q{i}" for i in range(20))
    docs = [(1, text), (1, text), (None, text), (2, text + " r"), (3, None), (3, ""), (0, "q1 " * 5), (7, "z" * 300000)]
    found = sorted((str(r.doc_id), r.n_words, r.n_removed) for r in dedup_substrings(frame(spark, docs)).collect())
    assert found == sorted([("1", 20, 0), ("1", 20, 0), ("None", 20, 20), ("2", 21, 20), ("3", 0, 0), ("3", 0, 0), ("0", 5, 0), ("7", 1, 0)])
    assert dedup_substrings(frame(spark, docs).limit(0)).count() == 0


def test_cover_holds_every_difference():
    assert {(a - b) % COVER_PERIOD for a in COVER for b in COVER} == set(range(COVER_PERIOD))


@pytest.mark.parametrize(("seed", "size", "gram", "at_once"), [(6, 100, 32, 60_000), (7, 40, 12, 50), (8, 100, 32, 10)])
def test_byte_spans(spark, seed, size, gram, at_once):
    docs = corpus(seed)
    found = dedup_bytes(frame(spark, docs), size=size, gram=gram, at_once=at_once).collect()
    assert len(found) == len(docs)
    expected = brute.substring_bytes(docs, size)
    for r in found:
        assert (r.n_bytes, r.n_removed, len(r.spans), brute.sha(bytes(r.kept))) == expected[r.doc_id]
        assert sum(s.length for s in r.spans) == r.n_removed


def test_byte_spans_of_odd_rows(spark):
    text = "".join(chr(33 + (i * i) % 90) for i in range(150))
    docs = [(1, text), (1, text), (None, text), (0, None), (0, ""), (5, "z" * 300000), (6, "é" * 50), (7, "é" * 51)]
    found = sorted((str(r.doc_id), r.n_bytes, r.n_removed) for r in dedup_bytes(frame(spark, docs)).collect())
    assert [x for x in found if x[0] == "1"] == [("1", 150, 0), ("1", 150, 150)]
    assert ("None", 150, 150) in found and ("5", 300000, 299999) in found and ("7", 102, 102) in found
    assert dedup_bytes(frame(spark, docs).limit(0)).count() == 0


def test_queries_against_plain_versions(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    spans, raw, near = brute.substring_words(docs, 13), brute.substring_bytes(docs, 100), brute.near_duplicates(docs, 2)
    for r in QUERIES["op7_debruijn_compaction"](spark, SF_DIR).collect():
        n, kept = spans[r.doc_id]
        assert (r.n_words, r.n_removed, r.kept_sha256) == (n, n - len(kept), brute.sha(" ".join(kept)))
    for r in QUERIES["op9_blockwise_suffixes"](spark, SF_DIR).collect():
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == raw[r.doc_id]
    for r in QUERIES["op2_one_permutation"](spark, SF_DIR).collect():
        assert (r.n_shingles, r.component_id) == near[r.doc_id]


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    kept = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/{i}")
        result = spark.read.parquet(f"{tmp_path}/{i}")
        kept.append(([(r.doc_id, r.text) for r in docs.collect()], result))
        assert i == 4 or result.columns == docs.columns
        docs = result
    (before, good), (quality, near), (distinct, cut), (spans, clean), (last, pieces) = kept
    left = {r.doc_id for r in good.collect()}
    judged = [labels[k] == (k in left) for k, _ in before if k in labels]
    assert sum(judged) > 0.95 * len(judged)
    assert {r.doc_id for r in near.collect()} == {k for k, (_, c) in brute.near_duplicates(quality, 5).items() if k == c}
    expected, texts = brute.substring_words(distinct, 13), dict(distinct)
    wanted = {k: texts[k] if len(w) == n else " ".join(w) for k, (n, w) in expected.items() if w or not n}
    assert {r.doc_id: r.text for r in cut.collect()} == wanted
    assert {r.doc_id for r in clean.collect()} == {k for k, (_, hit, _) in brute.contamination(spans, items).items() if not hit}
    assert {r.doc_id for r in pieces.collect()} == {k for k, _ in last}


def test_pipeline_of_odd_rows(spark, tmp_path):
    """Nulls in every column, empty texts, repeated rows and no rows pass through every stage."""
    columns = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG"
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, "word " * 30, None, "s", None), (2, "word " * 30, None, "s", None)]
    for i, data in enumerate((rows, [])):
        docs = spark.createDataFrame(data, columns)
        for j, (_, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/{i}-{j}")
            docs = spark.read.parquet(f"{tmp_path}/{i}-{j}")
