"""Toxicity by neighbours, the audit of sources, vector codes: against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as entry
from check import compare, database
from sluice.llm import divergence, pivot_codes, toxicity
from sluice.llm.divergence import audit_sources, gallop, price
from sluice.llm.pivot_codes import Nearest, choose_pivots, compress, distances, with_label_errors
from sluice.llm.registry import table
from sluice.llm.text import Texts

SF_DIR = "/root/testdata/sf0.01"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

# ------------------------------------------------------------------ sources


def plain_audit(docs, least, top):
    docs = [(t or "", l or "", s or "") for t, l, s in docs]
    found = [(l, s, re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t.translate(LOWER))) for t, l, s in docs]
    held, rows = defaultdict(Counter), []
    for l, _, w in found:
        held[l].update(set(w))
    for lang in held:
        kept = sorted(t for t, n in held[lang].items() if n >= least)
        groups = defaultdict(Counter)
        for l, s, w in found:
            if l == lang:
                groups[s].update(x for x in w if x in set(kept))
        whole = sum(groups.values(), Counter())

        def prices(c):
            n = sum(c.values())
            return {t: 1 + 10**9 * (c[t] + 5) // (n + 5 * len(kept)) for t in kept}

        p, q = {s: prices(c) for s, c in groups.items()}, prices(whole)
        for s in groups:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in groups if o != s]
            terms = [(q[t] - p[s][t], t.encode(), t) for t in kept if groups[s][t] and p[s][t] > q[t]]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                rows += [(lang, s, part, item, -v, i + 1) for i, (v, _, item) in enumerate(items)]
    return sorted(rows)


@pytest.mark.parametrize("block,tile", [(1 << 16, 16), (3, 2)])
def test_audit_of_sources(spark, monkeypatch, block, tile):
    monkeypatch.setattr(divergence, "BLOCK_TERMS", block)
    monkeypatch.setattr(divergence, "TILE_GROUPS", tile)
    r = random.Random(5)
    words = ["Ab", "éa", "ÉA", "zz", "ß", "I", "naïve", "x", "yy", "漢字", "q9r", "Z"]
    docs = []
    for n in range(160):
        lang, source = r.choice(["en", "en", "de", None]), r.choice(["hot"] * 4 + ["a", "b", "é", "", None, "z"])
        docs.append((" ".join(r.choices(words, range(12, 0, -1), k=r.randint(0, 25))), lang, source))
    docs += [(None, "en", "silent"), ("", "en", "mute"), ("x " * 9000, "en", "long"), ("only here", "it", "one"), ("", "fr", "p"), (None, "fr", "q")]
    docs += docs[:10]
    df = spark.createDataFrame([(*d, i, "x", "y") for i, d in enumerate(docs)], "text STRING, lang STRING, source STRING, doc_id LONG, n LONG, item STRING".replace("n LONG", "n STRING"))
    found = sorted(tuple(x) for x in audit_sources(df, least_documents=8, top_terms=4).collect())
    assert found == plain_audit(docs, 8, 4) and {"pair", "term"} == {x[2] for x in found}


def test_audit_of_nothing(spark):
    assert audit_sources(spark.createDataFrame([], "doc_id LONG, text STRING, lang STRING, source STRING")).count() == 0
    lone = spark.createDataFrame([("a", "en", "s")], "text STRING, lang STRING, source STRING")
    assert audit_sources(lone).count() == 0


def test_galloping_and_prices():
    r = np.random.default_rng(3)
    for few, many in ((0, 5), (5, 0), (1, 1), (40, 5000), (3000, 200), (100, 100)):
        a, b = (np.unique(r.integers(0, 4000, n)) for n in (few, many))
        assert np.array_equal(gallop(a, b), np.searchsorted(b, a))
    for _ in range(200):
        size = r.integers(1, 10**6)
        total = int(r.integers(0, 8 * 10**15))
        n = int(r.integers(0, total + 1))
        assert price(np.array([n]), total, int(size))[0] == 1 + 10**9 * (n + 5) // (total + 5 * int(size))


def test_registered_audit_agrees_with_sql(spark):
    assert compare(spark, database(SF_DIR), SF_DIR, "op12_source_divergence").startswith("ok")


# -------------------------------------------------------------------- codes


def plain_codes(rows, entries=256, rounds=4):
    """[(vec_id, code, error, label_error)], digest"""
    kept = [(i, [math.floor(1024 * x) for x in v], l) for i, v, l in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = len(kept[0][1]) // 4
    parts = [[v[k * w : (k + 1) * w] for _, v, _ in kept] for k in range(4)]
    books = [[list(x) for x in p[:entries]] for p in parts]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for k in range(4):
            groups = defaultdict(list)
            for x in parts[k]:
                groups[nearest(x, books[k])[1]].append(x)
            for i, xs in groups.items():
                books[k][i] = [sum(c) // len(xs) for c in zip(*xs)]
    found = [[nearest(x, books[k]) for x in parts[k]] for k in range(4)]
    errors = [sum(found[k][n][0] for k in range(4)) for n in range(len(kept))]
    by_label = Counter()
    for (_, _, l), e in zip(kept, errors):
        by_label[l] += e
    out = [(i, "".join(f"{found[k][n][1]:02x}" for k in range(4)), errors[n], by_label[l]) for n, (i, _, l) in enumerate(kept)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(out, key=str), digest


def coded(df, **options):
    codes, trained = compress(df, **options)
    rows = with_label_errors(codes).collect()
    return sorted(((r["vec_id"], r["code"].hex(), r["error"], r["label_error"]) for r in rows), key=str), trained


SCHEMA = "vec_id LONG, embedding ARRAY<FLOAT>, label INT, code STRING, error STRING, parts INT"


@pytest.mark.parametrize("entries", [256, 7, 1])
def test_codes(spark, entries):
    r = random.Random(entries)
    centres = [[r.uniform(-1, 1) for _ in range(12)] for _ in range(9)]
    rows = []
    for n in range(90):
        # Coarse steps make many ties; a third of the rows have one vector, most one label.
        v = centres[0] if n % 3 == 0 else [round(x + r.uniform(-0.2, 0.2), 1) for x in r.choice(centres)]
        rows.append((1000 - n, [float(np.float32(x)) for x in v], 1 if n % 4 else r.choice([None, 2])))
    rows += [(1, None, 1), (2, [None] * 12, 1), (3, [math.nan] + [0.0] * 11, 1), (4, [math.inf] + [0.0] * 11, 1), (1000, rows[5][1], None), (None, rows[4][1], 2)]
    df = spark.createDataFrame([(*x, "a", "b", 1) for x in rows], SCHEMA)
    found, trained = coded(df, entries=entries)
    expected, digest = plain_codes(rows, entries)
    assert found == expected and trained.digest() == digest


def test_odd_vectors(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert coded(none) == ([], None)
    assert coded(spark.createDataFrame([(1, None, 1, "", "", 1), (2, [math.nan], 1, "", "", 1)], SCHEMA)) == ([], None)
    same = spark.createDataFrame([(n, [], None, "", "", 1) for n in range(3)], SCHEMA)
    assert [x[1:] for x in coded(same)[0]] == [("00000000", 0, 0)] * 3
    mixed = [(n, [0.5] * 4, None, "", "", 1) for n in range(3)] + [(9, [0.5] * 8, None, "", "", 1)]
    assert len(coded(spark.createDataFrame(mixed, SCHEMA))[0]) == 3
    with pytest.raises(ValueError, match="4 equal parts"):
        coded(spark.createDataFrame([(1, [0.5] * 6, 1, "", "", 1)], SCHEMA))
    with pytest.raises(Exception, match="too large"):
        coded(spark.createDataFrame([(1, [1e30] * 4, 1, "", "", 1)], SCHEMA))


def test_pivots_leave_nothing_out():
    r = np.random.default_rng(1)
    for scale in (3, 400, 1 << 24):  # the last is the largest allowed
        book, parts = (r.integers(-scale, scale, (n, 16)) for n in (256, 500))
        pivots = choose_pivots(book)
        nearest = Nearest(book, pivots)
        entry, error = nearest.assign(parts, distances(parts[:, None], pivots[None]))
        whole = distances(parts[:, None], book[None])
        assert np.array_equal(entry, whole.argmin(1)) and np.array_equal(error, whole.min(1))
        assert (nearest.bounds(np.sqrt(distances(parts[:, None], pivots[None])).astype(np.float32)) <= whole).all()
    assert nearest.evaluated <= whole.size


def test_registered_codes(spark):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in table(spark, "/root/testdata/sf0.001", "embeddings").collect()]
    expected, digest = plain_codes(rows)
    found = entry.queries()["op13_laesa_pivots"](spark, "/root/testdata/sf0.001").collect()
    assert sorted(((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in found), key=str) == expected
    assert {r["codebooks_sha256"] for r in found} == {digest}


# ----------------------------------------------------------------- toxicity


def plain_grams(text):
    data = bytes(c + 32 if 65 <= c <= 90 else c for c in text.encode())
    out = Counter()
    for word in re.findall(rb"[0-9a-z\x80-\xff]+", data):
        for size in toxicity.GRAMS:
            padded = b" " + word + b" "
            out.update(padded[i : i + size] for i in range(len(padded) - size + 1))
    return out


def test_grams():
    texts = ["Idiots, an idiot!", "", "é naïve 漢字 x", "a", "abcdefghijklmnop", "abc\ndef abc"]
    batch = Texts(pa.array(texts))
    found, starts = [Counter() for _ in texts], toxicity.row_starts(batch)
    for grams, at in toxicity.packed_grams(batch):
        for g, row in zip(grams.tolist(), (np.searchsorted(starts, at, "right") - 1).tolist()):
            found[row][(g & ((1 << 56) - 1)).to_bytes(g >> 56, "big")] += 1
    assert found == [plain_grams(t) for t in texts]


def index_of(r, examples, terms):
    rows = np.repeat(np.arange(examples), 6)
    held = np.unique(rows * terms + r.integers(0, terms, len(rows)))
    rows, held = held // terms, held % terms
    counts, idf = r.integers(1, 4, len(rows)), r.uniform(1, 5, terms)
    return rows, held, counts, idf, toxicity.Index([f"{i:04}" for i in range(examples)], r.integers(0, 2, examples).astype(float), rows, held, counts, idf)


def test_nearest_are_those_of_all_examples():
    r = np.random.default_rng(2)
    rows, held, counts, idf, index = index_of(r, 700, 60)
    dense = np.zeros((700, 60))
    dense[rows, held] = toxicity.unit_weights(rows, held, counts, idf, 700)
    for _ in range(300):
        terms = np.unique(r.integers(0, 60, r.integers(1, 9)))
        weights = toxicity.unit_weights(np.zeros(len(terms), int), terms, r.integers(1, 5, len(terms)), idf, 1)
        cosine = dense[:, terms] @ weights
        best = sorted((-round(c, 9), f"{i:04}") for i, c in enumerate(cosine) if c > 0)[:10]
        found, near = index.nearest(terms, weights, 10)
        assert sorted((-round(c, 9), index.ids[e]) for e, c in zip(found, near)) == best
        # One example left out, as for the curve.
        gone = int(found[0])
        assert gone not in index.nearest(terms, weights, 10, without=gone)[0]


def auc(rows):
    rows = sorted(rows)
    ranks = defaultdict(list)
    for i, (s, _) in enumerate(rows):
        ranks[s].append(i + 1)
    up = [sum(ranks[s]) / len(ranks[s]) for s, y in rows if y]
    return (sum(up) - len(up) * (len(up) + 1) / 2) / (len(up) * (len(rows) - len(up)))


def test_registered_toxicity(spark):
    out = entry.queries()["op11_nearest_examples"](spark, SF_DIR).collect()
    toxic = {r["doc_id"]: r["toxic"] for r in table(spark, SF_DIR, "labels").collect()}
    assert len(out) == table(spark, SF_DIR, "documents").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in out)
    assert auc([(r["score"], toxic[r["doc_id"]]) for r in out if r["held_out"] and r["doc_id"] in toxic]) > 0.9
    assert any(r["evidence"] and r["evidence"][0]["terms"] for r in out)


DOCS = "doc_id LONG, text STRING, lang STRING, score STRING, evidence STRING, toxic STRING"


def toxic_docs(spark, n=120):
    r = random.Random(4)
    texts = [" ".join(r.choices(["morning", "garden", "letter", "quiet", "window"], k=9)) + (" scoundrel" if i % 3 == 0 else "") for i in range(n)]
    rows = [(i, t, "en", "s", "e", "t") for i, t in enumerate(texts)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0), "x") for i in range(n)] + [(None, 1, "x"), (1, None, "x"), (2, 7, "x"), (999, 1, "x")], "doc_id LONG, toxic INT, text STRING")
    return rows, labels


def test_toxicity_of_odd_rows(spark):
    rows, labels = toxic_docs(spark)
    more = [(None, None, None, None, None, None), (500, "", "en", "", "", ""), (501, "scoundrel " * 20000, "en", "", "", ""), (502, "!!", "en", "", "", ""),
            (503, "you scoundrel", "en", "", "", ""), (503, "you scoundrel", "en", "", "", ""), (504, "a quiet garden", "fr", "", "", "")]
    docs = spark.createDataFrame(rows + more, DOCS)
    model = toxicity.train(docs, labels)
    out = {(r["doc_id"], r["predicted"], r["score"]) for r in toxicity.score_documents(docs, model).collect()}
    by_id = {k: (p, s) for k, p, s in out}
    assert by_id[501][0] == by_id[503][0] == 1 and by_id[504][0] == by_id[500][0] == by_id[None][0] == 0
    assert by_id[500][1] == by_id[None][1] == by_id[502][1]
    # Scores follow from the text alone.
    renamed = spark.createDataFrame([(9000 + n, t, "xx", "", "", "") for n, (_, t, *_) in enumerate(rows)], DOCS)
    again = {r["doc_id"] - 9000: r["score"] for r in toxicity.score_documents(renamed, model).collect()}
    assert all(again[i] == by_id[i][1] for i, *_ in rows)


def test_held_out_labels_are_not_learned(spark):
    rows, labels = toxic_docs(spark)
    docs = spark.createDataFrame(rows, DOCS)
    flipped = labels.selectExpr("doc_id", "IF(crc32(CAST(doc_id AS STRING)) % 5 = 0, 1 - toxic, toxic) AS toxic")
    scores = [sorted((r["doc_id"], r["score"]) for r in toxicity.score_documents(docs, toxicity.train(docs, x)).collect()) for x in (labels, flipped)]
    assert scores[0] == scores[1]


def test_toxicity_without_examples(spark):
    rows, labels = toxic_docs(spark)
    docs = spark.createDataFrame(rows[:5], DOCS)
    for known, share in ((labels.limit(0), 0.0), (labels.where("toxic = 1"), 1.0)):
        out = toxicity.score_documents(docs, toxicity.train(docs, known)).collect()
        assert [r["score"] for r in out] == [share] * 5 and all(r["evidence"] == [] for r in out)
    assert toxicity.score_documents(docs.limit(0), toxicity.train(docs.limit(0), labels)).count() == 0
