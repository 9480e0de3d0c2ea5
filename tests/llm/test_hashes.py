"""Texts built to collide under polynomial hashes, through every operator that hashes words."""

import brute
import numpy as np
import pyarrow as pa
import pytest

from sluice.llm.debruijn import dedup_substrings
from sluice.llm.decontaminate import contamination
from sluice.llm.minhash import near_duplicates
from sluice.llm.repetition import repetition_rules
from sluice.llm.text import Texts, byte_values, grams, polynomial, rolling
from sluice.llm.tokens import Encoder, vocabulary_path

S = "a"
for _ in range(10):
    S += S.translate(str.maketrans("ab", "ba"))
T = S.translate(str.maketrans("ab", "ba"))


def hashed(function, texts):
    held = Texts(pa.array(texts))
    return function(byte_values(held.data), held.offsets[:-1], held.offsets[1:])


def test_hashes_tell_complementary_texts_apart():
    assert len(S) == 1024 and len(set(hashed(polynomial, [S, T]))) == 1
    assert len(set(hashed(rolling, [S, T, S + T, T + S, S[:512], T[:512], "", "a", "aa"]))) == 9
    words = np.array([1 + (c == "a") for c in S + T], np.uint64)
    names = grams(words, 1024)
    assert names[0] != names[1024] and len(grams(words[:5], 6)) == 0
    assert grams(words, 13)[0] == grams(words[:13], 13)[0]


def test_hash_of_a_run_depends_on_its_values_only(monkeypatch):
    monkeypatch.setattr("sluice.llm.text._AT_ONCE", 7)
    r = np.random.default_rng(1)
    values = r.integers(0, 3, 400).astype(np.uint64)
    starts = r.integers(0, 380, 300)
    ends = starts + r.integers(0, 20, 300)
    named = {}
    for h, a, b in zip(rolling(values, starts, ends).tolist(), starts, ends):
        assert named.setdefault(tuple(values[a:b].tolist()), h) == h
    assert len(set(named.values())) == len(named)


@pytest.fixture
def docs(spark):
    texts = [S + " x", T + " x", f"{S}\n{T}", f"{S} one two {S}", f"{T} one two {T}", " ".join([S] + ["w"] * 14), " ".join([T] + ["w"] * 14)]
    texts += [" ".join("ab"[c == "b"] for c in S), " ".join("ab"[c == "b"] for c in T)]
    rows = list(enumerate(texts))
    return rows, spark.createDataFrame(rows, "doc_id LONG, text STRING")


def test_operators_on_complementary_texts(spark, docs):
    rows, df = docs
    near = {r["doc_id"]: r["component_id"] for r in near_duplicates(df, shingle=2).collect()}
    assert near == {k: v[1] for k, v in brute.near_duplicates(rows, 2).items()} and near[1] == 1
    measured = {r["doc_id"]: (r["n_dup_lines"], r["n_repeat_words"]) for r in repetition_rules(df).collect()}
    assert measured[2][0] == 0 and measured == {k: tuple(brute.repetition(t, 6)[3:5]) for k, t in rows}
    cut = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in dedup_substrings(df).collect()}
    assert cut == {k: (n, n - len(kept)) for k, (n, kept) in brute.substring_words(rows, 13).items()}
    items = spark.createDataFrame([(1, f"{S} one two three"), (2, T)], "item_id LONG, text STRING")
    hit = {r["doc_id"]: (r["n_words"], r["n_hit"], sorted(map(str, r["item_ids"]))) for r in contamination(df, items).collect()}
    plain = brute.contamination(rows, [(1, f"{S} one two three"), (2, T)])
    assert hit == {k: (v[0], v[1], sorted(map(str, v[2]))) for k, v in plain.items()}


def test_encoder_on_complementary_texts():
    encoder = Encoder(vocabulary_path("byte_bpe_50k.json"))
    texts = [S, T, S + " " + T]
    ids, edges = encoder.encode(Texts(pa.array(texts)))
    for i, text in enumerate(texts):
        assert ids[edges[i] : edges[i + 1]].tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
