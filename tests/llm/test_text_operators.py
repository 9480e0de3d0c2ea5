"""Repetition rules, decontamination, token files and packing against plain versions."""

import hashlib
import random
from collections import defaultdict

import pytest

import brute
from sluice.llm import queries as _queries  # noqa: F401  (fills the registry)
from sluice.llm.decontaminate import contamination
from sluice.llm.packing import CAPACITY, fullest, pack, plan, token_pieces
from sluice.llm.registry import QUERIES
from sluice.llm.repetition import measure, repetition_rules
from sluice.llm.text import Texts
from sluice.llm.token_blocks import open_token_blocks, pack_bits, read_documents, read_ids, unpack_bits, write_token_blocks
from sluice.llm.tokens import Encoder, vocabulary_path

SF_DIR = "/root/testdata/sf0.001"
ODD = [None, "", " \n\n", "a", "x\nx", "y\n\ny\n", "é " * 40, "w" * 5000 + " " + "ab " * 3000]


def mess(seed, count, alphabet, gaps, longest):
    r = random.Random(seed)
    return ["".join(r.choice(alphabet) + r.choice(gaps) for _ in range(r.randint(0, longest))) for _ in range(count)]


@pytest.fixture
def rows(spark):
    """Texts as documents with clashing extra columns."""

    def make(texts):
        data = [(i, t, 1, "x", True) for i, t in enumerate(texts)]
        return spark.createDataFrame(data, "doc_id LONG, text STRING, n_words INT, sequence_id STRING, kept BOOLEAN")

    return make


def test_repetition_measures():
    import pyarrow as pa

    texts = ODD[:-1] + mess(1, 200, ["a", "b", "é", "#<"], [" ", "\n", "  "], 60)
    found = measure(Texts(pa.array(texts)), 6, 0.3, 100)
    for i, text in enumerate(texts):
        n, chars, symbols, dup, repeat, longest, covered = brute.repetition(text, 6)
        assert [found[k][i] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "longest_repeat")] == [
            n, chars, symbols, dup, repeat, longest,
        ]
        assert abs(found["covered_fraction"][i] - covered / max(chars, 1)) < 1e-9
        failed = n < 20 or 100 * repeat > 30 * n
        assert found["base_failed"][i] == failed
        assert found["kept"][i] == (not failed and covered <= 0.3 * max(chars, 1) + 1e-9 and longest <= 100)


def test_repetition_rules_keep_every_row(rows):
    docs = rows(ODD + ODD)
    found = {r.doc_id: r for r in repetition_rules(docs).collect()}
    assert len(found) == 2 * len(ODD) and not found[0].kept
    assert repetition_rules(docs.limit(0)).count() == 0


def test_contamination(spark, rows):
    r = random.Random(3)
    vocabulary = ["a", "B", "c1", "É"]
    item_texts = [" ".join(r.choice(vocabulary) for _ in range(n)) for n in (0, 1, 3, 9, 10, 11, 30, 30)] + [None]
    items = [(i, t) for i, t in enumerate(item_texts)] + [(6, item_texts[6]), (None, item_texts[5])]
    texts = ODD + mess(4, 150, ["a", "b", "C1", "É"], [" ", "-", "\n"], 40) + [item_texts[7] + " x", item_texts[5]]
    expected = brute.contamination(list(enumerate(texts)), items)
    bench = spark.createDataFrame(items, "item_id LONG, text STRING")
    for block in (4_000_000, 7):  # in one block, and in several
        found = contamination(rows(texts), bench, block=block)
        got = {x.doc_id: (x.n_words, x.n_hit, x.item_ids) for x in found.collect()}
        assert got == expected
        assert all(x.contaminated == (x.n_hit > 0) and x.n_items == len(x.item_ids) for x in found.collect())
    assert contamination(rows(texts), bench.limit(0)).where("contaminated").count() == 0
    assert contamination(rows([]), bench).count() == 0
    same = rows(texts[-2:]).union(rows(texts[-2:]))
    assert contamination(same, bench).count() == 4


@pytest.fixture(scope="module")
def plain_ids():
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))
    model.encode_special_tokens = True
    return lambda text: model.encode(text or "", add_special_tokens=False).ids


def test_contamination_by_passages_of_many_items(spark, rows):
    """A long passage in many items and documents, windowless and null texts, in one block and in many."""
    passage = " ".join(f"w{i}" for i in range(300))
    items = [(i, passage) for i in range(40)] + [(100 + i, passage + f" tail{i} of its own") for i in range(20)] + [(None, "a null id marks words"), (500, "two words"), (501, "")]
    texts = [passage, "x " + passage + " y", passage[:-20], "", None, "a null id marks words", "two words two words", "!!", passage + " tail3 of its own and more"] * 5
    bench = spark.createDataFrame(items, "item_id LONG, text STRING")
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "uid LONG, text STRING, found STRING")
    expected = brute.contamination(list(enumerate(texts)), items)
    for block in (10**6, 100):
        found = contamination(docs, bench, key="uid", block=block).collect()
        assert len(found) == len(texts)
        assert {r.uid: (r.n_words, r.n_hit, r.item_ids) for r in found} == expected
        assert all((r.n_items, r.contaminated) == (len(r.item_ids), r.n_hit > 0) for r in found)


def test_contamination_query(spark):
    """The registered query equals the brute version on the whole of a given table."""
    folder = "/root/testdata/sf0.001"
    pairs = {n: [tuple(r) for r in spark.read.parquet(f"{folder}/{n}.parquet").select(k, "text").collect()] for n, k in (("documents", "doc_id"), ("benchmark", "item_id"))}
    expected = brute.contamination(pairs["documents"], pairs["benchmark"])
    found = QUERIES["op8_winnowing"](spark, folder).collect()
    assert len(found) == len(pairs["documents"])
    for r, (doc, _) in zip(sorted(found, key=lambda r: r.doc_id), sorted(pairs["documents"])):
        n_words, n_hit, items = expected[doc][:3]
        assert (r.doc_id, r.n_words, r.n_hit, r.n_items) == (doc, n_words, n_hit, len(items))
        assert r.items_sha256 == hashlib.sha256(",".join(items).encode()).hexdigest()


def test_encoder_agrees_with_the_library(plain_ids):
    import pyarrow as pa

    parts = ["a", "Ab", "1", " ", "  ", "\n", " ", "é", ".", "'s", "\t", "　", "日本", "<|endoftext|>", "\x1c", "\x85", "\x00", "“"]
    texts = ODD + mess(5, 2000, parts, ["", "", " "], 20)
    ids, edges = Encoder.at(vocabulary_path("byte_bpe_50k.json")).encode(Texts(pa.array(texts)))
    assert [ids[a:b].tolist() for a, b in zip(edges[:-1], edges[1:])] == [plain_ids(t) for t in texts]


@pytest.mark.parametrize("width", [1, 5, 8, 13, 16, 17, 31])
def test_bits_round_trip(width):
    import numpy as np

    ids = np.random.default_rng(width).integers(0, 1 << width, 1001).astype(np.uint32)
    packed = pack_bits(ids, width)
    assert len(packed) == -(-1001 * width // 8)
    for a, b in ((0, 1001), (3, 3), (7, 500), (1000, 1001)):
        assert (unpack_bits(packed, width, a, b) == ids[a:b]).all()


def test_token_blocks(spark, rows, plain_ids, tmp_path):
    texts = ODD + mess(6, 60, ["a", "été", "1"], [" ", "\n"], 50)
    path = f"file://{tmp_path}/blocks"
    write_token_blocks(rows(texts).repartition(5), path, vocabulary_path("byte_bpe_50k.json"), block_ids=100)
    blocks = open_token_blocks(spark, path)
    start, every = 0, []
    for r in sorted(read_documents(spark, path).collect()):
        ids = [*plain_ids(texts[r.doc_id]), 0]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), brute.crc(ids))
        start, every = start + len(ids), every + ids
    assert start == len(every) and blocks.count() > 10
    for a, b in ((0, 5), (90, 310), (len(every) - 3, len(every) + 9)):
        got = sorted(read_ids(blocks, a, b).collect())
        assert [i for r in got for i in r.ids] == every[a:b] and got[0].start == a
    write_token_blocks(rows([]), path, vocabulary_path("byte_bpe_50k.json"))
    assert read_documents(spark, path).count() == 0


def test_a_worker_keeps_one_encoder_and_is_sent_none(spark, rows, tmp_path):
    import os

    from pyspark import cloudpickle

    from sluice.llm import token_blocks
    from sluice.llm.text import batch_of

    vocabulary = vocabulary_path("byte_bpe_50k.json")
    # The driver looks at the vocabulary before the function is sent.
    write_token_blocks(rows(ODD), f"file://{tmp_path}/blocks", vocabulary)
    assert len(cloudpickle.dumps(token_blocks._write_blocks(vocabulary, 0, 16, 100))) < 1 << 20

    def held(batches):
        for _ in batches:
            yield batch_of(worker=[os.getpid()], encoder=[id(Encoder.at(vocabulary).tokenizer)])

    found = spark.range(0, 24, 1, 24).mapInArrow(held, "worker long, encoder long").collect()
    assert len(found) == 24 and len(set(found)) == len({r.worker for r in found})


def check_packing(found, capacity):
    bins = defaultdict(list)
    for r in found:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_pieces_of_documents(rows, plain_ids):
    texts = ODD + mess(7, 40, ["a", "été", "1"], [" ", "\n"], 50) + ["go " * 5000]
    found = pack(token_pieces(rows(texts), vocabulary_path("byte_bpe_50k.json"))).collect()
    check_packing(found, CAPACITY)
    by_doc = defaultdict(list)
    for r in found:
        by_doc[r.doc_id].append(r)
    assert len(by_doc) == len(texts)
    for key, pieces in by_doc.items():
        ids, at = [*plain_ids(texts[key]), 0], 0
        for i, p in enumerate(sorted(pieces, key=lambda p: p.piece)):
            assert p.piece == i and p.start == at and p.ids_crc32 == brute.crc(ids[at : at + p.length])
            assert len(ids) > CAPACITY or len(pieces) == 1
            assert i == 0 or p.length == CAPACITY
            at += p.length
        assert at == len(ids)


def test_packing_fills_bins(spark):
    r = random.Random(8)
    lengths = [r.randint(1, 50) for _ in range(3000)] + [7] * 1500
    pieces = spark.createDataFrame([(i, n, 0) for i, n in enumerate(lengths)], "id INT, length INT, offset INT").repartition(7)
    found = pack(pieces, capacity=64).collect()
    assert len(found) == len(lengths) and sorted(found[0].asDict()) == ["id", "length", "offset", "sequence_id"]
    assert check_packing(found, 64) <= -(-sum(lengths) // 64) + 2
    odd = pack(spark.createDataFrame([(None,), (0,), (65,), (64,), (64,)], "length INT"), capacity=64).collect()
    assert sorted((x.length is None, x.length, x.sequence_id is None) for x in odd if x.length) == [
        (False, 64, False), (False, 64, False), (False, 65, True),
    ]
    assert len(odd) == 5 and len({x.sequence_id for x in odd if x.length == 64}) == 2
    assert pack(pieces.limit(0)).count() == 0


def test_fullest_is_the_best_subset():
    r = random.Random(9)
    for _ in range(300):
        counts = {r.randint(1, 20): r.randint(1, 4) for _ in range(4)}
        room = r.randint(0, 50)
        sums = {0}
        for n, c in counts.items():
            sums = {s + n * k for s in sums for k in range(c + 1)}
        used = fullest(counts, room)
        assert sum(n * c for n, c in used.items()) == max(s for s in sums if s <= room)
        assert all(counts[n] >= c for n, c in used.items())
    assert sum(times for _, times in plan({3: 4, 2: 2}, 8)) == 2
