"""Benchmark decontamination by winnowing.

The minimum k-gram hash of every window of `window` words is that window's fingerprint.
Equal windows have equal fingerprints, so every shared span of `window` words or more
shares one. Document windows whose fingerprint occurs in the benchmark are candidates;
they are extended to whole windows by a join on the hash of all their words. Items of
fewer words are one window of their own length, winnowed at that length.

The benchmark's fingerprints reach the scan of the documents in blocks of at most
`BLOCK` of them; a larger benchmark costs more scans, never more memory. Candidates are
written before they are joined, and documents are joined with names of item sets: a
passage of many windows in many items adds one name to a document, not a row for each pair.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sluice.llm.components import landed
from sluice.llm.text import ALNUM, LOWER, Texts, Words, batch_of, by_slice, grams, ids_of, sliding

WINDOW = 10
GRAM = 5
BLOCK = 4_000_000

_BASE = 0xD1B54A32D192ED03


def windows(words: Words, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, fingerprint and whole hash of every run of `length` words in one row."""
    k = min(gram, length)
    marks = sliding(grams(words.hash, k), length - k + 1)
    whole = grams(words.hash, length, _BASE)
    at = np.flatnonzero(words.within(length))
    return at, marks[at], whole[at]


def _item_windows(window: int, gram: int):
    def work(part, texts: Texts):
        words = texts.words(ALNUM, LOWER)
        counts, ids = words.counts(), ids_of(part.column(0))
        found = []
        for length in sorted({min(int(n), window) for n in counts if n}):
            at, mark, whole = windows(words, length, gram)
            row = words.row[at]
            held = np.minimum(counts[row], window) == length
            found.append((row[held], np.full(held.sum(), length), mark[held], whole[held]))
        if not found:
            return None
        row, length, mark, whole = (np.concatenate(x) for x in zip(*found))
        return batch_of(
            item=pa.array(ids[row], mask=part.column(0).is_null().to_numpy(zero_copy_only=False)[row]),
            length=pa.array(length, pa.int32()), mark=mark.view(np.int64), whole=whole.view(np.int64),
        )

    return work


def _document_windows(marks, gram: int):
    """One row per document: uid, key, words, and the windows whose fingerprint is in `marks`."""

    def work(part, texts: Texts):
        words = texts.words(ALNUM, LOWER)
        found = []
        for length, known in marks.value.items():
            at, mark, whole = windows(words, length, gram)
            near = np.searchsorted(known, mark)
            hit = known[np.minimum(near, len(known) - 1)] == mark
            found.append((at[hit], np.full(hit.sum(), length), mark[hit], whole[hit]))
        at, length, mark, whole = (np.concatenate(x) for x in zip(*found)) if found else [np.zeros(0, np.int64)] * 4
        order = np.argsort(at, kind="stable")
        at, length, mark, whole = at[order], length[order], mark[order].view(np.int64), whole[order].view(np.int64)
        edges = np.searchsorted(at, words.edges).astype(np.int32)
        entries = pa.StructArray.from_arrays(
            [pa.array(at - words.edges[words.row[at]]), pa.array(length, pa.int32()), pa.array(mark), pa.array(whole)],
            names=["at", "length", "mark", "whole"],
        )
        return batch_of(uid=part.column("uid"), key=part.column("key"), n_words=words.counts(), found=pa.ListArray.from_arrays(edges, entries))

    return by_slice("text", work)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    block: int = BLOCK,
) -> DataFrame:
    """One row per row of `docs`: key, n_words, n_hit, n_items, item_ids (sorted as text),
    contaminated.

    A word is hit inside any occurrence of a benchmark window. Null and empty texts have
    no words and no hits; items without words match nothing. Repeated documents are
    judged each for itself; repeated items count once per item id, and items with a null
    id mark words but are not listed. Other columns are not read.
    """
    spark = docs.sparkSession
    known = benchmark.select(F.col(item).cast("long").alias("item"), F.col(item_text).alias("text")).mapInArrow(
        by_slice("text", _item_windows(window, gram)), "item long, length int, mark long, whole long"
    )
    # All windows of a passage stand in the same items: what documents are joined with is the
    # name of that set, once a window, and the set's items only once a document.
    ids = F.array_sort(F.collect_set(F.col("item").cast("string")))
    sets = known.groupBy("length", "mark", "whole").agg(ids.alias("items"))
    listed = landed(sets.withColumn("items_name", F.sha2(F.concat_ws(",", "items"), 256)), "benchmark-windows")
    blocks = max(1, -(-listed.count() // block))
    wanted = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(key).alias("key"), F.col(text).alias("text"))
    if blocks > 1:
        # Rows need the same numbers in each scan, also where their order does not repeat.
        wanted = landed(wanted, "numbered-documents")
    kind = docs.schema[key].dataType.simpleString()
    found = f"uid long, key {kind}, n_words long, found array<struct<at: long, length: int, mark: long, whole: long>>"
    scans = []
    for b in range(blocks):
        part = listed.where(F.pmod(F.xxhash64("mark"), F.lit(blocks)) == b)
        marks = part.select("length", "mark").distinct().toArrow()
        length, mark = (marks.column(n).to_numpy() for n in ("length", "mark"))
        sent = spark.sparkContext.broadcast({int(n): np.unique(mark[length == n].view(np.uint64)) for n in np.unique(length)})
        scans.append(landed(wanted.mapInArrow(_document_windows(sent, gram), found), "candidate-windows"))
    # Only documents with candidates are joined; no row is without a key.
    opened = functools.reduce(DataFrame.unionByName, scans).select("uid", F.explode("found").alias("w")).select("uid", "w.*")
    hits = opened.join(listed.drop("items"), ["length", "mark", "whole"]).groupBy("uid").agg(
        F.array_sort(F.collect_set(F.struct("at", "length"))).alias("spans"), F.collect_set("items_name").alias("names")
    )
    hits = landed(hits, "hit-documents")
    named = listed.select("items_name", "items").distinct()
    items = hits.select("uid", F.explode("names").alias("items_name")).join(named, "items_name").groupBy("uid").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("item_ids")
    )
    end = F.lit(0).cast("long")
    covered = F.aggregate(
        "spans",
        F.struct(end.alias("end"), end.alias("total")),
        lambda s, x: F.struct(
            F.greatest(s["end"], x["at"] + x["length"]).alias("end"),
            (s["total"] + F.greatest(end, x["at"] + x["length"] - F.greatest(s["end"], x["at"]))).alias("total"),
        ),
        lambda s: s["total"],
    )
    judged = hits.select("uid", covered.alias("n_hit")).join(items, "uid")
    listed_ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    return (
        scans[0]
        .join(judged, "uid", "left_outer")
        .select(
            F.col("key").alias(key),
            "n_words",
            F.coalesce("n_hit", end).alias("n_hit"),
            F.size(listed_ids).cast("long").alias("n_items"),
            listed_ids.alias("item_ids"),
            F.col("n_hit").isNotNull().alias("contaminated"),
        )
    )
