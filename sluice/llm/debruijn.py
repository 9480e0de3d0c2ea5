"""Substring deduplication by compacting the de Bruijn graph of repeated word windows.

Every window of `size` words is an edge of the graph. The minimum hash of the `seed`-word
runs in a window is its seed; equal windows have equal seeds, so only windows whose seed
occurs in two documents can repeat, which leaves few of them. Of these, the edges found in
two documents make the graph. Edges that always follow each other are one nonbranching
path: documents traverse it whole or not at all, so a path is named by a digest of its
words and has one first document, found by grouping and joining paths, far fewer than
windows. The coordinates and digests of the paths verify each repeated span against its
source, and everything but the source's own copy is removed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sluice.llm.chunks import (
    ASK, asks, buckets_for, chunked, doc_ids, exchange, in_order, is_in, repeated_keys, repeated_seeds, seed_asks, texts_of, with_replies,
)
from sluice.llm.components import landed
from sluice.llm.text import WORD, Words, batch_of, grams, rolling, sliding

SIZE = 13
SEED = 5

_EDGE, _DIGEST = 0xA0761D6478BD642F, 0xE7037ED1A0B428DB
REPEATED, ONE_BEFORE, ONE_AFTER = 1, 2, 4


def _windows(docs: bytes, text: str, key: str, size: int, seed: int) -> list[tuple[np.ndarray, Words, np.ndarray, np.ndarray]]:
    """The words of a chunk, cut once: per part the documents' ids, the words, and the first
    words and seeds of the windows inside one row. A chunk's size bounds what is held."""
    found = []
    for part, texts in texts_of(docs, text):
        words = texts.words()
        at = np.flatnonzero(words.within(size))
        found.append((doc_ids(part, key), words, at, sliding(grams(words.hash, seed), size - seed + 1)[at]))
    return found


def _seeds(windows: list) -> np.ndarray:
    """The distinct seeds of each document."""
    found = []
    for own, words, at, low in windows:
        row = words.row[at]
        new = np.ones(len(at), bool)
        new[1:] = (low[1:] != low[:-1]) | (row[1:] != row[:-1])
        ids = own[row[new]]
        pairs = np.unique(np.rec.fromarrays([low[new], ids], names="low,id")) if new.any() else None
        if pairs is not None:
            found.append((pairs["low"], pairs["id"]))
    if not found:
        return np.zeros(0, np.uint64)
    low, ids = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((ids, low))
    low, ids = low[order], ids[order]
    new = np.ones(len(low), bool)
    new[1:] = (low[1:] != low[:-1]) | (ids[1:] != ids[:-1])
    return low[new]


def _edges(windows: list, size: int, repeated: np.ndarray) -> list[tuple[np.ndarray, Words, np.ndarray, np.ndarray]]:
    """Candidate windows of a chunk: the documents' ids, words, first words, edge keys."""
    found = []
    for own, words, at, low in windows:
        at = at[is_in(low, repeated)]
        found.append((own, words, at, grams(words.hash, size, _EDGE)[at]))
    return found


def _neighbours(words: Words, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the words before and after each window; 0 where the document ends."""
    none = np.uint64(0)
    before = np.where(at > words.edges[words.row[at]], words.hash[np.maximum(at - 1, 0)], none)
    after = np.where(at + size < words.edges[words.row[at] + 1], words.hash[np.minimum(at + size, len(words) - 1)], none)
    return before, after


_ENTRY = np.dtype([("edge", "u8"), ("least", "i8"), ("most", "i8"), ("before", "u8"), ("after", "u8")])


def _merged(entries: np.ndarray) -> np.ndarray:
    """One entry per edge: its least and greatest document, and its only neighbours or 0."""
    entries = entries[np.argsort(entries["edge"], kind="stable")]
    first = np.flatnonzero(np.append(True, entries["edge"][1:] != entries["edge"][:-1])) if len(entries) else np.zeros(0, np.int64)
    out = entries[first]
    if len(first):
        out["least"] = np.minimum.reduceat(entries["least"], first)
        out["most"] = np.maximum.reduceat(entries["most"], first)
        for side in ("before", "after"):
            low, high = np.minimum.reduceat(entries[side], first), np.maximum.reduceat(entries[side], first)
            out[side] = np.where(low == high, low, 0)
    return out


def _columns(entries: np.ndarray) -> bytes:
    """Column by column and byte by byte, with `most` as what it adds to `least`: bytes that
    are mostly zero lie together and compress to next to nothing."""
    entries = entries.copy()
    entries["most"] -= entries["least"]
    return b"".join(np.ascontiguousarray(entries[n]).view(np.uint8).reshape(-1, 8).T.tobytes() for n in _ENTRY.names)


def _entries(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(packed, np.uint8).reshape(len(_ENTRY.names), 8, -1)
    out = np.empty(planes.shape[2], _ENTRY)
    for name, bytes_of in zip(_ENTRY.names, planes):
        out[name] = np.ascontiguousarray(bytes_of.T).view(_ENTRY[name]).ravel()
    out["most"] += out["least"]
    return out


def _judge_edges(asked: list[bytes], chunks: list[int]) -> list[bytes]:
    arrays = [_entries(a) for a in asked]
    whole = _merged(np.concatenate(arrays))
    flags = (whole["least"] < whole["most"]) * REPEATED + (whole["before"] > 0) * ONE_BEFORE + (whole["after"] > 0) * ONE_AFTER
    flags = flags.astype(np.uint8)
    return [flags[np.searchsorted(whole["edge"], a["edge"])].tobytes() for a in arrays]


PATHS = "chunk long, part int, row int, start long, n long, doc long, high long, low long"


def _paths(words: Words, at: np.ndarray, flags: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Nonbranching paths: first word and number of words of each run of repeated windows in
    which each has one successor and each successor one predecessor."""
    kept = (flags & REPEATED) > 0
    at, flags = at[kept], flags[kept]
    joined = np.zeros(len(at), bool)
    joined[1:] = (at[1:] == at[:-1] + 1) & (words.row[at[1:]] == words.row[at[:-1]])
    joined[1:] &= ((flags[:-1] & ONE_AFTER) > 0) & ((flags[1:] & ONE_BEFORE) > 0)
    first = np.flatnonzero(~joined)
    last = np.append(first[1:], len(at))[: len(first)] - 1
    return at[first], at[last] + size - at[first]


def repeated_paths(chunks: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE, seed: int = SEED) -> DataFrame:
    """Every traversal of a nonbranching path of repeated windows, written: its place (chunk,
    part, row, start, n words), its document, and the digest of its words."""
    buckets = buckets_for(chunks)

    def ask_seeds(batches):
        for batch in batches:
            for chunk, docs in zip(batch.column("chunk").to_pylist(), batch.column("docs")):
                yield seed_asks(chunk, _seeds(_windows(docs.as_py(), text, key, size, seed)), buckets)

    seeds = exchange(chunks.mapInArrow(ask_seeds, ASK), repeated_keys, "seeds")

    def candidates(docs: bytes, replies: dict[int, bytes]) -> list:
        windows = _windows(docs, text, key, size, seed)
        return _edges(windows, size, repeated_seeds(_seeds(windows), buckets, replies))

    def merged(candidates: list) -> np.ndarray:
        found = []
        for ids, words, at, edge in candidates:
            own = np.empty(len(at), _ENTRY)
            own["edge"], own["least"] = edge, ids[words.row[at]]
            own["most"] = own["least"]
            own["before"], own["after"] = _neighbours(words, at, size)
            found.append(_merged(own))
        return _merged(np.concatenate(found)) if found else np.empty(0, _ENTRY)

    def ask_edges(chunk, docs, replies):
        entries = merged(candidates(docs, replies[0]))
        yield asks(chunk, entries["edge"], buckets, lambda at: _columns(entries[at]))

    edges = exchange(with_replies(chunks, [seeds], ask_edges, ASK), _judge_edges, "edges")

    def traverse(chunk, docs, replies):
        found = candidates(docs, replies[0])
        edges_of = np.unique(np.concatenate([edge for *_, edge in found])) if found else np.zeros(0, np.uint64)
        flags = in_order(edges_of, buckets, replies[1], np.uint8)
        for i, (ids, words, at, edge) in enumerate(found):
            first, n = _paths(words, at, flags[np.searchsorted(edges_of, edge)], size)
            row = words.row[first]
            yield batch_of(
                chunk=pa.array(np.full(len(first), chunk, np.int64)), part=pa.array(np.full(len(first), i), pa.int32()),
                row=pa.array(row, pa.int32()), start=first - words.edges[row], n=n, doc=ids[row],
                high=rolling(words.hash, first, first + n, _DIGEST).view(np.int64),
                low=rolling(words.hash, first, first + n).view(np.int64),
            )

    return landed(with_replies(chunks, [seeds, edges], traverse, PATHS), "paths")


def repeated_spans(paths: DataFrame) -> DataFrame:
    """Traversals whose words also stand in a document of a smaller id, with that source:
    the least document and the start there.

    The sources are written before they are joined, so that the join shuffles both of its sides
    itself and adaptive execution can split a path that very many documents traverse.
    """
    name = ["high", "low", "n"]
    first = paths.groupBy(*name).agg(F.min(F.struct("doc", "start")).alias("source"), F.max("doc").alias("most"))
    sources = landed(first.where("most > source.doc").select(*name, "source"), "sources")
    return paths.join(sources, name).where("doc > source.doc").select("chunk", "part", "row", "start", "n", "source")


def dedup_substrings(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE, seed: int = SEED) -> DataFrame:
    """`docs` with `text` less repeated spans, and n_words and n_removed added.

    A word goes if a window of `size` words over it also starts in a document with a smaller
    key; windows are judged on the input. Where words go, the others are joined by single
    spaces; a text that loses none stays as it is, and null stays null. Texts of fewer than
    `size` words keep all. Rows of one key are one document for each other: repeats among
    them stay. A null key counts as greater than all others. Columns of `docs` called
    n_words or n_removed are replaced.
    """
    docs = docs.drop("n_words", "n_removed")
    chunks = chunked(docs, text)
    spans = repeated_spans(repeated_paths(chunks, key, text, size, seed))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    fixed = spans.select("chunk", F.lit(0).alias("bucket"), F.struct("part", "row", "start", "n").alias("span"))

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        span = right.column("span").combine_chunks()
        where, row, start, n = (span.field(f).to_numpy(zero_copy_only=False) for f in ("part", "row", "start", "n"))
        order = np.argsort(where, kind="stable")
        out = []
        for docs_ in left.column("docs"):
            for i, (part, texts) in enumerate(texts_of(docs_.as_py(), text)):
                words = texts.words()
                own = order[np.searchsorted(where[order], i, "left") : np.searchsorted(where[order], i, "right")]
                first = words.edges[row[own]] + start[own]
                depth = np.zeros(len(words) + 1, np.int64)
                np.add.at(depth, first, 1)
                np.add.at(depth, first + n[own], -1)
                gone = np.cumsum(depth[:-1]) > 0
                total = np.append(0, np.cumsum(gone))
                removed = total[words.edges[1:]] - total[words.edges[:-1]]
                values = part.column(text)
                if removed.any():
                    rows = np.flatnonzero(removed)
                    fresh = dict(zip(rows.tolist(), (words.text(~gone, r).decode() for r in rows.tolist())))
                    values = pa.array([fresh.get(r, v) for r, v in enumerate(values.to_pylist())], values.type)
                columns = [values if name == text else part.column(name) for name in part.schema.names]
                out.append(
                    pa.RecordBatch.from_arrays([*columns, pa.array(words.counts()), pa.array(removed)], names=[*part.schema.names, "n_words", "n_removed"])
                )
        return pa.Table.from_batches(out)

    return chunks.groupBy("chunk").cogroup(fixed.groupBy("chunk")).applyInArrow(cut, f"{kinds}, n_words long, n_removed long")
