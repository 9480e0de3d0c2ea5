"""Byte-level deduplication by blockwise suffix sorting with a difference cover.

A window is `size` bytes. Its anchor is the minimum hash among the `gram`-byte runs in it:
equal windows have equal anchors at equal offsets, so windows can only repeat around
anchors that do. For each occurrence of a repeated anchor, the bytes that windows over it
can reach go to the task of the anchor's bucket.

There, suffixes are sorted one suffix bucket at a time: the bucket of the suffixes that
begin a given number of bytes before their anchor. All columns of the reach that lie in
a difference cover modulo 16 are ranked once, from right to left; a suffix is then sorted
by the few bytes before its next cover column and by the rank there, which settles ties of
any length. Neighbours that agree on `size` bytes are repeats, compared byte by byte. Of
equal reaches only the first occurrence is sorted, and anchors are taken in groups of a
bounded number of reaches, so memory is bounded by that number and not by the input.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sluice.llm.chunks import (
    ASK, asks, buckets_for, chunked, doc_ids, exchange, in_order, is_in, repeated_keys, repeated_seeds, seed_asks, texts_of, with_replies,
)
from sluice.llm.text import Texts, byte_values, covered, mix, polynomial, sliding

SIZE = 100
GRAM = 32
# Reaches whose suffixes are sorted together.
AT_ONCE = 60_000

# Fixed value: a difference cover modulo 16; every residue is a difference of two of these.
COVER_PERIOD, COVER = 16, (0, 1, 2, 5, 8)

_REACH = 0xA0761D6478BD642F


def _anchors(texts: Texts, size: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, rows and hashes of the anchors of all windows inside one row."""
    n = len(texts.data)
    if n < size:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64)
    starts = np.arange(n - gram + 1)
    hashes = polynomial(byte_values(texts.data), starts, starts + gram)
    low = sliding(hashes, size - gram + 1)
    # A window that reaches into the next row is none: it asks for 0, which no hash is.
    ends = np.searchsorted(texts.offsets, np.arange(len(low)), "right")
    low[np.arange(len(low)) + size > texts.offsets[np.minimum(ends, len(texts))]] = 0
    width = size - gram
    reach = np.concatenate([np.zeros(width, np.uint64), low, np.zeros(width, np.uint64)])
    at = np.flatnonzero((sliding(reach, width + 1, np.maximum) == hashes) & (hashes != 0))
    return at, np.searchsorted(texts.offsets, at, "right") - 1, hashes[at]


def _all_anchors(docs: bytes, text: str, size: int, gram: int) -> np.ndarray:
    found = [_anchors(texts, size, gram)[2] for _, texts in texts_of(docs, text)]
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


class _Occurrences:
    """Occurrences of repeated anchors in a chunk, with the bytes that windows over them reach.

    `first` marks the earliest occurrence in the chunk of each distinct reach; only those
    are asked about, in the order of `asked`.
    """

    def __init__(self, docs: bytes, text: str, key: str, size: int, gram: int, buckets: int, replies: dict[int, bytes]):
        self.size, self.gram = size, gram
        repeated = repeated_seeds(_all_anchors(docs, text, size, gram), buckets, replies)
        columns: list[list[np.ndarray]] = []
        self.parts = []
        for i, (part, texts) in enumerate(texts_of(docs, text)):
            at, row, anchor = _anchors(texts, size, gram)
            kept = is_in(anchor, repeated)
            at, row, anchor = at[kept], row[kept], anchor[kept]
            left = np.minimum(at - texts.offsets[row], size - gram)
            right = np.minimum(texts.offsets[row + 1] - at, size)
            values = byte_values(texts.data)
            names = [polynomial(values, at - left, at + right, b) + (left.astype(np.uint64) << np.uint64(8)) for b in (_REACH, 0x9E3779B97F4A7C15)]
            columns.append([np.full(len(at), i), at, row, doc_ids(part, key)[row], at - texts.offsets[row], left, right, anchor, *names])
            self.parts.append((part, texts))
        self.part, self.at, self.row, self.doc, self.start, self.left, self.right, self.anchor, a, b = (
            (np.concatenate(x) for x in zip(*columns)) if columns else [np.zeros(0, np.int64)] * 10
        )
        order = np.lexsort((self.start, self.row, self.part, self.doc, b, a))
        new = np.ones(len(order), bool)
        new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
        self.asked = order[new]
        self.first = np.zeros(len(order), bool)
        self.first[self.asked] = True

    def reaches(self, which: np.ndarray) -> np.ndarray:
        """A line of bytes for each occurrence, the anchor at the same column in all."""
        before, width = self.size - self.gram, 2 * self.size - self.gram
        out = np.zeros((len(which), width), np.uint8)
        columns = np.arange(width)
        for i, (_, texts) in enumerate(self.parts):
            own = np.flatnonzero(self.part[which] == i)
            if len(own):
                w = which[own]
                place = self.at[w][:, None] + (columns - before)
                inside = (columns >= before - self.left[w][:, None]) & (columns < before + self.right[w][:, None])
                out[own] = np.where(inside, texts.data[np.clip(place, 0, len(texts.data) - 1)], 0)
        return out


_PLACE = np.dtype([("anchor", "u8"), ("doc", "i8"), ("part", "i4"), ("row", "i4"), ("start", "i8"), ("left", "u1"), ("right", "u1")])


def _words_at(lines: np.ndarray, start: int, stop: int) -> np.ndarray:
    """Up to 8 bytes of each line as one big-endian number."""
    out = np.zeros(len(lines), np.uint64)
    for c in range(start, stop):
        out = (out << np.uint64(8)) | lines[:, c]
    return out


def _digests(lines: np.ndarray) -> list[np.ndarray]:
    """Two hashes of each line, 8 bytes at a time and without a table as large as the lines."""
    out = [np.full(len(lines), salt, np.uint64) for salt in (_REACH, 0x9E3779B97F4A7C15)]
    for c in range(0, lines.shape[1], 8):
        word = _words_at(lines, c, min(c + 8, lines.shape[1]))
        out = [mix(h ^ word) + np.uint64(i + 1) for i, h in enumerate(out)]
    return out


def _ranked(head: np.ndarray, tail: np.ndarray) -> np.ndarray:
    order = np.lexsort((tail, head))
    new = np.ones(len(head), np.int64)
    new[1:] = (head[order][1:] != head[order][:-1]) | (tail[order][1:] != tail[order][:-1])
    out = np.empty(len(head), np.int32)
    out[order] = np.cumsum(new)
    return out


def cover_ranks(lines: np.ndarray) -> dict[int, np.ndarray]:
    """Ranks of the suffixes that begin at each cover column, from right to left."""
    width = lines.shape[1]
    columns = [c for c in range(width) if c % COVER_PERIOD in COVER]
    ranks, after, last = {}, width, np.zeros(len(lines), np.int32)
    for c in reversed(columns):
        last = _ranked(_words_at(lines, c, min(after, c + 8)), last)
        ranks[c] = last
        after = c
    return ranks


def repeats_of(lines: np.ndarray, anchor: np.ndarray, left: np.ndarray, right: np.ndarray, size: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """For reaches in order of occurrence: how far before and after its anchor the windows
    lie that also occur at an earlier reach of the same anchor; 0, 0 where none do."""
    before = size - gram
    ranks = cover_ranks(lines)
    group = np.unique(anchor, return_inverse=True)[1]
    most, least = np.full(len(lines), -1), np.full(len(lines), size)
    for o in range(before + 1):
        column = before - o
        usable = np.flatnonzero((left >= o) & (right >= size - o))
        if len(usable) < 2:
            continue
        cover = next(c for c in range(column, lines.shape[1]) if c in ranks)
        own = lines[usable]
        head = _words_at(own, column, cover)
        order = np.lexsort((usable, ranks[cover][usable], head, group[usable]))
        a, b = order[:-1], order[1:]
        alike = (group[usable[a]] == group[usable[b]]) & (head[a] == head[b])
        near = np.flatnonzero(alike)
        same = (own[a[near], column : column + size] == own[b[near], column : column + size]).all(axis=1)
        alike[near] = same
        # The first of each run of equal windows is its earliest only after a look at all.
        run = np.cumsum(np.append(True, ~alike)) - 1
        earliest = np.full(run[-1] + 1, len(lines))
        np.minimum.at(earliest, run, usable[order])
        hit = usable[order][usable[order] > earliest[run]]
        most[hit] = np.maximum(most[hit], o)
        least[hit] = np.minimum(least[hit], o)
    found = most >= 0
    return np.where(found, most, 0).astype(np.uint8), np.where(found, size - least, 0).astype(np.uint8)


def _judge(size: int, gram: int, at_once: int):
    width = 2 * size - gram
    item = _PLACE.itemsize + width

    def answer(asked: list[bytes], chunks: list[int]) -> list[bytes]:
        raw = [pa.decompress(a[8:], int.from_bytes(a[:8], "little"), "zstd", asbytes=True) for a in asked]
        counts = [len(r) // item for r in raw]
        places = np.concatenate([np.frombuffer(r, _PLACE, n) for r, n in zip(raw, counts)])
        lines = np.concatenate([np.frombuffer(r, np.uint8, n * width, n * _PLACE.itemsize).reshape(n, width) for r, n in zip(raw, counts)])
        del raw
        chunk = np.repeat(np.array(chunks, np.int64), counts)
        # Occurrence order; then equal reaches of an anchor side by side, the earliest first.
        order = np.lexsort((places["start"], places["row"], places["part"], chunk, places["doc"]))
        places, lines = places[order], lines[order]
        names = _digests(lines)
        by = np.lexsort((np.arange(len(lines)), places["right"], places["left"], *names, places["anchor"]))
        near, far = by[:-1], by[1:]
        twin = np.zeros(len(by), bool)
        twin[1:] = (
            (places["anchor"][near] == places["anchor"][far]) & (places["left"][near] == places["left"][far])
            & (places["right"][near] == places["right"][far]) & (names[0][near] == names[0][far]) & (names[1][near] == names[1][far])
        )
        before, after = np.zeros(len(by), np.uint8), np.zeros(len(by), np.uint8)
        copies = by[twin]  # an equal reach occurred before
        before[copies], after[copies] = places["left"][copies], places["right"][copies]
        single = by[~twin]
        anchors, group, members = np.unique(places["anchor"][single], return_inverse=True, return_counts=True)
        shared = single[members[group] > 1]
        edges = np.cumsum(np.where(members > 1, members, 0))
        last = 0
        while last < len(shared):  # whole anchors, about `at_once` reaches
            stop = int(edges[min(np.searchsorted(edges, last + at_once, "right"), len(edges) - 1)])
            stop = stop if stop > last else len(shared)
            own = np.sort(shared[last:stop])
            before[own], after[own] = repeats_of(lines[own], places["anchor"][own], places["left"][own], places["right"][own], size, gram)
            last = stop
        out = np.empty((len(by), 2), np.uint8)
        out[order, 0], out[order, 1] = before, after
        cuts = np.append(0, np.cumsum(counts))
        return [out[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]

    return answer


def dedup_bytes(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE, gram: int = GRAM, at_once: int = AT_ONCE) -> DataFrame:
    """Key, n_bytes, n_removed, spans (array of start and length, in bytes) and kept (binary),
    a row per row of `docs`.

    A byte of the UTF-8 text goes if a run of `size` bytes over it also starts earlier: in a
    document of a smaller key, or before in the same one. Runs are judged on the input and
    never cross documents. Null and empty texts have no bytes. Rows of one key follow each
    other in the order of the table's chunks; a null key counts as greater than all others.
    `size` is at most 255. Other columns are not read.
    """
    kind = docs.schema[key].dataType.simpleString()
    chunks = chunked(docs.select(key, text), text)
    buckets = buckets_for(chunks)

    def ask_anchors(batches):
        for batch in batches:
            for chunk, packed in zip(batch.column("chunk").to_pylist(), batch.column("docs")):
                yield seed_asks(chunk, _all_anchors(packed.as_py(), text, size, gram), buckets)

    anchors = exchange(chunks.mapInArrow(ask_anchors, ASK), repeated_keys, "anchors")

    def ask_reaches(chunk, packed, replies):
        found = _Occurrences(packed, text, key, size, gram, buckets, replies[0])
        which = found.asked

        def packed_places(at: np.ndarray) -> bytes:
            w = which[at]
            place = np.empty(len(w), _PLACE)
            for name in _PLACE.names:
                place[name] = getattr(found, name)[w]
            raw = place.tobytes() + found.reaches(w).tobytes()
            return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)

        yield asks(chunk, found.anchor[which], buckets, packed_places)

    reaches = exchange(with_replies(chunks, [anchors], ask_reaches, ASK), _judge(size, gram, at_once), "reaches")

    def cut(chunk, packed, replies):
        found = _Occurrences(packed, text, key, size, gram, buckets, replies[0])
        before, after = found.left.copy(), found.right.copy()  # later ones in the chunk: all windows
        told = in_order(found.anchor[found.asked], buckets, replies[1], np.dtype([("before", "u1"), ("after", "u1")]))
        before[found.asked], after[found.asked] = told["before"], told["after"]
        used = before + after >= size
        for i, (part, texts) in enumerate(found.parts):
            own = used & (found.part == i)
            gone = covered(len(texts.data), found.at[own] - before[own], found.at[own] + after[own])
            sizes = np.diff(texts.offsets)
            edge = np.zeros(len(gone) + 1, bool)
            edge[texts.offsets] = True
            starts = np.flatnonzero(gone & np.append(True, ~gone[:-1] | edge[1:-1])) if len(gone) else np.zeros(0, np.int64)
            stops = np.flatnonzero(gone & np.append(~gone[1:] | edge[1:-1], True)) + 1 if len(gone) else starts
            row = np.searchsorted(texts.offsets, starts, "right") - 1
            entries = pa.StructArray.from_arrays([pa.array(starts - texts.offsets[row]), pa.array(stops - starts)], names=["start", "length"])
            total = np.append(0, np.cumsum(gone))
            left = texts.data[~gone].tobytes()
            ends = texts.offsets - total[texts.offsets]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(key), pa.array(sizes), pa.array(sizes - np.diff(ends)),
                    pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(len(texts) + 1)), pa.int32()), entries),
                    pa.array([left[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())], pa.binary()),
                ],
                names=[key, "n_bytes", "n_removed", "spans", "kept"],
            )

    return with_replies(chunks, [anchors, reaches], cut, f"`{key}` {kind}, n_bytes long, n_removed long, spans array<struct<start: long, length: long>>, kept binary")
