"""Numpy on the bytes of many texts at once: words, hashes of runs, sliding minima.

Task functions see an Arrow batch of texts as one byte array with row offsets. Work is
cut into slices of about `SLICE` bytes, so that memory follows the slice and the
longest single text, never the batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 20

# The white space of the word contracts, and 64-bit mixing constants.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
_STEP = 0x9E3779B97F4A7C15

WORD = np.ones(256, bool)
WORD[list(SPACES)] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
# Lower-case ASCII letters, digits and everything beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[ord("0") : ord("9") + 1] = ALNUM[ord("a") : ord("z") + 1] = ALNUM[0x80:] = True

NULL_ID = np.iinfo(np.int64).max


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(_MIX[0])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_MIX[1])
    return x ^ (x >> np.uint64(31))


_BYTE = mix((np.arange(1, 257, dtype=np.uint64) * np.uint64(_STEP))) | np.uint64(1)
_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse modulo 2**64 for i < n; base is odd."""
    if base not in _tables or len(_tables[base][0]) < n:
        size, both = max(n, SLICE), []
        for b in (base, pow(base, -1, 1 << 64)):
            table = np.full(size, b, np.uint64)
            table[0] = 1
            both.append(np.multiply.accumulate(table))
        if n > 8 * SLICE:
            return both[0], both[1]
        _tables[base] = (both[0], both[1])
    return _tables[base]


def polynomial(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _STEP) -> np.ndarray:
    """A cheap hash of values[start:end] for each pair, alike for alike sequences.

    A polynomial modulo 2**64: good for runs of a few hundred values only. There are pairs of
    sequences of 1,024 values that collide whatever the base is; use `rolling` for runs of any length.
    """
    power, inverse = _powers(base, len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * power[: len(values)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def byte_values(data: np.ndarray) -> np.ndarray:
    return _BYTE[data]


# Values hashed at once by `rolling`.
_AT_ONCE = 1 << 17


def rolling(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _STEP) -> np.ndarray:
    """A hash of values[start:end] for each pair, alike for alike sequences.

    Every value is scrambled together with its place in the run, and the results are added
    up, so that sequences collide like random 64-bit numbers, however they are built.
    """
    lengths = np.maximum(ends - starts, 0)
    out = np.empty(len(starts), np.uint64)
    before = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths, out=before[1:])
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(before, before[first] + _AT_ONCE, "right")) - 1)
        sizes = lengths[first:last]
        skipped = before[first:last] - before[first]
        place = np.arange(before[last] - before[first]) - np.repeat(skipped, sizes)
        held = values[place + np.repeat(starts[first:last], sizes)]
        key = (place.astype(np.uint64) + np.uint64(base & 0xFFFFFFFF)) * np.uint64(_STEP)
        total = np.zeros(len(held) + 1, np.uint64)
        np.cumsum(mix(held ^ key), out=total[1:])
        out[first:last] = total[skipped + sizes] - total[skipped]
        first = last
    return mix(out + lengths.astype(np.uint64) * np.uint64(base | 1))


def grams(values: np.ndarray, size: int, base: int = _STEP) -> np.ndarray:
    """Hashes of all runs of `size` consecutive values, by doubling: a run is named by the names
    of two shorter runs that cover it, scrambled after each step. Other names than `rolling`'s."""
    names, have = mix(values ^ np.uint64(base)), 1
    if len(values) < size:
        return names[:0]
    while have < size:
        step = min(have, size - have)
        names = mix(names[: len(names) - step] * np.uint64(_MIX[0]) + names[step:])
        have += step
    return names


def sliding(values: np.ndarray, width: int, op=np.minimum) -> np.ndarray:
    """op over every run of `width` values, in log(width) passes."""
    have = 1
    if len(values) < width:
        return values[:0]
    while have < width:
        step = min(have, width - have)
        values = op(values[: len(values) - step], values[step:])
        have += step
    return values


class Texts:
    """Rows of texts as bytes: `data`, `offsets` (one more than rows). Null counts as empty."""

    def __init__(self, column: pa.Array):
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        if not pa.types.is_large_binary(column.type):
            column = column.cast(pa.large_binary())
        if column.null_count:
            column = column.fill_null(b"")
        _, where, data = column.buffers()
        edges = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
        first = int(edges[0])
        whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        self.data, self.offsets = whole[first : int(edges[-1])], edges - first

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def row(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()

    def words(self, inside: np.ndarray = WORD, fold: np.ndarray | None = None) -> Words:
        return Words(self, inside, fold)


class Words:
    """Maximal runs of bytes of a class: start, end (bytes), row, and a hash of each."""

    def __init__(self, texts: Texts, inside: np.ndarray, fold: np.ndarray | None):
        data = texts.data if fold is None else fold[texts.data]
        n = len(data)
        held = np.zeros(n + 2, bool)
        held[1:-1] = inside[data]
        first = np.zeros(n + 1, bool)
        first[texts.offsets] = True
        self.start = np.flatnonzero(held[1:] & (~held[:-1] | first))
        self.end = np.flatnonzero(held[:-1] & (~held[1:] | first))
        self.row = np.searchsorted(texts.offsets, self.start, "right") - 1
        # First word of each row, and one past the last.
        self.edges = np.searchsorted(self.row, np.arange(len(texts) + 1))
        self.data = data

    @cached_property
    def hash(self) -> np.ndarray:
        return rolling(_BYTE[self.data], self.start, self.end)

    def __len__(self) -> int:
        return len(self.start)

    def counts(self) -> np.ndarray:
        return np.diff(self.edges)

    def within(self, size: int) -> np.ndarray:
        """For each run of `size` words: whether it stays in one row."""
        if len(self) < size:
            return np.zeros(0, bool)
        return self.row[: len(self) - size + 1] == self.row[size - 1 :]

    def text(self, keep: np.ndarray, row: int) -> bytes:
        """The kept words of a row joined by one space."""
        at = np.flatnonzero(keep[self.edges[row] : self.edges[row + 1]]) + self.edges[row]
        return b" ".join([self.data[s:e].tobytes() for s, e in zip(self.start[at].tolist(), self.end[at].tolist())])


def slices(batch: pa.RecordBatch, column: str, size: int = SLICE, rows: int | None = None) -> Iterator[pa.RecordBatch]:
    """Cut a batch where its texts reach `size` bytes, or `rows` if given; a longer text is a slice of its own."""
    lengths = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    total, first = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if i > first and (total + n > size or i - first == rows):
            yield batch.slice(first, i - first)
            total, first = 0, i
        total += n
    if first < batch.num_rows:
        yield batch.slice(first)


def by_slice(column: str, work: Callable[[pa.RecordBatch, Texts], pa.RecordBatch | None], rows: int | None = None):
    """A function for mapInArrow that applies `work` to each slice, of at most `rows` rows if given."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, column, rows=rows):
                out = work(part, Texts(part.column(column)))
                if out is not None and out.num_rows:
                    yield out

    return run


def covered(size: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of `size` places lie in any [start, end)."""
    depth = np.zeros(size + 1, np.int64)
    np.add.at(depth, starts, 1)
    np.add.at(depth, ends, -1)
    return np.cumsum(depth[:-1]) > 0


def per_row(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Sums of values between consecutive edges."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[edges[1:]] - total[edges[:-1]]


def ids_of(column: pa.Array) -> np.ndarray:
    """Document ids as int64; null sorts after all others."""
    return column.cast(pa.int64()).fill_null(int(NULL_ID)).to_numpy(zero_copy_only=False)


def batch_of(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], names=list(columns))
