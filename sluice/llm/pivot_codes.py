"""Vectors as short codes: codebooks trained with LAESA pivots, exactly on integers.

A vector is cut into equal parts and every part becomes the index of the nearest entry of
its position's codebook. Distances from every part to a few fixed pivots are computed once
and written beside the parts. In each round the entries' distances to the same pivots
give, by the triangle inequality, a lower bound of every part-entry distance: the entry
with the least bound is evaluated first, the next few after it, and then only those whose
bound does not exceed the best distance found. Bounds are floats rounded down; whatever
they leave is decided by exact integers, ties to the lower index.

A round is one pass over the written table. Tasks add up the parts of each entry; sums of
fixed size (positions x entries) reach the driver, which forms the next codebooks.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sluice.llm.components import landed
from sluice.llm.text import batch_of

PARTS, ENTRIES, ROUNDS = 4, 256, 4
PIVOTS = 8
SCALE = 1024
# Entries evaluated at once in the order of their bounds, and vectors assigned at once.
FIRST = 4
SLICE_ROWS = 1024
# Where more than this share of the pairs stays open, one product evaluates them faster than
# one by one; what the bounds have ruled out is left out of it afterwards.
MANY = 0.1


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared Euclidean distances of the rows of two arrays of integers."""
    gap = a - b
    return np.einsum("...i,...i->...", gap, gap)


def choose_pivots(book: np.ndarray, n: int = PIVOTS) -> np.ndarray:
    """Entries of a codebook, each the furthest from those chosen before (ties: the first)."""
    chosen = [0]
    near = distances(book, book[0])
    while len(chosen) < min(n, len(book)):
        chosen.append(int(near.argmax()))
        near = np.minimum(near, distances(book, book[chosen[-1]]))
    return book[chosen]


def _roots(squared: np.ndarray) -> np.ndarray:
    return np.sqrt(squared.astype(np.float64))


class Nearest:
    """Nearest entries of one codebook, by distances to fixed pivots."""

    def __init__(self, book: np.ndarray, pivots: np.ndarray):
        self.book = book
        self.from_pivots = _roots(distances(book[None], pivots[:, None])).astype(np.float32)
        self.evaluated = 0

    def bounds(self, to_pivots: np.ndarray) -> np.ndarray:
        """Lower bounds of the squared distances, rounded down: 32-bit roots are off by less
        than one in four million."""
        low = np.zeros((len(to_pivots), len(self.book)), np.float32)
        for p, entries in enumerate(self.from_pivots):
            np.maximum(low, np.abs(to_pivots[:, p, None] - entries), out=low)
        slack = (to_pivots.max(axis=1) + self.from_pivots.max()) * np.float32(1e-6)
        return np.maximum(low - slack[:, None], 0) ** 2 * np.float32(1 - 1e-6)

    def assign(self, parts: np.ndarray, squared_to_pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry of each part."""
        size = len(self.book)
        bound = self.bounds(_roots(squared_to_pivots).astype(np.float32))
        some = min(FIRST, size)
        first = np.argpartition(bound, some - 1, axis=1)[:, :some] if some < size else np.tile(np.arange(size), (len(parts), 1))
        # Distance and index as one number: the least is the nearest, ties to the lower index.
        best = (distances(parts[:, None], self.book[first]) * size + first).min(axis=1)
        np.put_along_axis(bound, first, np.inf, axis=1)
        open_ = bound <= (best // size)[:, None]
        self.evaluated += first.size + int(open_.sum())
        if open_.mean() > MANY and self._exact_in_floats(parts):
            best = np.minimum(best, np.where(open_, self._all(parts) * size + np.arange(size), best[:, None]).min(axis=1))
            return best % size, best // size
        row, entry = np.nonzero(open_)
        if len(row):
            found = distances(parts[row], self.book[entry]) * size + entry
            begins = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
            rows = row[begins]
            best[rows] = np.minimum(best[rows], np.minimum.reduceat(found, begins))
        return best % size, best // size

    def _exact_in_floats(self, parts: np.ndarray) -> bool:
        """Whether products of these integers add up below 2^53, where doubles are exact."""
        most = max(np.abs(parts).max(initial=0), np.abs(self.book).max(initial=0))
        return 4 * int(most) ** 2 * self.book.shape[1] < 1 << 53

    def _all(self, parts: np.ndarray) -> np.ndarray:
        """Distances of all parts to all entries by one matrix product."""
        x, e = parts.astype(np.float64), self.book.astype(np.float64)
        return ((x**2).sum(axis=1)[:, None] + (e**2).sum(axis=1) - 2 * (x @ e.T)).astype(np.int64)


def scaled(column: pa.Array, width: int, largest: int) -> np.ndarray:
    """Vectors as integers floor(1024 x), one row each."""
    values = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(column), width)
    whole = np.floor(values * SCALE)
    if np.abs(whole).max(initial=0) > largest:
        raise ValueError(f"a component is beyond {largest / SCALE:g}, too large for exact 64-bit distances")
    return whole.astype(np.int64)


def _lists(values: np.ndarray) -> pa.Array:
    rows, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * width), pa.array(values.ravel()))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _pieces(batches):
    for batch in batches:
        for first in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(first, SLICE_ROWS)


def usable(vectors: DataFrame, column: str) -> DataFrame:
    """Rows whose vector is there and holds only finite numbers."""
    finite = F.forall(column, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return vectors.where(F.col(column).isNotNull() & finite)


class Trained:
    """Codebooks of every position, and the pivots that the written distances belong to."""

    def __init__(self, books: list[np.ndarray], pivots: list[np.ndarray]):
        self.books, self.pivots = books, pivots

    @property
    def width(self) -> int:
        return self.books[0].shape[1]

    def assigned(self, piece: pa.RecordBatch):
        """Per position: the integer parts of a piece, their entries and squared distances."""
        whole = _matrix(piece.column("parts"), PARTS * self.width).astype(np.int64)
        known = len(self.pivots[0])
        near = _matrix(piece.column("to_pivots"), PARTS * known)
        for k, (book, pivots) in enumerate(zip(self.books, self.pivots)):
            parts = whole[:, k * self.width : (k + 1) * self.width]
            yield parts, *Nearest(book, pivots).assign(parts, near[:, k * known : (k + 1) * known])

    def digest(self) -> str:
        """SHA-256 of all entries as decimal numbers, by position, entry and component."""
        return hashlib.sha256(",".join(str(x) for b in self.books for x in b.ravel().tolist()).encode()).hexdigest()


def _sums(model: Trained):
    """Sums and numbers of the parts of every entry in a task."""

    def run(batches):
        total = [np.zeros((len(b), model.width), np.int64) for b in model.books]
        count = [np.zeros(len(b), np.int64) for b in model.books]
        for piece in _pieces(batches):
            for k, (parts, entry, _) in enumerate(model.assigned(piece)):
                order = np.argsort(entry, kind="stable")
                begins = np.flatnonzero(np.append(True, entry[order][1:] != entry[order][:-1]))
                total[k][entry[order][begins]] += np.add.reduceat(parts[order], begins, axis=0)
                count[k] += np.bincount(entry, minlength=len(count[k]))
        for k, n in enumerate(count):
            used = np.flatnonzero(n)
            columns = {f"s{i}": total[k][used, i] for i in range(model.width)}
            yield batch_of(position=np.full(len(used), k), entry=used, n=n[used], **columns)

    return run


def train_codebooks(table: DataFrame, model: Trained, rounds: int = ROUNDS) -> Trained:
    """The codebooks after `rounds` rounds over a table of `parts` and `to_pivots`."""
    sums = [f"s{i}" for i in range(model.width)]
    schema = "position long, entry long, n long" + "".join(f", {s} long" for s in sums)
    for _ in range(rounds):
        found = table.select("parts", "to_pivots").mapInArrow(_sums(model), schema)
        books = [b.copy() for b in model.books]
        for row in found.groupBy("position", "entry").agg(*[F.sum(c).alias(c) for c in ("n", *sums)]).collect():
            books[row["position"]][row["entry"]] = [row[s] // row["n"] for s in sums]
        model = Trained(books, model.pivots)
    return model


def _first_books(kept: DataFrame, key: str, column: str, entries: int) -> tuple[int, int, list[np.ndarray]]:
    """Width of a part, largest component allowed, and the parts of the vectors with the least keys."""
    common = kept.groupBy(F.size(column).alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    if common is None:
        return 0, 0, []
    if common["n"] % PARTS:
        raise ValueError(f"vectors of {common['n']} components cannot be cut into {PARTS} equal parts")
    width = common["n"] // PARTS
    # (2 largest)^2 * width * entries stays below 2^62.
    largest = int((2**60 / max(1, width * entries)) ** 0.5)
    first = kept.where(F.size(column) == common["n"]).orderBy(F.asc_nulls_last(key), column).limit(entries)
    lists = pa.array([r[0] for r in first.select(column).collect()], pa.list_(pa.float64()))
    whole = scaled(lists, PARTS * width, largest)
    return width, largest, [whole[:, k * width : (k + 1) * width].copy() for k in range(PARTS)]


def compress(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", label: str = "label", rounds: int = ROUNDS, entries: int = ENTRIES) -> tuple[DataFrame, Trained | None]:
    """Key, label, code (one byte a part) and error of each vector, and the trained codebooks.

    Rows whose vector is null or holds null, NaN or an infinity are dropped, and so are those
    whose length differs from the most common one. The codebooks start as the parts of the
    `entries` (at most 256) least keys, rows of one key by their vectors, null keys last; with fewer
    vectors they are smaller. Repeated rows and keys count each. Vectors without components
    all have error 0. Components are limited so that distances are exact in 64 bits; a larger
    one, or a length that is no multiple of 4, is a ValueError. An empty table gives no rows
    and no codebooks. Other columns are not read.
    """
    if not 1 <= entries <= ENTRIES:
        raise ValueError(f"entries must be from 1 to {ENTRIES}")
    kept = usable(vectors.select(F.col(key), F.col(column).cast("array<double>"), F.col(label)), column)
    kept = kept.toDF("vec_id", "embedding", "label")
    kinds = {f.name: f.dataType.simpleString() for f in kept.schema}
    shape = f"vec_id {kinds['vec_id']}, label {kinds['label']}"
    width, largest, books = _first_books(kept, "vec_id", "embedding", entries)
    if not books:
        return vectors.sparkSession.createDataFrame([], f"{shape}, code binary, error long"), None
    model = Trained(books, [choose_pivots(b) for b in books])

    def measured(batches):
        for piece in _pieces(batches):
            whole = scaled(piece.column("embedding"), PARTS * width, largest)
            near = [distances(whole[:, None, k * width : (k + 1) * width], p[None]) for k, p in enumerate(model.pivots)]
            yield batch_of(
                vec_id=piece.column("vec_id"), label=piece.column("label"), parts=_lists(whole), to_pivots=_lists(np.concatenate(near, axis=1))
            )

    same = kept.where(F.size("embedding") == PARTS * width)
    table = landed(same.mapInArrow(measured, f"{shape}, parts array<long>, to_pivots array<long>"), "parts")
    trained = train_codebooks(table, model, rounds)

    def coded(batches):
        for piece in _pieces(batches):
            found = list(trained.assigned(piece))
            codes = np.stack([entry for _, entry, _ in found], axis=1).astype(np.uint8)
            error = sum(d for _, _, d in found)
            code = pa.array([row.tobytes() for row in codes], pa.binary())
            yield batch_of(vec_id=piece.column("vec_id"), label=piece.column("label"), code=code, error=error)

    return table.mapInArrow(coded, f"{shape}, code binary, error long"), trained


def with_label_errors(codes: DataFrame) -> DataFrame:
    """Adds label_error, the errors of a label's vectors summed, null labels together.

    The sums are written before they are joined, so that adaptive execution can split a label
    with most of the vectors.
    """
    codes = landed(codes, "codes")
    sums = landed(codes.groupBy("label").agg(F.sum("error").alias("label_error")), "label_errors")
    joined = codes.join(sums.withColumnRenamed("label", "_label"), F.col("label").eqNullSafe(F.col("_label")))
    return joined.drop("_label")
