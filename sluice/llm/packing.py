"""Best-fit packing by minimum bin slack.

Only the number of pieces of each length matters for a plan, and there are at most
`capacity` lengths. The driver holds that histogram and plans by minimum bin slack: the
bin that takes the longest remaining piece is filled as far as any combination of the
remaining lengths allows (subset sums as the bits of one integer), and that combination
is taken as often as its lengths last. Each combination uses a length up or nearly so,
which bounds their number, whatever the number of pieces.

The pieces stay in their tasks: a piece's rank among those of its length is its place in
its task plus the number in earlier tasks, and rank and length name its sequence.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from sluice.llm.text import Texts, batch_of, slices
from sluice.llm.tokens import ENCODE_SLICE, Encoder, with_end
from sluice.session import shared_folder

CAPACITY = 2048


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """Lengths, with how many of each, whose sum is the largest that is at most `room`."""
    lengths = sorted((n for n, c in counts.items() if c and n <= room), reverse=True)
    mask, reach, steps = (1 << (room + 1)) - 1, 1, []
    for n in lengths:
        left, step = min(counts[n], room // n), 1
        while left:  # 1, 2, 4, .. pieces at a time reach every number of them
            take = min(step, left)
            steps.append((n, take, reach))
            reach |= (reach << (n * take)) & mask
            left, step = left - take, step * 2
        if reach >> room & 1:
            break
    total, used = reach.bit_length() - 1, {}
    for n, take, before in reversed(steps):
        if not before >> total & 1:
            used[n] = used.get(n, 0) + take
            total -= n * take
    return used


def plan(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Combinations of lengths, each with the number of bins filled by it."""
    left, bins = dict(counts), []
    while left:
        longest = max(left)
        left[longest] -= 1
        fill = fullest(left, capacity - longest)
        left[longest] += 1
        fill[longest] = fill.get(longest, 0) + 1
        times = min(left[n] // c for n, c in fill.items())
        for n, c in fill.items():
            left[n] -= c * times
            if not left[n]:
                del left[n]
        bins.append((fill, times))
    return bins


def _layout(bins: list[tuple[dict[int, int], int]]) -> dict[str, np.ndarray]:
    """For ranges of ranks of each length: the bins and the offsets they go to."""
    rows, used, base = [], {}, 0
    for fill, times in bins:
        offset = 0
        for n, c in sorted(fill.items(), reverse=True):
            rows.append((n, used.get(n, 0), c, base, offset))
            used[n] = used.get(n, 0) + c * times
            offset += n * c
        base += times
    rows.sort()
    return dict(zip(("length", "rank", "per_bin", "base", "offset"), np.array(rows, np.int64).reshape(-1, 5).T))


def _ranked(length: str):
    """Adds the task and the place among the task's pieces of the same length."""

    def run(batches):
        task, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            sizes = batch.column(length).cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)
            order = np.argsort(sizes, kind="stable")
            first = np.searchsorted(sizes[order], sizes[order], "left")
            place = np.empty(len(sizes), np.int64)
            place[order] = np.arange(len(sizes)) - first
            values, counts = np.unique(sizes, return_counts=True)
            before = np.array([seen.get(n, 0) for n in values.tolist()], np.int64)
            place += before[np.searchsorted(values, sizes)]
            seen.update(zip(values.tolist(), (before + counts).tolist()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(sizes), task, np.int64)), pa.array(place)], names=[*batch.schema.names, "_task", "_place"]
            )

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY, length: str = "length") -> DataFrame:
    """`pieces` with sequence_id and offset, packed into few sequences of at most `capacity`.

    A piece whose length is null, below 1 or over `capacity` fits nowhere and gets nulls.
    Columns of `pieces` called sequence_id or offset are replaced. Equal rows are pieces
    of their own. The pieces are written to the shared folder once, so that a repeated
    task finds each with the same rank.
    """
    spark = pieces.sparkSession
    pieces = pieces.drop("sequence_id", "offset", "_task", "_place")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    folder = shared_folder(spark, "pieces")
    pieces.mapInArrow(_ranked(length), f"{kinds}, _task long, _place long").write.parquet(folder)
    ranked = spark.read.parquet(folder)
    tasks = ranked.groupBy("_task", length).agg(F.count("*").alias("_n"))
    before = Window.partitionBy(length).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    bases = tasks.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    counts = {
        r[0]: r[1]
        for r in tasks.where(F.col(length).between(1, capacity)).groupBy(F.col(length).cast("int")).agg(F.sum("_n")).collect()
    }
    layout = _layout(plan(counts, capacity))
    span = 1 << 44  # more than the ranks of a length
    keys = layout["length"] * span + layout["rank"]

    def place(batches):
        for batch in batches:
            sizes = batch.column(length).cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)
            rank = batch.column("_place").to_numpy() + batch.column("_base").to_numpy()
            fits = (sizes >= 1) & (sizes <= capacity)
            at = np.maximum(np.searchsorted(keys, np.where(fits, sizes * span + rank, 0), "right") - 1, 0)
            if len(keys):
                own = rank - layout["rank"][at]
                per_bin = layout["per_bin"][at]
                sequence, offset = layout["base"][at] + own // per_bin, layout["offset"][at] + own % per_bin * sizes
            else:
                sequence = offset = np.zeros(len(sizes), np.int64)
            names = [n for n in batch.schema.names if n not in ("_task", "_place", "_base")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(sequence, mask=~fits), pa.array(offset, mask=~fits)],
                names=[*names, "sequence_id", "offset"],
            )

    # Null lengths meet too.
    same = ranked["_task"].eqNullSafe(bases["_task"]) & ranked[length].eqNullSafe(bases[length])
    joined = ranked.join(bases, same).select(ranked["*"], bases["_base"])
    return joined.mapInArrow(place, f"{kinds}, sequence_id long, offset long")


def token_pieces(
    docs: DataFrame, vocabulary: str, end: int = 0, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Every text as token ids and `end`, cut to `capacity` where longer (the first piece
    takes the remainder): key, piece, start, length, ids_crc32. Null counts as empty."""

    def work(batches):
        encoder = Encoder.at(vocabulary)
        for batch in batches:
            for cut in slices(batch, text, ENCODE_SLICE):
                ids, edges = with_end(*encoder.encode(Texts(cut.column(1))), end)
                sizes = np.diff(edges)
                pieces = -(-sizes // capacity)
                row = np.repeat(np.arange(len(sizes)), pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                first = sizes - (pieces - 1) * capacity
                start = np.where(piece == 0, 0, first[row] + (piece - 1) * capacity)
                length = np.where(piece == 0, first[row], capacity)
                at, data = edges[row] + start, ids.astype("<u4")
                crc = [zlib.crc32(data[a : a + n]) for a, n in zip(at.tolist(), length.tolist())]
                yield batch_of(
                    **{key: cut.column(0).take(pa.array(row))}, piece=pa.array(piece, pa.int32()),
                    start=start, length=length, ids_crc32=pa.array(crc, pa.int64()),
                )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(work, f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long")
