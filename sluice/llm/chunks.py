"""Texts in chunks that ask each other about keys.

Documents are written once as chunks of a few megabytes, whole rows in Arrow's own format.
A chunk asks about its keys by sending, for each bucket of keys, one packed array; the task
of a bucket sees what all chunks sent there and replies to each, usually with some bits per
key. Both ways only packed numbers travel, each key once per chunk, so a key that a
third of all texts hold costs a bucket no more than one entry per chunk. A task holds one
chunk, or what was asked of one bucket; there are as many buckets as keep those small.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from sluice.llm.components import landed
from sluice.llm.text import Texts, batch_of, slices

CHUNK_BYTES = 8 << 20
ASK = "bucket int, chunk long, asked binary"
REPLY = "chunk long, bucket int, reply binary"


def _pack_chunks(text: str, size: int):
    def run(batches):
        chunk, held, total = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for part in slices(batch, text):
                held.append(part)
                total += sum(b.nbytes for b in part.columns)
                if total >= size:
                    yield batch_of(chunk=[chunk], docs=pa.array([_to_bytes(held)], pa.large_binary()).cast(pa.binary()))
                    chunk, held, total = chunk + 1, [], 0
        if held:
            yield batch_of(chunk=[chunk], docs=pa.array([_to_bytes(held)], pa.binary()))

    return run


def _to_bytes(parts: list[pa.RecordBatch]) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, parts[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        for p in parts:
            writer.write_batch(p)
    return sink.getvalue().to_pybytes()


def chunked(docs: DataFrame, text: str = "text", size: int = CHUNK_BYTES) -> DataFrame:
    """A written table of (chunk, docs): every row and column of `docs`, packed."""
    return landed(docs.mapInArrow(_pack_chunks(text, size), "chunk long, docs binary"), "chunks")


def buckets_for(chunks: DataFrame) -> int:
    return max(24, chunks.count() // 2)


def parts_of(packed: bytes) -> Iterator[pa.RecordBatch]:
    """The rows of a chunk, in slices."""
    with pa.ipc.open_stream(packed) as reader:
        yield from reader


def texts_of(packed: bytes, text: str) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    for part in parts_of(packed):
        yield part, Texts(part.column(text))


def doc_ids(part: pa.RecordBatch, key: str) -> np.ndarray:
    return part.column(key).cast(pa.int64()).fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)


def asks(chunk: int, keys: np.ndarray, buckets: int, packed: Callable[[np.ndarray], bytes]) -> pa.RecordBatch:
    """One row per bucket that holds any of the keys; `packed` makes the bytes of some places."""
    bucket = (keys % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    names, first = np.unique(bucket[order], return_index=True)
    edges = np.append(first, len(keys))
    return batch_of(
        bucket=pa.array(names, pa.int32()),
        chunk=pa.array(np.full(len(names), chunk, np.int64)),
        asked=pa.array([packed(order[a:b]) for a, b in zip(edges[:-1], edges[1:])], pa.binary()),
    )


def in_order(keys: np.ndarray, buckets: int, replies: dict[int, bytes], dtype) -> np.ndarray:
    """What was replied for each key, where `asks` sent the keys in this order."""
    bucket = (keys % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    out = np.zeros(len(keys), dtype)
    if len(keys):
        out[order] = np.concatenate([np.frombuffer(replies[b], dtype) for b in np.unique(bucket).tolist()])
    return out


def exchange(asked: DataFrame, answer: Callable[[list[bytes], list[int]], list[bytes]], name: str) -> DataFrame:
    """Replies (chunk, bucket, reply), written: `answer` sees all that was asked of a bucket,
    and by which chunks, in any order."""

    def work(table: pa.Table) -> pa.Table:
        chunks = table.column("chunk").to_pylist()
        replies = answer([x.as_py() for x in table.column("asked")], chunks)
        return pa.table({"chunk": pa.array(chunks, pa.int64()), "bucket": table.column("bucket").cast(pa.int32()), "reply": pa.array(replies, pa.binary())})

    return landed(asked.groupBy("bucket").applyInArrow(work, REPLY), name)


def with_replies(chunks: DataFrame, replies: list[DataFrame], work: Callable, schema: str) -> DataFrame:
    """`work(chunk, docs, [{bucket: reply}, ..])` for every chunk, with a dictionary for each
    table of replies; yields batches of `schema`."""
    kinds = len(replies)
    told = None
    for i, r in enumerate(replies):
        own = r.select(F.lit(i).alias("kind"), "chunk", "bucket", "reply")
        told = own if told is None else told.union(own)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        known: list[dict[int, bytes]] = [{} for _ in range(kinds)]
        for kind, bucket, reply in zip(*(right.column(c).to_pylist() for c in ("kind", "bucket", "reply"))):
            known[kind][bucket] = reply
        out = [b for chunk, docs in zip(left.column("chunk").to_pylist(), left.column("docs")) for b in work(chunk, docs.as_py(), known)]
        return pa.Table.from_batches(out) if out else empty

    empty = _empty(chunks, schema)
    return chunks.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(run, schema)


def _empty(df: DataFrame, schema: str) -> pa.Table:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(df.sparkSession.createDataFrame([], schema).schema).empty_table()


def repeated_keys(asked: list[bytes], chunks: list[int]) -> list[bytes]:
    """Per chunk, for its distinct keys in order: 1 where the key was sent more than once, by
    one chunk or several."""
    arrays = [np.frombuffer(a, np.uint64) for a in asked]
    keys = np.sort(np.concatenate(arrays))
    again = np.unique(keys[1:][keys[1:] == keys[:-1]])
    return [np.isin(np.unique(a), again).astype(np.uint8).tobytes() for a in arrays]


def seed_asks(chunk: int, seeds: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Asks about seeds, of which those that repeat in the chunk are listed twice."""
    unique, counts = np.unique(seeds, return_counts=True)
    twice = counts > 1
    return asks(chunk, unique, buckets, lambda at: np.concatenate([unique[at], unique[at][twice[at]]]).tobytes())


def repeated_seeds(seeds: np.ndarray, buckets: int, replies: dict[int, bytes]) -> np.ndarray:
    """The seeds of a chunk, sorted, that repeat anywhere."""
    unique = np.unique(seeds)
    return unique[in_order(unique, buckets, replies, np.uint8) == 1]


def is_in(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Membership in a sorted array."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values
