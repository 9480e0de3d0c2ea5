"""Token ids as blocks of fixed-width bit-packed numbers.

Every id takes the fewest bits that hold the vocabulary, so id i of a block begins at bit
i * width and any range is unpacked by numpy without reading the rest. A block is one row
of a Parquet table: the documents whose ids it holds, where each begins, and the packed
bytes. Documents are laid out in ascending order of their key: texts are dealt to tasks
by key range, each task writes its blocks in order, and a document never leaves its block.
Spark's writer commits the files, so a lost executor repeats tasks, not the table.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from sluice.llm.text import Texts, batch_of, slices
from sluice.llm.tokens import ENCODE_SLICE, Encoder, with_end

BLOCK_IDS = 1 << 18


def width_of(vocabulary: int) -> int:
    """Bits that hold every id below `vocabulary`."""
    return max(1, int(vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, width: int) -> bytes:
    """Ids as consecutive little-endian bit fields."""
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = (ids.astype(np.uint32)[:, None] >> np.arange(width, dtype=np.uint32)) & 1
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack_bits(packed: bytes, width: int, start: int, stop: int) -> np.ndarray:
    """Ids start to stop of a block; only their bytes are looked at."""
    if width in (8, 16, 32):
        return np.frombuffer(packed, f"<u{width // 8}", stop - start, start * width // 8).astype(np.uint32)
    first, last = start * width // 8, -(-stop * width // 8)
    bits = np.unpackbits(np.frombuffer(packed, np.uint8, last - first, first), bitorder="little")
    skip = start * width - first * 8
    fields = bits[skip : skip + (stop - start) * width].reshape(-1, width).astype(np.uint32)
    return (fields << np.arange(width, dtype=np.uint32)).sum(axis=1, dtype=np.uint32)


def _block(part: int, block: int, before: int, rows: list, width: int) -> pa.RecordBatch:
    keys = pa.concat_arrays([r[0] for r in rows])
    ids = np.concatenate([r[1] for r in rows])
    sizes = np.concatenate([r[2] for r in rows])
    edges = np.concatenate([[0], np.cumsum(sizes)])
    whole = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
    return batch_of(
        part=pa.array([part], pa.int32()), block=pa.array([block], pa.int32()), before=[before], n_ids=[len(ids)],
        width=pa.array([width], pa.int32()), keys=whole(keys), edges=whole(pa.array(edges)), packed=pa.array([pack_bits(ids, width)], pa.binary()),
    )


def _write_blocks(path: str, end: int, width: int, block_ids: int):
    def run(batches):
        encoder, part = Encoder.at(path), TaskContext.get().partitionId()
        block, before, rows, held = 0, 0, [], 0
        for batch in batches:
            for cut in slices(batch, "text", ENCODE_SLICE):
                ids, edges = with_end(*encoder.encode(Texts(cut.column("text"))), end)
                first = 0
                while first < cut.num_rows:
                    # As many documents as fill the block, one at least.
                    last = max(first + 1, int(np.searchsorted(edges, edges[first] + block_ids - held, "right")) - 1)
                    rows.append((cut.column("key").slice(first, last - first), ids[edges[first] : edges[last]], np.diff(edges[first : last + 1])))
                    held += int(edges[last] - edges[first])
                    first = last
                    if held >= block_ids or first < cut.num_rows:
                        yield _block(part, block, before, rows, width)
                        block, before, rows, held = block + 1, before + held, [], 0
        if rows:
            yield _block(part, block, before, rows, width)

    return run


def write_token_blocks(
    docs: DataFrame, folder: str, vocabulary: str, end: int = 0, key: str = "doc_id", text: str = "text", block_ids: int = BLOCK_IDS
) -> None:
    """Encodes every text of `docs` with the vocabulary file, appends `end`, and writes blocks
    to `folder` in ascending order of `key` (null first; equal keys in any order).

    Null and empty texts are the end id alone. An empty table writes no blocks. Other
    columns are not read.
    """
    width = width_of(max(Encoder.at(vocabulary).tokenizer.get_vocab_size(), end + 1))
    kind = docs.schema[key].dataType.simpleString()
    (
        docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
        .repartitionByRange("key")
        .sortWithinPartitions("key")
        .mapInArrow(
            _write_blocks(vocabulary, end, width, block_ids),
            f"part int, block int, before long, n_ids long, width int, keys array<{kind}>, edges array<long>, packed binary",
        )
        .write.mode("overwrite")
        .parquet(folder)
    )


def _bases(blocks: DataFrame) -> DataFrame:
    """The ids before each part; one row per task that wrote, so that one ordered window does."""
    totals = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def read_documents(spark: SparkSession, folder: str, key: str = "doc_id") -> DataFrame:
    """Per document of the blocks: key, start, n_tokens, crc32 of the ids (uint32, little endian)."""

    def work(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                at = batch.slice(i, 1)
                edges = at.column("edges").flatten().to_numpy()
                ids = unpack_bits(at.column("packed")[0].as_py(), at.column("width")[0].as_py(), 0, int(edges[-1])).astype("<u4")
                crc = [zlib.crc32(ids[s:e]) for s, e in zip(edges[:-1].tolist(), edges[1:].tolist())]
                yield batch_of(
                    key=at.column("keys").flatten(),
                    part=pa.array(np.full(len(crc), at.column("part")[0].as_py()), pa.int32()),
                    inside=edges[:-1] + at.column("before")[0].as_py(),
                    n_tokens=np.diff(edges),
                    ids_crc32=pa.array(crc, pa.int64()),
                )

    blocks = spark.read.parquet(folder)
    kind = blocks.schema["keys"].dataType.elementType.simpleString()
    found = blocks.select("part", "before", "width", "keys", "edges", "packed").mapInArrow(
        work, f"key {kind}, part int, inside long, n_tokens long, ids_crc32 long"
    )
    # Only numbers are joined; the packed bytes stay in the tasks that read them.
    return found.join(_bases(blocks), "part").select(
        F.col("key").alias(key), (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )


def open_token_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """The blocks, each with `start`, the number of ids before it in the whole table."""
    blocks = spark.read.parquet(folder)
    return blocks.join(_bases(blocks), "part").withColumn("start", F.col("base") + F.col("before")).drop("base", "before")


def read_ids(blocks: DataFrame, start: int, stop: int) -> DataFrame:
    """Ids start to stop of the whole table: (start, ids) per touched block. Random access:
    other blocks are filtered out and only the bytes of the range are unpacked."""

    def work(batches):
        for batch in batches:
            for r in batch.to_pylist():
                first, last = max(0, start - r["start"]), min(r["n_ids"], stop - r["start"])
                ids = unpack_bits(r["packed"], r["width"], first, last)
                yield batch_of(start=[r["start"] + first], ids=pa.array([ids.tolist()], pa.list_(pa.int64())))

    touched = blocks.where((F.col("start") < stop) & (F.col("start") + F.col("n_ids") > start))
    return touched.select("start", "n_ids", "width", "packed").mapInArrow(work, "start long, ids array<long>")
