"""Near-duplicate detection by one-permutation hashing.

One hash of each shingle names a bin and a value; the least value of each bin is the
signature, and an empty bin takes that of a bin found by probing with a hash of its own
number (optimal densification), so that equal sets agree everywhere and similar ones in
proportion. `ROWS` bins make a band; documents that share a band share a bucket. Two sets
of similarity 0.8 share none of the `BANDS` with a probability of 3 in a million.

Equal sets are one node from the start. In each bucket, candidate edges form a star
around its least document; links are confirmed on the full sets. Buckets whose documents
then lie in one component are done. The others get stars around a few more documents, and
in the end around each that is outside the bucket's largest component, which meets all
pairs across components. Of these stars only edges pass whose sketches allow a link: a
set's sketch holds the parity of its shingles in each of `SKETCH` classes, and two sets
differ in at least as many shingles as their sketches in bits. So no link of a bucket is
missed, and pairs too far apart are left out before they are made.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sluice.llm.components import components, landed
from sluice.llm.text import LOWER, SLICE, WORD, Texts, batch_of, by_slice, grams, mix, rolling

SHINGLE = 5
PERCENT = 80
ROWS, BANDS = 6, 42
BINS = ROWS * BANDS
SKETCH = 256
SECOND_STARS = 4
# Rows signed at once: a signature and its scratch arrays take some 20 KB a row.
SIGNED_ROWS = 512
SKETCHES = [f"sketch_{i}" for i in range(SKETCH // 64)]

_EMPTY = np.iinfo(np.uint64).max


def shingle_sets(texts: Texts, size: int, fold: bool) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every distinct shingle of each row, in that order. Rows of fewer words
    than `size` have one, all their words; rows without words none."""
    words = texts.words(WORD, LOWER if fold else None)
    at = np.flatnonzero(words.within(size))
    counts = words.counts()
    short = np.flatnonzero((counts > 0) & (counts < size))
    row = np.concatenate([words.row[at], short])
    value = np.concatenate([grams(words.hash, size)[at], rolling(words.hash, words.edges[short], words.edges[short + 1])])
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[new], value[new]


def signatures(row: np.ndarray, value: np.ndarray, rows: int) -> np.ndarray:
    """The densified signature of each row; rows without shingles hold only `_EMPTY`."""
    hashed = mix(value ^ np.uint64(0x5851F42D4C957F2D))
    bins = ((hashed >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)
    out = np.full((rows, BINS), _EMPTY, np.uint64)
    np.minimum.at(out.ravel(), row * BINS + bins.astype(np.int64), mix(hashed) >> np.uint64(1))
    source = out.copy()
    holder, column = np.nonzero((out == _EMPTY) & (out.min(axis=1) != _EMPTY)[:, None])
    probe = 0
    while len(holder):
        probe += 1
        to = (mix(column.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(probe)) % np.uint64(BINS)).astype(np.int64)
        found = source[holder, to]
        hit = found != _EMPTY
        out[holder[hit], column[hit]] = found[hit]
        holder, column = holder[~hit], column[~hit]
    return out


def sketches(row: np.ndarray, value: np.ndarray, rows: int) -> np.ndarray:
    """Parity of each row's shingles by class of their hash, as bits of 64-bit words."""
    kind = (mix(value ^ np.uint64(0x9FB21C651E98DF25)) % np.uint64(SKETCH)).astype(np.int64)
    odd = (np.bincount(row * SKETCH + kind, minlength=rows * SKETCH) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(rows, SKETCH), axis=1).view(np.int64)


def _signed(size: int, fold: bool):
    def work(part, texts: Texts):
        n = len(texts)
        row, value = shingle_sets(texts, size, fold)
        bands = signatures(row, value, n).reshape(n, BANDS, ROWS)
        keys = np.full((n, BANDS), np.uint64(1)) * mix(np.arange(BANDS, dtype=np.uint64) + np.uint64(1))
        for i in range(ROWS):
            keys = mix(keys ^ bands[:, :, i]) + np.uint64(i)
        counts = np.bincount(row, minlength=n)
        digests = []
        for salt in (0x2545F4914F6CDD1D, 0xD6E8FEB86659FD93):  # sums, as sets have no order
            total = np.append(np.uint64(0), np.cumsum(mix(value ^ np.uint64(salt))))
            ends = np.cumsum(counts)
            digests.append((total[ends] - total[ends - counts]).view(np.int64))
        bits = sketches(row, value, n)
        kept = np.where(counts > 0, BANDS, 0)
        edges = np.append(0, np.cumsum(kept))
        return batch_of(
            doc=part.column(0), n=counts, high=digests[0], low=digests[1],
            bands=pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(keys[counts > 0].ravel().view(np.int64))),
            **{name: np.ascontiguousarray(bits[:, i]) for i, name in enumerate(SKETCHES)},
        )

    return by_slice("text", work, SIGNED_ROWS)


def _packed(batches):
    for batch in batches:
        texts = Texts(batch.column("text"))
        raw = [texts.row(i) for i in range(len(texts))]
        yield batch_of(
            doc=batch.column("doc"), size=pa.array([len(r) for r in raw], pa.int32()), packed=pa.array([pa.compress(r, "zstd", asbytes=True) for r in raw], pa.binary())
        )


def _confirm(size: int, fold: bool, percent: int):
    """Keeps the pairs whose full sets are similar enough."""

    def text_of(packed: list[bytes], sizes: list[int]) -> Texts:
        return Texts(pa.array([pa.decompress(p, s, "zstd", asbytes=True) if s else b"" for p, s in zip(packed, sizes)], pa.large_binary()))

    def run(batches):
        for batch in batches:
            sizes = [batch.column(c).to_pylist() for c in ("size_a", "size_b")]
            total = np.cumsum(np.array(sizes).sum(axis=0))
            first = 0
            while first < batch.num_rows:
                before = int(total[first - 1]) if first else 0
                last = max(first + 1, int(np.searchsorted(total, before + SLICE, "right")))
                part = batch.slice(first, last - first)
                sets = []
                for column, own in (("packed_a", sizes[0]), ("packed_b", sizes[1])):
                    row, value = shingle_sets(text_of(part.column(column).to_pylist(), own[first:last]), size, fold)
                    sets.append((row, value))
                counts = [np.bincount(r, minlength=part.num_rows) for r, _ in sets]
                row, value = (np.concatenate([s[i] for s in sets]) for i in (0, 1))
                order = np.lexsort((value, row))
                twice = (row[order][1:] == row[order][:-1]) & (value[order][1:] == value[order][:-1])
                both = np.bincount(row[order][1:][twice], minlength=part.num_rows)
                linked = (100 * both >= percent * (counts[0] + counts[1] - both)) & (both > 0)
                found = part.filter(pa.array(linked))
                if found.num_rows:
                    yield batch_of(a=found.column("a"), b=found.column("b"))
                first = last

    return run


def _alike_in_size(a: str, b: str, percent: int):
    """No two sets further apart in size can be linked."""
    return (F.col(a) * percent <= F.col(b) * 100) & (F.col(b) * percent <= F.col(a) * 100)


def _may_link(percent: int):
    """Sets whose sketches differ in so many bits that they cannot be linked are told apart."""
    differ = sum((F.bit_count(F.col(s).bitwiseXOR(F.col(f"hub_{s}"))) for s in SKETCHES[1:]), F.bit_count(F.col(SKETCHES[0]).bitwiseXOR(F.col(f"hub_{SKETCHES[0]}"))))
    return differ * (100 + percent) <= (F.col("n") + F.col("hub_n")) * (100 - percent)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT, fold: bool = True) -> DataFrame:
    """Key, n_shingles, component_id and kept (key = component_id), a row per row of `docs`.

    Documents are linked where 100 * intersection >= `percent` * union of their sets of
    shingles of `shingle` words (A-Z lower-cased if `fold`); a component is named by its
    least key. Null and empty texts have no shingles and no links. Rows of one key are one
    document, linked by the text of any. Rows with a null key are in no component and
    kept. Other columns are not read.
    """
    texts = docs.select(F.col(key).alias("doc"), F.col(text).alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    signed = landed(texts.mapInArrow(_signed(shingle, fold), f"doc {kind}, n long, high long, low long, bands array<long>, {', '.join(f'{s} long' for s in SKETCHES)}"), "signatures")
    same = ["n", "high", "low"]
    sets = landed(signed.where("n > 0 AND doc IS NOT NULL").groupBy(*same).agg(F.min("doc").alias("rep"), *(F.first(c).alias(c) for c in ["bands", *SKETCHES])), "sets")
    # Equal keys with several texts, and equal texts, are linked without a look.
    given = signed.where("n > 0 AND doc IS NOT NULL").join(sets.select(*same, "rep"), same).where("doc <> rep").select("doc", "rep")

    # Aggregates are written before they are joined with their own table, so that the join
    # shuffles both sides itself and adaptive execution can split a bucket of many documents.
    opened = sets.select(F.col("rep").alias("doc"), "n", F.explode("bands").alias("band"))
    stars = landed(opened.groupBy("band").agg(F.min(F.struct("doc", "n")).alias("hub"), F.count("*").alias("members")).where("members > 1"), "stars-of-buckets")
    buckets = landed(opened.join(stars, "band").select("band", "doc", "n", "hub", "members"), "buckets")
    active = buckets.select("doc").distinct()
    bodies = landed(texts.where("doc IS NOT NULL").mapInArrow(_packed, f"doc {kind}, size int, packed binary").join(active, "doc", "left_semi").dropDuplicates(["doc", "packed"]), "bodies")

    def confirmed(pairs: DataFrame) -> DataFrame:
        side = lambda s: bodies.select(F.col("doc").alias(s), F.col("size").alias(f"size_{s}"), F.col("packed").alias(f"packed_{s}"))
        return pairs.join(side("b"), "b").join(side("a"), "a").mapInArrow(_confirm(shingle, fold, percent), f"a {kind}, b {kind}").distinct()

    near = buckets.where("doc <> hub.doc").where(_alike_in_size("n", "hub.n", percent))
    tested = landed(near.select(F.col("hub.doc").alias("a"), F.col("doc").alias("b")).distinct(), "pairs")
    links = landed(confirmed(tested), "links")
    found = landed(components(given.union(links)), "components")
    marks = sets.select(F.col("rep").alias("doc"), "n", "bands", *SKETCHES)
    of_hub = [F.col(c).alias(f"hub_{c}") for c in ("band", "doc", "n", "component", "bands", *SKETCHES)]
    open_buckets = buckets.where("members > 2").select("band", "doc", "n", "members")
    for last in (False, True):
        named = open_buckets.join(found, open_buckets["doc"] == found["node"], "left_outer").select(
            "band", "doc", "n", "members", F.coalesce("component", "doc").alias("component")
        )
        parts = named.groupBy("band", "component").agg(F.count("*").alias("size"))
        most = F.max_by("component", F.struct("size", "component"))
        main = landed(parts.groupBy("band").agg(most.alias("main"), F.count("*").alias("parts")).where("parts > 1").select("band", "main"), "main")
        open_buckets = landed(named.join(main, "band").join(marks, ["doc", "n"]), "open")
        # Hubs are chosen by chance first, of all that are outside the largest component last.
        chance = F.pmod(F.xxhash64("doc"), F.lit(1 << 30)) * F.col("members") < F.lit(SECOND_STARS << 30)
        hubs = open_buckets.where(F.col("component") != F.col("main") if last else chance).select(*of_hub)
        across = (F.col("band") == F.col("hub_band")) & (F.col("component") != F.col("hub_component"))
        # A pair is made in the first bucket it shares, and by one of two hubs.
        once = F.get(F.array_intersect("bands", "hub_bands"), 0) == F.col("band")
        if last:
            once = ((F.col("component") == F.col("main")) | (F.col("hub_doc") < F.col("doc"))) & once
        pairs = open_buckets.join(hubs, across & _alike_in_size("n", "hub_n", percent) & _may_link(percent) & once)
        pairs = pairs.select(F.least("doc", "hub_doc").alias("a"), F.greatest("doc", "hub_doc").alias("b")).distinct()
        fresh = landed(pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
        new = landed(confirmed(fresh), "links")
        if not new.isEmpty():
            links = links.union(new)
            found = landed(components(given.union(links)), "components")
        if not last:
            tested = tested.union(fresh)
            open_buckets = open_buckets.select("band", "doc", "n", "members").distinct()
    result = signed.join(found, signed["doc"] == found["node"], "left_outer")
    component = F.coalesce("component", "doc")
    return result.select(F.col("doc").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("doc"), F.lit(True)).alias("kept"))


def keep_one_of_each(docs: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """The rows of `docs`, all columns, whose key names their component (or is null)."""
    gone = near_duplicates(docs, key, **options).where("NOT kept").select(F.col(key).alias("_gone")).distinct()
    return docs.join(gone, docs[key] == F.col("_gone"), "left_anti")
