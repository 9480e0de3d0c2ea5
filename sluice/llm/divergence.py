"""How far the sources of a language diverge in their use of words.

Every language keeps the terms that enough of its documents hold. Each (language, source)
group then is a sorted array of (term id, count), cut into blocks of terms so that no
array outgrows a task. For every unordered pair of a language's groups a task co-groups
their arrays, finds the overlap by galloping, and prices terms that both have, one has, or
neither has; a price serves both directions. Groups are dealt into tiles, and a task holds
the pairs of two tiles, so that an array travels once per tile and not once per partner.

Counting is two sums that tasks combine before they shuffle: a source with a third of all
documents is as many rows as it has terms. All arithmetic is on integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from sluice.llm.components import landed
from sluice.llm.text import LOWER, Texts, batch_of, slices

LEAST_DOCUMENTS = 30
TOP_TERMS = 50
# Terms of a block (about), groups of a tile (about), bytes of text counted at once.
BLOCK_TERMS, TILE_GROUPS = 1 << 16, 16
COUNT_SLICE = 1 << 23

# Fixed values of the contract: added to each count, units of a share.
ADDED, UNITS = 5, 1_000_000_000

# ASCII letters and everything beyond ASCII.
_TERM = np.zeros(256, bool)
_TERM[ord("A") : ord("Z") + 1] = _TERM[ord("a") : ord("z") + 1] = _TERM[0x80:] = True


def term_runs(texts: Texts) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All terms of the texts in order, lower-cased and each distinct one kept once, and the
    row of each."""
    held = np.zeros(len(texts.data) + 1, bool)
    held[:-1] = _TERM[texts.data]
    first = np.zeros(len(held), bool)
    first[texts.offsets] = True
    before = np.zeros(len(held), bool)
    before[1:] = held[:-1]
    start = np.flatnonzero(held & (~before | first))
    # Terms are maximal runs: without the bytes between them each begins where the last ended.
    letters = LOWER[texts.data[held[:-1]]]
    at = np.cumsum(held, dtype=np.int64)[start] - 1
    buffers = [None, pa.py_buffer(np.append(at, len(letters))), pa.py_buffer(letters)]
    terms = pa.Array.from_buffers(pa.large_binary(), len(start), buffers)
    return terms.dictionary_encode(), np.searchsorted(texts.offsets, start, "right") - 1


def _counts(batches):
    """Occurrences and documents of each (lang, source, term) in a slice of documents."""
    for batch in batches:
        for part in slices(batch, "text", COUNT_SLICE):
            terms, row = term_runs(Texts(part.column("text")))
            if not len(row):
                continue
            group = pc.binary_join_element_wise(part.column("lang"), part.column("source"), "\0").dictionary_encode()
            of_row = group.indices.to_numpy()
            term, size = terms.indices.to_numpy().astype(np.int64), len(terms.dictionary)
            key, n = np.unique(of_row[row] * size + term, return_counts=True)
            once = np.unique(row * size + term)
            # Every pair of group and term has documents, so both lists have the same keys.
            docs = np.unique(of_row[once // size] * size + once % size, return_counts=True)[1]
            some = np.unique(of_row, return_index=True)[1]
            rows = pa.array(some[key // size])
            yield batch_of(
                lang=part.column("lang").take(rows),
                source=part.column("source").take(rows),
                term=terms.dictionary.take(pa.array(key % size)).cast(pa.binary()),
                n=n,
                docs=docs,
            )


def price(n, total, size):
    """1 + floor(UNITS * (n + 5) / (total + 5 * size)) on arrays of integers, by long division
    with three digits a step, so that products stay below 2^63 for totals up to 9 * 10^15."""
    divisor = total + ADDED * size
    rest, found = n + ADDED, 0
    for _ in range(3):
        rest = rest * 1000
        found, rest = found * 1000 + rest // divisor, rest % divisor
    return found + 1


def price_column(n: str, total: str, size: str) -> Column:
    """`price` of three columns."""
    divisor = f"({total} + {ADDED} * {size})"
    first = f"({n} + {ADDED}) * 1000"
    second = f"({first}) % {divisor} * 1000"
    third = f"({second}) % {divisor} * 1000"
    return F.expr(f"1 + ({first}) div {divisor} * 1000000 + ({second}) div {divisor} * 1000 + ({third}) div {divisor}")


def gallop(wanted: np.ndarray, held: np.ndarray, stride: int = 32) -> np.ndarray:
    """First place in sorted `held` that is not below each of the sorted `wanted`.

    Every `stride`-th is looked up; the others start where the last one looked up ended, go
    on in doubling steps until they have passed their value, and halve the last step.
    """
    low = np.repeat(np.searchsorted(held, wanted[::stride]), stride)[: len(wanted)]
    high, step, active = low.copy(), 1, np.arange(len(wanted))
    while len(active):
        active = active[high[active] < len(held)]
        active = active[held[high[active]] < wanted[active]]
        low[active] = high[active] + 1
        high[active] = np.minimum(high[active] + step, len(held))
        step *= 2
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        middle = (low[open_] + high[open_]) // 2
        below = held[middle] < wanted[open_]
        low[open_[below]] = middle[below] + 1
        high[open_[~below]] = middle[~below]


class _Group:
    """One group's terms of a block, priced."""

    def __init__(self, row: dict):
        self.source, total, size = row["source"], row["total"], row["size"]
        self.ids, n = np.array(row["ids"], np.int64), np.array(row["ns"], np.int64)
        # Without kept terms in the language nothing has a price.
        self.prices = price(n, total, size) if size else n
        self.absent = price(0, total, size) if size else 0


def priced(a: _Group, b: _Group) -> tuple[int, int]:
    """What the terms of a block differ by that one of two groups has at least, and their number."""
    few, many = (a, b) if len(a.ids) <= len(b.ids) else (b, a)
    at = gallop(few.ids, many.ids)
    both = at < len(many.ids)
    both[both] = many.ids[at[both]] == few.ids[both]
    shared = at[both]
    overlap = np.abs(few.prices[both] - many.prices[shared]).sum()
    few_only = np.abs(few.prices[~both] - many.absent).sum()
    against = np.abs(many.prices - few.absent)
    many_only = against.sum() - against[shared].sum()
    return int(overlap + few_only + many_only), len(few.ids) + len(many.ids) - len(shared)


_PAIRS = "lang string, a string, b string, value long, present long, gap long, size long"


def _pair_task(key, left: pa.Table, right: pa.Table) -> pa.Table:
    """All pairs of a group of one tile with a later group, by name, or one of another tile."""
    lang, _, i, j = (k.as_py() for k in key)
    ours = [_Group(r) for r in left.to_pylist()]
    theirs = ours if i == j else [_Group(r) for r in right.to_pylist()]
    size = (left if left.num_rows else right).column("size")[0].as_py()
    rows = [
        (lang, a.source, b.source, *priced(a, b), abs(a.absent - b.absent), size)
        for a in ours
        for b in theirs
        if i != j or a.source < b.source
    ]
    kinds = [pa.string()] * 3 + [pa.int64()] * 4
    names = [c.split()[0] for c in _PAIRS.split(", ")]
    return pa.table([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [[]] * len(kinds), kinds)], names=names)


def group_vectors(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """One row per group and block of its language's terms, also where the group has none:
    lang, source, tile, tiles, block, size (kept terms of the language), total and lang_total
    (their occurrences in the group and the language), entries (sorted by term id)."""
    named = docs.select(
        *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")], F.col("text").cast("string").alias("text")
    )
    found = named.mapInArrow(_counts, "lang string, source string, term binary, n long, docs long")
    counts = landed(found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "counts")
    by_lang = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("term_total"))
    terms = landed(
        by_lang.where(F.col("docs") >= least_documents).select("lang", "term", "term_total", F.monotonically_increasing_id().alias("id")), "terms"
    )
    sizes = terms.groupBy("lang").agg(F.count("*").alias("size"), F.sum("term_total").alias("lang_total"))
    groups = named.groupBy("lang", "source").count().drop("count")
    langs = groups.groupBy("lang").agg(F.count("*").alias("sources")).join(sizes, "lang", "left")
    langs = landed(
        langs.select(
            "lang",
            F.ceil(F.col("sources") / TILE_GROUPS).alias("tiles"),
            F.coalesce("size", F.lit(0)).alias("size"),
            F.coalesce("lang_total", F.lit(0)).alias("lang_total"),
        ),
        "langs",
    )
    blocks = F.expr(f"1 + size div {BLOCK_TERMS}")
    # Terms of a language are dealt to its blocks by hash, its groups to its tiles likewise.
    dealt = landed(terms.join(langs.select("lang", blocks.alias("_blocks")), "lang").select(
        "lang", "term", "term_total", "id", F.pmod(F.xxhash64("term"), "_blocks").alias("block")), "dealt")
    entry = F.struct("id", "n", "term_total", F.col("term").cast("string").alias("term"))
    arrays = counts.join(dealt, ["lang", "term"]).groupBy("lang", "source", "block").agg(
        F.sort_array(F.collect_list(entry)).alias("entries"), F.sum("n").alias("part")
    )
    arrays = landed(arrays, "arrays")
    totals = arrays.groupBy("lang", "source").agg(F.sum("part").alias("total"))
    grid = (
        groups.join(totals, ["lang", "source"], "left")
        .join(langs, "lang")
        .select(
            "lang", "source", "tiles", "size", "lang_total",
            F.coalesce("total", F.lit(0)).alias("total"),
            F.pmod(F.xxhash64("source"), "tiles").alias("tile"),
            F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("block"),
        )
    )
    joined = grid.join(arrays.drop("part"), ["lang", "source", "block"], "left")
    empty = F.array().cast("array<struct<id:bigint,n:bigint,term_total:bigint,term:string>>")
    return joined.withColumn("entries", F.coalesce("entries", empty))


def pair_values(vectors: DataFrame) -> DataFrame:
    """lang, a, b, value: the summed differences of every unordered pair of groups, once."""
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("other")
    thin = vectors.select(
        "lang", "block", "source", "total", "size", "tile", F.col("entries.id").alias("ids"), F.col("entries.n").alias("ns"), other
    )
    key = ("lang", "block", "i", "j")
    left = thin.where("tile <= other").withColumns({"i": F.col("tile"), "j": F.col("other")})
    right = thin.where("tile > other").withColumns({"i": F.col("other"), "j": F.col("tile")})
    sides = [side.drop("tile", "other").groupBy(*key) for side in (left, right)]
    parts = sides[0].cogroup(sides[1]).applyInArrow(_pair_task, _PAIRS)
    neither = (F.max("size") - F.sum("present")) * F.max("gap")
    return parts.groupBy("lang", "a", "b").agg((F.sum("value") + neither).alias("value"))


def excess_terms(vectors: DataFrame) -> DataFrame:
    """lang, source, item, value: the terms whose share in a group is above the language's."""
    held = vectors.select("lang", "source", "total", "lang_total", "size", F.explode("entries").alias("e"))
    held = held.select("*", "e.n", "e.term_total", F.col("e.term").alias("item"))
    value = price_column("n", "total", "size") - price_column("term_total", "lang_total", "size")
    return held.select("lang", "source", "item", value.alias("value")).where("value > 0")


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def audit_sources(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, top_terms: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank of every (lang, source) group of `docs`.

    Part `pair`: every other source of the language with the summed differences of term
    shares, largest first; part `term`: the `top_terms` terms whose share is furthest above
    the language's. Shares are in thousand millionths, smoothed by 5 occurrences a term; a
    term counts if at least `least_documents` documents of the language hold it, repeated
    rows each counting. Ties go by item in byte order. Null text, lang and source count as
    empty; a group without terms is compared like others; a language without kept terms has
    pairs of value 0; a language with one source has no pairs. Other columns are not read.
    """
    vectors = landed(group_vectors(docs, least_documents), "vectors")
    pairs = landed(pair_values(vectors), "pairs")
    both = pairs.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").union(
        pairs.select("lang", "b", "a", "value")
    )
    terms = _ranked(excess_terms(vectors), "term").where(F.col("rank") <= top_terms)
    return _ranked(both, "pair").union(terms)


# The same rows in DuckDB.
AUDIT_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text
           FROM documents),
w AS (SELECT doc, lang, source, translate(unnest(regexp_extract_all(text, '[A-Za-z\\x{{80}}-\\x{{10FFFF}}]+')),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY ALL HAVING count(DISTINCT doc) >= {LEAST_DOCUMENTS}),
langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
        1 + ({UNITS}::HUGEINT * (coalesce(c.n, 0) + {ADDED})) // (coalesce(t.total, 0) + {ADDED} * l.v)::HUGEINT AS p,
        1 + ({UNITS}::HUGEINT * (k.n + {ADDED})) // (l.total + {ADDED} * l.v)::HUGEINT AS q
      FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang)
      LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source
      LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (SELECT a.lang, a.source, b.source AS item,
            coalesce((SELECT sum(abs(x.p - y.p)) FROM p x JOIN p y USING (lang, term)
                      WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0)::BIGINT AS value
          FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source),
terms AS (SELECT lang, source, term AS item, (p - q)::BIGINT AS value FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT lang, source, 'pair' AS part, item, value,
             row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER AS rank FROM pairs
           UNION ALL
           SELECT lang, source, 'term', item, value,
             row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER FROM terms)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= {TOP_TERMS}
"""
