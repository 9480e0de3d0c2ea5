"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max index.

A bounded sample of labelled documents are the examples. Terms are byte 5- to 7-grams of
lower-cased words with the blanks around them, packed into 64-bit numbers without loss;
those that mark the toxic examples best are kept. Their document frequencies
come from all documents. The index holds, term by term, the weights of the examples in
blocks, and the largest weight of every block.

For a document the blocks are visited in the order of their bounds (the largest weights
times the document's), until no block can beat the nearest examples found; that is exact.
The neighbours vote with weights that fall with their distance. A logistic curve, fitted on
the examples with themselves left out and weighted by how often each label occurs among
all labelled rows, turns vote and nearness into a probability. The neighbours, and
the terms shared with the nearest, are the evidence.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sluice.llm.components import landed
from sluice.llm.text import LOWER, Texts, batch_of, by_slice, mix, slices

# The sample of labelled rows, half of each label at most, and the terms kept: together they
# bound the index (every example with every term would take EXAMPLES * TERMS * 16 bytes, 32 MB).
EXAMPLES, TERMS = 4096, 512
# Examples that must hold a term, neighbours that vote, neighbours and terms shown.
LEAST_EXAMPLES, NEIGHBOURS, SHOWN = 5, 15, 3
BLOCK = 32
GRAMS = (5, 6, 7)
HELD_OUT = 5
THRESHOLD = 0.5

_WORD = np.zeros(256, bool)
_WORD[ord("A") : ord("Z") + 1] = _WORD[ord("a") : ord("z") + 1] = _WORD[ord("0") : ord("9") + 1] = _WORD[0x80:] = True
_BLANK = np.uint64(0x20)


def held_out(key: str | Column) -> Column:
    """Whether a row is kept from learning: crc32 of its key as text, modulo 5, is 0."""
    text = F.coalesce((F.col(key) if isinstance(key, str) else key).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % HELD_OUT == 0


def packed_grams(texts: Texts):
    """For each size: all grams of words and the blanks around them, and where each ends.

    A gram is its bytes in the low 56 bits and its size above them, so different grams are
    different numbers. What is no letter or digit counts as a blank, and so do both ends of a
    text; a gram has a blank at its ends only.
    """
    sizes = np.diff(texts.offsets)
    # Each text behind a blank of its own; one more closes the last.
    data = np.full(len(texts.data) + len(sizes) + 1, 0x20, np.uint8)
    place = np.arange(len(texts.data)) + np.repeat(np.arange(1, len(sizes) + 1), sizes)
    data[place] = np.where(_WORD[texts.data], LOWER[texts.data], 0x20)
    letter = data != 0x20
    # Letters in a row up to each byte.
    at = np.arange(len(data))
    run = at - np.maximum.accumulate(np.where(letter, -1, at))
    # Letters of the word before, at its closing blank.
    before = np.zeros(len(data), np.int64)
    before[1:] = run[:-1]
    value = data.astype(np.uint64)
    packed = np.zeros(len(data), np.uint64)
    for size in range(1, max(GRAMS) + 1):
        shifted = np.zeros_like(packed)
        shifted[1:] = packed[:-1] << np.uint64(8)
        packed = shifted | value
        if size in GRAMS:
            inside = letter & (run >= size - 1) | ~letter & ((before == size - 2) | (before >= size - 1))
            end = np.flatnonzero(inside[size - 1 :]) + size - 1
            yield packed[end] | np.uint64(size << 56), end - size + 1


def row_starts(texts: Texts) -> np.ndarray:
    """Where each text's own blank lies among the bytes of `packed_grams`."""
    return texts.offsets[:-1] + np.arange(len(texts))


def gram_text(packed: int) -> str:
    return (packed & ((1 << 56) - 1)).to_bytes(packed >> 56, "big").decode(errors="replace").strip()


class Vocabulary:
    """The kept terms, sorted, and a bit table that rules out most other grams."""

    def __init__(self, grams: np.ndarray):
        self.grams = np.sort(grams)
        self.bits = np.zeros(1 << 18, bool)
        self.bits[self._slot(self.grams)] = True

    @staticmethod
    def _slot(grams: np.ndarray) -> np.ndarray:
        return (mix(grams) >> np.uint64(46)).astype(np.int64)

    def counts(self, texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """row, term number and occurrences of every kept term in every text, in that order."""
        rows, terms = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        starts = row_starts(texts)
        for grams, at in packed_grams(texts):
            some = np.flatnonzero(self.bits[self._slot(grams)])
            found = np.searchsorted(self.grams, grams[some])
            found = np.minimum(found, max(0, len(self.grams) - 1))
            hit = self.grams[found] == grams[some] if len(self.grams) else np.zeros(0, bool)
            terms.append(found[: len(hit)][hit])
            rows.append(np.searchsorted(starts, at[some[: len(hit)]][hit], "right") - 1)
        key, n = np.unique(np.concatenate(rows) * (len(self.grams) + 1) + np.concatenate(terms), return_counts=True)
        return key // (len(self.grams) + 1), key % (len(self.grams) + 1), n


class Index:
    """Examples as unit TF-IDF vectors, by term in blocks, with the largest weight of a block."""

    def __init__(self, ids: list, toxic: np.ndarray, rows: np.ndarray, terms: np.ndarray, counts: np.ndarray, idf: np.ndarray):
        self.idf, size = idf, len(ids)
        weights = unit_weights(rows, terms, counts, idf, size)
        # Examples that share their heaviest term lie together, so that blocks differ.
        heaviest = np.full(size, len(idf))
        order = np.lexsort((weights, rows))
        last = np.flatnonzero(np.append(rows[order][1:] != rows[order][:-1], True)) if len(rows) else order
        heaviest[rows[order][last]] = terms[order][last]
        placed = np.argsort(heaviest, kind="stable")
        place = np.argsort(placed)
        self.ids, self.toxic = [ids[i] for i in placed], toxic[placed]
        # Ties between neighbours go by id.
        self.rank = np.argsort(np.argsort(np.array(self.ids), kind="stable"), kind="stable") if size else placed
        self.blocks = -(-size // BLOCK)
        at = place[rows]
        order = np.lexsort((at, terms))
        self.example, self.weight, term = at[order], weights[order], terms[order]
        group = term * self.blocks + self.example // BLOCK
        # Postings of term t and block b: from edges[t, b] to the next edge.
        self.edges = np.searchsorted(group, np.arange(len(idf) * self.blocks + 1))
        self.most = np.zeros(len(idf) * self.blocks)
        np.maximum.at(self.most, group, self.weight)
        self.most = self.most.reshape(len(idf), self.blocks)

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of largest cosine above 0, and the cosines. Equal ones go by id."""
        bound = weights @ self.most[terms]
        order = np.argsort(-bound, kind="stable")
        order = order[: np.count_nonzero(bound)]
        found, cosine, least, done, step = np.zeros(0, np.int64), np.zeros(0), 0.0, 0, 4
        while done < len(order) and bound[order[done]] * (1 + 1e-9) >= least:
            blocks = np.sort(order[done : done + step])
            done, step = done + step, step * 2
            first = self.edges[terms[:, None] * self.blocks + blocks]
            sizes = (self.edges[terms[:, None] * self.blocks + blocks + 1] - first).ravel()
            ends = np.cumsum(sizes)
            at = np.arange(ends[-1]) + np.repeat(first.ravel() - ends + sizes, sizes)
            # Always added up in the order of terms, so that no rounding depends on the blocks.
            local = np.searchsorted(blocks, self.example[at] // BLOCK) * BLOCK + self.example[at] % BLOCK
            sums = np.bincount(local, np.repeat(np.repeat(weights, len(blocks)), sizes) * self.weight[at], len(blocks) * BLOCK)
            some = np.flatnonzero(sums)
            new = blocks[some // BLOCK] * BLOCK + some % BLOCK
            found, cosine = np.append(found, new[new != without]), np.append(cosine, sums[some[new != without]])
            best = np.lexsort((self.rank[found], -cosine))[:k]
            found, cosine = found[best], cosine[best]
            least = cosine[-1] if len(found) == k else 0.0
        return found, np.minimum(cosine, 1.0)


def unit_weights(rows: np.ndarray, terms: np.ndarray, counts: np.ndarray, idf: np.ndarray, size: int) -> np.ndarray:
    """(1 + ln count) * idf, each row scaled to length 1."""
    weights = (1 + np.log(counts)) * idf[terms]
    length = np.sqrt(np.bincount(rows, weights**2, size))
    return weights / length[rows]


def vote(index: Index, found: np.ndarray, cosine: np.ndarray) -> tuple[float, float]:
    """Share of the neighbours' weights, 1 / (distance + 0.1), that is toxic; the largest cosine."""
    if not len(found):
        return 0.0, 0.0
    weight = 1 / (1.1 - cosine)
    return float(weight @ index.toxic[found] / weight.sum()), float(cosine[0])


def _curve_features(share: np.ndarray, top: np.ndarray) -> np.ndarray:
    return np.stack([share, share * top, top, np.ones(len(share))], axis=1)


def fit_curve(share: np.ndarray, top: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Coefficients of a weighted logistic regression, by Newton steps with a small ridge."""
    x, c = _curve_features(share, top), np.zeros(4)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ c, -30, 30)))
        slope = x.T @ (weight * (p - toxic)) + 0.1 * c
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(4)
        c = c - np.linalg.solve(bend, slope)
    return c


class Model:
    """Vocabulary, index and curve; `plain` is the score of texts without any neighbour."""

    def __init__(self, vocabulary: Vocabulary, index: Index, curve: np.ndarray, plain: float):
        self.vocabulary, self.index, self.curve, self.plain = vocabulary, index, curve, plain

    def neighbours(self, texts: Texts, k: int):
        """Per row with a kept term: row, its terms, and its nearest examples with cosines."""
        rows, terms, counts = self.vocabulary.counts(texts)
        weights = unit_weights(rows, terms, counts, self.index.idf, len(texts))
        edges = np.flatnonzero(np.append(np.append(True, rows[1:] != rows[:-1]), True)) if len(rows) else np.zeros(1, int)
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            yield int(rows[a]), terms[a:b], weights[a:b], *self.index.nearest(terms[a:b], weights[a:b], k)

    def score(self, share: np.ndarray, top: np.ndarray) -> np.ndarray:
        p = 1 / (1 + np.exp(-np.clip(_curve_features(share, top) @ self.curve, -30, 30)))
        return np.where(top > 0, p, self.plain)

    def shared_terms(self, terms: np.ndarray, weights: np.ndarray, example: int) -> list[str]:
        """The terms that add most to the cosine with an example, as text."""
        index = self.index
        first, last = (index.edges[terms * index.blocks + example // BLOCK + i] for i in (0, 1))
        held = [(w * index.weight[a:b][index.example[a:b] == example].sum(), t) for w, a, b, t in zip(weights, first, last, terms)]
        best = sorted((-v, t) for v, t in held if v > 0)[:SHOWN]
        return [gram_text(int(self.vocabulary.grams[t])) for _, t in best]


def choose_examples(labels: DataFrame, key: str, label: str, examples: int) -> tuple[DataFrame, dict[int, int]]:
    """A sample of learnable labelled keys, at most half of `examples` for each label and in the
    order of a hash, and how many learnable keys have each label. A key labelled twice counts as
    toxic if any of its rows does."""
    known = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull() & ~held_out(key))
    known = landed(known.groupBy(F.col(key).alias("_key")).agg(F.max(label).cast("int").alias("_toxic")), "labels")
    sizes = {r["_toxic"]: r["count"] for r in known.groupBy("_toxic").count().collect()}
    order = (F.xxhash64(F.col("_key").cast("string")), "_key")
    halves = [known.where(F.col("_toxic") == y).orderBy(*order).limit(examples // 2) for y in (0, 1)]
    return halves[0].union(halves[1]), sizes


def _gram_rows(batches):
    """The distinct grams of each example: a row of key, label, grams and their counts."""

    def work(part, texts):
        starts, rows, grams = row_starts(texts), [], []
        for found, at in packed_grams(texts):
            rows.append(np.searchsorted(starts, at, "right") - 1)
            grams.append(found)
        row, gram = np.concatenate(rows), np.concatenate(grams)
        order = np.lexsort((gram, row))
        row, gram = row[order], gram[order]
        new = np.append(True, (row[1:] != row[:-1]) | (gram[1:] != gram[:-1])) if len(row) else np.zeros(0, bool)
        counts = np.diff(np.append(np.flatnonzero(new), len(row)))
        edges = np.searchsorted(row[new], np.arange(len(texts) + 1)).astype(np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(edges), pa.array(v)) for v in (gram[new].view(np.int64), counts.astype(np.int32))]
        return batch_of(key=part.column("_key"), toxic=part.column("_toxic"), grams=lists[0], counts=lists[1])

    yield from by_slice("_text", work)(batches)


def _document_frequencies(vocabulary: Vocabulary):
    """Documents of a task, in all and with each kept term."""

    def run(batches):
        total, rows = np.zeros(len(vocabulary.grams), np.int64), 0
        for batch in batches:
            for part in slices(batch, "_text"):
                total += np.bincount(vocabulary.counts(Texts(part.column("_text")))[1], minlength=len(total))
            rows += batch.num_rows
        held = np.flatnonzero(total)
        yield batch_of(term=np.append(held, -1), n=np.append(total[held], rows))

    return run


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
          examples: int = EXAMPLES, terms: int = TERMS, neighbours: int = NEIGHBOURS) -> Model:
    """The index over a sample of the labelled documents, with its curve.

    `examples` and `terms` bound the index; document frequencies are those of all documents.
    Rows of `labels` without a key or with another label than 0 and 1 are ignored, held-out
    rows are not read. Without examples of both labels every score is the share of toxic
    labels (0 without labels).
    """
    sample, sizes = choose_examples(labels, key, label, examples)
    own = docs.select(F.col(key).alias("_own"), F.col(text).cast("string").alias("_text"))
    # At most `examples` keys; of several rows with one key, that with the least grams counts.
    matched = own.join(F.broadcast(sample), F.col("_own") == F.col("_key")).select("_key", "_toxic", "_text")
    kind = sample.schema["_key"].dataType.simpleString()
    grams = matched.mapInArrow(_gram_rows, f"key {kind}, toxic int, grams array<long>, counts array<int>")
    found = landed(grams.groupBy("key").agg(F.min(F.struct("grams", "counts", "toxic")).alias("r")).select("key", "r.*"), "examples")
    by_label = found.groupBy("toxic").count().collect()
    held = {r["toxic"]: r["count"] for r in by_label}
    share = sizes.get(1, 0) / max(1, sum(sizes.values()))
    if len(held) < 2:
        empty = Index([], np.zeros(0), *[np.zeros(0, np.int64)] * 3, np.zeros(0))
        return Model(Vocabulary(np.zeros(0, np.uint64)), empty, np.zeros(4), share)
    # Chi-squared of a term against the label, on the examples.
    gram = found.select("toxic", F.explode("grams").alias("gram")).groupBy("gram").agg(
        F.count("*").cast("double").alias("n"), F.sum("toxic").cast("double").alias("a")
    )
    pos, total = float(held[1]), float(sum(held.values()))
    b = F.col("n") - F.col("a")
    gap = F.col("a") * (total - pos - b) - b * (pos - F.col("a"))
    chi = gap * gap / (F.col("n") * (total - F.col("n")))
    best = gram.where((F.col("n") >= LEAST_EXAMPLES) & (F.col("n") < total) & (gap > 0)).orderBy(chi.desc(), "gram").limit(terms).select("gram")
    chosen = [r["gram"] for r in best.collect()]
    vocabulary = Vocabulary(np.array(chosen, np.int64).view(np.uint64))
    frequencies = docs.select(F.col(text).cast("string").alias("_text")).mapInArrow(_document_frequencies(vocabulary), "term long, n long")
    df = {r["term"]: r["n"] for r in frequencies.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    idf = np.log((1 + df.get(-1, 0)) / (1 + np.array([df.get(t, 0) for t in range(len(vocabulary.grams))], float))) + 1
    # Only kept terms of the examples reach the driver.
    known = F.broadcast(best.sparkSession.createDataFrame([(int(g), t) for t, g in enumerate(vocabulary.grams.view(np.int64))], "gram long, term long"))
    entries = found.select("key", F.explode(F.arrays_zip("grams", "counts")).alias("e")).select("key", F.col("e.grams").alias("gram"), F.col("e.counts").alias("n"))
    postings = entries.join(known, "gram").select("key", "term", "n").toArrow()
    ids = sorted(found.select("key", "toxic").collect())
    number = {r["key"]: i for i, r in enumerate(ids)}
    toxic = np.array([r["toxic"] for r in ids], float)
    rows = np.array([number[k] for k in postings.column("key").to_pylist()], np.int64)
    terms_, counts = (postings.column(c).to_numpy().astype(np.int64) for c in ("term", "n"))
    order = np.lexsort((terms_, rows))
    rows, terms_, counts = rows[order], terms_[order], counts[order]
    index = Index([r["key"] for r in ids], toxic, rows, terms_, counts, idf)
    return _calibrated(vocabulary, index, rows, terms_, counts, toxic, [r["key"] for r in ids], sizes, held, neighbours)


def _calibrated(vocabulary, index, rows, terms, counts, toxic, ids, sizes, held, neighbours) -> Model:
    """The curve, from the votes that each example gets with itself left out."""
    place = {k: i for i, k in enumerate(index.ids)}
    weights = unit_weights(rows, terms, counts, index.idf, len(ids))
    shares, tops = np.zeros(len(ids)), np.zeros(len(ids))
    edges = np.searchsorted(rows, np.arange(len(ids) + 1))
    for i, key in enumerate(ids):
        a, b = edges[i], edges[i + 1]
        if a < b:
            shares[i], tops[i] = vote(index, *index.nearest(terms[a:b], weights[a:b], neighbours, without=place[key]))
    # An example stands for all labelled rows of its label.
    weight = np.where(toxic == 1, sizes[1] / held[1], sizes[0] / held[0])
    near = tops > 0
    scale = weight[near].sum() / max(1, near.sum())
    curve = fit_curve(shares[near], tops[near], toxic[near], weight[near] / scale) if near.any() else np.zeros(4)
    far = weight[~near]
    plain = (far @ toxic[~near] + sizes[1] / sum(sizes.values())) / (far.sum() + 1)
    return Model(vocabulary, index, curve, float(plain))


def score_documents(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", neighbours: int = NEIGHBOURS) -> DataFrame:
    """Key, held_out, score (0 to 1), predicted (1 from 0.5 on) and evidence of each row.

    `evidence` lists the nearest examples (id, toxic, cosine) and the terms that the document
    shares most with each. Scores depend on the text alone. Null and empty texts, and texts
    without any kept term, have the score of labelled texts like them and no evidence. Rows are
    scored one by one: repeated rows, null keys and very long texts are rows like others.
    Other columns are not read.
    """
    example = docs.schema[key].dataType.simpleString()
    evidence = f"array<struct<example:string,toxic:int,cosine:double,terms:array<string>>>"
    schema = f"`{key}` {example}, score double, evidence {evidence}"
    packed = pickle.dumps(model)
    shared = docs.sparkSession.sparkContext.broadcast(packed)

    def run(batches):
        own = pickle.loads(shared.value)

        def work(part, texts):
            share, top = np.zeros(len(texts)), np.zeros(len(texts))
            shown: list[list] = [[] for _ in range(len(texts))]
            for row, terms, weights, found, cosine in own.neighbours(texts, neighbours):
                share[row], top[row] = vote(own.index, found, cosine)
                shown[row] = [
                    {"example": str(own.index.ids[e]), "toxic": int(own.index.toxic[e]), "cosine": float(c), "terms": own.shared_terms(terms, weights, e)}
                    for e, c in zip(found[:SHOWN].tolist(), cosine[:SHOWN])
                ]
            kind = pa.list_(pa.struct([("example", pa.string()), ("toxic", pa.int32()), ("cosine", pa.float64()), ("terms", pa.list_(pa.string()))]))
            return batch_of(**{key: part.column(0), "score": own.score(share, top), "evidence": pa.array(shown, kind)})

        yield from by_slice("_text", work)(batches)

    scored = docs.select(key, F.col(text).cast("string").alias("_text")).mapInArrow(run, schema)
    return scored.select(
        key, held_out(key).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "evidence"
    )
