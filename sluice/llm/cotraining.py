"""Quality classification by co-training two views of a document.

One classifier sees the text alone: the shapes of its words, and how its words and byte
4-grams, hashed, are distributed over good and bad labelled texts (the lexicon: smoothed
log-odds, so that what no labelled text holds speaks for the rarer class). The other sees
the page's metadata alone (language, source, declared size). Both learn from the labelled rows; then, for some rounds, each
also learns from unlabelled rows that the other is confident about. At the end both
views are calibrated on labelled rows kept out of training, combined, and every document
is scored.

Both are logistic regressions fitted by Newton steps. A step is one pass of the feature
table in which tasks add up gradients and curvatures of fixed size, so all labelled and
all confident unlabelled rows count, however many. Only sums reach the driver, among them the
lexicon's counts in `GRAMS` + `TERMS` classes, and, for the calibration, at most `CALIBRATION_ROWS` labelled rows of a few numbers each.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sluice.llm.components import landed
from sluice.llm.text import WORD, Texts, Words, batch_of, by_slice, byte_values, grams, per_row, slices

ROUNDS = 2
CONFIDENT = 0.97
PSEUDO_WEIGHT = 0.25
THRESHOLD = 0.5
FIRST_STEPS, ROUND_STEPS = 6, 3
CALIBRATION_ROWS = 20_000
RIDGE = 1.0
LANGUAGES, SOURCES = 8, 32
GRAM, GRAMS, TERMS = 4, 1 << 16, 1 << 16

_upper, _lower, _digit, _mark, _tail = (np.zeros(256, bool) for _ in range(5))
_upper[ord("A") : ord("Z") + 1] = True
_lower[ord("a") : ord("z") + 1] = True
_digit[ord("0") : ord("9") + 1] = True
_mark[[x for x in range(0x21, 0x7F) if not chr(x).isalnum()]] = True
_tail[[ord(c) for c in ".,;:!?"]] = True

CONTENT = 18
METADATA = 3 + LANGUAGES + SOURCES


def _terms(texts: Texts, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows and classes of all byte 4-grams inside a text, and of all its words after them."""
    names = grams(byte_values(texts.data), GRAM)
    row = np.repeat(np.arange(len(texts)), np.diff(texts.offsets))[: len(names)]
    inside = np.arange(len(names)) + GRAM <= texts.offsets[row + 1]
    return row[inside], (names[inside] % np.uint64(GRAMS)).astype(np.int64), words.row, (words.hash % np.uint64(TERMS)).astype(np.int64) + GRAMS


def _labelled(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str) -> DataFrame:
    """Text and label of the documents that are learned from.

    Every text moves once, about 1 x input, however many labels there are: a way for labels that can be
    broadcast would hide that from trial runs, as it ends where they grow.
    """
    known = _known(labels, key, label).where(~_held(key))
    return docs.select(F.col(key), F.col(text)).join(known.hint("merge"), key).select(text, "label")


def lexicon_of(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> np.ndarray:
    """Smoothed log-odds of good against bad for each class of 4-grams and words, counted over all
    labelled rows that are not held out; zeros without labels."""
    texts = _labelled(docs, labels, key, text, label)

    def work(batches):
        total = np.zeros((GRAMS + TERMS, 2))
        for batch in batches:
            for part in slices(batch, text):
                own = Texts(part.column(text))
                good = part.column("label").to_numpy(zero_copy_only=False)
                found = _terms(own, own.words())
                for row, kind in (found[:2], found[2:]):
                    total[:, 0] += np.bincount(kind, good[row], GRAMS + TERMS)
                    total[:, 1] += np.bincount(kind, 1 - good[row], GRAMS + TERMS)
        at = np.flatnonzero(total.sum(axis=1))
        yield batch_of(slot=pa.array(at, pa.int32()), good=total[at, 0], bad=total[at, 1])

    counts = np.zeros((GRAMS + TERMS, 2))
    for batch in texts.mapInArrow(work, "slot int, good double, bad double").groupBy("slot").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).toArrow().to_batches():
        counts[batch.column("slot").to_numpy(zero_copy_only=False)] = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("good", "bad")], axis=1)
    odds = np.zeros(GRAMS + TERMS)
    for kinds in (slice(0, GRAMS), slice(GRAMS, None)):
        share = (counts[kinds] + 1) / (counts[kinds] + 1).sum(axis=0)
        odds[kinds] = np.clip(np.log(share[:, 0] / share[:, 1]), -4, 4)
    return odds.astype(np.float32)


def content_features(texts: Texts, lexicon: np.ndarray) -> np.ndarray:
    """Shares and sizes of characters and words of each text, and the mean log-odds of its 4-grams
    and words with the share of each that speaks against it; the last column is 1."""
    words = Words(texts, WORD, None)
    lexical = []
    found = _terms(texts, words)
    for row, kind in (found[:2], found[2:]):
        odds, many = lexicon[kind], np.maximum(np.bincount(row, minlength=len(texts)), 1)
        lexical += [np.bincount(row, odds, len(texts)) / many, np.bincount(row, odds < -0.5, len(texts)) / many]
    data, offsets = texts.data, texts.offsets
    size = np.maximum(np.diff(offsets), 1)
    upper, lower, digit, mark = (per_row(c[data], offsets) for c in (_upper, _lower, _digit, _mark))
    n = words.counts()
    many = np.maximum(n, 1)
    last = words.data[words.end - 1]
    word_length = (words.end - words.start).astype(np.int64)
    odd_tail = (_mark[last] & ~_tail[last]) & (word_length > 1)
    lone_mark = (word_length == 1) & _mark[last]
    doubled = np.zeros(len(words), bool)
    long = word_length > 2
    doubled[long] = (last[long] == words.data[words.end[long] - 2]) & _mark[last[long]]
    # Distinct words of a row: first places among its words, sorted by row and hash.
    order = np.lexsort((words.hash, words.row))
    new = np.ones(len(words), bool)
    new[1:] = (words.hash[order][1:] != words.hash[order][:-1]) | (words.row[order][1:] != words.row[order][:-1])
    distinct = np.bincount(words.row[order][new], minlength=len(texts)) if len(words) else np.zeros(len(texts))
    columns = [
        upper / np.maximum(upper + lower, 1),
        digit / size,
        mark / size * 4,
        per_row(odd_tail, words.edges) / many,
        per_row(lone_mark, words.edges) / many,
        per_row(doubled, words.edges) / many,
        per_row(word_length, words.edges) / many / 10,
        np.log1p(n) / 10,
        distinct / many,
        per_row(_tail[last], words.edges) / many,
        np.log1p(per_row(mark, np.arange(len(texts) + 1))) / 10,
        (n < 20).astype(float),
        (n == 0).astype(float),
        *lexical,
        np.ones(len(texts)),
    ]
    return np.stack(columns, axis=1).astype(np.float32)


def metadata_features(lang: pa.Array, source: pa.Array, n_chars: pa.Array) -> np.ndarray:
    """Declared size, and hashed language and source of each page; the last column is 1."""
    out = np.zeros((len(lang), METADATA), np.float32)
    stated = n_chars.cast(pa.float64()).fill_null(-1).to_numpy(zero_copy_only=False)
    out[:, 0] = np.log1p(np.maximum(stated, 0)) / 10
    out[:, 1] = stated < 0
    for column, first, buckets in ((lang, 2, LANGUAGES), (source, 2 + LANGUAGES, SOURCES)):
        values = column.cast(pa.string()).dictionary_encode()
        places = np.array([zlib.crc32(v.encode()) % buckets for v in values.dictionary.to_pylist()] + [-1], np.int64)
        at = places[values.indices.fill_null(len(places) - 1).to_numpy(zero_copy_only=False)]
        known = np.flatnonzero(at >= 0)
        out[known, first + at[known]] = 1
    out[:, -1] = 1
    return out


def logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(np.float64)


def _sums(weights: tuple[np.ndarray, np.ndarray], teachers: tuple[np.ndarray, np.ndarray] | None, confident: float, share: float):
    """Gradient and curvature of both views over the task's rows, as (slot, value)."""
    sizes = (CONTENT, METADATA)

    def run(batches):
        total = [np.zeros((n, n + 1)) for n in sizes]
        for batch in batches:
            views = [_matrix(batch.column(k), n) for k, n in zip(("content", "metadata"), sizes)]
            label = batch.column("label").fill_null(np.nan).to_numpy(zero_copy_only=False)
            training = ~np.isnan(label) & ~batch.column("held_out").to_numpy(zero_copy_only=False)
            unknown = np.isnan(label)
            for i, x in enumerate(views):
                target, weight = np.where(training, label, 0.0), training.astype(float)
                if teachers is not None:  # what the other view is sure of
                    p = logistic(views[1 - i] @ teachers[1 - i])
                    sure = unknown & ((p >= confident) | (p <= 1 - confident))
                    target[sure], weight[sure] = p[sure] >= 0.5, share
                used = weight > 0
                x, target, weight = x[used], target[used], weight[used]
                p = logistic(x @ weights[i])
                total[i][:, 0] += x.T @ (weight * (p - target))
                total[i][:, 1:] += (x * (weight * p * (1 - p))[:, None]).T @ x
        flat = np.concatenate([t.ravel() for t in total])
        yield batch_of(slot=pa.array(np.arange(len(flat)), pa.int32()), value=flat)

    return run


def _newton(features: DataFrame, weights, teachers, confident: float, share: float):
    """One step for both views from one pass."""
    passed = features.mapInArrow(_sums(weights, teachers, confident, share), "slot int, value double")
    flat = np.zeros(sum(n * (n + 1) for n in (CONTENT, METADATA)))
    for slot, value in passed.groupBy("slot").agg(F.sum("value")).collect():
        flat[slot] = value
    out, at = [], 0
    for n, w in zip((CONTENT, METADATA), weights):
        part = flat[at : at + n * (n + 1)].reshape(n, n + 1)
        at += n * (n + 1)
        ridge = np.full(n, RIDGE)
        step = np.linalg.solve(part[:, 1:] + np.diag(ridge), part[:, 0] + ridge * w)
        size = np.abs(step).max()
        out.append(w - step * min(1.0, 8 / max(size, 1e-9)))
    return tuple(out)


def fit_logistic(x: np.ndarray, y: np.ndarray, start: np.ndarray, ridge: float = 1e-2, steps: int = 25) -> np.ndarray:
    """A small regression in memory; pulled towards `start`, which it returns without rows."""
    w = start.astype(float)
    for _ in range(steps):
        p = logistic(x @ w)
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (p - y) + ridge * (w - start))
        w = w - step * min(1.0, 4 / max(np.abs(step).max(), 1e-9))
    return w


class CoTrained:
    """Weights of both views, their calibrations (slope, shift), how they combine, and the lexicon
    of the content view."""

    def __init__(self, views, calibrations, combination, lexicon):
        self.views, self.calibrations, self.combination, self.lexicon = views, calibrations, combination, lexicon

    def scores(self, content: np.ndarray, metadata: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities of good quality: by content, by metadata, together."""
        logits = [(x.astype(np.float64) @ w) * a + b for x, w, (a, b) in zip((content, metadata), self.views, self.calibrations)]
        both = np.stack([*logits, np.ones(len(content))], axis=1)
        return logistic(logits[0]), logistic(logits[1]), logistic(both @ self.combination)


def _known(labels: DataFrame, key: str, label: str) -> DataFrame:
    """One label a document: the mean of those that are not null."""
    return labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(key).agg(F.avg(F.col(label).cast("double")).alias("label"))


def _held(key: str):
    """A fifth of the documents, which are not learned from."""
    return F.pmod(F.xxhash64(key), F.lit(5)) == 0


def features_of(docs: DataFrame, lexicon: np.ndarray, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source", n_chars: str = "n_chars") -> DataFrame:
    """Key and both views as arrays of floats, one row per row of `docs`."""

    def work(part, texts):
        views = content_features(texts, lexicon), metadata_features(part.column(2), part.column(3), part.column(4))
        lists = [
            pa.ListArray.from_arrays(pa.array(np.arange(len(v) + 1) * v.shape[1], pa.int32()), pa.array(v.ravel())) for v in views
        ]
        return batch_of(**{key: part.column(0)}, content=lists[0], metadata=lists[1])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text, lang, source, n_chars).mapInArrow(by_slice(text, work), f"`{key}` {kind}, content array<float>, metadata array<float>")


def train(
    features: DataFrame, labels: DataFrame, lexicon: np.ndarray, key: str = "doc_id", label: str = "quality",
    rounds: int = ROUNDS, confident: float = CONFIDENT, share: float = PSEUDO_WEIGHT, calibration_rows: int = CALIBRATION_ROWS,
) -> CoTrained:
    """Co-trains on features (of `features_of` with this lexicon) and labels (key and a number in 0..1).

    Several labels of one document count by their mean; null labels and labels of unknown
    documents are ignored. A fifth of the labelled documents, chosen by the hash of the key,
    only calibrates. Without labels every score is 1/2.
    """
    known, held = _known(labels, key, label), _held(key)
    table = landed(
        features.join(known, key, "left_outer").select(key, "content", "metadata", "label", F.coalesce(held, F.lit(False)).alias("held_out")),
        "features",
    )
    used = table.select("content", "metadata", "label", "held_out")
    weights = np.zeros(CONTENT), np.zeros(METADATA)
    for _ in range(FIRST_STEPS):
        weights = _newton(used, weights, None, confident, share)
    for _ in range(rounds):
        teachers = weights
        for _ in range(ROUND_STEPS):
            weights = _newton(used, weights, teachers, confident, share)
    own = table.where("held_out AND label IS NOT NULL")
    fraction = min(1.0, calibration_rows / max(1, own.count()))
    # A few more than asked for, then the first by their hash: the same rows in every run.
    order = F.xxhash64(key, F.lit(1))
    chosen = own.where(F.pmod(order, F.lit(1 << 20)) < F.lit(math.ceil(1.1 * fraction * (1 << 20))))
    rows = chosen.orderBy(order, key).select("content", "metadata", "label").limit(calibration_rows).collect()
    y = np.array([r[2] for r in rows])
    logits = [np.array([r[i] for r in rows], np.float64).reshape(-1, n) @ w for i, (n, w) in enumerate(zip((CONTENT, METADATA), weights))]
    calibrations = [tuple(fit_logistic(np.stack([z, np.ones(len(z))], axis=1), y, np.array([1.0, 0.0]))) for z in logits]
    adjusted = [z * a + b for z, (a, b) in zip(logits, calibrations)]
    combination = fit_logistic(np.stack([*adjusted, np.ones(len(y))], axis=1), y, np.array([0.5, 0.5, 0.0]))
    return CoTrained(weights, calibrations, combination, lexicon)


def score(features: DataFrame, model: CoTrained, key: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """Key, content_score, metadata_score, score and kept (score >= threshold), a row per row."""

    def work(batches):
        for batch in batches:
            found = model.scores(_matrix(batch.column("content"), CONTENT), _matrix(batch.column("metadata"), METADATA))
            yield batch_of(**{key: batch.column(key)}, content_score=found[0], metadata_score=found[1], score=found[2], kept=found[2] >= threshold)

    kind = features.schema[key].dataType.simpleString()
    return features.select(key, "content", "metadata").mapInArrow(work, f"`{key}` {kind}, content_score double, metadata_score double, score double, kept boolean")


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", **options) -> DataFrame:
    """Trains on the labelled rows of `docs` and scores them all.

    Null and empty texts are documents without words, null metadata is its own category;
    repeated rows are scored alike, each for itself. Other columns are not read.
    """
    lexicon = lexicon_of(docs, labels, label=label)
    features = landed(features_of(docs, lexicon), "views")
    return score(features, train(features, labels, lexicon, label=label, **options))


def keep_good(docs: DataFrame, model: CoTrained, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, that `model` scores at `threshold` or more."""
    names = docs.columns

    def work(part, texts):
        meta = [part.column(names.index(c)) for c in ("lang", "source", "n_chars")]
        good = model.scores(content_features(texts, model.lexicon), metadata_features(*meta))[2] >= threshold
        return part.filter(pa.array(good))

    return docs.mapInArrow(by_slice(text, work), docs.schema)
