"""Quality rules on repetition inside a text, by suffix arrays over its words.

Each task builds the suffix arrays of a slice of texts at once. Neighbouring suffixes
with a longest common prefix (LCP) of `min_words` or more bound the LCP intervals; the
spans of all maximal repeated substrings together are the words within the larger LCP
of any suffix, and the longest repeat is the largest LCP. Nothing is shuffled.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from sluice.llm.text import WORD, Texts, Words, batch_of, by_slice, byte_values, covered, mix, per_row, rolling

MIN_WORDS = 6
MAX_COVERED = 0.3
MAX_REPEAT = 100

# Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
BASE_WINDOW, BASE_LEAST_WORDS, BASE_PERCENT = 8, 20, 30

_symbol = np.zeros(256, bool)
_symbol[list(SYMBOLS)] = True


def suffix_ranks(values: np.ndarray, row: np.ndarray) -> list[np.ndarray]:
    """Order-preserving ranks of prefixes of 1, 2, 4, .. words of each suffix.

    Suffixes of different rows never share a rank, and a suffix that has ended ranks
    alone. The last rank array has no ties: its argsort is the suffix array.
    """
    n = len(values)
    order = np.lexsort((values, row))
    new = np.ones(n, bool)
    new[1:] = (values[order][1:] != values[order][:-1]) | (row[order][1:] != row[order][:-1])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    ranks, height = [rank], 1
    while True:
        size = np.bincount(rank, minlength=n)
        tied = np.flatnonzero(size[rank] > 1)
        if not len(tied):
            return ranks
        ahead = np.minimum(tied + height, n - 1)
        after = np.where((tied + height < n) & (row[ahead] == row[tied]), rank[ahead], -1)
        order = np.lexsort((after, rank[tied]))
        group, after, at = rank[tied][order], after[order], np.arange(len(tied))
        first = np.ones(len(tied), bool)
        first[1:] = group[1:] != group[:-1]
        new = first.copy()
        new[1:] |= after[1:] != after[:-1]
        rank = rank.copy()
        place = at - np.maximum.accumulate(np.where(first, at, 0))
        lead = np.maximum.accumulate(np.where(new, at, 0))
        rank[tied[order]] = group + place[lead]
        ranks.append(rank)
        height *= 2


def longest_repeats(values: np.ndarray, row: np.ndarray, least: int) -> np.ndarray:
    """For each suffix, its longest prefix of `least` words or more that occurs elsewhere in
    its row (0: none)."""
    best = np.zeros(len(values), np.int64)
    if len(values) < 2:
        return best
    ranks = suffix_ranks(values, row)
    array = np.argsort(ranks[-1], kind="stable")
    a, b = array[:-1], array[1:]
    for k in range(len(ranks) - 1, -1, -1):  # only neighbours alike this far can be long enough
        if 1 << k <= least:
            alike = ranks[k][a] == ranks[k][b]
            a, b = a[alike], b[alike]
            break
    length, n = np.zeros(len(a), np.int64), len(values)
    for k in range(len(ranks) - 1, -1, -1):
        p, q = np.minimum(a + length, n - 1), np.minimum(b + length, n - 1)
        inside = (a + length < n) & (b + length < n) & (row[p] == row[a]) & (row[q] == row[b])
        length += (inside & (ranks[k][p] == ranks[k][q])).astype(np.int64) << k
    length[length < least] = 0
    np.maximum.at(best, a, length)
    np.maximum.at(best, b, length)
    return best


def duplicate_lines(texts: Texts) -> np.ndarray:
    """Per row: lines with a word that equal an earlier line of the row."""
    data, n = texts.data, len(texts.data)
    starts = np.union1d(texts.offsets[:-1][np.diff(texts.offsets) > 0], np.flatnonzero(data == 10) + 1)
    starts = starts[starts < n]
    row = np.searchsorted(texts.offsets, starts, "right") - 1
    stops = np.append(starts[1:], n)
    # A line ends before its line feed; one that is cut by the next row has none.
    ends = stops - (data[stops - 1] == 10) if len(starts) else stops[:0]
    filled = np.zeros(n + 1, np.int64)
    np.cumsum(WORD[data], out=filled[1:])
    has_word = filled[ends] > filled[starts]
    key = mix(rolling(byte_values(data), starts, ends) + row.astype(np.uint64))
    again = np.ones(len(starts), bool)
    again[np.unique(key, return_index=True)[1]] = False
    return np.bincount(row[again & has_word], minlength=len(texts))


def measure(texts: Texts, min_words: int, max_covered: float, max_repeat: int) -> dict[str, np.ndarray]:
    words = Words(texts, WORD, None)
    n_words = words.counts()
    letters = ((texts.data & 0xC0) != 0x80) & WORD[texts.data]
    chars_before = np.zeros(len(texts.data) + 1, np.int64)
    np.cumsum(letters, out=chars_before[1:])
    word_size = chars_before[words.end] - chars_before[words.start]
    best = longest_repeats(words.hash, words.row, min(min_words, BASE_WINDOW))
    at = np.arange(len(words))

    def words_in_repeats(least: int) -> np.ndarray:
        long = best >= least
        return covered(len(words), at[long], at[long] + best[long])

    repeated = words_in_repeats(BASE_WINDOW)
    spans = words_in_repeats(min_words)
    word_chars = per_row(word_size, words.edges)
    covered_chars = per_row(np.where(spans, word_size, 0), words.edges)
    longest = np.zeros(len(texts), np.int64)
    np.maximum.at(longest, words.row, np.where(best >= min_words, best, 0))
    n_repeat = per_row(repeated, words.edges)
    failed = (n_words < BASE_LEAST_WORDS) | (100 * n_repeat > BASE_PERCENT * n_words)
    fraction = covered_chars / np.maximum(word_chars, 1)
    return {
        "n_words": n_words,
        "word_chars": word_chars,
        "n_symbols": per_row(_symbol[texts.data], texts.offsets),
        "n_dup_lines": duplicate_lines(texts),
        "n_repeat_words": n_repeat,
        "base_failed": failed,
        "covered_fraction": fraction,
        "longest_repeat": longest,
        "kept": ~failed & (fraction <= max_covered) & (longest <= max_repeat),
    }


def repetition_rules(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    min_words: int = MIN_WORDS,
    max_covered: float = MAX_COVERED,
    max_repeat: int = MAX_REPEAT,
) -> DataFrame:
    """One row per row of `docs`: its key, counts, base rules and the verdict `kept`.

    The verdict is false where the base rules fail, where maximal repeated substrings of
    `min_words` or more words cover more than `max_covered` of the word characters, or
    where the longest is over `max_repeat` words. Null and empty texts have no words and
    fail the base rules. Repeated rows and null keys are rows like others; other columns
    of `docs` are not read.
    """

    def work(part, texts):
        return batch_of(**{key: part.column(0)}, **measure(texts, min_words, max_covered, max_repeat))

    kind = docs.schema[key].dataType.simpleString()
    schema = (
        f"`{key}` {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, covered_fraction double, longest_repeat long, kept boolean"
    )
    return docs.select(key, text).mapInArrow(by_slice(text, work), schema)
