"""Plain, slow statements of what the operators return."""

import hashlib
import re
import zlib
from collections import Counter
from itertools import groupby

import numpy as np

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def in_windows(n, width, hits):
    inside = [False] * n
    for i in hits:
        inside[i : i + width] = [True] * width
    return inside


def repetition(text, least):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, longest, covered characters."""
    w, seen, dup = words(text), set(), 0
    for line in (text or "").split("\n"):
        dup += line in seen and bool(words(line))
        seen.add(line)

    def repeated(k):
        runs = [tuple(w[i : i + k]) for i in range(len(w) - k + 1)]
        often = Counter(runs)
        return in_windows(len(w), k, [i for i, r in enumerate(runs) if often[r] > 1])

    longest = max((k for k in range(least, len(w)) if any(repeated(k))), default=0)
    covered = sum(len(x) for x, inside in zip(w, repeated(least)) if inside)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, sum(repeated(8)), longest, covered


def contamination(docs, items):
    """{doc_id: (n_words, n_hit, item ids)}"""
    known = {}
    for item, text in items:
        w = alnum(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            known.setdefault(tuple(w[i : i + 10]), set()).add(item)
    sizes, out = {len(k) for k in known}, {}
    for key, text in docs:
        w, hit, found = alnum(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in known:
                    hit.update(range(i, i + n))
                    found |= known[tuple(w[i : i + n])]
        out[key] = len(w), len(hit), sorted(str(x) for x in found if x is not None)
    return out


def near_duplicates(docs, size, fold=True):
    """{doc_id: (n_shingles, component_id)}, by comparing all pairs."""
    sets = {}
    for key, text in docs:
        w = words((text or "").translate(LOWER) if fold else text)
        sets[key] = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())
    label = {k: k for k in sets}

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and min(len(x), len(y)) >= 0.8 * max(len(x), len(y)) and 100 * len(x & y) >= 80 * len(x | y):
                ra, rb = root(a), root(b)
                label[max(ra, rb)] = min(ra, rb)
    return {k: (len(sets[k]), root(k)) for k in keys}


def substring_words(docs, size):
    """{doc_id: (n_words, kept words)}"""
    first, split = {}, {k: words(t) for k, t in docs}
    for key in sorted(split):
        w = split[key]
        for i in range(len(w) - size + 1):
            first.setdefault(tuple(w[i : i + size]), key)
    out = {}
    for key, w in split.items():
        gone = in_windows(len(w), size, [i for i in range(len(w) - size + 1) if first[tuple(w[i : i + size])] < key])
        out[key] = len(w), [x for x, g in zip(w, gone) if not g]
    return out


def substring_bytes(docs, size):
    """{doc_id: (n_bytes, n_removed, n_spans, sha256 of the rest)}"""
    seen, out = set(), {}
    for key, text in sorted(docs):
        data = (text or "").encode()
        hits = []
        for i in range(len(data) - size + 1):
            run = data[i : i + size]
            if run in seen:
                hits.append(i)
            seen.add(run)
        gone = in_windows(len(data), size, hits)
        spans = sum(g for g, _ in groupby(gone))
        out[key] = len(data), sum(gone), spans, sha(bytes(b for b, g in zip(data, gone) if not g))
    return out


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())
