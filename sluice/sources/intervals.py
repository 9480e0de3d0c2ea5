"""Sets of whole numbers as sorted, disjoint, inclusive intervals."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

Intervals = list[tuple[int, int]]


def normal(pairs: Iterable[tuple[int, int]]) -> Intervals:
    """The numbers of all pairs as few intervals; pairs that end before they begin are empty."""
    out: Intervals = []
    for first, last in sorted(p for p in pairs if p[0] <= p[1]):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


def union(a: Intervals, b: Intervals) -> Intervals:
    return normal([*a, *b])


def minus(a: Intervals, b: Intervals) -> Intervals:
    """The numbers of `a` that are not in `b`."""
    out, at = [], 0
    for first, last in a:
        while at < len(b) and b[at][1] < first:
            at += 1
        n = at
        while n < len(b) and b[n][0] <= last:
            if b[n][0] > first:
                out.append((first, b[n][0] - 1))
            first = b[n][1] + 1
            n += 1
        if first <= last:
            out.append((first, last))
    return out


def numbers(a: Intervals) -> Iterator[int]:
    for first, last in a:
        yield from range(first, last + 1)


def of_numbers(values: Iterable[int]) -> Intervals:
    return normal((v, v) for v in values)


def count(a: Intervals) -> int:
    return sum(last - first + 1 for first, last in a)


def to_text(a: Intervals) -> str:
    """`1-4,6,8-9`"""
    return ",".join(str(f) if f == l else f"{f}-{l}" for f, l in a)


def from_text(text: str) -> Intervals:
    ends = (part.split("-") for part in text.split(",") if part)
    return normal((int(e[0]), int(e[-1])) for e in ends)
