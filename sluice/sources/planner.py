"""Page ranges of a scan."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql.datasource import InputPartition


@dataclass
class PageRange(InputPartition):
    """Pages `start_page`..`end_page` of one endpoint; range `index` of `count`, in a stream's `round`."""

    endpoint: str
    start_page: int
    end_page: int
    index: int = 0
    count: int = 1
    round: int = 0

    @property
    def pages(self) -> range:
        return range(self.start_page, self.end_page + 1)


def page_ranges(start: int, n: int, concurrency: int) -> list[tuple[int, int]]:
    """Consecutive inclusive ranges of max(1, n // concurrency) pages."""
    if concurrency < 1:
        raise ValueError("concurrency must be at least 1")
    chunk = max(1, n // concurrency)
    stop = start + n
    return [(first, min(first + chunk, stop) - 1) for first in range(start, stop, chunk)]


def plan(endpoints: Iterable[str], start: int, n: int, concurrency: int) -> list[PageRange]:
    ranges = [
        PageRange(endpoint, first, last)
        for endpoint in endpoints
        for first, last in page_ranges(start, n, concurrency)
    ]
    return number(ranges)


def number(ranges: list[PageRange]) -> list[PageRange]:
    """The ranges, each told its place among all."""
    for index, r in enumerate(ranges):
        r.index, r.count = index, len(ranges)
    return ranges
