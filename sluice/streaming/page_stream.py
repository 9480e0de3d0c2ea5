"""Stream side of `restpages`: the offset holds the set of pages read of each endpoint."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql.datasource import DataSourceStreamReader

from sluice.functions.envelopes import ENVELOPE_KEYS
from sluice.sources import intervals as I
from sluice.sources.fetch import Fetcher
from sluice.sources.options import PageOptions
from sluice.sources.pages import in_batches
from sluice.sources.planner import PageRange, number, page_ranges
from sluice.streaming.gaps import GapLog


class PageStreamReader(DataSourceStreamReader):
    """Pages from `start_page` to the last of `max_pages`, each that holds records in exactly one batch.

    An offset is, for each endpoint, the intervals of pages read up to it. A page that is
    missing, empty or failing is not in them: it stays open, and is looked for again at every
    trigger until it holds records. Beyond the last page known, new ones are found by looking ahead
    in doubling steps; the end is where `max_gap` pages in a row hold nothing. Pages in
    between are asked for by the tasks, which note those that hold nothing in the folder
    `state_path`; the next offset takes them back out. Without that folder the pages are looked at
    one by one before they are read, and one that is gone again fails its batch.

    With `max_pages_per_trigger` a batch has at most that many pages per endpoint. A batch that is
    read again after a failure asks for the same pages and notes them anew.
    """

    def __init__(self, options: PageOptions):
        self.options = options
        self.fetcher = Fetcher(options.rate, options.rate_capacity)
        self.log = GapLog(options.state_path) if options.state_path else None
        known = self.log.planned() if self.log else None
        self.planned = self.initialOffset() | (known or {})

    def initialOffset(self) -> dict:
        return {e: {"read": "", "again": "", "round": 0} for e in self.options.endpoints}

    def latestOffset(self) -> dict:
        return {e: self._next(e, self._state(self.planned, e)) for e in self.planned}

    @property
    def bounds(self) -> tuple[int, int]:
        return self.options.start_page, self.options.start_page + self.options.max_pages - 1

    def _state(self, offset: dict, endpoint: str) -> dict:
        state = offset.get(endpoint, {"read": "", "again": "", "round": 0})
        if isinstance(state, int):  # an offset of earlier versions: the next page
            state = {"read": I.to_text(I.normal([(self.options.start_page, state - 1)])), "again": "", "round": 0}
        return state

    def _next(self, endpoint: str, state: dict) -> dict:
        planned = I.from_text(state["read"])
        gaps = self.log.gaps(endpoint, state["round"]) if self.log else []
        read = I.minus(planned, gaps)
        step = self.options.max_pages_per_trigger or self.options.max_pages
        first, last = self.bounds
        known = min(last, planned[-1][1]) if planned else first - 1
        found = []
        for page in I.numbers(I.minus(I.normal([(first, known)]), read)):
            if len(found) == step:
                break
            if self._holds(endpoint, page):
                found.append(page)
        open_now = I.of_numbers(found)
        ahead = self._ahead(endpoint, known + 1, min(last, known + step - len(found)))
        read = I.union(I.union(read, open_now), ahead)
        # Pages that an earlier offset counted as read, and which are asked for again.
        again = I.minus(open_now, I.minus(open_now, planned))
        if read == planned and not again:
            return state
        return {"read": I.to_text(read), "again": I.to_text(again), "round": state["round"] + 1}

    def _ahead(self, endpoint: str, page: int, last: int) -> I.Intervals:
        """Pages from `page` up to the last that holds records."""
        if self.log is None:
            found, empty = [], 0
            for n in range(page, last + 1):
                held = self._holds(endpoint, n)
                empty = 0 if held else empty + 1
                if held:
                    found.append(n)
                elif empty > self.options.max_gap:
                    break
            return I.of_numbers(found)
        start, width, stop = page, 1, last + 1
        while page < stop:
            probe = min(page + width, stop) - 1
            held = next((n for n in range(probe, min(probe + self.options.max_gap, last) + 1) if self._holds(endpoint, n)), None)
            if held is None:
                stop, width = probe, max(1, (probe - page) // 2)
            else:
                page, width = held + 1, 2 * width
                stop = max(stop, min(page, last + 1))
        return I.normal([(start, page - 1)])

    def _holds(self, endpoint: str, page: int) -> bool:
        return holds_records(*self.fetcher.page(self.options.for_endpoint(endpoint), page))

    def partitions(self, start: dict, end: dict) -> list[PageRange]:
        # After a restart Spark comes here first, with the last planned offsets.
        ranges = []
        for endpoint in end:
            before, after = (self._state(offset, endpoint) for offset in (start, end))
            read = I.minus(I.from_text(before["read"]), I.from_text(after["again"]))
            for first, last in I.minus(I.from_text(after["read"]), read):
                for pages in page_ranges(first, last - first + 1, self.options.concurrency):
                    ranges.append(PageRange(endpoint, *pages, round=after["round"]))
        self.planned = self.planned | {e: self._state(end, e) for e in end}
        if self.log:
            self.log.plan(self.planned)
        return number(ranges)

    def read(self, partition: PageRange | None) -> Iterator:
        if partition is None:
            return
        options = self.options
        fetcher = Fetcher(options.rate, options.rate_capacity, partition.index, partition.count)
        request = options.for_endpoint(partition.endpoint)
        gaps = []

        def found():
            for page in partition.pages:
                answer = fetcher.page(request, page)
                if holds_records(*answer):
                    yield partition.endpoint, page, *answer
                elif self.log is None:
                    status, _, error = answer
                    raise RuntimeError(f"{partition.endpoint} page {page}: {error or f'HTTP {status}, no records'}; set state_path to go on without it")
                else:
                    gaps.append(page)

        yield from in_batches(found())
        if self.log:
            self.log.note(partition, I.of_numbers(gaps))

    def commit(self, end: dict) -> None:
        pass


def holds_records(status: int | None, body: str | None, error: str | None) -> bool:
    """Whether a page was read and is not empty. Text that is not JSON counts as content,
    which is read and reported."""
    if error is not None or body is None or status is None or not 200 <= status < 300:
        return False
    value = body
    while isinstance(value, str):
        try:
            value = json.loads(value)
        except ValueError:
            return True
    if isinstance(value, dict):
        value = next((value[k] for k in ENVELOPE_KEYS if isinstance(value.get(k), list)), value)
    return value is not None and value != []
