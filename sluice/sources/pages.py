"""Reading ranges of pages: one row per page with its response body."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql.datasource import (
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
)

from sluice.sources.fetch import Fetcher
from sluice.sources.options import PageOptions
from sluice.sources.planner import PageRange, plan

RAW_PAGES = "endpoint STRING, page INT, status INT, body STRING, error STRING"
# Of single attempts, with the number of tries before and the time from which on another
# may be made.
ATTEMPTS = f"{RAW_PAGES}, attempt INT, not_before DOUBLE"

# A batch of pages is handed to Spark when it holds this many bytes or rows.
BATCH_BYTES = 4 << 20
BATCH_ROWS = 1024


class PageReader(DataSourceReader):
    def __init__(self, options: PageOptions):
        self.options = options
        self.endpoints = list(dict.fromkeys(options.endpoints))
        self.first = options.start_page
        self.last = options.start_page + options.max_pages - 1

    def partitions(self) -> list[PageRange]:
        n = max(0, self.last - self.first + 1)
        return plan(self.endpoints, self.first, n, self.options.concurrency)

    def read(self, partition: PageRange | None) -> Iterator:
        return read_range(self.options, partition)


class PruningPageReader(PageReader):
    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Takes what selects endpoints and page ranges; Spark does the rest."""
        for f in filters:
            if not self._take(f):
                yield f

    def _take(self, f: Filter) -> bool:
        column = getattr(f, "attribute", None)
        if column == ("endpoint",):
            if isinstance(f, IsNotNull):
                return True
            if isinstance(f, (EqualTo, In)):
                wanted = f.value if isinstance(f, In) else (f.value,)
                self.endpoints = [e for e in self.endpoints if e in wanted]
                return True
        if column == ("page",):
            if isinstance(f, IsNotNull):
                return True
            if isinstance(f, EqualTo):
                self.first, self.last = max(self.first, f.value), min(self.last, f.value)
                return True
            if isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                self.first = max(self.first, f.value + isinstance(f, GreaterThan))
                return True
            if isinstance(f, (LessThan, LessThanOrEqual)):
                self.last = min(self.last, f.value - isinstance(f, LessThan))
                return True
        return False


def read_range(options: PageOptions, partition: PageRange | None) -> Iterator:
    """Arrow batches of raw pages. Spark passes None when there are no partitions."""
    if partition is None:
        return
    fetcher = Fetcher(options.rate, options.rate_capacity, partition.index, partition.count)
    request = options.for_endpoint(partition.endpoint)
    yield from in_batches((partition.endpoint, page, *fetcher.page(request, page)) for page in partition.pages)


def in_batches(rows: Iterable[tuple]) -> Iterator:
    pending, size = [], 0
    for row in rows:
        pending.append(row)
        size += len(row[3] or "")
        if size >= BATCH_BYTES or len(pending) >= BATCH_ROWS:
            yield to_batch(pending)
            pending, size = [], 0
    if pending:
        yield to_batch(pending)


_ARROW_KINDS = {"STRING": "string", "INT": "int32", "DOUBLE": "double"}


def to_batch(rows: list[tuple]):
    """Rows of raw pages, or of attempts at them, as a batch."""
    import pyarrow as pa

    fields = [f.split() for f in (RAW_PAGES if len(rows[0]) == 5 else ATTEMPTS).split(", ")]
    schema = pa.schema([(name, pa.type_for_alias(_ARROW_KINDS[kind])) for name, kind in fields])
    columns = [pa.array(values, f.type) for values, f in zip(zip(*rows), schema)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)
