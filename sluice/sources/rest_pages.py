"""Source `restpages`: response bodies of paged endpoints, in batch or as a stream."""

from __future__ import annotations

from pyspark.sql.datasource import DataSource

from sluice.sources.options import PageOptions
from sluice.sources.pages import RAW_PAGES, PageReader, PruningPageReader
from sluice.streaming.page_stream import PageStreamReader


class RestPages(DataSource):
    """Pages `start_page`.. of `endpoint` (or of the JSON list `endpoints`) below `base_url`.

    Nothing raises on a bad answer: its status or error is part of the row, as
    only the rows before an endpoint's last page count. See `PageOptions`.

    With `filter_pushdown` true, filters on endpoint and page prune the scan. It is
    off by default: Spark 4.1 keeps the pruned ranges with the loaded DataFrame,
    so a later query on the same DataFrame would miss pages. Turn it on for a
    DataFrame that is used in one query; `readers.read_pages` prunes safely.
    """

    @classmethod
    def name(cls) -> str:
        return "restpages"

    def schema(self) -> str:
        return RAW_PAGES

    def reader(self, schema) -> PageReader:
        options = PageOptions.parse(self.options)
        return PruningPageReader(options) if options.filter_pushdown else PageReader(options)

    def streamReader(self, schema) -> PageStreamReader:
        return PageStreamReader(PageOptions.parse(self.options))
