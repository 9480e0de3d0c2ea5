"""Sources that answer with records: `restapi` and `myrestdatasource`."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StringType, StructField, StructType

from sluice.sources.fetch import Fetcher
from sluice.sources.options import Request, join_url, parse_request

# Fixed values of the posts source.
POSTS_URL = "https://jsonplaceholder.typicode.com"
POSTS_SCHEMA = "userId INT, id INT, title STRING, body STRING"
POSTS_KEYS = ("userId", "id", "title", "body")


class RawRecords(DataSource):
    """One GET of `url`; the JSON text of each record in a column named `schemaname`."""

    @classmethod
    def name(cls) -> str:
        return "restapi"

    def schema(self) -> StructType:
        name = self.options.get("schemaname")
        if not name:
            raise ValueError("option schemaname is required")
        return StructType([StructField(name, StringType(), True)])

    def reader(self, schema: StructType) -> DataSourceReader:
        url = self.options.get("url")
        if not url:
            raise ValueError("option url is required")
        return OneRequestReader(parse_request(url, self.options), _as_text)


class FixedPosts(DataSource):
    """One GET of `endpoint`; four fixed keys per record, null where missing."""

    @classmethod
    def name(cls) -> str:
        return "myrestdatasource"

    def schema(self) -> str:
        return POSTS_SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        base = self.options.get("base_url") or POSTS_URL
        url = join_url(base, self.options.get("endpoint") or "posts")
        return OneRequestReader(parse_request(url, self.options), _posts_row)


class OneRequestReader(DataSourceReader):
    def __init__(self, request: Request, to_row):
        self.request = request
        self.to_row = to_row

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        status, body, error = Fetcher().page(self.request, None)
        if error or not 200 <= (status or 0) < 300:
            raise RuntimeError(f"{self.request.url}: {error or f'HTTP {status}'}")
        data = json.loads(body)
        for record in data if isinstance(data, list) else [data]:
            yield self.to_row(record)


def _as_text(record) -> tuple:
    return (json.dumps(record, ensure_ascii=False, separators=(",", ":")),)


def _posts_row(record: dict) -> tuple:
    return tuple(record.get(key) for key in POSTS_KEYS)
