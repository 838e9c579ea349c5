"""A cursor-paginated API as a Spark data source, and the fetch loop behind it."""

from __future__ import annotations

import csv
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


@dataclass
class Page:
    rows: list[dict]
    next_cursor: str | None = None
    total: int | None = None


class APIError(Exception):
    def __init__(self, status: int, message: str = "", retry_after: float | None = None):
        super().__init__(f"{status} {message}".strip())
        self.status, self.retry_after = status, retry_after

    @property
    def retryable(self) -> bool:
        return self.status == 429 or self.status >= 500


class IncompleteError(Exception):
    """The pages do not add up to what the API declared, or cannot."""


@dataclass
class Fetched:
    rows: list[dict] = field(default_factory=list)
    pages: int = 0
    retries: int = 0


def fetch_all(fetch: Callable[[str | None], Page], max_retries: int = 4, backoff: float = 0.5, max_pages: int = 10_000, sleep: Callable[[float], None] = time.sleep) -> Fetched:
    """All rows by following cursors. Only 429 and 5xx are tried again, after Retry-After or a doubling wait."""
    out, cursor, seen, total = Fetched(), None, set(), None
    while True:
        for attempt in range(max_retries + 1):
            try:
                page = fetch(cursor)
                break
            except APIError as e:
                if not e.retryable or attempt == max_retries:
                    raise
                out.retries += 1
                sleep(e.retry_after if e.retry_after is not None else backoff * 2**attempt)
        out.rows += page.rows
        out.pages += 1
        total = page.total if page.total is not None else total
        if page.next_cursor is None:
            break
        if page.next_cursor in seen:
            raise IncompleteError(f"cursor {page.next_cursor} came twice")
        if out.pages >= max_pages:
            raise IncompleteError(f"more than {max_pages} pages")
        seen.add(page.next_cursor)
        cursor = page.next_cursor
    if total is not None and total != len(out.rows):
        raise IncompleteError(f"{len(out.rows)} rows of {total}")
    return out


class PaginatedReader(DataSourceReader):
    def __init__(self, schema, fetch: Callable[[str | None], Page]):
        self.names, self.fetch = [f.name for f in schema.fields], fetch

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]  # a cursor leads from page to page

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for row in fetch_all(self.fetch).rows:
            yield tuple(row.get(n) for n in self.names)


def register(spark: SparkSession, name: str, schema: str, fetch: Callable[[str | None], Page]) -> None:
    """Make spark.read.format(name) read the API. ``fetch`` goes to one executor."""

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return schema

        def reader(self, schema) -> DataSourceReader:
            return PaginatedReader(schema, fetch)

    spark.dataSource.register(Source)


def fake_api(rows: list[dict], size: int = 100, fail: dict[int, APIError] | None = None) -> Callable[[str | None], Page]:
    """A test server: pages of ``size``; the call with a number in ``fail`` raises once."""
    left, calls = dict(fail or {}), [0]

    def fetch(cursor: str | None) -> Page:
        calls[0] += 1
        if (e := left.pop(calls[0], None)) is not None:
            raise e
        at = int(cursor or 0)
        nxt = at + size
        return Page(rows[at:nxt], str(nxt) if nxt < len(rows) else None, len(rows))

    return fetch


def csv_api(path: str, size: int = 200, fail: dict[int, APIError] | None = None) -> Callable[[str | None], Page]:
    """A test server over the rows of one CSV file with a header; values are text, empty fields None."""
    with open(path, newline="", encoding="utf-8") as f:
        return fake_api([{k: v or None for k, v in r.items()} for r in csv.DictReader(f)], size, fail)
