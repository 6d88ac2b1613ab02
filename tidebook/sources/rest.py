"""REST sources as Python data sources: paged listings and batched order books.

The transport is an option, ``package.module:function``, and is imported where the reading happens; it
takes (method, url, body) and returns decoded JSON. Without one, urllib is used.
"""

from __future__ import annotations

import importlib
import json
import time
from collections.abc import Iterator
from urllib.parse import urlencode
from urllib.request import Request, urlopen

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: The cursor of the last page, and how many pages a listing may have.
END_CURSOR, MAX_PAGES = "LTE=", 100
#: Assets per request for books.
BATCH = 500


def send(method: str, url: str, body: object | None = None, timeout: float = 30) -> object:
    request = Request(url, method=method, data=None if body is None else json.dumps(body).encode(), headers={"Content-Type": "application/json", "Accept": "application/json"})
    with urlopen(request, timeout=timeout) as answer:  # noqa: S310
        if answer.status != 200:
            raise OSError(f"{url}: status {answer.status}")
        return json.load(answer)


def transport(options: dict):
    if not (name := options.get("transport")):
        return send
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


class Pages(DataSource):
    """Items of a listing that is read page by page; `next_cursor` leads on, so it is one partition."""

    @classmethod
    def name(cls) -> str:
        return "rest_pages"

    def schema(self) -> str:
        return "page int, item string"

    def reader(self, schema) -> PageReader:
        return PageReader(dict(self.options))


class PageReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.options = options

    def read(self, partition) -> Iterator[tuple]:
        call, cursor = transport(self.options), ""
        base = json.loads(self.options.get("params", "{}"))
        for page in range(MAX_PAGES):
            query = urlencode(base | ({"next_cursor": cursor} if cursor else {}))
            answer = call("GET", f"{self.options['endpoint']}?{query}", None)
            if not isinstance(answer, dict):
                raise ValueError(f"{self.options['endpoint']} gave no object")
            items = answer.get("data") or []
            for item in items:
                yield page, json.dumps(item, sort_keys=True, ensure_ascii=False, separators=(",", ":"))
            cursor = answer.get("next_cursor") or END_CURSOR
            if cursor == END_CURSOR or not items:
                return
        raise RuntimeError(f"{self.options['endpoint']} has over {MAX_PAGES} pages")


class Books(DataSource):
    """Checkpoint records of order books, a partition for every 500 assets (option `assets`, JSON list)."""

    @classmethod
    def name(cls) -> str:
        return "rest_books"

    def schema(self) -> str:
        return "value string"

    def reader(self, schema) -> BookReader:
        return BookReader(dict(self.options))


class Batch(InputPartition):
    def __init__(self, number: int, assets: list[str]) -> None:
        self.number, self.assets = number, assets


class BookReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.options = options
        self.assets = list(dict.fromkeys(json.loads(options.get("assets", "[]"))))

    def partitions(self) -> list[Batch]:
        return [Batch(i, self.assets[at : at + BATCH]) for i, at in enumerate(range(0, len(self.assets), BATCH))]

    def read(self, partition: Batch) -> Iterator[tuple]:
        common = {"received_at_ns": time.time_ns(), "received_monotonic_ns": time.monotonic_ns(), "checkpoint_id": f"{self.options.get('checkpoint_id', 'checkpoint')}-{partition.number}", "requested_asset_count": len(self.assets)}
        try:
            books = transport(self.options)("POST", self.options["endpoint"], [{"token_id": a} for a in partition.assets])
            if not isinstance(books, list):
                raise ValueError("the answer is not a list")
        except Exception as e:  # a failed batch is a record of its own
            yield (json.dumps({"record_type": "rest_book_checkpoint_error", **common, "error_type": type(e).__name__, "error": str(e)}),)
            return
        books = [b for b in books if isinstance(b, dict)]
        for i, payload in enumerate(books):
            yield (json.dumps({"record_type": "rest_book_checkpoint", **common, "checkpoint_index": i, "checkpoint_book_count": len(books), "payload": payload}),)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Pages)
    spark.dataSource.register(Books)
