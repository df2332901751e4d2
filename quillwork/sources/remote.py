"""Remote sources as Python data sources: objects by id range, and pages by token.

A fetcher is any picklable callable; the network one retries with back-off and renews its session. Failed and
missing objects are rows without content, so that a run never fails on one of them.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader

#: Answers on which a request is tried again (fixed values).
RETRY = (429, 500, 502, 503, 504)


class Fetcher:
    """Texts by URL: so many tries with doubling pauses; 404 gives None, other errors raise after the last try."""

    def __init__(self, tries: int = 5, pause: float = 0.5, rotate: int = 25, timeout: float = 30.0, opener: Callable | None = None, sleep=time.sleep):
        self.tries, self.pause, self.rotate, self.timeout, self.opener, self.sleep = tries, pause, rotate, timeout, opener, sleep
        self.used, self.current = 0, None

    def __call__(self, url: str) -> str | None:
        for k in range(self.tries):
            if self.current is None or self.used >= self.rotate:
                self.current, self.used = (self.opener or urllib.request.build_opener)(), 0
            self.used += 1
            try:
                with self.current.open(url, timeout=self.timeout) as r:
                    return r.read().decode("utf-8", "replace")
            except urllib.error.HTTPError as e:
                if e.code == 404:
                    return None
                if e.code not in RETRY or k + 1 == self.tries:
                    raise
            except OSError:
                if k + 1 == self.tries:
                    raise
            self.sleep(self.pause * 2**k)
        return None


class IdRange(InputPartition):
    def __init__(self, ids: list[str]):
        self.ids = ids


class ObjectSource(DataSource):
    """spark.read.format("objects").option("url", "https://.../{id}").option("ids", "1,2|5").load(): (id, content, error).

    ids from several listings are joined by |; a partition fetches `chunk` of them.
    """

    @classmethod
    def name(cls) -> str:
        return "objects"

    def schema(self) -> str:
        return "id string, content string, error string"

    def reader(self, schema) -> DataSourceReader:
        return ObjectReader(self.options)


class ObjectReader(DataSourceReader):
    def __init__(self, options):
        self.url, self.chunk = options["url"], int(options.get("chunk", 100))
        self.ids = list(dict.fromkeys(i.strip() for part in options.get("ids", "").split("|") for i in part.split(",") if i.strip()))

    def partitions(self) -> list[IdRange]:
        return [IdRange(self.ids[k : k + self.chunk]) for k in range(0, len(self.ids), self.chunk)]

    def read(self, partition: IdRange) -> Iterator[tuple]:
        fetch = Fetcher()
        for i in partition.ids:
            try:
                yield i, fetch(self.url.replace("{id}", i)), None
            except Exception as e:
                yield i, None, str(e)[:200]


class PageSource(DataSource):
    """A stream of pages that name their successor by a token: (token, content). Options: url with {token}, field of the next token."""

    @classmethod
    def name(cls) -> str:
        return "pages_by_token"

    def schema(self) -> str:
        return "token string, content string"

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return PageReader(self.options)


class PageReader(SimpleDataSourceStreamReader):
    def __init__(self, options):
        self.url, self.field, self.most = options["url"], options.get("field", "resumptionToken"), int(options.get("pages", 10))

    def initialOffset(self) -> dict:
        return {"token": "", "done": False}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        fetch, rows, token, done = Fetcher(), [], start["token"], start["done"]
        for _ in range(0 if done else self.most):
            content = fetch(self.url.replace("{token}", token))
            if content is None:
                done = True
                break
            rows.append((token, content))
            token = next_token(content, self.field)
            if not token:
                done = True
                break
        return iter(rows), {"token": token, "done": done}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        fetch, token = Fetcher(), start["token"]
        while token != end["token"] or (token == "" and not end["done"]):
            content = fetch(self.url.replace("{token}", token))
            if content is None:
                return
            yield token, content
            token = next_token(content, self.field)
            if not token:
                return

    def commit(self, end: dict) -> None:
        pass


def next_token(content: str, field: str) -> str:
    """The successor's token in a page of JSON or XML; '' at the end."""
    import re

    try:
        return str(json.loads(content).get(field) or "")
    except ValueError:
        m = re.search(rf"<(?:\w+:)?{re.escape(field)}[^>]*>([^<]*)<", content)
        return m[1].strip() if m else ""


def register(spark) -> None:
    """Make both sources known to a session."""
    spark.dataSource.register(ObjectSource)
    spark.dataSource.register(PageSource)
