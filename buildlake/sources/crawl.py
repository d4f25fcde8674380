"""A paged, time-windowed crawl as a Spark data source: batch and stream, offline or with a fetcher of one's own.

The source splits ``[start, end)`` into windows, newest first; each window is
a partition, so executors fetch windows in parallel, in a stream too: its
driver side only moves the offset, the time up to which all is read. A fetcher
is any importable ``module:function`` that takes (since, until, page) and
returns (total, rows); a window is read until ``page * 100 >= total``, and in
halves where its total is over 999. A second can't be halved: it is read page by
page, and if the service stops before its total the crawl fails. With the
option ``source`` the function is called with it and returns the fetcher.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from buildlake import schemas as S

# fixed values: the crawled service's page size, its cap on results, the oldest second asked for
PAGE, CAP, OLDEST = 100, 999, 1_262_322_000
FORMAT = "repository_crawl"


def sample_fetch(since: int, until: int, page: int) -> tuple[int, list[dict]]:
    """A fetcher without a network: one repository for every 600 seconds."""
    first = -(-since // 600)
    last = -(-until // 600)
    rows = [{"name": f"repo{k}", "url": f"https://api.forge.com/repos/repo{k}", "language": S.LANGUAGES[k % 3], "owner_id": k % 97, "description": "", "created_at": str(600 * k), "updated_at": str(600 * k), "size": k % 1000, "build_system": S.BUILD_SYSTEMS[k % 5], "branch": "master"} for k in range(first, last)]
    return len(rows), rows[(page - 1) * PAGE : page * PAGE]


def fetched(fetch: Callable[[int, int, int], tuple[int, list[dict]]], since: int, until: int) -> Iterator[tuple]:
    """Rows of a window. One with more than the service gives is read in two halves, down to a second."""
    total, rows = fetch(since, until, 1)
    if total > CAP and until - since > 1:
        middle = (since + until) // 2
        yield from fetched(fetch, middle, until)
        yield from fetched(fetch, since, middle)
        return
    names, page = [f.name for f in S.CRAWLED.fields], 1
    while True:
        for row in rows:
            yield tuple(map(row.get, names))
        if page * PAGE >= total:
            return
        page += 1
        rows = fetch(since, until, page)[1]
        if not rows:
            raise ValueError(f"the service gives fewer than its {total} rows between {since} and {until}")


class Window(InputPartition):
    def __init__(self, since: int, until: int) -> None:
        self.since, self.until = since, until


class _Options:
    def __init__(self, options: dict) -> None:
        oldest = int(options.get("oldest", OLDEST))
        self.start = max(oldest, int(options.get("start", oldest)))
        self.end = options.get("end")
        self.frontier = options.get("frontier")
        self.interval = int(options.get("interval", 86400))
        self.fetcher = options.get("fetcher", f"{__name__}:sample_fetch")
        self.source = options.get("source")

    def fetch(self) -> Callable[[int, int, int], tuple[int, list[dict]]]:
        return self.of_source(self.fetcher) if self.source is not None else _imported(self.fetcher)

    def of_source(self, name: str) -> Callable | int:
        return _imported(name)(*([] if self.source is None else [self.source]))

    def windows(self, start: int, end: int) -> list[Window]:
        return [Window(max(start, until - self.interval), until) for until in range(end, start, -self.interval)]

    def newest(self) -> int:
        """The second up to which there is something to read: a fixed one, or what ``frontier`` (a ``module:function``, called with ``source`` if there is one) says now."""
        return int(self.end if self.frontier is None else self.of_source(self.frontier))


def _imported(name: str) -> Callable:
    module, function = name.split(":")
    return getattr(importlib.import_module(module), function)


class CrawlReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.options = _Options(options)

    def partitions(self) -> list[Window]:
        return self.options.windows(self.options.start, int(self.options.end))

    def read(self, partition: Window | None) -> Iterator[tuple]:
        """Rows of a window; without windows Spark asks for None."""
        return iter(()) if partition is None else fetched(self.options.fetch(), partition.since, partition.until)


class CrawlStream(DataSourceStreamReader):
    """A micro-batch is what lies between two offsets, in windows that executors fetch; nothing is kept on the driver.

    Offsets only grow: after a restart the query goes on at the checkpointed
    one, and a batch that was planned but not committed is planned again alike.
    """

    def __init__(self, options: dict) -> None:
        self.options = _Options(options)

    def initialOffset(self) -> dict:  # noqa: N802
        return {"until": self.options.start}

    def latestOffset(self) -> dict:  # noqa: N802
        return {"until": max(self.options.start, self.options.newest())}

    def partitions(self, start: dict, end: dict) -> list[Window]:
        return self.options.windows(start["until"], end["until"])

    def read(self, partition: Window) -> Iterator[tuple]:
        return fetched(self.options.fetch(), partition.since, partition.until)


class RepositoryCrawl(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        return S.CRAWLED

    def reader(self, schema: StructType) -> CrawlReader:
        return CrawlReader(self.options)

    def streamReader(self, schema: StructType) -> CrawlStream:  # noqa: N802
        return CrawlStream(self.options)


def _options(**chosen: object) -> dict:
    return {k: v for k, v in chosen.items() if v is not None}


def crawl(spark: SparkSession, start: int, end: int, interval: int = 86400, fetcher: str | None = None, source: str | None = None, oldest: int | None = None) -> DataFrame:
    """Rows of all windows from ``start``, or ``oldest`` if that is later; filter and project them like any table."""
    spark.dataSource.register(RepositoryCrawl)
    return spark.read.format(FORMAT).options(**_options(start=start, end=end, interval=interval, fetcher=fetcher, source=source, oldest=oldest)).load()


def crawl_stream(spark: SparkSession, start: int, end: int | None = None, frontier: str | None = None, interval: int = 86400, fetcher: str | None = None, source: str | None = None, oldest: int | None = None) -> DataFrame:
    """The crawl as a stream, up to ``end`` or as far as ``frontier`` says whenever a batch is planned."""
    if (end is None) == (frontier is None):
        raise ValueError("a crawl ends at a second or at a frontier")
    spark.dataSource.register(RepositoryCrawl)
    return spark.readStream.format(FORMAT).options(**_options(start=start, end=end, frontier=frontier, interval=interval, fetcher=fetcher, source=source, oldest=oldest)).load()
