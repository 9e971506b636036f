"""A counted source read by date ranges: a range is split until its count fits one page."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Fixed value: most ids that one page of the service gives.
PAGE = 9_999


def split_ranges(first: dt.date, last: dt.date, count: Callable[[dt.date, dt.date], int], page: int = PAGE) -> list[tuple[dt.date, dt.date]]:
    """Years, then months, then days, until each range has at most ``page`` records; empty ranges drop out, full days stay whole."""
    def parts(a: dt.date, b: dt.date) -> list[tuple[dt.date, dt.date]]:
        if a.year != b.year:
            return [(max(a, dt.date(y, 1, 1)), min(b, dt.date(y, 12, 31))) for y in range(a.year, b.year + 1)]
        if a.month != b.month:
            return [(max(a, dt.date(a.year, m, 1)), min(b, dt.date(a.year + m // 12, m % 12 + 1, 1) - dt.timedelta(1))) for m in range(a.month, b.month + 1)]
        return [(a + dt.timedelta(i),) * 2 for i in range((b - a).days + 1)]

    out, todo = [], [(first, last)]
    while todo:
        a, b = todo.pop()
        n = count(a, b)
        if n <= 0:
            continue
        if n <= page or a == b:
            out.append((a, b))
        else:
            todo += reversed(parts(a, b))
    return out


class _Range(InputPartition):
    def __init__(self, first: dt.date, last: dt.date):
        self.first, self.last = first, last


class _Reader(DataSourceReader):
    def __init__(self, count, fetch, first, last, page):
        self.count, self.fetch, self.first, self.last, self.page = count, fetch, first, last, page

    def partitions(self):
        return [_Range(a, b) for a, b in split_ranges(self.first, self.last, self.count, self.page)]

    def read(self, partition) -> Iterator[tuple]:
        for record in self.fetch(partition.first, partition.last):
            yield (str(record),)


def read_ranges(spark: SparkSession, count: Callable, fetch: Callable, first: dt.date, last: dt.date, page: int = PAGE) -> DataFrame:
    """Distinct ids of a counted source; each range is one task. ``count`` and ``fetch`` are what talks to the service."""
    class Counted(DataSource):
        @classmethod
        def name(cls):
            return "counted_ranges"

        def schema(self):
            return "id string"

        def reader(self, schema):
            return _Reader(count, fetch, first, last, page)

    spark.dataSource.register(Counted)
    return spark.read.format("counted_ranges").load().dropDuplicates(["id"])


def fetched(todo: DataFrame, cache: DataFrame, key: str, batch: int, lookup: Callable[[list[str]], list[tuple]], schema: str) -> DataFrame:
    """Rows of a batched lookup for keys that the cache lacks; ``lookup`` gets up to ``batch`` keys and returns rows of ``schema``."""
    import pandas as pd

    missing = todo.select(key).where(f"{key} is not null").distinct().join(cache.select(key), key, "left_anti")

    def run(batches):
        for b in batches:
            keys = b[key].tolist()
            for i in range(0, len(keys), batch):
                yield pd.DataFrame(lookup(keys[i : i + batch]), columns=[f.split()[0] for f in schema.split(", ")])

    return missing.mapInPandas(run, schema)
