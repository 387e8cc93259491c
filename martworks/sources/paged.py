"""Paged REST-like extracts as a Spark data source.

`fetch_page(offset, limit)` returns the rows of one page as dicts. Each Spark
partition pages through its own offset range until the range or the data ends, so
pages are read in parallel and nothing passes through the driver.
"""

from __future__ import annotations

import pickle
from base64 import b64decode, b64encode
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

try:
    from pyspark import cloudpickle
except ImportError:  # pragma: no cover
    cloudpickle = pickle


class _PageRange(InputPartition):
    def __init__(self, start: int, stop: int | None):
        self.start = start
        self.stop = stop


class _PagedReader(DataSourceReader):
    def __init__(self, options, fields):
        self.fetch = pickle.loads(b64decode(options["fetch"]))
        self.size = int(options["pagesize"])
        self.pages = int(options["pages"])
        self.ranges = int(options["ranges"])
        self.fields = fields

    def partitions(self):
        # the last range is open-ended: rows beyond the expected pages are still read
        step = max(1, -(-self.pages // self.ranges)) * self.size
        cuts = list(range(0, max(1, self.pages) * self.size, step))
        return [_PageRange(a, a + step if i + 1 < len(cuts) else None) for i, a in enumerate(cuts)]

    def read(self, partition):
        offset = partition.start
        while partition.stop is None or offset < partition.stop:
            rows = self.fetch(offset, self.size)
            if not rows:
                return
            for row in rows:
                yield tuple(row.get(f) for f in self.fields)
            offset += self.size


class PagedSource(DataSource):
    @classmethod
    def name(cls):
        return "paged"

    def schema(self):
        return self.options["schema_ddl"]

    def reader(self, schema: StructType):
        return _PagedReader(self.options, schema.fieldNames())


def read_paged(spark: SparkSession, fetch_page: Callable[[int, int], list[dict]], schema: str,
               pages: int, page_size: int = 50, ranges: int | None = None) -> DataFrame:
    """All pages of an extract; `pages` is the expected number, not a limit."""
    spark.dataSource.register(PagedSource)
    return (
        spark.read.format("paged").schema(schema)
        .option("schema_ddl", schema)
        .option("fetch", b64encode(cloudpickle.dumps(fetch_page)).decode())
        .option("pagesize", page_size).option("pages", pages)
        .option("ranges", ranges or spark.sparkContext.defaultParallelism)
        .load()
    )
