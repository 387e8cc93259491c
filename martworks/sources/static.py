"""The static side of stream joins: deduplicated once per version, bucketed by its join key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martworks.session import work_partitions
from martworks.sources.state import WatermarkStore


class StaticSide:
    """A versioned snapshot of a slowly changing table.

    `refresh` reads the raw table, once per version, and writes it without
    repeated rows, bucketed and sorted by the join key. Micro-batches read the
    snapshot: a small one is broadcast if its files are below Spark's threshold,
    of a large one only the micro-batch is shuffled.
    """

    def __init__(self, spark: SparkSession, path: str, name: str, key: str, columns: list[str]):
        self.spark, self.path, self.name, self.key, self.columns = spark, path, name, key, columns
        self.state = WatermarkStore(spark, f"{path}/versions")

    def version(self) -> str | None:
        return self.state.get(self.name)

    def _table(self, version: str) -> str:
        return f"{self.name}_{version}"

    def refresh(self, raw: DataFrame, version: str, buckets: int | None = None) -> bool:
        """Takes a new version; False if it is the one that is there, whose raw table is then not read."""
        if self.version() == version:
            return False
        rows = raw.select(*self.columns).distinct()
        n = buckets or work_partitions(self.spark)
        rows.repartition(n, self.key).write.mode("overwrite").format("parquet").bucketBy(n, self.key).sortBy(self.key).option(
            "path", f"{self.path}/{self._table(version)}").saveAsTable(self._table(version))
        self.state.save(self.name, version)
        return True

    def read(self) -> DataFrame:
        """The current snapshot; by its path where this session does not know the table."""
        version = self.version()
        if version is None:
            raise ValueError(f"{self.name} has no version yet: refresh it first")
        table = self._table(version)
        if self.spark.catalog.tableExists(table):
            return self.spark.table(table)
        return self.spark.read.parquet(f"{self.path}/{table}")

    def join(self, stream: DataFrame) -> DataFrame:
        return stream.join(self.read(), self.key)
