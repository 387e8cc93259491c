"""Tables that grow by batches: runs of rows in key buckets, and a manifest of the runs that count.

Every batch adds one run, a folder with a subfolder per bucket. A loader that
must compare with what is stored reads the buckets it touches, of the live runs
only. When a level holds `fan` runs they are merged into one run of the next
level, so the number of runs stays below fan x log(batches) and every row is
rewritten once per level. Run folders never change once they are listed:
readers that hold an older manifest go on with its runs.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from martworks.operators.joins import growing
from martworks.session import write_table

BUCKETS, FAN = 16, 8
_MANIFEST = "version long, buckets int, ledger string, run string, level int"


@dataclass(frozen=True)
class Manifest:
    """A version of a table: the live runs as (run, level), and per source the last batch that they hold."""

    version: int = 0
    ledger: dict[str, int] = field(default_factory=dict)
    runs: tuple[tuple[str, int], ...] = ()


class RunStore:
    """A table in key buckets. Each source of batches numbers its own in ascending order.

    keys: columns whose hash is the bucket. parts: columns that are folders above
    the buckets. merge: applied to the rows of several runs when they are read
    together or merged, for rows that replace each other or add up; it must give
    a key the same result whichever of its rows were merged before. By default
    rows are just kept.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str, keys: list[str], buckets: int = BUCKETS,
                 fan: int = FAN, merge: Callable[[DataFrame], DataFrame] | None = None, parts: tuple[str, ...] = ()):
        self.spark, self.path, self.keys, self.buckets, self.fan, self.merge, self.parts = spark, path, keys, buckets, fan, merge, parts
        self.schema = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
        self._stored = T.StructType([*self.schema.fields, T.StructField("bucket", T.IntegerType())])

    # ---- manifest: two slots written in turn, so one is whole whatever fails ------------

    def manifest(self) -> Manifest:
        try:
            rows = self.spark.read.schema(_MANIFEST).parquet(f"{self.path}/manifest/slot*").collect()
        except Exception as error:  # not written yet
            if "PATH_NOT_FOUND" not in str(error):
                raise
            rows = []
        last = max((r.version for r in rows), default=0)
        rows = [r for r in rows if r.version == last]
        if not rows:
            return Manifest()
        if rows[0].buckets != self.buckets:
            raise ValueError(f"{self.path} has {rows[0].buckets} buckets, not {self.buckets}")
        return Manifest(last, json.loads(rows[0].ledger), tuple(sorted((r.run, r.level) for r in rows if r.run is not None)))

    def _switch(self, new: Manifest) -> Manifest:
        ledger = json.dumps(new.ledger, sort_keys=True)
        rows = [(new.version, self.buckets, ledger, run, level) for run, level in new.runs or [(None, None)]]
        self.spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/manifest/slot{new.version % 2}")
        return new

    # ---- reading ------------------------------------------------------------------------

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def touched(self, df: DataFrame) -> list[int]:
        """The buckets in which the keys of `df` lie; at most `buckets` numbers."""
        return sorted(r.b for r in df.select(self.bucket().alias("b")).distinct().collect())

    def _rows(self, runs: Iterable[str]) -> DataFrame:
        # one scan per run: its folder is the base path, so only parts and bucket are partition columns
        scans = [self.spark.read.schema(self._stored).parquet(f"{self.path}/{run}") for run in runs]
        out = scans[0] if scans else self.spark.createDataFrame([], self._stored)
        for scan in scans[1:]:
            out = out.unionByName(scan)
        return out

    def read(self, buckets: list[int] | None = None, manifest: Manifest | None = None) -> DataFrame:
        """The rows of the table, or of some buckets; of an older version if its manifest is given."""
        live = manifest or self.manifest()
        rows = self._rows(run for run, _ in live.runs)
        if buckets is not None:
            rows = rows.where(F.col("bucket").isin(buckets))
        rows = rows.select(*self.schema.names)
        return self.merge(rows) if self.merge and len(live.runs) > 1 else rows

    def near(self, df: DataFrame) -> DataFrame:
        """The stored rows of the buckets that `df` touches; they grow with the table, so a join never broadcasts them."""
        live = self.manifest()
        return growing(self.read(self.touched(df) if live.runs else [], live))

    # ---- writing ------------------------------------------------------------------------

    def holds(self, batch_id: int, source: str = "stream") -> bool:
        """Whether the table has this batch: given again, it adds nothing."""
        return batch_id <= self.manifest().ledger.get(source, -1)

    def _write(self, rows: DataFrame, run: str) -> None:
        split = [*self.parts, "bucket"]
        # a large bucket is cut into several tasks, so none sorts more than fits
        dealt = rows.select(*self.schema.names).withColumn("bucket", self.bucket()).hint("rebalance", *[F.col(c) for c in split])
        write_table(dealt.sortWithinPartitions(*split, *self.keys), f"{self.path}/{run}", *split)

    def append(self, rows: DataFrame, batch_id: int, source: str = "stream") -> bool:
        """Adds the rows of a batch; False if the table has it.

        The manifest is the fence: a run that was written but not listed, as the
        job failed in between, is written anew when the batch comes again.
        """
        now = self.manifest()
        if batch_id <= now.ledger.get(source, -1):
            return False
        run = f"run-{source}-{batch_id}"
        self._write(rows, run)
        now = self._switch(Manifest(now.version + 1, {**now.ledger, source: batch_id}, (*now.runs, (run, 0))))
        while True:
            levels: dict[int, list[str]] = {}
            for name, level in now.runs:
                levels.setdefault(level, []).append(name)
            full = [level for level, runs in levels.items() if len(runs) >= self.fan]
            if not full:
                return True
            now = self._merge(now, levels[min(full)], min(full) + 1)

    def _merge(self, now: Manifest, runs: list[str], level: int) -> Manifest:
        rows = self._rows(runs).select(*self.schema.names)
        merged = f"merged-{now.version + 1}"
        self._write(self.merge(rows) if self.merge else rows, merged)
        rest = tuple(r for r in now.runs if r[0] not in runs)
        return self._switch(Manifest(now.version + 1, now.ledger, (*rest, (merged, level))))

    def compact(self) -> None:
        """Merges all runs into one."""
        now = self.manifest()
        if len(now.runs) > 1:
            self._merge(now, [run for run, _ in now.runs], max(level for _, level in now.runs) + 1)
