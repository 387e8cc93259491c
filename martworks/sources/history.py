"""Histories that do not depend on the order in which their versions arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from martworks.operators.ranges import Ranges
from martworks.session import reliable, staging
from martworks.sources.runs import BUCKETS, FAN, RunStore


class HistoryStore:
    """Every version that any message told of, and whether it is a change.

    A version is (keys, attributes, diff, load_dt, load_src); it is a change if
    its diff differs from the key's version before it by (load_dt, diff). A late
    version is put in its place and compared with both neighbours: it gets a flag of its
    own, and its successor a new one. Stored rows are never rewritten for that: of
    several rows of one version the one of the latest load counts.
    So any deal of the versions to batches, in any order, gives the same table.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], attrs: str, diff: str = "hashdiff",
                 buckets: int = BUCKETS, fan: int = FAN, parts: tuple[str, ...] = ()):
        self.keys, self.diff = keys, diff
        own = T.StructType.fromDDL(attrs)
        self.version = [*[f.name for f in own], diff, "load_dt", "load_src"]
        schema = T.StructType([*own.fields, *T.StructType.fromDDL(
            f"{diff} string, load_dt timestamp_ntz, load_src string, changed boolean, seq long").fields])
        self.store = RunStore(spark, path, schema, keys, buckets, fan, self._latest, parts)

    def _latest(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.version).agg(F.max_by("changed", "seq").alias("changed"), F.max("seq").alias("seq")).select(
            *self.store.schema.names)

    def marked(self, versions: DataFrame) -> DataFrame:
        """The versions with `now`: whether each differs from its predecessor. All versions of a key must be there."""
        stepped = Ranges(versions, self.keys, ["load_dt", self.diff]).step(F.col(self.diff))
        return stepped.withColumn("now", F.col("_step").isNull() | ~F.col("_step.v").eqNullSafe(F.col(self.diff))).select(
            *versions.columns, "now")

    def load(self, versions: DataFrame, batch_id: int, source: str = "stream", unique: bool = False) -> bool:
        """Adds versions (repeated ones count once); False if the batch is there already.

        `unique`: no version is repeated within the batch, which spares a shuffle.
        """
        if self.store.holds(batch_id, source):
            return False
        with staging(self.store.spark):
            told_of = versions.select(*self.version)
            return self._load(told_of if unique else told_of.distinct(), batch_id, source)

    def _load(self, told_of: DataFrame, batch_id: int, source: str) -> bool:
        # versions that are stored change no mark: only new ones are written, and only their keys are read and marked
        if self.store.manifest().runs:
            told_of = reliable(told_of)
            stored = [F.col(f"n.{c}").eqNullSafe(F.col(f"s.{c}")) for c in self.version]
            fresh = reliable(told_of.alias("n").join(self.store.near(told_of).alias("s"), stored, "left_anti"))
            keys = fresh.select(*self.keys).distinct()
            same = [F.col(f"s.{k}").eqNullSafe(F.col(f"n.{k}")) for k in self.keys]
            known = self.store.near(fresh).alias("s").join(keys.alias("n"), same, "left_semi")
            # a version is stored or new, never both
            both = known.select(*self.version, F.col("changed").alias("was")).unionByName(
                fresh.withColumn("was", F.lit(None).cast("boolean")))
        else:
            both = told_of.withColumn("was", F.lit(None).cast("boolean"))
        told = self.marked(both)
        seq = self.store.manifest().version + 1
        return self.store.append(told.where(~F.col("was").eqNullSafe(F.col("now"))).select(
            *self.version, F.col("now").alias("changed"), F.lit(seq).cast("long").alias("seq")), batch_id, source)

    def versions(self) -> DataFrame:
        """All versions, with `changed`."""
        return self.store.read().select(*self.version, "changed")

    def changes(self) -> DataFrame:
        """The satellite: the versions that differ from the one before them."""
        return self.store.read().where("changed").select(*self.version)
