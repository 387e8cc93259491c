"""Ordered scans over balanced ranges.

A window over a key puts all rows of the key in one task. Here the rows are laid
out in order of (keys, order), cut into ranges by count, and written. A window
runs inside a range; what a range needs from the ranges before it is one row per
range, whatever the keys and however the order column is spread: a single key
with all rows is scanned by all tasks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from martworks.session import reliable, work_partitions

# monotonically_increasing_id = partition number << 33 | row number in the partition
_ROW_BITS = 33


class Ranges:
    """Rows of a table in order of (keys, order); rows equal in both stay in one range.

    `rows` has the columns of the table, `_pos` (ascending in that order) and `_range`.
    """

    def __init__(self, df: DataFrame, keys: list[str], order: list[str]):
        self.keys, self.columns = keys, df.columns
        by = [F.col(c) for c in [*keys, *order]]
        # written, because range bounds are sampled: a recomputed range could be cut elsewhere
        laid = reliable(
            df.repartitionByRange(work_partitions(df.sparkSession), *by).sortWithinPartitions(*by)
            .withColumn("_pos", F.monotonically_increasing_id()))
        self.rows = laid.withColumn("_range", F.shiftright("_pos", _ROW_BITS).cast("int"))
        ends = self.rows.groupBy("_range").agg(F.min("_pos").alias("a"), F.max("_pos").alias("b")).collect()
        # one entry per range
        self.ends = sorted((r["_range"], r.a, r.b) for r in ends)

    def window(self) -> WindowSpec:
        return Window.partitionBy("_range", *self.keys).orderBy("_pos")

    def _same_key(self) -> Column:
        same = F.lit(True)
        for k in self.keys:
            same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
        return same

    def _at(self, wanted: list[tuple[int, int]], value: Column) -> DataFrame:
        """(_range, keys as `_k_…`, _value) of the rows at the given (range to tell, position)."""
        tell = self.rows.sparkSession.createDataFrame(wanted, "_to int, _pos long")
        found = self.rows.where(F.col("_pos").isin([pos for _, pos in wanted]))
        return found.join(F.broadcast(tell), "_pos").select(
            F.col("_to").alias("_range"), *[F.col(k).alias(f"_k_{k}") for k in self.keys], value.alias("_value"))

    def step(self, value: Column, forward: bool = False) -> DataFrame:
        """`rows` with `_step`: the value in the key's previous row (next with `forward`), as a struct `v`; null at the edge of a key."""
        packed = F.struct(value.alias("v"))
        inside = (F.lead if forward else F.lag)(packed).over(self.window())
        pairs = [(here[0], there[2]) for there, here in zip(self.ends, self.ends[1:])]
        if forward:
            pairs = [(here[0], there[1]) for here, there in zip(self.ends, self.ends[1:])]
        scanned = self.rows.withColumn("_in", inside)
        # one row per range
        told = scanned.join(F.broadcast(self._at(pairs, packed)), "_range", "left")
        return told.withColumn("_step", F.coalesce("_in", F.when(self._same_key(), F.col("_value")))).select(
            *self.columns, "_pos", "_range", "_step")

    def before(self, value: Column, how: Callable[[Column], Column]) -> DataFrame:
        """`rows` with `_before`: `how` of the value over the key's rows in the ranges before, null if there are none.

        Only keys that end a range can lie in several; at most two of them a
        range are summed up.
        """
        last = self._at([(r, b) for r, _, b in self.ends], F.lit(True)).select(*[f"_k_{k}" for k in self.keys]).distinct()
        parts = self.rows.withColumn("_v", value).join(F.broadcast(last), self._same_key()).groupBy(
            "_range", *[f"_k_{k}" for k in self.keys]).agg(how(F.col("_v")).alias("_part"))
        earlier = Window.partitionBy(*[f"_k_{k}" for k in self.keys]).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
        carry = parts.withColumn("_before", how(F.col("_part")).over(earlier)).withColumnRenamed("_range", "_r").drop("_part")
        same = self._same_key() & (F.col("_range") == F.col("_r"))
        return self.rows.join(F.broadcast(carry), same, "left").select(*self.columns, "_pos", "_range", "_before")
