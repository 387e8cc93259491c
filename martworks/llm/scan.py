"""Running sums over sorted groups, whatever the size of a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from martworks.llm.common import staged
from martworks.session import work_partitions

# monotonically_increasing_id = partition number << 33 | row number in the partition
_ROW_BITS = 33


def running(df: DataFrame, group: str, order: list[str | Column], sums: dict[str, Column]) -> DataFrame:
    """Adds per name in `sums` the sum of that column over the rows of the group up to and with this one.

    Rows are range-partitioned and sorted by (group, order) and written, so a
    hot group is cut like any other range. Sums run inside one range; a group
    that lies in several ranges gets the sum of the ranges before, from one
    row per range and cut group. Groups must not be null; ties in the order are
    kept as the written layout has them.
    """
    keys = [F.col(group), *order]
    named = df.select("*", *[value.alias(f"_v_{name}") for name, value in sums.items()])
    laid = staged(
        named.repartitionByRange(work_partitions(df.sparkSession), *keys).sortWithinPartitions(*keys)
        .withColumn("_pos", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_pos", _ROW_BITS).cast("int")))
    here = Window.partitionBy("_part", group).orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    # a group lies in several ranges only if it ends one and begins the next
    by_range = laid.groupBy(group, "_part").agg(*[F.sum(f"_v_{name}").alias(f"_s_{name}") for name in sums])
    cut = by_range.groupBy(group).agg(F.count("*").alias("_n")).where("_n > 1").select(group)
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carry = by_range.join(cut, group).select(
        group, "_part", *[F.sum(f"_s_{name}").over(before).alias(f"_c_{name}") for name in sums])
    # at most two cut groups a range: as many rows as twice the partitions
    out = laid.join(F.broadcast(carry), [group, "_part"], "left")
    for name in sums:
        kind = laid.schema[f"_v_{name}"].dataType
        out = out.withColumn(name, (
            F.sum(f"_v_{name}").over(here) + F.coalesce(f"_c_{name}", F.lit(0))).cast(
                "decimal(38,0)" if kind.typeName() == "decimal" else kind))
    return out.select(*df.columns, *sums)
