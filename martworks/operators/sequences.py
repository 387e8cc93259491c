"""Ordered windows per key that a hot key does not gather in one task (see `ranges`)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from martworks.operators.grouping import ordered_list
from martworks.operators.ranges import Ranges

# rows of one piece of a joined text
_PIECE = 1000


def neighbour(df: DataFrame, keys: list[str], ts: str, tie: list[str], value: str, name: str, forward: bool = False) -> DataFrame:
    """`lag(value)` per key by (ts, tie), or `lead` when `forward`.

    A key's first (last) row gets null. Also adds `<name>_exists`, which tells
    a missing neighbour from a null value.
    """
    stepped = Ranges(df, keys, [ts, *tie]).step(F.col(value), forward)
    return stepped.select(*df.columns, F.col("_step")["v"].alias(name), F.col("_step").isNotNull().alias(f"{name}_exists"))


def changes(df: DataFrame, keys: list[str], ts: str, tie: list[str], value: str) -> DataFrame:
    """Rows whose value differs from the key's previous row (null-safe)."""
    seen = neighbour(df, keys, ts, tie, value, "_prev")
    return seen.where(~F.col("_prev_exists") | ~F.col(value).eqNullSafe(F.col("_prev"))).select(*df.columns)


def _total(a: Column, b: Column) -> Column:
    return F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))


def running_max(df: DataFrame, keys: list[str], ts: str, value: str, name: str) -> DataFrame:
    """Running maximum per key by time; rows of equal time share one value (they lie in one range)."""
    laid = Ranges(df, keys, [ts])
    inside = Window.partitionBy("_range", *keys).orderBy(ts).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    carried = laid.before(F.col(value), F.max)
    return carried.select(*df.columns, F.greatest(F.max(value).over(inside), "_before").alias(name))


def running_sum(df: DataFrame, keys: list[str], order: list[str], value: Column, name: str) -> DataFrame:
    """Sum of the value over the key's rows up to and with this one."""
    laid = Ranges(df, keys, order)
    inside = F.sum(value).over(laid.window().rowsBetween(Window.unboundedPreceding, 0))
    return laid.before(value, F.sum).select(*df.columns, _total(inside, F.col("_before")).alias(name))


def numbered(df: DataFrame, keys: list[str], order: list[str], name: str = "no") -> DataFrame:
    """`row_number` per key in the given order, from 1."""
    return running_sum(df, keys, order, F.lit(1).cast("long"), name)


def ordered_runs(df: DataFrame, keys: list[str], ts: str, tie: list[str], value: str, name: str, sep: str = ", ") -> DataFrame:
    """Per key the values in order as one text; made of pieces of bounded length, which only the last step joins."""
    rows = numbered(df, keys, [ts, *tie], "_no")
    parts = rows.groupBy(*keys, F.floor((F.col("_no") - 1) / _PIECE).alias("_piece")).agg(
        ordered_list(value, ["_no"], sep).alias("_part"), F.count("*").alias("_n"))
    return parts.groupBy(*keys).agg(F.sum("_n").alias(f"{name}_count"), ordered_list("_part", ["_piece"], sep).alias(name))
