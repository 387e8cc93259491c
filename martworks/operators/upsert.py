"""Merging a batch into a table, as pure transforms of both."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from martworks.operators.grouping import dedupe, latest_per_key
from martworks.operators.joins import rows_absent, with_keys


def upsert(target: DataFrame, source: DataFrame, keys: list[str], update_cols: list[str],
           order: list[str] | None = None) -> DataFrame:
    """Insert new keys, update the listed columns of known keys.

    The source is cut to one row per key first, the latest by `order` or else by
    all its other columns, so the join meets each key once on both sides and reruns
    take the same row. Rows with a null key are rejected.
    """
    batch = with_keys(source, *keys)
    rest = order or [c for c in batch.columns if c not in keys]
    batch = latest_per_key(batch, keys, rest) if rest else batch.dropDuplicates(keys)
    old = target.select(*keys, F.struct(*[c for c in target.columns if c not in keys]).alias("_old"))
    new = batch.select(*keys, F.struct(*[c for c in target.columns if c not in keys]).alias("_new"))
    merged = old.join(new, keys, "full")

    def value(c: str) -> Column:
        first, second = ("_new", "_old") if c in update_cols else ("_old", "_new")
        kind = target.schema[c].dataType
        return F.when(F.col(first).isNotNull(), F.col(f"{first}.{c}").cast(kind)).otherwise(
            F.col(f"{second}.{c}").cast(kind)).alias(c)

    return merged.select(*[F.col(c) if c in keys else value(c) for c in target.columns])


def insert_ignore(target: DataFrame, source: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """The rows to append: one per key that the target lacks."""
    return rows_absent(dedupe(with_keys(source, *keys), keys, order), target, *keys)


def insert_new(target: DataFrame, source: DataFrame, key: str, order: list[str] | None = None) -> DataFrame:
    """Rows to append for keys absent from the target (null keys rejected)."""
    return insert_ignore(target, source, [key], order)


def appended(target: DataFrame, new_rows: DataFrame) -> DataFrame:
    return target.unionByName(new_rows.select(*target.columns))


def upsert_counter(state: DataFrame, batch: DataFrame, keys: list[str], counter: str, labels: list[str] = ()) -> DataFrame:
    """Replace counters by the absolute values of the batch.

    Absolute counts make a repeated batch harmless, unlike adding one per row.
    """
    return upsert(state, batch, keys, [counter, *labels])
