"""Dimensions: surrogate ids, time, validity intervals, evolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from martworks.functions.text import parse_json
from martworks.functions.time import date_parts, to_second
from martworks.operators.filters import open_end
from martworks.operators.joins import rows_absent, with_keys
from martworks.operators.ranking import dense_ids
from martworks.operators.sequences import neighbour


def assign_ids(df: DataFrame, order: list[str], name: str = "id", start: int = 1) -> DataFrame:
    return dense_ids(df, order, name, start).select(name, *df.columns)


def load_dim(docs: DataFrame, schema: T.StructType | str, fields: dict[str, str], key: str,
             existing: DataFrame | None = None, order: list[str] = ("update_ts",)) -> DataFrame:
    """Dimension rows from stored JSON documents, one per key, latest document.

    `fields` maps an output column to a path in the document. With `existing`
    only unknown keys come back, to be appended.
    """
    from martworks.operators.grouping import latest_per_key

    parsed = docs.withColumn("_doc", parse_json(F.col("object_value"), schema))
    rows = parsed.select(*[F.col(f"_doc.{path}").alias(name) for name, path in fields.items()], "update_ts",
                         *[c for c in order if c != "update_ts"])
    rows = latest_per_key(with_keys(rows, key), [key], list(order))
    return rows_absent(rows, existing, key) if existing is not None else rows


def extend_dim(existing: DataFrame, rows: DataFrame, key: str, order: list[str], name: str = "id") -> DataFrame:
    """Rows to append for keys the dimension lacks, numbered after its largest id.

    Stored rows keep their ids, so facts that point at them stay right. One
    number reaches the driver. Of several rows per key the earliest by `order`
    counts; rows with a null key are left out. `order` should be unique.
    """
    from martworks.operators.upsert import insert_new

    last = existing.agg(F.max(name)).first()[0]
    return assign_ids(insert_new(existing, rows, key, order), [key], name, (last or 0) + 1)


def time_dimension(df: DataFrame, ts: str, start: int = 1) -> DataFrame:
    """One row per distinct second, with its date parts and a dense id."""
    seconds = df.where(F.col(ts).isNotNull()).select(to_second(F.col(ts)).alias("ts")).distinct()
    parts = seconds.select("ts", *[c.alias(n) for n, c in date_parts(F.col("ts")).items()])
    return assign_ids(parts, ["ts"], start=start)


def close_missing(dim: DataFrame, source: DataFrame, key: str, now: Column) -> DataFrame:
    """Ends the validity of open rows whose key left the source."""
    seen = source.select(key).dropDuplicates([key]).withColumn("_seen", F.lit(True))
    gone = F.col("_seen").isNull() & (F.col("active_to") >= open_end())
    return (
        dim.join(seen, key, "left")
        .withColumn("active_to", F.when(gone, now).otherwise(F.col("active_to")))
        .select(*dim.columns)
    )


def upsert_validity(dim: DataFrame, source: DataFrame, key: str, attrs: list[str]) -> DataFrame:
    """Type 1: attributes follow the source, the first active_from is kept."""
    from martworks.operators.upsert import upsert

    return upsert(dim, source, [key], attrs, ["active_from"])


def scd_validity(history: DataFrame, keys: list[str], ts: str, tie: list[str]) -> DataFrame:
    """Type 2: each version is valid until the key's next one, the last is open."""
    seen = neighbour(history, keys, ts, tie, ts, "_next", forward=True)
    return seen.select(
        *history.columns, F.col(ts).alias("active_from"),
        F.coalesce(F.col("_next").cast("timestamp_ntz"), open_end()).alias("active_to"))


def evolve(df: DataFrame, schema: T.StructType, defaults: dict[str, object]) -> DataFrame:
    """Old rows in a new schema: missing columns and nulls take the defaults."""
    out = []
    for field in schema:
        base = F.col(field.name) if field.name in df.columns else F.lit(None)
        value = base.cast(field.dataType)
        if field.name in defaults:
            value = F.coalesce(value, F.lit(defaults[field.name]).cast(field.dataType))
        out.append(value.alias(field.name))
    return df.select(*out)


def union_evolved(old: DataFrame, new: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Old and new rows together, columns added later filled with defaults."""
    both = old.unionByName(new, allowMissingColumns=True)
    return both.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})
