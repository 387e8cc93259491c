"""Incremental extracts behind a watermark, and the copies built on them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from martworks.functions.text import canonical_json
from martworks.operators.grouping import latest_per_key
from martworks.operators.ranking import batch
from martworks.sources.runs import RunStore
from martworks.sources.state import WatermarkStore


def incremental_by_id(df: DataFrame, id_col: str, last=None, limit: int | None = None) -> DataFrame:
    """Rows with a larger id; all that have an id without `last`; with `limit` the next ones in id order."""
    later = F.col(id_col).isNotNull() if last is None else F.col(id_col) > F.lit(last)
    return batch(df.where(later), [id_col], limit)


def without_cursor(df: DataFrame, col: str) -> DataFrame:
    """Rows that no incremental scan reads: their cursor column is null."""
    return df.where(F.col(col).isNull())


def incremental_by_ts(df: DataFrame, ts_col: str, last, id_col: str | None = None, last_id=None,
                      limit: int | None = None) -> DataFrame:
    """Rows updated later than the watermark; all that have a time without one.

    With an id the cursor is (time, id), so a batch that ends between rows of
    equal time loses none of them.
    """
    if last is None:
        return batch(df.where(F.col(ts_col).isNotNull()), [ts_col, *([id_col] if id_col else [])], limit)
    kind = df.schema[ts_col].dataType
    mark = F.lit(str(last)).cast(kind)
    later = F.col(ts_col) > mark
    order = [ts_col]
    if id_col:
        order.append(id_col)
        if last_id is not None:
            later = (F.col(ts_col) >= mark) & (later | (F.col(id_col) > F.lit(last_id)))
    return batch(df.where(later), order, limit)


def copy_by_id(source: DataFrame, id_col: str, state: WatermarkStore, key: str,
               write: Callable[[DataFrame], None], limit: int | None = None, first=None) -> int | None:
    """Copy the rows after the saved id, then move the watermark to the last id read.

    The first run starts after `first`, or with the smallest id there is.

    The written rows are bounded by that id, so a recomputed partition cannot bring
    in rows that arrived meanwhile.
    """
    rows = incremental_by_id(source, id_col, state.get(key, first), limit).persist()
    try:
        last = rows.agg(F.max(id_col)).first()[0]
        if last is not None:
            write(rows.where(F.col(id_col) <= F.lit(last)))
            state.save(key, last)
        return last
    finally:
        rows.unpersist()


def as_documents(df: DataFrame, id_col: str, ts_col: str) -> DataFrame:
    """Rows as (object_id, object_value, update_ts) with canonical JSON text."""
    return df.select(
        F.col(id_col).cast("string").alias("object_id"),
        canonical_json({c: F.col(c) for c in df.columns}).alias("object_value"),
        F.col(ts_col).alias("update_ts"))


def copy_documents(source: DataFrame, id_col: str, ts_col: str, state: WatermarkStore, key: str,
                   write: Callable[[DataFrame], None], limit: int | None = None, first=None) -> dt.datetime | None:
    """Copy documents changed after the watermark; `write` upserts by object_id.

    The cursor is (time, id): both are saved. The first run starts after the
    time `first`, or with the oldest document.
    """
    saved = state.get(key, {"ts": first, "id": None})
    rows = incremental_by_ts(source, ts_col, saved["ts"], id_col, saved["id"], limit).persist()
    try:
        last = rows.agg(F.max(F.struct(F.col(ts_col).cast("string").alias("ts"), F.col(id_col).alias("id"))).alias("m")).first().m
        if last is not None:
            mark = F.lit(last.ts).cast(source.schema[ts_col].dataType)
            seen = (F.col(ts_col) < mark) | ((F.col(ts_col) == mark) & (F.col(id_col) <= F.lit(last.id)))
            write(as_documents(rows.where(seen), id_col, ts_col))
            state.save(key, {"ts": last.ts, "id": last.id})
        return last
    finally:
        rows.unpersist()


def _latest_document(rows: DataFrame) -> DataFrame:
    return latest_per_key(rows, ["object_id"], ["update_ts", "object_value"])


def document_store(spark: SparkSession, path: str, ts_type: str = "timestamp_ntz") -> RunStore:
    """Copied documents: the latest version of every object_id, in buckets."""
    return RunStore(spark, path, f"object_id string, object_value string, update_ts {ts_type}", ["object_id"], merge=_latest_document)


def upsert_documents(store: RunStore) -> Callable[[DataFrame], None]:
    """A `write` for `copy_documents`: inserts new documents and replaces older versions.

    A run repeated after a failure brings the same versions again, which changes nothing.
    """
    def write(df: DataFrame) -> None:
        store.append(_latest_document(df), store.manifest().ledger.get("copy", -1) + 1, "copy")
    return write
