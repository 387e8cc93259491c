"""Predicates on validity, days and status, and load metadata."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

OPEN_END = "2099-12-31 00:00:00"


def open_end() -> Column:
    return F.lit(OPEN_END).cast("timestamp_ntz")


def active_at(df: DataFrame, start: str, end: str, now: Column) -> DataFrame:
    """Rows whose validity strictly contains `now`."""
    return df.where((F.col(start) < now) & (F.col(end) > now))


def is_current(df: DataFrame, as_of: Column, active_to: str = "active_to") -> DataFrame:
    return df.where(F.col(active_to) >= as_of)


def on_day(df: DataFrame, ts: str, day: str) -> DataFrame:
    """One business date as a half-open range, so the scan can skip files."""
    start = dt.date.fromisoformat(day)
    stop = start + dt.timedelta(days=1)
    kind = df.schema[ts].dataType
    return df.where((F.col(ts) >= F.lit(start.isoformat()).cast(kind)) & (F.col(ts) < F.lit(stop.isoformat()).cast(kind)))


def with_load_meta(df: DataFrame, source: str, load_dt: str) -> DataFrame:
    """Load time and source; the time is an argument, so a run can be repeated."""
    return df.withColumns({"load_dt": F.lit(load_dt).cast("timestamp_ntz"), "load_src": F.lit(source)})


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
