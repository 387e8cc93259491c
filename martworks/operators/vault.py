"""Data-vault loads: hubs, links and change-only satellites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from martworks.functions.keys import hash_key, hashdiff
from martworks.operators.filters import with_load_meta
from martworks.operators.grouping import dedupe, latest_per_key
from martworks.operators.joins import growing, with_keys


def load_hub(src: DataFrame, pk: str, business_key: str, existing: DataFrame | None, source: str, load_dt: str,
             extra: list[str] = (), key: Column | None = None, order: list[str] | None = None) -> DataFrame:
    """New hub rows: one per business key the hub does not have yet.

    Business keys are made unique before they are hashed and anti-joined, so
    the shuffle carries one short row per key and map task, however often a key
    occurs in the batch, and each key is hashed once.
    """
    rows = dedupe(with_keys(src.select(business_key, *extra), business_key), [business_key], order or (list(extra) or None))
    rows = rows.withColumn(pk, key if key is not None else hash_key(F.col(business_key))).select(pk, business_key, *extra)
    return with_load_meta(_new_only(rows, existing, pk), source, load_dt)


def load_link(src: DataFrame, pk: str, members: dict[str, Column] | list[str], existing: DataFrame | None, source: str,
              load_dt: str, key: Column | None = None) -> DataFrame:
    """New link rows between hub keys; the link key hashes all member keys.

    `members` names hub-key columns of `src`, or gives for each one the expression
    over business keys. In the second form `src` holds just those business keys:
    they are made unique first and hashed after.
    """
    names = list(members)
    key = key if key is not None else hash_key(*[F.col(m) for m in names])
    if isinstance(members, dict):
        # the hub keys are made again after the comparison, which moves the short business keys in their place
        rows = _new_only(with_keys(src, *src.columns).distinct().withColumns(members).withColumn(pk, key).select(pk, *src.columns), existing, pk)
        return with_load_meta(rows.select(pk, *[c.alias(m) for m, c in members.items()]), source, load_dt)
    rows = with_keys(src.select(*members), *members).dropDuplicates(members).withColumn(pk, key).select(pk, *names)
    return with_load_meta(_new_only(rows, existing, pk), source, load_dt)


def _new_only(rows: DataFrame, existing: DataFrame | None, pk: str) -> DataFrame:
    """Rows whose key is not stored.

    A key hashes values that are there, so it is not tested for null: the filter would hash it
    again for every source row. A left join, because Spark moves an anti-join below the step that
    makes the keys unique, and then sorts all source rows by keys that each comparison hashes anew.
    """
    if existing is None:
        return rows
    stored = growing(existing.select(pk, F.lit(True).alias("_stored")))
    return rows.join(stored, pk, "left").where("_stored is null").drop("_stored")


def load_satellite(src: DataFrame, key: str, attrs: list[str], existing: DataFrame | None, source: str, load_dt: str,
                   order: list[str] | None = None, diff: str = "hashdiff",
                   business_key: tuple[str, Column] | None = None) -> DataFrame:
    """Satellite rows whose attributes differ from the latest stored ones.

    The hashdiff covers key and attributes only, so loading the same data again
    adds nothing. Of several rows per key in a batch the last one by `order`
    counts, since they share one load time. With `business_key` (a column and the
    expression of the hub key) rows are grouped by it and hashed after.
    """
    by = business_key[0] if business_key else key
    wanted = list(dict.fromkeys([by, *attrs, *(order or [])]))
    rows = latest_per_key(with_keys(src.select(*wanted), by), [by], order or attrs)
    hub_key = business_key[1] if business_key else F.col(key)
    rows = rows.select(hub_key.alias(key), *attrs)
    rows = rows.withColumn(diff, hashdiff(F.col(key), *[F.col(a) for a in attrs]))
    if existing is not None:
        current = existing.groupBy(key).agg(F.max_by(diff, "load_dt").alias("_known"))
        rows = rows.join(growing(current), key, "left").where(~F.col(diff).eqNullSafe(F.col("_known"))).drop("_known")
    return with_load_meta(rows, source, load_dt)


def version_rows(src: DataFrame, key: str, attrs: list[str], source: str, at: str, diff: str = "hashdiff",
                 business_key: tuple[str, Column] | None = None) -> DataFrame:
    """Every version of a satellite that a message tells of, with the time in column `at` as its load time.

    Which of them are changes is for the history to say, which knows the others
    of the key (`HistoryStore`). An unreadable time is null and comes first.
    """
    by = business_key[0] if business_key else key
    hub_key = business_key[1] if business_key else F.col(key)
    when = F.try_to_timestamp(F.col(at).cast("string")).cast("timestamp_ntz").alias("load_dt")
    rows = with_keys(src.select(by, *attrs, when), by).distinct().select(hub_key.alias(key), *attrs, "load_dt")
    return rows.withColumn(diff, hashdiff(F.col(key), *[F.col(a) for a in attrs])).select(
        key, *attrs, diff, "load_dt", F.lit(source).alias("load_src"))


def current_satellite(sat: DataFrame, key: str) -> DataFrame:
    """The latest version per key."""
    return latest_per_key(sat, [key], ["load_dt"])
