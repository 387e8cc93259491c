"""Checks in place of database constraints: each returns rows or counts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from martworks.operators.filters import union_all
from martworks.operators.joins import orphans


def uniqueness_report(sets: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows against distinct keys, per data set."""
    return union_all([
        df.agg(F.count("*").alias("total"), F.countDistinct(key).alias("uniq")).select(
            F.lit(name).alias("dataset"), "total", "uniq")
        for name, (df, key) in sets.items()
    ])


def hash_collisions(df: DataFrame, key: str, hashed: Column) -> DataFrame:
    """Distinct keys against distinct hashes; equal numbers mean no collision."""
    return df.select(F.col(key), hashed.alias("_hash")).distinct().agg(
        F.countDistinct(key).alias("keys"), F.countDistinct("_hash").alias("hashes"))


def date_range_report(sets: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Earliest and latest value of each set, as labelled rows."""
    frames = []
    for name, (df, c) in sets.items():
        ends = df.agg(F.min(c).alias("lo"), F.max(c).alias("hi"))
        frames.append(ends.select(F.inline(F.array(
            F.struct(F.lit(name).alias("dataset"), F.lit("earliest").alias("info"), F.col("lo").cast("timestamp_ntz").alias("at")),
            F.struct(F.lit(name).alias("dataset"), F.lit("latest").alias("info"), F.col("hi").cast("timestamp_ntz").alias("at"))))))
    return union_all(frames)


def no_future_dates(sets: dict[str, tuple[DataFrame, str]], now: Column) -> DataFrame:
    """Per set, whether its latest date lies before `now`."""
    return union_all([
        df.agg((F.max(c) < now).alias("ok")).select(F.lit(name).alias("dataset"), "ok")
        for name, (df, c) in sets.items()
    ])


def orphan_report(checks: list[tuple[DataFrame, str, DataFrame, str, str]]) -> DataFrame:
    """Count of rows with a dangling foreign key, per labelled check."""
    return union_all([
        orphans(child, parent, fk, pk).agg(F.count("*").alias("cnt")).select(F.lit(label).alias("info"), "cnt")
        for child, fk, parent, pk, label in checks
    ])


def matched_count(child: DataFrame, fk: str, parent: DataFrame, pk: str, label: str) -> DataFrame:
    """How many child rows do find their parent."""
    hit = child.join(parent.select(F.col(pk).alias(fk)), fk, "left_semi")
    return hit.agg(F.count("*").alias("cnt")).select(F.lit(label).alias("info"), "cnt")


@dataclass(frozen=True)
class Rule:
    """A named condition each row must meet; null counts as a violation."""

    name: str
    ok: Column


def not_null(c: str) -> Rule:
    return Rule(f"{c}_not_null", F.col(c).isNotNull())


def in_range(c: str, low=None, high=None) -> Rule:
    ok = F.lit(True)
    if low is not None:
        ok = ok & (F.col(c) >= F.lit(low))
    if high is not None:
        ok = ok & (F.col(c) <= F.lit(high))
    return Rule(f"{c}_range", ok)


def max_length(c: str, n: int) -> Rule:
    return Rule(f"{c}_length", F.col(c).isNull() | (F.length(c) <= n))


def expect(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """(rows that meet all rules, other rows with the names of broken rules)."""
    broken = F.filter(
        F.array(*[F.when(~F.coalesce(r.ok, F.lit(False)), F.lit(r.name)) for r in rules]), lambda x: x.isNotNull())
    marked = df.withColumn("violations", broken)
    good = marked.where(F.size("violations") == 0).drop("violations")
    return good, marked.where(F.size("violations") > 0)


def violation_counts(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Violations per rule in one pass over the data."""
    sums = df.agg(*[F.count_if(~F.coalesce(r.ok, F.lit(False))).alias(r.name) for r in rules])
    return sums.select(F.inline(F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.col(r.name).alias("cnt")) for r in rules])))


def describe_table(df: DataFrame) -> DataFrame:
    """Column, type and nullability of a table."""
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema]
    return df.sparkSession.createDataFrame(rows, "col_name string, data_type string, nullable boolean")


def profile_table(df: DataFrame) -> DataFrame:
    """Per column: col_name, data_type, n_rows, n_null, n_distinct, is_unique (no value twice, none missing).

    What constraints the data would meet, counted exactly: values are counted
    first and the counts per column after, so a hot value is one row per task.
    """
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    values = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("col_name"), F.col(c).cast("string").alias("value")) for c in kinds])))
    counted = values.groupBy("col_name", "value").agg(F.count("*").alias("n"))
    kind = F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])
    n_null = F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0))
    n_distinct = F.count("value")
    return counted.groupBy("col_name").agg(F.sum("n").alias("n_rows"), n_null.alias("n_null"), n_distinct.alias("n_distinct")).select(
        "col_name", kind[F.col("col_name")].alias("data_type"), "n_rows", "n_null", "n_distinct",
        (F.col("n_distinct") == F.col("n_rows")).alias("is_unique"))
