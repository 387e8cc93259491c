"""Aggregation patterns. All of them pre-aggregate before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def count_by(df: DataFrame, *keys: str, name: str = "cnt") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def count_distinct(*columns: str, approx: bool = False) -> Column:
    if approx:
        return F.approx_count_distinct(columns[0] if len(columns) == 1 else F.xxhash64(*columns))
    return F.countDistinct(*columns)


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    return count_by(df, *keys).where("cnt > 1")


# bits of a value, one more for null; times between the years 1 and 9999 need 59
_BITS = {T.BooleanType: 2, T.ByteType: 9, T.ShortType: 17, T.IntegerType: 33, T.DateType: 33, T.LongType: 65,
         T.TimestampType: 60, T.TimestampNTZType: 60}
_FIXED = (*_BITS, T.FloatType, T.DoubleType, T.DecimalType)
_YEAR_1 = 62_135_596_800_000_000  # microseconds from there to 1970


def _whole_number(df: DataFrame, c: str) -> Column:
    """A value as a number from 1 in the order of its type, 0 for null."""
    kind, value = df.schema[c].dataType, F.col(c)
    if isinstance(kind, T.TimestampType):
        number = F.unix_micros(value).cast("decimal(38,0)") + F.lit(_YEAR_1)
    elif isinstance(kind, T.TimestampNTZType):
        number = F.timestamp_diff("MICROSECOND", F.lit("0001-01-01").cast("timestamp_ntz"), value).cast("decimal(38,0)")
    elif isinstance(kind, T.DateType):
        number = F.unix_date(value).cast("decimal(38,0)") + F.lit(1 << 31)
    else:
        number = value.cast("int" if isinstance(kind, T.BooleanType) else kind).cast("decimal(38,0)") + F.lit(str(1 << (_BITS[type(kind)] - 2))).cast("decimal(38,0)")
    return F.coalesce(number + 1, F.lit(0).cast("decimal(38,0)"))


def _one_number(df: DataFrame, order: list[str]) -> Column | None:
    """Several order columns as one decimal, if they are whole numbers or times that fit its digits."""
    kinds = [type(df.schema[c].dataType) for c in order]
    if not order or any(k not in _BITS for k in kinds) or sum(_BITS[k] for k in kinds) > 125:
        return None
    packed = F.lit(0).cast("decimal(38,0)")
    for c, kind in zip(order, kinds):
        packed = (packed * F.lit(str(1 << _BITS[kind])).cast("decimal(38,0)") + _whole_number(df, c)).cast("decimal(38,0)")
    if sum(_BITS[k] for k in kinds) + 65 > 125:
        return packed
    # room for a choice between equal rows of the order that reruns repeat
    row = F.xxhash64(*df.columns).cast("decimal(38,0)") + F.lit(str(1 << 63)).cast("decimal(38,0)")
    return (packed * F.lit(str(1 << 64)).cast("decimal(38,0)") + row).cast("decimal(38,0)")


def pick_per_key(df: DataFrame, keys: list[str], order: list[str], latest: bool = True) -> DataFrame:
    """The whole latest (or earliest) row of each key.

    One aggregate: partial results are merged map side, so a key with very many
    rows never meets in one task as a window would make it. Rows of numbers and
    times are kept in a hash table under one number made of the order columns; rows
    with texts or arrays are compared as structs, which Spark sorts for. The order
    columns should be unique within a key, the last one being there for that; rows
    equal in a single one are told apart by their hash.
    """
    rest = [c for c in df.columns if c not in keys]
    number = _one_number(df, order)
    if number is not None and rest and all(isinstance(df.schema[c].dataType, _FIXED) for c in rest):
        by = F.max_by if latest else F.min_by
        return df.withColumn("_order", number).groupBy(*keys).agg(*[by(c, "_order").alias(c) for c in rest]).select(*df.columns)
    # a column that the order has is not carried twice
    at = {c: f"_o{i}" for i, c in enumerate(order)}
    more = [c for c in rest if c not in at]
    ordered = F.struct(*[F.col(c).alias(o) for c, o in at.items()], *([F.struct(*more).alias("_row")] if more else []))
    best = (F.max if latest else F.min)(ordered)
    picked = {c: F.col(f"_best.{at[c]}") if c in at else F.col(f"_best._row.`{c}`") for c in rest}
    return df.groupBy(*keys).agg(best.alias("_best")).select(*[picked[c].alias(c) if c in picked else F.col(c) for c in df.columns])


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return pick_per_key(df, keys, order, latest=True)


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return pick_per_key(df, keys, order, latest=False)


def dedupe(df: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """One row per key: the earliest by `order`, or by all other columns when none is given, so reruns keep the same row."""
    rest = order or [c for c in df.columns if c not in keys]
    return first_per_key(df, keys, rest) if rest else df.dropDuplicates(keys)


def two_level(df: DataFrame, keys1: list, aggs1: list[Column], keys2: list, aggs2: list[Column]) -> DataFrame:
    """Aggregate per fine key, then the result per coarse key."""
    return df.groupBy(*keys1).agg(*aggs1).groupBy(*keys2).agg(*aggs2)


def ordered_list(value: str, order: list[str], sep: str = ", ") -> Column:
    """Aggregate of one text: the values joined in the given order."""
    rows = F.array_sort(F.collect_list(F.struct(*order, F.col(value).alias("_value"))))
    return F.array_join(F.transform(rows, lambda r: r["_value"]), sep)


def week_and_month_counts(df: DataFrame, date: str, keys: list[str], name: str) -> DataFrame:
    """Week counts per key which also carry the total of their month.

    A week that spans two months stays two rows. The month total is added up
    from the week rows, so the input is scanned and shuffled once.
    """
    from martworks.functions.time import trunc_month, trunc_week

    weeks = (
        df.groupBy(*keys, trunc_month(F.col(date)).alias("month"), trunc_week(F.col(date)).alias("week"))
        .agg(F.count("*").alias(f"week_{name}"))
    )
    months = weeks.groupBy(*keys, "month").agg(F.sum(f"week_{name}").alias(f"month_{name}"))
    return weeks.join(months, [*keys, "month"])
