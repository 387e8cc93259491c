"""Ranks over a whole data set without a single-task window."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, Window, functions as F, types as T

from martworks.session import reliable, work_partitions

# monotonically_increasing_id = partition number << 33 | row number in the partition
_ROW_BITS = 33


def top_k(df: DataFrame, order: list, k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def batch(df: DataFrame, order: list, n: int | None = None) -> DataFrame:
    """Sorted batch of a cursor; without `n` the rest of the input, unsorted."""
    return df if n is None else df.orderBy(*order).limit(n)


def _sorted_layout(df: DataFrame, order: list[str]) -> DataFrame:
    """Rows range-partitioned and sorted by `order`, with their place as `_pos`.

    The layout is written to the shared folder: range bounds are sampled, so a
    recomputed partition could otherwise cut the data at another row.
    """
    laid = (
        df.repartitionByRange(work_partitions(df.sparkSession), *order)
        .sortWithinPartitions(*order)
        .withColumn("_pos", F.monotonically_increasing_id())
    )
    return reliable(laid)


def _partition_starts(laid: DataFrame) -> dict[int, tuple[int, int]]:
    """{partition: (rows before it, rows in it)}; one small row per partition."""
    counts = (
        laid.groupBy(F.shiftright("_pos", _ROW_BITS).alias("part")).agg(F.count("*").alias("n")).collect()
    )
    rows = sorted((r.part, r.n) for r in counts)
    before = [0, *accumulate(n for _, n in rows)]
    return {part: (before[i], n) for i, (part, n) in enumerate(rows)}


def dense_ids(df: DataFrame, order: list[str], name: str = "id", start: int = 1) -> DataFrame:
    """Dense integer ids from `start` in the given order (unique columns)."""
    laid = _sorted_layout(df, order)
    starts = _partition_starts(laid)
    row_in_part = F.col("_pos").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    # one offset per partition of the layout, as a literal: Spark would take a join with them for the product of both
    # sizes and then shuffle what is joined with a table of a few ids
    before = F.get(F.array(*[F.lit(starts.get(part, (0, 0))[0]).cast("bigint") for part in range(max(starts, default=0) + 1)]),
                   F.shiftright("_pos", _ROW_BITS).cast("int"))
    return laid.select(*df.columns, (before + row_in_part + F.lit(start)).alias(name))


def tile_window(df: DataFrame, value: str, id_col: str, n: int = 5, name: str = "tile") -> DataFrame:
    """Plain `ntile` over everything: one task, for inputs known to be small."""
    return df.withColumn(name, F.ntile(n).over(Window.orderBy(value, id_col)))


def _decimal_for(kinds: set[T.DataType]) -> str | None:
    """The decimal type that holds integers and decimals of all these types, if there is one."""
    whole, scale = 0, 0
    for kind in kinds:
        if not isinstance(kind, (T.IntegralType, T.DecimalType)):
            return None
        p, s = (kind.precision, kind.scale) if isinstance(kind, T.DecimalType) else (19, 0)
        whole, scale = max(whole, p - s), max(scale, s)
    return f"decimal({whole + scale},{scale})" if whole + scale <= 38 else None


def tiles(df: DataFrame, values: dict[str, str], id_col: str, n: int = 5) -> DataFrame:
    """Exact `ntile(n)` of several measures at once, ascending, ties by id.

    `values` maps an output column to its measure. All measures are laid out in
    one range-partitioned sort by (measure, value, id); a hot value spreads over
    partitions because the id is part of the sort. From the partition counts the
    n - 1 rows at the tile borders are looked up, and the tile of each row of
    `df` is then a comparison with those borders: no join back, no window.
    Measures of unequal type share a sort if one decimal type holds all their
    digits; otherwise each type has a sort of its own.
    """
    kinds = {df.schema[c].dataType for c in values.values()}
    common = kinds.pop().simpleString() if len(kinds) == 1 else _decimal_for(kinds)
    if common is None:
        for kind in sorted(kinds, key=str):
            df = tiles(df, {name: c for name, c in values.items() if df.schema[c].dataType == kind}, id_col, n)
        return df
    id_type = df.schema[id_col].dataType.simpleString()
    names = list(values)
    entries = F.array(*[
        F.struct(F.lit(i).alias("m"), F.col(values[name]).cast(common).alias("v"), F.col(id_col).alias("i"))
        for i, name in enumerate(names)
    ])
    laid = _sorted_layout(df.select(F.inline(entries)), ["m", "v", "i"])
    starts = _partition_starts(laid)
    total = sum(count for _, count in starts.values())
    rows = total // len(names)
    ends = [t * (rows // n) + min(t, rows % n) for t in range(1, n)] if rows else []
    wanted = {}
    for i, _ in enumerate(names):
        for t, end in enumerate(ends):
            rank = i * rows + end - 1
            for part, (before, count) in starts.items():
                if before <= rank < before + count:
                    wanted.setdefault((part << _ROW_BITS) + rank - before, []).append((i, t))
    borders = {}
    if wanted:
        found = laid.where(F.col("_pos").isin(list(wanted))).select(
            "_pos", F.col("v").cast("string"), F.col("i").cast("string")).collect()
        for row in found:
            for slot in wanted[row._pos]:
                borders[slot] = (row.v, row.i)
    out = df
    for i, name in enumerate(names):
        tile = F.lit(1)
        here = F.struct(F.col(values[name]).cast(common).alias("v"), F.col(id_col).alias("i"))
        for t, _ in enumerate(ends):
            v, key = borders[(i, t)]
            border = F.struct(F.lit(v).cast(common).alias("v"), F.lit(key).cast(id_type).alias("i"))
            tile = tile + (here > border).cast("int")
        out = out.withColumn(name, tile)
    return out


def quintile(df: DataFrame, value: str, id_col: str, n: int = 5, name: str = "tile") -> DataFrame:
    return tiles(df, {name: value}, id_col, n)
