"""Join patterns. None carries a broadcast hint: Spark broadcasts a side that is
below its size threshold at run time and otherwise splits skewed partitions.
Sides that grow with the data and whose size Spark guesses too low (`growing`) are
always shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def with_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Rows whose keys are all present; plain conditions reach the file scan."""
    for key in keys:
        df = df.where(F.col(key).isNotNull())
    return df


def growing(df: DataFrame) -> DataFrame:
    """A side to be joined by shuffle, never by broadcast.

    Spark guesses sizes from compressed files, and takes an exploded array for one
    row: a menu of millions of rows looks small enough to be collected by the driver.
    """
    return df.hint("merge")


def with_all(base: DataFrame, agg: DataFrame, key: str, defaults: dict[str, Column]) -> DataFrame:
    """Every row of `base`, with defaults where `agg` has nothing."""
    joined = agg.join(base, key, "right")
    return joined.withColumns({c: F.coalesce(F.col(c), d) for c, d in defaults.items()})


def join_on_expr(left: DataFrame, right: DataFrame, on: dict[str, Column], how: str = "inner") -> DataFrame:
    """Equi-join on computed values of `left`, keyed by columns of `right`."""
    return left.withColumns(on).join(right, list(on), how)


def rows_absent(source: DataFrame, other: DataFrame, *keys: str) -> DataFrame:
    """Source rows whose key the other side lacks; rows with a null key go too."""
    return with_keys(source, *keys).join(other.select(*keys), list(keys), "left_anti")


def rows_present(source: DataFrame, other: DataFrame, *keys: str) -> DataFrame:
    return source.join(other.select(*keys), list(keys), "left_semi")


def orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Child rows with a foreign key that no parent has."""
    return child.where(F.col(fk).isNotNull()).join(parent.select(F.col(pk).alias(fk)), fk, "left_anti")


def missing_keys(dim: DataFrame, source: DataFrame, key: str) -> DataFrame:
    return dim.join(source.select(key), key, "left_anti")


def resolve_ids(df: DataFrame, dim: DataFrame, key: str, dim_key: str, dim_id: str, name: str) -> tuple[DataFrame, DataFrame]:
    """(rows with the id of their key, rows whose key is unknown)."""
    lookup = dim.select(F.col(dim_key).alias(key), F.col(dim_id).alias(name))
    joined = df.join(lookup.withColumn("_known", F.lit(True)), key, "left")
    known = F.coalesce("_known", F.lit(False))
    return joined.where(known).drop("_known"), joined.where(~known).select(*df.columns)


def lookup_default(df: DataFrame, dim: DataFrame, keys: list[str], defaults: dict[str, Column]) -> DataFrame:
    """Left join which replaces missing values by defaults."""
    joined = df.join(dim.select(*keys, *defaults), keys, "left")
    return joined.withColumns({c: F.coalesce(F.col(c), d) for c, d in defaults.items()})


def join_static(stream: DataFrame, static: DataFrame, key: str, dedup: list[str]) -> DataFrame:
    """Stream rows joined with the deduplicated static side."""
    return stream.join(static.dropDuplicates(dedup), key)


def enrich_items(df: DataFrame, order_key: str, items: str, item_key: str, menu: DataFrame,
                 scope: list[str], fields: list[str], how: str = "left") -> DataFrame:
    """Add menu fields to the structs of an item array.

    Items are exploded with their position, equi-joined to the menu on
    (scope, item) and collected back in order, one order at a time. Only the item
    key travels to the menu and only the menu fields back; the rest of an item
    waits in its array. An item the menu lacks keeps null fields.
    """
    item_fields = df.schema[items].dataType.elementType.fieldNames()
    key = f"_i_{item_key}"
    flat = df.select(order_key, *scope, F.posexplode(items).alias("_at", "_item")).select(
        order_key, *scope, "_at", F.col("_item")[item_key].alias(key))
    known = menu.select(*scope, F.col(item_key).alias(key), *fields)
    joined = flat.join(growing(known), [*scope, key], how)
    packed = joined.groupBy(order_key).agg(F.array_sort(F.collect_list(F.struct("_at", *fields))).alias("_all"))
    named = F.transform("_all", lambda e: F.struct(
        *[F.get(F.col(items), e["_at"])[f].alias(f) for f in item_fields], *[e[f].alias(f) for f in fields]))
    others = [c for c in df.columns if c not in (items, order_key)]
    return df.join(packed, order_key, "left").select(order_key, *others, named.alias(items))


def salted_pairs(left: DataFrame, right: DataFrame, on: list[str], left_spread: Column, right_spread: Column,
                 target: int, sizes: DataFrame | None = None) -> DataFrame:
    """Inner equi-join that cuts hot keys into blocks on both sides.

    Keys are counted first, unless `sizes` (the keys, `_nl`, `_nr`: rows of a key
    at most, left and right) is known already. A key with more than `target` rows on a side is cut
    there into ceil(count / target) blocks by the hash of the spread column;
    each row meets every block of the other side once. So no task compares more
    than about target x target rows, and every pair still appears exactly once.
    Keys under the target, normally almost all, have one block and no copies.
    """
    def cuts(n: str) -> Column:
        return F.ceil(F.col(n) / F.lit(target)).cast("int")

    def blocks(df: DataFrame, name: str) -> DataFrame:
        counted = df.groupBy(*on).agg(F.count("*").alias("_n")).where(F.col("_n") > target)
        return counted.select(*on, cuts("_n").alias(name))

    if sizes is None:
        hot = blocks(left, "_bl").join(blocks(right, "_br"), on, "full")
    else:
        hot = sizes.where((F.col("_nl") > target) | (F.col("_nr") > target)).select(
            *on, cuts("_nl").alias("_bl"), cuts("_nr").alias("_br"))
    nl, nr = F.coalesce("_bl", F.lit(1)), F.coalesce("_br", F.lit(1))

    def cut(df: DataFrame, own: str, n_own: Column, spread: Column, other: str, n_other: Column) -> DataFrame:
        marked = df.join(hot, on, "left").withColumn(own, F.pmod(F.xxhash64(spread), n_own).cast("int"))
        return marked.withColumn(other, F.explode(F.sequence(F.lit(0), n_other - 1))).drop("_bl", "_br")

    return cut(left, "_a", nl, left_spread, "_b", nr).join(
        cut(right, "_b", nr, right_spread, "_a", nl), [*on, "_a", "_b"]).drop("_a", "_b")
