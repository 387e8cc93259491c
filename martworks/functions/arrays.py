"""Arrays of structs: search, projection, zip and explode."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F


def array_find(arr: Column, predicate: Callable[[Column], Column]) -> Column:
    """First element that satisfies the predicate, else null."""
    return F.try_element_at(F.filter(arr, predicate), F.lit(1))


def array_pluck(arr: Column, field: str) -> Column:
    """One field of every struct in the array."""
    return F.transform(arr, lambda item: item[field])


def zip_arrays(**arrays: Column) -> Column:
    """Parallel arrays as one array of structs with the given field names."""
    return F.arrays_zip(*[c.alias(name) for name, c in arrays.items()])


def explode_items(df: DataFrame, items: str, position: str | None = None, outer: bool = False) -> DataFrame:
    """One row per array element; struct fields become columns."""
    if position:
        fn = F.posexplode_outer if outer else F.posexplode
        rows = df.select("*", fn(items).alias(position, "_item"))
    else:
        rows = df.select("*", (F.explode_outer if outer else F.explode)(items).alias("_item"))
    return rows.drop(items).select(*[c for c in rows.columns if c not in (items, "_item")], "_item.*")
