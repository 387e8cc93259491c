"""Registration of queries and helpers shared by the catalog modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_STAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"


class Tables:
    """The driver's parquet tables by attribute."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def plain(df: DataFrame) -> DataFrame:
    """Result types both engines print alike: numbers as double or bigint, times as text."""
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, _STAMP)
        out.append(c.alias(f.name))
    return df.select(*out)


def query(name: str, sql: str | None = None):
    """Registers `fn(tables) -> DataFrame` under a name, with its SQL twin."""
    def add(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: plain(fn(Tables(spark, sf_dir)))
        if sql:
            ORACLES[name] = sql
        return fn
    return add


def money(c: str) -> Column:
    return F.col(c).cast("decimal(14,2)")


def ts_sql(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f')"


def uuid3_sql(x: str) -> str:
    h = f"md5(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode({x}))"
    return (f"(substr({h},1,8) || '-' || substr({h},9,4) || '-3' || substr({h},14,3) || '-' || "
            f"translate(substr({h},17,1),'0123456789abcdef','89ab89ab89ab89ab') || substr({h},18,3) || '-' || substr({h},21,12))")
