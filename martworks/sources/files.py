"""Files: dated partitions, delimited text, marts and views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from martworks import schemas
from martworks.functions.text import decimal_comma
from martworks.functions.time import run_dates
from martworks.operators.grouping import latest_per_key


def read_event_window(spark: SparkSession, base: str, date: str, depth: int) -> DataFrame:
    """The `depth` daily partitions that end at `date`, pruned by `date`."""
    days = run_dates(date, depth)
    return spark.read.parquet(base).where(F.col("date").between(F.lit(days[-1]).cast("date"), F.lit(days[0]).cast("date")))


def read_geo_cities(spark: SparkSession, path: str) -> DataFrame:
    """City list with decimal commas: degrees and radians."""
    raw = spark.read.option("header", True).option("sep", ";").schema(schemas.GEO_CITIES).csv(path)
    return raw.select(
        "id", "city", decimal_comma(F.col("lat")).alias("lat"), decimal_comma(F.col("lng")).alias("lon"),
    ).withColumns({"lat_geo": F.radians("lat"), "lon_geo": F.radians("lon")})


def as_places(cities: DataFrame) -> DataFrame:
    return cities.select(F.col("id").alias("place_id"), F.col("city").alias("place"), "lat", "lon")


def read_order_increment(spark: SparkSession, path: str) -> DataFrame:
    """Order increment by header name; `status` defaults to 'shipped'.

    All files must have the columns in the same order; another header is an error.
    """
    header = spark.read.option("header", True).csv(path).columns
    declared = T.StructType.fromDDL(schemas.ORDER_INCREMENT)
    schema = T.StructType([declared[c] if c in declared.names else T.StructField(c, T.StringType()) for c in header])
    raw = spark.read.option("header", True).option("enforceSchema", False).schema(schema).csv(path)
    return clean_order_increment(raw)


def clean_order_increment(raw: DataFrame) -> DataFrame:
    """One row per `uniq_id`, the latest; equal times are told apart by the other columns."""
    rows = raw.drop("id")
    rest = [c for c in rows.columns if c not in ("uniq_id", "date_time")]
    rows = latest_per_key(rows, ["uniq_id"], [*(["date_time"] if "date_time" in rows.columns else []), *rest])
    status = F.coalesce(F.col("status"), F.lit("shipped")) if "status" in rows.columns else F.lit("shipped")
    return rows.withColumn("status", status)


def load_staging_csv(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = False) -> DataFrame:
    """Comma-separated file under a declared schema; object stores by s3a:// path."""
    return spark.read.option("header", header).schema(schema).csv(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Stored documents: key, JSON text and update time."""
    return spark.read.schema("id bigint, object_id string, object_value string, update_ts timestamp_ntz").json(path)


def read_mart(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}")


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """The first rows of a staged file, for a look at it."""
    return df.limit(n)


def register_views(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
