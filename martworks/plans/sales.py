"""Sales star schema from order increments, and weekly retention."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martworks.functions.money import signed_amount, sum_if
from martworks.operators.filters import on_day
from martworks.operators.grouping import two_level
from martworks.operators.upsert import insert_new


def calendar(dates: DataFrame, c: str) -> DataFrame:
    """Calendar rows (yyyymmdd id) of the dates found in a column."""
    days = dates.select(F.to_date(c).alias("date_actual")).distinct().where("date_actual is not null")
    return days.select(
        F.date_format("date_actual", "yyyyMMdd").cast("int").alias("date_id"), "date_actual",
        F.weekofyear("date_actual").alias("week_of_year"))


def new_cities(increment: DataFrame, existing: DataFrame) -> DataFrame:
    return insert_new(existing, increment.select("city_id", "city_name"), "city_id", ["city_name"])


def new_items(increment: DataFrame, existing: DataFrame) -> DataFrame:
    return insert_new(existing, increment.select("item_id", "item_name"), "item_id", ["item_name"])


def new_customers(increment: DataFrame, existing: DataFrame) -> DataFrame:
    """Unknown customers: latest name, largest city id."""
    last = F.max(F.struct("date_time", "uniq_id", "first_name", "last_name")).alias("last")
    rows = increment.where("customer_id is not null").groupBy("customer_id").agg(last, F.max("city_id").alias("city_id"))
    return insert_new(existing, rows.select("customer_id", "last.first_name", "last.last_name", "city_id"), "customer_id")


def fact_sales(increment: DataFrame, cal: DataFrame, day: str | None = None) -> DataFrame:
    """Sales of one day (or of the whole input) with the sign of refunds."""
    rows = on_day(increment, "date_time", day) if day else increment
    return rows.withColumn("date_actual", F.to_date("date_time")).join(cal, "date_actual", "left").select(
        "date_id", "item_id", "customer_id", "city_id", "quantity",
        signed_amount(F.col("payment_amount"), F.col("status")).alias("payment_amount"), "status")


def customer_retention(sales: DataFrame, cal: DataFrame) -> DataFrame:
    """New, returning and refunding customers per item and week."""
    dated = sales.join(cal.select("date_id", "week_of_year"), "date_id")
    new, back, refund = F.col("orders") == 1, F.col("orders") > 1, F.col("refunded_orders") > 0
    week = two_level(
        dated,
        ["week_of_year", "customer_id", "item_id"],
        [F.count("*").alias("orders"), F.count_if(F.col("status") == "refunded").alias("refunded_orders"),
         F.sum("payment_amount").alias("revenue")],
        ["week_of_year", "item_id"],
        [F.count_if(new).alias("new_customers_count"), F.count_if(back).alias("returning_customers_count"),
         F.count_if(refund).alias("refunded_customer_count"),
         sum_if(new, F.col("revenue")).alias("new_customers_revenue"),
         sum_if(back, F.col("revenue")).alias("returning_customers_revenue"),
         sum_if(refund, F.col("revenue")).alias("customers_refunded")])
    return week.select(
        "new_customers_count", "returning_customers_count", "refunded_customer_count",
        F.lit("weekly").alias("period_name"), F.col("week_of_year").cast("smallint").alias("period_id"), "item_id",
        "new_customers_revenue", "returning_customers_revenue", "customers_refunded")
