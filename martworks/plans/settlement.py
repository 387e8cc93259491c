"""Settlement of restaurants and pay of couriers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from martworks.functions.money import courier_pay, money
from martworks.operators.filters import is_current

ORDER_FEE = "0.25"
RESTAURANT_SHARE = "0.75"
TIP_SHARE = "0.95"


def _share(text: str) -> Column:
    return F.lit(text).cast("decimal(3,2)")


def settlement_report(sales: DataFrame, orders: DataFrame, timestamps: DataFrame, products: DataFrame,
                      restaurants: DataFrame, as_of: Column) -> DataFrame:
    """Closed orders per restaurant and day: counts, sums, fee and reward."""
    closed = orders.where(F.col("order_status") == "CLOSED").select(
        F.col("id").alias("order_id"), "restaurant_id", F.col("timestamp_id"))
    days = timestamps.select(F.col("id").alias("timestamp_id"), F.col("date").alias("settlement_date"))
    goods = is_current(products, as_of).select(F.col("id").alias("product_id"), "restaurant_id")
    places = is_current(restaurants, as_of).select(F.col("id").alias("restaurant_id"), "restaurant_name")
    rows = (
        sales.select("order_id", "product_id", "total_sum", "bonus_payment", "bonus_grant")
        .join(closed, "order_id")
        .join(goods, ["product_id", "restaurant_id"])
        .join(places, "restaurant_id")
        .join(days, "timestamp_id")
    )
    total, paid = F.sum("total_sum"), F.sum("bonus_payment")
    return rows.groupBy("restaurant_id", "restaurant_name", "settlement_date").agg(
        F.countDistinct("order_id").alias("orders_count"),
        money(total).alias("orders_total_sum"),
        money(paid).alias("orders_bonus_payment_sum"),
        money(F.sum("bonus_grant")).alias("orders_bonus_granted_sum"),
        money(_share(ORDER_FEE) * total).alias("order_processing_fee"),
        money(_share(RESTAURANT_SHARE) * total - paid).alias("restaurant_reward_sum"))


def courier_ledger(deliveries: DataFrame, couriers: DataFrame, orders: DataFrame, timestamps: DataFrame) -> DataFrame:
    """Orders, rate, fee, pay and tips per courier and month of the order."""
    names = couriers.select(F.col("id").alias("courier_id"), "courier_name")
    when = orders.select(F.col("id").alias("order_id"), "timestamp_id").join(
        timestamps.select(F.col("id").alias("timestamp_id"), F.col("year").alias("settlement_year"),
                          F.col("month").alias("settlement_month")), "timestamp_id")
    # sums per courier and month come first; names join the small result
    base = (
        deliveries.select("order_id", "courier_id", "delivery_id", "sum", "tip_sum", "rate")
        .join(when.drop("timestamp_id"), "order_id")
        .groupBy("courier_id", "settlement_year", "settlement_month")
        .agg(
            F.count("delivery_id").alias("orders_count"),
            F.sum("sum").alias("total"),
            (F.sum(F.col("rate").cast("bigint")).cast("decimal(18,0)") / F.count("rate").cast("decimal(18,0)")).alias("rate"),
            F.sum("tip_sum").alias("tips"))
        .join(names, "courier_id")
    )
    pay = money(courier_pay(F.col("rate"), F.col("total")))
    return base.select(
        "courier_id", "courier_name", "settlement_year", "settlement_month", "orders_count",
        money(F.col("total")).alias("orders_total_sum"),
        F.col("rate").cast("decimal(3,2)").alias("rate_avg"),
        money(F.col("total") * _share(ORDER_FEE)).alias("order_processing_fee"),
        pay.alias("courier_order_sum"),
        money(F.col("tips")).alias("courier_tips_sum"),
        money(pay + F.col("tips") * _share(TIP_SHARE)).alias("courier_reward_sum"))
