"""Stored documents to star schema: dimensions and facts of a delivery service."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martworks import schemas
from martworks.functions.arrays import explode_items
from martworks.functions.money import money
from martworks.functions.text import parse_json
from martworks.functions.time import to_second
from martworks.operators.dims import load_dim
from martworks.operators.filters import open_end
from martworks.operators.grouping import latest_per_key
from martworks.operators.joins import lookup_default, resolve_ids
from martworks.operators.upsert import insert_ignore

CANCELLED = "CANCELLED"
BONUS_EVENT = "bonus_transaction"


def dim_users(docs: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    return load_dim(docs, schemas.DOC_USER, {"user_id": "_id", "user_name": "name", "user_login": "login"},
                    "user_id", existing).drop("update_ts")


def _open_version(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("update_ts", "active_from").withColumn("active_to", open_end())


def dim_restaurants(docs: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    return _open_version(load_dim(docs, schemas.DOC_RESTAURANT, {"restaurant_id": "_id", "restaurant_name": "name"},
                                  "restaurant_id", existing))


def dim_couriers(docs: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    return _open_version(load_dim(docs, schemas.DOC_COURIER, {"courier_id": "_id", "courier_name": "name"},
                                  "courier_id", existing))


def dim_products(docs: DataFrame, restaurants: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(products with their restaurant's id, menu items of unknown restaurants)."""
    parsed = docs.withColumn("_doc", parse_json(F.col("object_value"), schemas.DOC_RESTAURANT))
    latest = latest_per_key(parsed.select(F.col("_doc._id").alias("_rid"), F.col("_doc.menu").alias("menu"), "update_ts"),
                            ["_rid"], ["update_ts"])
    items = explode_items(latest, "menu").select(
        "_rid", F.col("_id").alias("product_id"), F.col("name").alias("product_name"),
        money(F.col("price")).alias("product_price"), F.col("update_ts").alias("active_from"), open_end().alias("active_to"))
    known, rejects = resolve_ids(items, restaurants, "_rid", "restaurant_id", "id", "restaurant_id")
    return known.drop("_rid"), rejects


def parsed_orders(docs: DataFrame) -> DataFrame:
    """Order documents with their fields, parsed once."""
    return docs.withColumn("_doc", parse_json(F.col("object_value"), schemas.DOC_ORDER)).select(
        F.col("_doc._id").alias("order_key"), F.col("_doc.user.id").alias("user_key"),
        F.col("_doc.restaurant.id").alias("restaurant_key"), F.col("_doc.final_status").alias("order_status"),
        F.col("_doc.order_items").alias("order_items"), "update_ts")


def fact_orders(orders: DataFrame, users: DataFrame, restaurants: DataFrame, timestamps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(orders with ids of user, restaurant and second, rejects with the reason)."""
    rows = orders.drop("order_items").withColumn("_ts", to_second(F.col("update_ts")))
    ok, no_user = resolve_ids(rows, users, "user_key", "user_id", "id", "user_id")
    ok, no_place = resolve_ids(ok, restaurants, "restaurant_key", "restaurant_id", "id", "restaurant_id")
    ok, no_time = resolve_ids(ok, timestamps, "_ts", "ts", "id", "timestamp_id")
    rejects = None
    for reason, bad in (("user", no_user), ("restaurant", no_place), ("timestamp", no_time)):
        part = bad.select("order_key", F.lit(reason).alias("missing"))
        rejects = part if rejects is None else rejects.unionByName(part)
    return ok.select("order_key", "order_status", "user_id", "restaurant_id", "timestamp_id"), rejects


def order_bonuses(events: DataFrame) -> DataFrame:
    """Bonus per order and product, from the latest bonus event of each order."""
    bonus = events.where(F.col("event_type") == BONUS_EVENT).withColumn(
        "_doc", parse_json(F.col("event_value"), schemas.DOC_BONUS)).select(
            F.col("_doc.order_id").alias("order_key"), F.col("_doc.product_payments").alias("_pay"), "event_ts", "id")
    last = latest_per_key(bonus, ["order_key"], ["event_ts", "id"])
    return explode_items(last.select("order_key", "_pay"), "_pay").groupBy(
        "order_key", F.col("product_id").alias("product_key")).agg(
            F.max("bonus_payment").alias("bonus_payment"), F.max("bonus_grant").alias("bonus_grant"))


def fact_product_sales(orders: DataFrame, bonuses: DataFrame, dm_orders: DataFrame,
                       dm_products: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(one row per order item with ids, total and bonus, rejected items)."""
    lines = explode_items(
        orders.where(F.col("order_status") != CANCELLED).select("order_key", "order_items"), "order_items").select(
            "order_key", F.col("id").alias("product_key"), F.col("quantity").alias("count"), money(F.col("price")).alias("price"))
    zero = money(F.lit(0))
    with_bonus = lookup_default(lines, bonuses, ["order_key", "product_key"], {"bonus_payment": zero, "bonus_grant": zero})
    ok, no_order = resolve_ids(with_bonus, dm_orders, "order_key", "order_key", "id", "order_id")
    ok, no_product = resolve_ids(ok, dm_products, "product_key", "product_id", "id", "product_id")
    facts = ok.select(
        "product_id", "order_id", "count", "price", money(F.col("count") * F.col("price")).alias("total_sum"),
        money(F.col("bonus_payment")).alias("bonus_payment"), money(F.col("bonus_grant")).alias("bonus_grant"))
    rejects = no_order.select("order_key", "product_key", F.lit("order").alias("missing")).unionByName(
        no_product.select("order_key", "product_key", F.lit("product").alias("missing")))
    return facts, rejects


def fact_deliveries(docs: DataFrame, couriers: DataFrame, dm_orders: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """New deliveries with the ids of courier and order, one row per delivery."""
    d = F.col("_doc")
    raw = docs.withColumn("_doc", parse_json(F.col("object_value"), schemas.DOC_DELIVERY)).select(
        F.col("object_id").alias("order_key"), d["order_ts"].alias("order_ts"), d["delivery_id"].alias("delivery_id"),
        d["courier_id"].alias("courier_key"), d["address"].alias("address"), d["delivery_ts"].alias("delivery_ts"),
        money(d["sum"]).alias("sum"), money(d["tip_sum"]).alias("tip_sum"), d["rate"].alias("rate"))
    rows = raw.join(couriers.select(F.col("courier_id").alias("courier_key"), F.col("id").alias("courier_id")), "courier_key").join(
        dm_orders.select("order_key", F.col("id").alias("order_id")), "order_key")
    rows = rows.select("order_id", "order_ts", "delivery_id", "courier_id", "address", "delivery_ts", "sum", "tip_sum", "rate")
    target = existing if existing is not None else rows.limit(0)
    return insert_ignore(target, rows, ["delivery_id"], ["order_ts", "order_id"])
