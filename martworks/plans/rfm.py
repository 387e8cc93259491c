"""Customer quintiles by recency, frequency and monetary value."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martworks.functions.time import wall_seconds
from martworks.operators.grouping import latest_per_key
from martworks.operators.joins import with_all
from martworks.operators.ranking import tiles
from martworks.session import reliable

CLOSED = "Closed"
NEVER = "1970-01-01 00:00:00"


def orders_with_latest_status(orders: DataFrame, log: DataFrame, tie: str = "id") -> DataFrame:
    """Orders with the status of their last log entry (ties: larger log id)."""
    last = latest_per_key(log.select("order_id", "dttm", tie, "status_id"), ["order_id"], ["dttm", tie])
    return orders.drop("status").join(last.select("order_id", F.col("status_id").alias("status")), "order_id")


def closed_orders(orders: DataFrame, statuses: DataFrame) -> DataFrame:
    done = statuses.where(F.col("key") == CLOSED).select(F.col("id").alias("status"))
    return orders.join(done, "status", "left_semi")


def user_measures(users: DataFrame, closed: DataFrame) -> DataFrame:
    """Last order time, order count and sum per user; users without orders kept."""
    per_user = closed.groupBy("user_id").agg(
        F.max("order_ts").alias("last_order_ts"),
        F.count("*").alias("order_cnt"),
        F.sum("payment").alias("payment_sum"))
    money = per_user.schema["payment_sum"].dataType
    return with_all(users.select(F.col("id").alias("user_id")), per_user, "user_id", {
        "last_order_ts": F.lit(NEVER).cast("timestamp_ntz"),
        "order_cnt": F.lit(0).cast("bigint"),
        "payment_sum": F.lit(0).cast(money),
    }).withColumn("last_order_sec", wall_seconds(F.col("last_order_ts")))


_MEASURES = {"recency": "last_order_sec", "frequency": "order_cnt", "monetary_value": "payment_sum"}


def _ranked(users: DataFrame, closed: DataFrame, names: list[str]) -> DataFrame:
    # one aggregate per user feeds both the tile borders and the result
    measures = reliable(user_measures(users, closed).select("user_id", *[_MEASURES[n] for n in names]))
    ranked = tiles(measures, {n: _MEASURES[n] for n in names}, "user_id", 5)
    return ranked.select("user_id", *[F.col(n).cast("smallint").alias(n) for n in names])


def rfm_recency(users: DataFrame, closed: DataFrame) -> DataFrame:
    return _ranked(users, closed, ["recency"])


def rfm_frequency(users: DataFrame, closed: DataFrame) -> DataFrame:
    return _ranked(users, closed, ["frequency"])


def rfm_monetary(users: DataFrame, closed: DataFrame) -> DataFrame:
    return _ranked(users, closed, ["monetary_value"])


def rfm_segments(users: DataFrame, closed: DataFrame) -> DataFrame:
    """All three quintiles per user, from one aggregate and one sorted layout."""
    return _ranked(users, closed, ["recency", "frequency", "monetary_value"])
