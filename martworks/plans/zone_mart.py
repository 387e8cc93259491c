"""Week and month counts of activity per city."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martworks.functions.time import trunc_month, trunc_week
from martworks.plans.geo_events import activity, geo_events

KINDS = ["message", "reaction", "subscription", "registration"]


def _week(*columns: str) -> list:
    return [*columns, trunc_month(F.col("date")).alias("month"), trunc_week(F.col("date")).alias("week")]


def zone_counts(events: DataFrame, places: DataFrame) -> DataFrame:
    """City, month, week and the count of each kind, all kinds in one aggregate.

    A registration is a user's first channel message; those weeks are always
    weeks with messages, so they join on the left.
    """
    located = geo_events(activity(events), places)
    kinds = located.groupBy(*_week("city_id")).agg(
        *[F.count_if(F.col("kind") == k).alias(f"week_{k}") for k in KINDS if k != "registration"])
    first = (
        located.where(F.col("kind") == "message").groupBy("user_id")
        .agg(F.min(F.struct("ts", "lat", "lon", "city_id", "date")).alias("first")).select("first.*")
    )
    registered = first.groupBy(*_week("city_id")).agg(F.count("*").alias("week_registration"))
    return kinds.join(registered, ["city_id", "month", "week"], "left").fillna(0, ["week_registration"])


def geo_zone_mart(events: DataFrame, places: DataFrame, full: bool = False, zero: bool = False) -> DataFrame:
    """Counts per zone; weeks without messages only with `full`, 0 instead of null with `zero`.

    A week that spans two months stays split, and carries each month's total.
    """
    weeks = zone_counts(events, places)
    # a few rows per city: totals are added up from the week rows
    months = weeks.groupBy("city_id", "month").agg(*[F.sum(f"week_{k}").alias(f"month_{k}") for k in KINDS])
    both = weeks.join(months, ["city_id", "month"])
    if not full:
        both = both.where("week_message > 0")

    def shown(column: str, kind: str):
        value = F.col(column)
        return value if zero else F.when(F.col(f"week_{kind}") > 0, value)

    names = {"message": "message", "reaction": "reaction", "subscription": "subscription", "registration": "user"}
    return both.select(
        "month", "week", F.col("city_id").alias("zone_id"),
        *[shown(f"week_{k}", k).alias(f"week_{n}") for k, n in names.items()],
        *[shown(f"month_{k}", k).alias(f"month_{n}") for k, n in names.items()])
