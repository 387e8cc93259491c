"""Per user: actual and home city, travels, local time of the last message."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martworks.functions.time import local_time
from martworks.operators.sequences import changes, neighbour, numbered, ordered_runs
from martworks.plans.geo_events import channel_messages, city_timezones, geo_events

TIE = ["lat", "lon"]


def user_cities(located: DataFrame, run_date: str, home_days: int = 27) -> DataFrame:
    """City of the last message, and of the last one at least `home_days` old."""
    row = F.struct("ts", *TIE, "city", "city_id")
    old = F.datediff(F.lit(run_date).cast("date"), F.col("date")) >= home_days
    return located.groupBy("user_id").agg(
        F.max(row).alias("last"), F.max(F.when(old, row)).alias("old")).select(
            "user_id", F.col("last.ts").alias("last_ts"), F.col("last.city").alias("actual_city"), F.col("last.city_id").alias("actual_city_id"),
            F.coalesce(F.col("old.city"), F.col("last.city")).alias("home_city"))


def home_by_stay(located: DataFrame, run_date: str, min_stay_days: int) -> DataFrame:
    """Other reading of home: the latest city stayed in for a run of days.

    A stay lasts from its first message to the first message elsewhere, or to the
    run date.
    """
    moves = changes(located, ["user_id"], "ts", TIE, "city_id")
    ends = neighbour(moves, ["user_id"], "ts", TIE, "date", "left_on", forward=True)
    stay = F.datediff(F.coalesce("left_on", F.lit(run_date).cast("date")), F.col("date"))
    return ends.where(stay >= min_stay_days).groupBy("user_id").agg(
        F.max(F.struct("ts", *TIE, "city")).alias("h")).select("user_id", F.col("h.city").alias("home_city"))


def _moves(located: DataFrame) -> DataFrame:
    return changes(located.select("user_id", "ts", *TIE, "city", "city_id"), ["user_id"], "ts", TIE, "city_id")


def travel_steps(located: DataFrame) -> DataFrame:
    """The cities a user moved through, one row each: user_id, no (from 1), city, city_id, ts.

    The form for users with very many moves: no row grows with their number.
    """
    return numbered(_moves(located), ["user_id"], ["ts", *TIE]).select("user_id", "no", "city", "city_id", "ts")


def travels(located: DataFrame) -> DataFrame:
    """Number and ordered list of the cities a user moved through, as one text per user."""
    return ordered_runs(_moves(located), ["user_id"], "ts", TIE, "city", "travel_array").withColumnRenamed(
        "travel_array_count", "travel_count")


def user_mart(events: DataFrame, places: DataFrame, run_date: str, home_days: int = 27,
              min_stay_days: int | None = None) -> DataFrame:
    """Cities are told apart by id: two of one name are two cities."""
    located = geo_events(channel_messages(events), places).select("user_id", "ts", "date", *TIE, "city", "city_id")
    cities = user_cities(located, run_date, home_days)
    if min_stay_days is not None:
        stays = home_by_stay(located, run_date, min_stay_days)
        cities = cities.drop("home_city").join(stays, "user_id", "left").withColumn(
            "home_city", F.coalesce("home_city", "actual_city"))
    zones = city_timezones(places).select(F.col("id").alias("actual_city_id"), "timezone")
    return (
        cities.join(travels(located), "user_id", "left")
        .join(zones, "actual_city_id", "left")
        .select("user_id", "actual_city", "home_city", "travel_count", "travel_array",
                local_time(F.col("last_ts"), F.col("timezone")).alias("local_time"))
    )
