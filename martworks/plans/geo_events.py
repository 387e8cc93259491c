"""Typed views of chat events and the city each one happened in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from martworks.functions.geo import nearest_place

# State capitals whose name is also their time zone.
ZONE_CITIES = ["Brisbane", "Sydney", "Adelaide", "Perth", "Melbourne", "Darwin", "Hobart", "Canberra"]
ZONE_PREFIX = "Australia/"


def _when() -> Column:
    return F.to_timestamp_ntz(F.col("event.datetime"))


def _view(ev: DataFrame, kind: str, condition: Column | None, user: Column, **extra: Column) -> DataFrame:
    rows = ev.where(F.col("event_type") == kind)
    if condition is not None:
        rows = rows.where(condition)
    return rows.select(
        user.cast("bigint").alias("user_id"), *[c.alias(n) for n, c in extra.items()],
        _when().alias("ts"), F.to_date(_when()).alias("date"), "lat", "lon")


def channel_messages(ev: DataFrame) -> DataFrame:
    return _view(ev, "message", F.col("event.message_channel_to").isNotNull(), F.col("event.message_from"))


def all_messages(ev: DataFrame) -> DataFrame:
    return _view(ev, "message", None, F.col("event.message_from"), user_id_to=F.col("event.message_to"))


def reactions(ev: DataFrame) -> DataFrame:
    return _view(ev, "reaction", F.col("lat").isNotNull(), F.col("event.reaction_from"))


def subscriptions(ev: DataFrame) -> DataFrame:
    return _view(ev, "subscription", F.col("lat").isNotNull(), F.col("event.user"), channel=F.col("event.subscription_channel"))


def activity(ev: DataFrame) -> DataFrame:
    """Channel messages, reactions and subscriptions with their kind, in one scan."""
    e, kind, placed = F.col("event"), F.col("event_type"), F.col("lat").isNotNull()
    message = (kind == "message") & e["message_channel_to"].isNotNull()
    reaction, subscription = (kind == "reaction") & placed, (kind == "subscription") & placed
    user = F.when(kind == "message", e["message_from"]).when(kind == "reaction", e["reaction_from"].cast("bigint")).otherwise(
        e["user"].cast("bigint"))
    return ev.where(message | reaction | subscription).select(
        kind.alias("kind"), user.alias("user_id"), _when().alias("ts"), F.to_date(_when()).alias("date"), "lat", "lon")


def geo_events(points: DataFrame, places: DataFrame) -> DataFrame:
    """Events with their nearest city; events without coordinates are left out."""
    return nearest_place(points, places).withColumnsRenamed({"place_id": "city_id", "place": "city"})


def city_timezones(places: DataFrame) -> DataFrame:
    """Zone of every city: its own for a capital, else that of the nearest capital."""
    capital = F.col("place").isin(ZONE_CITIES)
    own = places.where(capital).select(
        F.col("place_id").alias("id"), F.col("place").alias("city"), F.concat(F.lit(ZONE_PREFIX), "place").alias("timezone"))
    others = places.where(~capital).select(F.col("place_id").alias("id"), F.col("place").alias("city"), "lat", "lon")
    near = nearest_place(others, places.where(capital)).select(
        "id", "city", F.concat(F.lit(ZONE_PREFIX), "place").alias("timezone"))
    return own.unionByName(near)
