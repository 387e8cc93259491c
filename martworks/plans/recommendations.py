"""Pairs of users to introduce: a shared channel, no contact so far, close by."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from martworks.functions.geo import EARTH_KM, haversine_km, metre_cell
from martworks.operators.grouping import latest_per_key
from martworks.operators.joins import growing, salted_pairs
from martworks.plans.geo_events import all_messages, geo_events, subscriptions
from martworks.session import reliable

# The cell itself and the 13 cells ahead of it: each pair of touching cells meets once.
_AHEAD = [(x, y, z) for x in (-1, 0, 1) for y in (-1, 0, 1) for z in (-1, 0, 1) if (x, y, z) >= (0, 0, 0)]
# Keys a user carries at most to tell which one owns a pair.
SHORT_LIST = 256


def contacts(events: DataFrame) -> DataFrame:
    """Unordered pairs of users who wrote to each other directly."""
    pairs = all_messages(events).where("user_id is not null and user_id_to is not null")
    return pairs.select(
        F.least("user_id", "user_id_to").alias("user_left"), F.greatest("user_id", "user_id_to").alias("user_right")).distinct()


def _on_sphere(km: float) -> Column:
    """Whether the sphere crosses the cube of edge `km` named by _ox, _oy, _oz."""
    edge, slack = km / EARTH_KM, 1e-9
    near2, far2 = F.lit(0.0), F.lit(0.0)
    for a in "xyz":
        low, high = F.col(f"_o{a}") * edge, (F.col(f"_o{a}") + 1) * edge
        inner = F.when((low <= 0) & (high >= 0), F.lit(0.0)).otherwise(F.least(F.abs(low), F.abs(high)))
        outer = F.greatest(F.abs(low), F.abs(high))
        near2, far2 = near2 + inner * inner, far2 + outer * outer
    return (near2 <= 1 + slack) & (far2 >= 1 - slack)


def _met(apart: DataFrame, near: DataFrame, km: float) -> DataFrame:
    """The pairs of `apart` that are about `km` apart at most."""
    who = near.select("user_id", "lat", "lon").distinct()
    at = lambda side: who.select(F.col("user_id").alias(f"user_{side}"), F.col("lat").alias(f"lat_{side}"), F.col("lon").alias(f"lon_{side}"))
    km_apart = haversine_km(F.col("lat_left"), F.col("lon_left"), F.col("lat_right"), F.col("lon_right"))
    return apart.join(at("left"), "user_left").join(at("right"), "user_right").where(km_apart <= km * 1.001).select("user_left", "user_right")


def near_pairs(points: DataFrame, key: str, km: float, block: int = 5000, most: int = SHORT_LIST, about: DataFrame | None = None,
               apart: DataFrame | None = None) -> DataFrame:
    """Unordered pairs (u < v) that share `key` and are at most `km` apart.

    `points` has one row per (user_id, key) with lat and lon, the same in all
    rows of a user. The join is on (key, cell of edge km), not on the key: users
    of a channel who are far apart never meet. Occupied cells are counted and
    paired first, so a user row is repeated for occupied neighbours only, and a
    user alone in a neighbourhood is not joined at all. Two users of one cell
    are within sqrt(3) km, so the candidates stay within a constant factor of the
    answers. Hot cells are cut into blocks.

    A pair belongs to the smallest key under which it meets: each user carries
    the keys that have somebody near, and other keys pass the pair over, so
    pairs need no `distinct`. Users with more than `most` such keys carry none;
    only pairs with such a user are made unique afterwards.

    What else a pair needs comes with its users, since pairs can be very many more than
    users: the columns of `about` (user_id, …) for the left user, without whom the pair
    is left out, and the partners of the left user in `apart` (user_left, user_right), pairs
    to be left out. Pairs whose left user has more than `most` partners near are compared afterwards.
    """
    axes = ["_cx", "_cy", "_cz"]
    cell = metre_cell(F.col("lat"), F.col("lon"), km)
    # written, because cells, lists and both sides of the join read it
    placed = reliable(points.select("user_id", key, "lat", "lon", *[c.alias(f"_c{a}") for a, c in cell.items()]))
    cells = placed.groupBy(key, *axes).agg(F.count("*").alias("_n"))
    steps = F.explode(F.array(*[F.struct(*[F.lit(v).alias(a) for a, v in zip("xyz", at)]) for at in _AHEAD]))
    ahead = cells.withColumn("_step", steps).select(
        key, *axes, "_n", *[(F.col(f"_c{a}") + F.col(f"_step.{a}")).alias(f"_o{a}") for a in "xyz"]).where(_on_sphere(km))
    same = (F.col("_cx") == F.col("_ox")) & (F.col("_cy") == F.col("_oy")) & (F.col("_cz") == F.col("_oz"))
    others = cells.select(key, *[F.col(f"_c{a}").alias(f"_o{a}") for a in "xyz"], F.col("_n").alias("_no"))
    meet = reliable(ahead.withColumn("_same", same).where(~F.col("_same") | (F.col("_n") > 1)).join(
        others, [key, "_ox", "_oy", "_oz"]))
    sizes = meet.groupBy(key, "_ox", "_oy", "_oz").agg(F.sum("_n").alias("_nl"), F.max("_no").alias("_nr"))
    busy = meet.select(key, *axes).unionByName(
        meet.select(key, *[F.col(f"_o{a}").alias(f"_c{a}") for a in "xyz"])).distinct()
    near = reliable(placed.join(busy, [key, *axes]))

    counts = near.groupBy("user_id").agg(F.count("*").alias("_keys"))
    short = counts.where(F.col("_keys") <= most).select("user_id")
    lists = near.select("user_id", key).join(short, "user_id").groupBy("user_id").agg(F.collect_set(key).alias("_list"))
    listed = near.join(lists, "user_id", "left")
    met, told = None, []
    if apart is not None:
        met = reliable(_met(apart, near, km))
        partners = met.groupBy(F.col("user_left").alias("user_id")).agg(F.count("*").alias("_partners"))
        some = met.withColumnRenamed("user_left", "user_id").join(partners.where(F.col("_partners") <= most), "user_id")
        listed = listed.join(some.groupBy("user_id").agg(F.collect_list("user_right").alias("_apart")), "user_id", "left").join(
            partners.where(F.col("_partners") > most).select("user_id", F.lit(True).alias("_many")), "user_id", "left")
    else:
        listed = listed.withColumns({"_apart": F.lit(None).cast("array<bigint>"), "_many": F.lit(False)})
    if about is not None:
        told = [c for c in about.columns if c != "user_id"]
        listed = listed.join(about.select("user_id", F.struct(*told).alias("_about")), "user_id", "left")
    else:
        listed = listed.withColumn("_about", F.lit(True))
    own = [F.col("_list"), F.col("_apart"), F.coalesce("_many", F.lit(False)).alias("_many"), F.col("_about")]
    with_user = lambda n: [F.col("user_id").alias(n), F.col("lat").alias(f"lat_{n}"), F.col("lon").alias(f"lon_{n}"),
                           *[c.alias(f"{name}_{n}") for c, name in zip(own, ("_list", "_apart", "_many", "_about"))]]
    left = listed.join(meet, [key, *axes]).select(key, *with_user("u"), "_same", "_ox", "_oy", "_oz")
    right = listed.select(key, *with_user("v"), *[F.col(f"_c{a}").alias(f"_o{a}") for a in "xyz"])
    close = haversine_km(F.col("lat_u"), F.col("lon_u"), F.col("lat_v"), F.col("lon_v")) <= km
    once = (F.col("u") != F.col("v")) & (~F.col("_same") | (F.col("u") < F.col("v")))

    def of_left(name: str) -> Column:
        return F.when(F.col("u") < F.col("v"), F.col(f"{name}_u")).otherwise(F.col(f"{name}_v"))

    wanted = of_left("_about").isNotNull() & ~F.coalesce(F.array_contains(of_left("_apart"), F.greatest("u", "v")), F.lit(False))

    def pairs(a: DataFrame, b: DataFrame, condition: Column) -> DataFrame:
        both = salted_pairs(a, b, [key, "_ox", "_oy", "_oz"], F.col("u"), F.col("v"), block, sizes)
        return both.where(once & close & condition & wanted).select(
            F.least("u", "v").alias("user_left"), F.greatest("u", "v").alias("user_right"), *[of_left("_about")[c].alias(c) for c in told])

    owner = F.array_min(F.array_intersect("_list_u", "_list_v")) == F.col(key)
    long_lists = bool(counts.where(F.col("_keys") > most).head(1))

    def unique_pairs(a: DataFrame, b: DataFrame, condition: Column) -> DataFrame:
        owned = pairs(a.where("_list_u is not null"), b.where("_list_v is not null"), owner & condition)
        if not long_lists:
            return owned
        rest = pairs(a.where("_list_u is null"), b, condition).unionByName(
            pairs(a.where("_list_u is not null"), b.where("_list_v is null"), condition))
        return owned.unionByName(rest.distinct())

    if met is None or not partners.where(F.col("_partners") > most).head(1):
        return unique_pairs(left, right, F.lit(True))
    many = of_left("_many")
    later = unique_pairs(left.where("_many_u"), right, many).unionByName(unique_pairs(left.where("not _many_u"), right.where("_many_v"), many))
    return unique_pairs(left, right, ~many).unionByName(later.join(growing(met), ["user_left", "user_right"], "left_anti").select(
        "user_left", "user_right", *told))


def recommendation_mart(events: DataFrame, places: DataFrame, users: DataFrame, run_date: str, km: float = 1.0) -> DataFrame:
    """Pairs with the zone and local time of the left user.

    A user's position is that of the latest message with coordinates; `users` is
    the user mart.
    """
    messages = all_messages(events).where("user_id is not null and lat is not null and lon is not null")
    position = latest_per_key(messages.select("user_id", "ts", "lat", "lon"), ["user_id"], ["ts", "lat", "lon"])
    members = subscriptions(events).select("user_id", "channel").where("user_id is not null and channel is not null").distinct()
    zones = geo_events(position, places).select("user_id", F.col("city_id").alias("zone_id"))
    about = zones.join(users.select("user_id", "local_time"), "user_id")
    pairs = near_pairs(members.join(position.drop("ts"), "user_id"), "channel", km, about=about, apart=contacts(events))
    return pairs.select("user_left", "user_right", F.lit(run_date).cast("date").alias("processed_dttm"), "zone_id", "local_time")
