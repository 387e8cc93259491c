"""Geographic marts over events placed on a map by their number."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martworks.catalog.registry import Tables, query, ts_sql
from martworks.plans import geo_events as g
from martworks.plans.recommendations import recommendation_mart
from martworks.plans.user_mart import travel_steps, travels, user_mart
from martworks.plans.zone_mart import geo_zone_mart

# Event types of the input taken as chat activity.
_KINDS = {"click": "message", "view": "reaction", "signup": "subscription"}
_RUN_DATE = "2024-01-31"


def places(t: Tables) -> DataFrame:
    """Nations as cities; the first eight carry the capitals' names."""
    key = F.col("n_nationkey")
    name = F.coalesce(*[F.when(key == i, F.lit(c)) for i, c in enumerate(g.ZONE_CITIES)], F.col("n_name"))
    return t.nation.select(
        key.alias("place_id"), name.alias("place"), (-10 - (key * 7 % 34) * F.lit(1.0)).alias("lat"),
        (113 + (key * 11 % 40) * F.lit(1.0)).alias("lon"))


def many_places(t: Tables) -> DataFrame:
    """Customers as cities: a list that grows with the data."""
    key = F.col("c_custkey")
    return t.customer.select(
        key.alias("place_id"), F.col("c_name").alias("place"), (-10 - (key * 7919 % 34000) / F.lit(1000.0)).alias("lat"),
        (113 + (key * 104729 % 40000) / F.lit(1000.0)).alias("lon"))


def chat_events(t: Tables, lat, lon) -> DataFrame:
    """The events as nested chat events; a quarter of the messages are direct."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    kind = F.coalesce(*[F.when(F.col("event_type") == a, F.lit(b)) for a, b in _KINDS.items()], F.col("event_type"))
    message = F.col("event_type") == "click"
    return t.events.select(
        F.struct(
            F.when(message, F.col("user_id")).alias("message_from"),
            F.when(message, k).alias("message_to"),
            F.when(message & (k < 75), k).alias("message_channel_to"),
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("datetime"),
            F.when(F.col("event_type") == "view", F.col("user_id").cast("string")).alias("reaction_from"),
            F.when(F.col("event_type") == "signup", F.col("user_id").cast("string")).alias("user"),
            F.when(F.col("event_type") == "signup", k).alias("subscription_channel")).alias("event"),
        kind.alias("event_type"), lat.alias("lat"), lon.alias("lon"))


def _wide() -> tuple:
    e = F.col("event_id")
    # every 50th value of props has no coordinates
    lat = F.when(F.get_json_object("props", "$.k").cast("int") != 49, -10 - (e * 7919 % 34000) / F.lit(1000.0))
    return lat, 113 + (e * 104729 % 40000) / F.lit(1000.0)


def _town() -> tuple:
    e = F.col("event_id")
    return -33 - (e * 7919 % 100) / F.lit(1000.0), 151 + (e * 104729 % 100) / F.lit(1000.0)


def _capital_sql(x: str) -> str:
    return "case " + " ".join(f"when {x} = {i} then '{c}'" for i, c in enumerate(g.ZONE_CITIES)) + " end"


def _km_sql(a: str, b: str) -> str:
    return (f"(2 * 6371 * asin(sqrt(least(1.0, power(sin((radians({b}.lat) - radians({a}.lat)) / 2), 2) + cos(radians({a}.lat)) * cos(radians({b}.lat)) * "
            f"power(sin((radians({b}.lon) - radians({a}.lon)) / 2), 2)))))")


_PLACES = f"""place as (select n_nationkey as place_id, coalesce({_capital_sql('n_nationkey')}, n_name) as place,
  -10 - (n_nationkey * 7 % 34) * 1.0::double as lat, 113 + (n_nationkey * 11 % 40) * 1.0::double as lon from nation)"""
_WIDE = """ev as (select event_id, ts, user_id, event_type, json_extract_string(props, '$.k')::int as k,
  -10 - (event_id * 7919 % 34000) / 1000.0::double as lat, 113 + (event_id * 104729 % 40000) / 1000.0::double as lon from events)"""
_LOCATED = f"""with {_PLACES}, {_WIDE}, geo as (
  select ev.*, p.place_id as city_id, p.place as city, {_km_sql('ev', 'p')} as km from ev cross join place p
  where k <> 49 and event_type in ('click', 'view', 'signup')
  qualify row_number() over (partition by event_id order by km, place_id) = 1),
msg as (select * from geo where event_type = 'click' and k < 75)"""


@query("geo_events", _LOCATED + f""" select user_id, {ts_sql('ts')} as ts, strftime(ts, '%Y-%m-%d') as date, lat, lon, city_id::bigint as city_id, city,
 round(km, 6) as km from msg""")
def _(t):
    rows = g.geo_events(g.channel_messages(chat_events(t, *_wide())), places(t))
    return rows.withColumn("km", F.round("km", 6))


@query("nearest_city_by_cells", f"""with ev as (select event_id, -10 - (event_id * 7919 % 34000) / 1000.0::double as lat,
  113 + (event_id * 104729 % 40000) / 1000.0::double as lon from events),
place as (select c_custkey as place_id, c_name as place, -10 - (c_custkey * 7919 % 34000) / 1000.0::double as lat,
  113 + (c_custkey * 104729 % 40000) / 1000.0::double as lon from customer)
select event_id, round(min({_km_sql('ev', 'p')}), 6) as km from ev cross join place p group by event_id""")
def _(t):
    e = F.col("event_id")
    points = t.events.select("event_id", (-10 - (e * 7919 % 34000) / F.lit(1000.0)).alias("lat"),
                             (113 + (e * 104729 % 40000) / F.lit(1000.0)).alias("lon"))
    return g.geo_events(points, many_places(t)).select("event_id", F.round("km", 6).alias("km"))


@query("city_timezones", f"""with {_PLACES}, near as (
  select o.place_id, o.place, c.place as capital, row_number() over (partition by o.place_id order by {_km_sql('o', 'c')}, c.place_id) as rn
  from place o cross join place c where o.place_id >= 8 and c.place_id < 8)
select place_id::bigint as id, place as city, 'Australia/' || place as timezone from place where place_id < 8
union all select place_id, place, 'Australia/' || capital from near where rn = 1""")
def _(t):
    return g.city_timezones(places(t))


# Summer offsets of the eight zones in January 2024, in minutes.
_OFFSET = """case capital when 'Brisbane' then 600 when 'Perth' then 480 when 'Adelaide' then 630 when 'Darwin' then 570 else 660 end"""
_MART = _LOCATED + f""", near as (
  select o.place as city, c.place as capital from place o cross join place c where c.place_id < 8
  qualify row_number() over (partition by o.place_id order by {_km_sql('o', 'c')}, c.place_id) = 1),
last as (select user_id, city as actual_city, ts as last_ts from msg qualify row_number() over (partition by user_id order by ts desc, lat desc, lon desc) = 1),
home as (select user_id, city as home_city from msg where date_diff('day', ts::date, date '{_RUN_DATE}') >= 27
  qualify row_number() over (partition by user_id order by ts desc, lat desc, lon desc) = 1),
moves as (select user_id, ts, lat, lon, city from (select *, lag(city) over (partition by user_id order by ts, lat, lon) as prev from msg)
  where prev is null or prev <> city),
trav as (select user_id, count(*) as travel_count, string_agg(city, ', ' order by ts, lat, lon) as travel_array from moves group by 1)"""


@query("user_mart", _MART + f""" select last.user_id, actual_city, coalesce(home_city, actual_city) as home_city, travel_count, travel_array,
 {ts_sql(f"(last_ts + interval 1 minute * ({_OFFSET}))")} as local_time
from last left join home using (user_id) left join trav using (user_id) left join near on near.city = actual_city""")
def _(t):
    return user_mart(chat_events(t, *_wide()), places(t), _RUN_DATE)


@query("travel_list", _MART + " select user_id, travel_count, travel_array from trav")
def _(t):
    return travels(g.geo_events(g.channel_messages(chat_events(t, *_wide())), places(t)))


@query("travel_steps", _MART + f""" select user_id, row_number() over (partition by user_id order by ts, lat, lon) as no, city, {ts_sql('ts')} as ts from moves""")
def _(t):
    return travel_steps(g.geo_events(g.channel_messages(chat_events(t, *_wide())), places(t))).drop("city_id")


@query("geo_zone_mart", _LOCATED + """, acts as (
  select city_id, ts, 'message' as kind from msg union all select city_id, ts, 'reaction' from geo where event_type = 'view'
  union all select city_id, ts, 'subscription' from geo where event_type = 'signup'
  union all select city_id, ts, 'user' from (select * from msg qualify row_number() over (partition by user_id order by ts, lat, lon) = 1)),
weeks as (select city_id, date_trunc('month', ts) as month, date_trunc('week', ts) as week, kind, count(*) as n from acts group by all),
months as (select city_id, month, kind, sum(n)::bigint as n from weeks group by all),
both_ as (select w.*, m.n as mn from weeks w join months m using (city_id, month, kind))
select strftime(month, '%Y-%m-%d') as month, strftime(week, '%Y-%m-%d') as week, city_id::bigint as zone_id,
 max(n) filter (kind = 'message') as week_message, max(n) filter (kind = 'reaction') as week_reaction,
 max(n) filter (kind = 'subscription') as week_subscription, max(n) filter (kind = 'user') as week_user,
 max(mn) filter (kind = 'message') as month_message, max(mn) filter (kind = 'reaction') as month_reaction,
 max(mn) filter (kind = 'subscription') as month_subscription, max(mn) filter (kind = 'user') as month_user
from both_ group by month, week, city_id having max(n) filter (kind = 'message') is not null""")
def _(t):
    return geo_zone_mart(chat_events(t, *_wide()), places(t))


_TOWN = """ev as (select event_id, ts, user_id, event_type, json_extract_string(props, '$.k')::int as k,
  -33 - (event_id * 7919 % 100) / 1000.0::double as lat, 151 + (event_id * 104729 % 100) / 1000.0::double as lon from events)"""


@query("recommendation_mart", f"""with {_PLACES}, {_TOWN},
pos as (select user_id, lat, lon from ev where event_type = 'click' qualify row_number() over (partition by user_id order by ts desc, lat desc, lon desc) = 1),
zone as (select pos.user_id, p.place_id from pos cross join place p qualify row_number() over (partition by user_id order by {_km_sql('pos', 'p')}, place_id) = 1),
msg as (select ev.user_id, ts, place_id from ev cross join place p where event_type = 'click' and k < 75
  qualify row_number() over (partition by event_id order by {_km_sql('ev', 'p')}, place_id) = 1),
near as (select o.place_id, c.place as capital from place o cross join place c where c.place_id < 8
  qualify row_number() over (partition by o.place_id order by {_km_sql('o', 'c')}, c.place_id) = 1),
lastmsg as (select user_id, ts + interval 1 minute * ({_OFFSET}) as local_time from msg join near using (place_id)
  qualify row_number() over (partition by user_id order by ts desc) = 1),
sub as (select distinct user_id, k from ev where event_type = 'signup'),
contact as (select distinct least(user_id, k) as u, greatest(user_id, k) as v from ev where event_type = 'click')
select distinct a.user_id as user_left, b.user_id as user_right, '{_RUN_DATE}' as processed_dttm, zone.place_id::bigint as zone_id, {ts_sql('local_time')} as local_time
from sub a join sub b on a.k = b.k and a.user_id < b.user_id join pos pa on pa.user_id = a.user_id join pos pb on pb.user_id = b.user_id
join zone on zone.user_id = a.user_id join lastmsg on lastmsg.user_id = a.user_id
where {_km_sql('pa', 'pb')} <= 1 and not exists (select 1 from contact where u = a.user_id and v = b.user_id)""")
def _(t):
    events = chat_events(t, *_town())
    cities = places(t)
    return recommendation_mart(events, cities, user_mart(events, cities, _RUN_DATE), _RUN_DATE)
