"""Streaming jobs, run to the end of data that Spark wrote from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martworks.catalog.registry import Tables, query, ts_sql, uuid3_sql
from martworks.catalog.vaults import CATEGORY_COUNTERS, KNOWN_SQL, PRODUCT_COUNTERS, known_orders, order_dimensions, order_messages
from martworks.plans.order_vault import user_message
from martworks.functions.keys import hash_key
from martworks.operators.joins import rows_absent
from martworks.operators.vault import load_hub, version_rows
from martworks.session import reliable, run_dir, write_table
from martworks.sources.history import HistoryStore
from martworks.sources.runs import RunStore
from martworks.sources.static import StaticSide
from martworks.streaming.campaigns import SUBSCRIBER, campaign_sinks, run_campaigns
from martworks.streaming.counters import read_counters, run_counters
from martworks.streaming.letters import DeadLetters, ParkedOrders
from martworks.streaming.orders import order_writer, release_parked, run_orders
from martworks.streaming.sinks import batch_sink
from martworks.streaming.vault import OrderVault

_NOW = 1705276800  # 2024-01-15 00:00:00 UTC


def _stream(t: Tables, df: DataFrame, path: str, per_trigger: int = 0) -> DataFrame:
    """The rows as files, read back as a stream."""
    write_table(df, path)
    reader = t.spark.readStream.schema(df.schema)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.parquet(path)


@query("campaign_stream", f"""with c as (select *, epoch(date_trunc('second', ts))::bigint as t0 from events)
select user_id::varchar as restaurant_id, event_id::varchar as adv_campaign_id, event_type as adv_campaign_content,
 t0 as adv_campaign_datetime_start, t0 + 864000 as adv_campaign_datetime_end, c_custkey::varchar as client_id, {_NOW}::bigint as trigger_datetime_created
from c join customer on c_nationkey = user_id where t0 < {_NOW} and t0 + 864000 > {_NOW}""")
def _(t):
    root = run_dir(t.spark, "campaigns")
    start = F.unix_timestamp(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("adv_campaign_datetime_start")
    fields = t.events.select(
        F.col("user_id").cast("string").alias("restaurant_id"), F.col("event_id").cast("string").alias("adv_campaign_id"),
        F.col("event_type").alias("adv_campaign_content"), F.lit("owner").alias("adv_campaign_owner"),
        F.lit("contact").alias("adv_campaign_owner_contact"), start)
    fields = fields.withColumn("adv_campaign_datetime_end", F.col("adv_campaign_datetime_start") + 864000).withColumn(
        "datetime_created", F.col("adv_campaign_datetime_start"))
    messages = _stream(t, fields.select(F.to_json(F.struct(*fields.columns)).alias("value")), f"{root}/in")
    clients = t.customer.select(F.col("c_custkey").cast("string").alias("client_id"), F.col("c_nationkey").cast("string").alias("restaurant_id"))
    sinks = campaign_sinks(f"{root}/snapshot", None, None, batch_sink(f"{root}/feedback"))
    subscribers = StaticSide(t.spark, f"{root}/static", f"subscribers_{root[-32:]}", "restaurant_id", SUBSCRIBER)
    subscribers.refresh(clients.unionByName(clients), "v1")
    run_campaigns(messages, subscribers, sinks, f"{root}/checkpoint", f"{root}/dead", F.lit(_NOW)).awaitTermination()
    return t.spark.read.parquet(f"{root}/feedback").drop("batch_id", "adv_campaign_owner", "adv_campaign_owner_contact", "datetime_created")


@query("counters_stream", PRODUCT_COUNTERS)
def _(t):
    root = run_dir(t.spark, "counters")
    messages = _stream(t, user_message(known_orders(t)), f"{root}/in", 4)
    run_counters(messages, "product", f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return read_counters(t.spark, f"{root}/out", "product")


def _order_json(t: Tables) -> DataFrame:
    return order_messages(t).select("object_id", F.to_json(F.struct("object_id", "object_type", "sent_dttm", "payload")).alias("value"))


def _load_dt(batch: int) -> str:
    return f"2002-01-{1 + batch % 28:02d} 00:00:00"


@query("order_stream", CATEGORY_COUNTERS)
def _(t):
    root = run_dir(t.spark, "orders")
    orders = _stream(t, _order_json(t).select("value"), f"{root}/in")
    run_orders(orders, order_writer(f"{root}/dds", *order_dimensions(t), _load_dt), f"{root}/orders-checkpoint").awaitTermination()
    messages = t.spark.readStream.schema(t.spark.read.parquet(f"{root}/dds/messages").schema).parquet(f"{root}/dds/messages")
    run_counters(messages, "category", f"{root}/out", f"{root}/counter-checkpoint").awaitTermination()
    return read_counters(t.spark, f"{root}/out", "category")


# ---- messages that cannot be used (yet) ------------------------------------------------


def _spoilt(t: Tables) -> DataFrame:
    """Order messages of which some are cut off, blank, without key or of another type."""
    kind = F.col("object_id") % 20
    return _order_json(t).select(
        F.when(kind == 3, F.substring("value", 1, 30)).when(kind == 4, F.lit(" ")).when(kind == 5, F.lit('{"object_type":"order"}'))
        .when(kind == 6, F.concat(F.lit('{"object_id":"no'), F.col("object_id").cast("string"), F.lit('"}'))).when(kind == 7, None)
        .otherwise(F.col("value")).alias("value"))


_SPOILT = """spoilt as (select case o_orderkey % 20 when 3 then left('{"object_id":' || o_orderkey || ',"object_type":"order","sent_dttm":"', 30)
  when 4 then ' ' when 5 then '{"object_type":"order"}' when 6 then '{"object_id":"no' || o_orderkey || '"}' when 7 then null else '' end as value,
  o_orderkey % 20 as kind, o_orderkey from orders)"""


@query("malformed_messages", f"""with {_SPOILT} select value, case kind when 3 then 'malformed' when 6 then 'malformed' when 5 then 'no object_id' else 'empty' end as reason,
 count(*) as n from spoilt where kind between 3 and 7 group by 1, 2""")
def _(t):
    root = run_dir(t.spark, "spoilt")
    run_orders(_stream(t, _spoilt(t), f"{root}/in", 4), order_writer(f"{root}/dds", *order_dimensions(t), _load_dt), f"{root}/checkpoint").awaitTermination()
    return DeadLetters(t.spark, f"{root}/dds/dead").read()


@query("message_accounts", f"""with {_SPOILT}, {KNOWN_SQL} select count(*) as n_in, count(*) filter (kind between 3 and 7) as n_malformed,
 count(*) filter (kind not between 3 and 7 and o_orderkey in (select o_orderkey from known)) as n_known,
 count(*) filter (kind not between 3 and 7 and o_orderkey not in (select o_orderkey from known)) as n_parked, 0::bigint as n_repeated from spoilt""")
def _(t):
    root = run_dir(t.spark, "accounts")
    run_orders(_stream(t, _spoilt(t), f"{root}/in"), order_writer(f"{root}/dds", *order_dimensions(t), _load_dt), f"{root}/checkpoint").awaitTermination()
    names = ["n_in", "n_malformed", "n_known", "n_parked", "n_repeated"]
    return t.spark.read.parquet(f"{root}/dds/batches").agg(*[F.sum(n).alias(n) for n in names])


@query("parked_orders", f"""with {KNOWN_SQL} select o_orderkey as order_id, case when o_custkey % 3 = 0 then 'released' else 'known' end as how from known
union all select o_orderkey, 'parked' from orders where o_orderkey not in (select o_orderkey from known)""")
def _(t):
    root = run_dir(t.spark, "parked")
    users, restaurants, menu = order_dimensions(t)
    late = F.col("id").cast("bigint") % 3 == 0
    run_orders(_stream(t, _order_json(t).select("value"), f"{root}/in"),
               order_writer(f"{root}/dds", users.where(~late), restaurants, menu, _load_dt), f"{root}/checkpoint").awaitTermination()
    early = OrderVault(t.spark, f"{root}/dds/vault").table("h_order").select("order_id", F.lit("known").alias("how"))
    early = reliable(early)
    nothing = (restaurants.where("false"), menu.where("false"))
    release_parked(f"{root}/dds", (users.where(late), *nothing), (users, restaurants, menu), 0, _load_dt(27))
    all_known = OrderVault(t.spark, f"{root}/dds/vault").table("h_order").select("order_id")
    released = all_known.join(early, "order_id", "left_anti").withColumn("how", F.lit("released"))
    waiting = ParkedOrders(t.spark, f"{root}/dds").parked().select(F.col("object_id").alias("order_id"), F.lit("parked").alias("how"))
    return early.unionByName(released).unionByName(waiting)


# ---- histories and stores --------------------------------------------------------------

_STATUS_DIFF = uuid3_sql("'32:' || k || '|1:' || status")


@query("order_status_history", f"""with v as (select distinct md5(l_orderkey::varchar) as k, l_returnflag as status, l_shipdate as t from lineitem),
d as (select *, {_STATUS_DIFF} as hashdiff from v),
c as (select *, lag(hashdiff) over (partition by k order by t, hashdiff) as before from d)
select k as hk_order, status, hashdiff, {ts_sql('t')} as load_dt, 'files' as load_src from c where before is null or before <> hashdiff""")
def _(t):
    root = run_dir(t.spark, "history")
    store = HistoryStore(t.spark, root, ["hk_order"], "hk_order string, status string")
    versions = version_rows(t.lineitem.withColumn("hk_order", hash_key(F.col("l_orderkey"))).withColumnRenamed("l_returnflag", "status"),
                            "hk_order", ["status"], "files", "l_shipdate")
    # dealt by hash, so versions come late, and most of them twice
    part = F.pmod(F.xxhash64("hk_order", "load_dt", "status"), F.lit(3))
    for number in range(3):
        store.load(versions.where(part >= number) if number < 2 else versions, number, unique=True)
    return store.changes()


@query("bucketed_hub", f"""select md5(o_orderkey::varchar) as hk_order, o_orderkey, ('2002-01-' || lpad((1 + least(o_orderkey % 10, (o_orderkey // 7) % 10))::varchar, 2, '0')
 || ' 00:00:00.000000') as load_dt, 'files' as load_src from orders""")
def _(t):
    """Ten loads of which most keys come twice, merged on the way."""
    root = run_dir(t.spark, "hub")
    store = RunStore(t.spark, root, "hk_order string, o_orderkey long, load_dt timestamp_ntz, load_src string", ["hk_order"], fan=3)
    first, second = F.col("o_orderkey") % 10, F.floor(F.col("o_orderkey") / 7) % 10
    for number in range(10):
        rows = reliable(load_hub(t.orders.where((first == number) | (second == number)), "hk_order", "o_orderkey", None, "files", _load_dt(number)))
        store.append(rows_absent(rows, store.near(rows), "hk_order"), number)
    return store.read()
