"""Load patterns, documents, files, checks and layout helpers over the given tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from martworks import schemas
from martworks.catalog.registry import Tables, money, query, ts_sql
from martworks.functions.arrays import array_find
from martworks.functions.text import canonical_json, json_field
from martworks.functions.time import calendar_partition
from martworks.operators import dims, quality
from martworks.operators.grouping import count_by
from martworks.operators.joins import enrich_items, missing_keys, rows_absent
from martworks.operators.ranking import dense_ids
from martworks.operators.sequences import running_max
from martworks.operators.upsert import appended, insert_ignore, upsert, upsert_counter
from martworks.plans import delivery
from martworks.session import reliable, run_dir
from martworks.sources import files, incremental, sinks
from martworks.sources.kafka import topic_value
from martworks.sources.paged import read_paged
from martworks.sources.state import WatermarkStore

_ORDER_COLS = f"o_orderkey, o_custkey, o_orderstatus, o_totalprice, {ts_sql('o_orderdate')} as o_orderdate, o_orderpriority"



def stored(docs: DataFrame) -> DataFrame:
    """Documents as the stored table they are in practice, not as an expression."""
    return reliable(docs)


# ---- merging -------------------------------------------------------------------------

_CHANGED = "o_orderdate >= timestamp '1998-01-01'"


def _closed_and_changed(t: Tables) -> tuple[DataFrame, DataFrame]:
    target = t.orders.where("o_orderstatus <> 'O'")
    source = t.orders.where("o_orderdate >= timestamp_ntz '1998-01-01'").withColumns(
        {"o_orderstatus": F.lit("X"), "o_orderpriority": F.lit("new")})
    return target, source


_UPSERT = f"""select o_orderkey, o_custkey, case when {_CHANGED} then 'X' else o_orderstatus end as o_orderstatus, o_totalprice,
{ts_sql('o_orderdate')} as o_orderdate, case when {_CHANGED} and o_orderstatus = 'O' then 'new' else o_orderpriority end as o_orderpriority
from orders where o_orderstatus <> 'O' or {_CHANGED}"""


@query("upsert_rows", _UPSERT)
def _(t):
    return upsert(*_closed_and_changed(t), ["o_orderkey"], ["o_orderstatus"])


@query("upsert_buckets", _UPSERT)
def _(t):
    target, source = _closed_and_changed(t)
    path = run_dir(t.spark, "buckets")
    sinks.write_bucketed(target, path, ["o_orderkey"], 16)
    sinks.upsert_table(t.spark, path, source, ["o_orderkey"], ["o_orderstatus"], 16)
    return t.spark.read.parquet(path).drop("bucket")


@query("insert_ignore", f"""select {_ORDER_COLS} from (select *, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as rn
from orders where o_custkey not in (select o_custkey from orders where o_orderpriority = '1-URGENT')) where rn = 1
union all select {_ORDER_COLS} from orders where o_orderpriority = '1-URGENT'""")
def _(t):
    target = t.orders.where("o_orderpriority = '1-URGENT'")
    return appended(target, insert_ignore(target, t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]))


@query("upsert_counter", """select o_custkey, count(*) as order_cnt from orders group by o_custkey""")
def _(t):
    count = lambda df: df.groupBy("o_custkey").agg(F.count("*").alias("order_cnt"))
    state = count(t.orders.where("o_orderdate < timestamp_ntz '1999-01-01'"))
    return upsert_counter(state, count(t.orders), ["o_custkey"], "order_cnt")


@query("rows_absent", """select c_custkey, c_name from customer where not exists (select 1 from orders where o_custkey = c_custkey and o_orderstatus = 'F')""")
def _(t):
    closed = t.orders.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return rows_absent(t.customer.select("c_custkey", "c_name"), closed, "c_custkey")


@query("full_refresh", f"""select {_ORDER_COLS.replace('o_totalprice', '(o_totalprice::decimal(14,2) * 2)::double as o_totalprice')} from orders""")
def _(t):
    root = run_dir(t.spark, "refresh")
    state = WatermarkStore(t.spark, f"{root}/state")
    sinks.full_refresh(t.orders.withColumn("o_totalprice", money("o_totalprice")), root, "orders", state)
    current = sinks.read_refreshed(t.spark, root, "orders", state)
    sinks.full_refresh(current.withColumn("o_totalprice", (F.col("o_totalprice") * 2).cast("decimal(15,2)")), root, "orders", state)
    return sinks.read_refreshed(t.spark, root, "orders", state)


@query("replace_partition", f"""select {_ORDER_COLS.replace('o_orderstatus,', "case when o_orderpriority = '5-LOW' then 'Z' else o_orderstatus end as o_orderstatus,")} from orders""")
def _(t):
    path = f"{run_dir(t.spark, 'partitions')}/orders"
    sinks.replace_partition(t.orders, path, "o_orderpriority")
    low = t.orders.where("o_orderpriority = '5-LOW'").withColumn("o_orderstatus", F.lit("Z"))
    sinks.replace_partition(low, path, "o_orderpriority")
    sinks.replace_partition(low, path, "o_orderpriority")
    return t.spark.read.parquet(path)


# ---- incremental extracts ------------------------------------------------------------

_EVENT_COLS = f"event_id, {ts_sql('ts')} as ts, user_id, event_type, value, props"


@query("incremental_by_id", f"select {_EVENT_COLS} from events where event_id > 100")
def _(t):
    return incremental.incremental_by_id(t.events, "event_id", 100)


@query("incremental_by_ts", f"select {_EVENT_COLS} from events where ts > timestamp '2024-01-10 00:00:00'")
def _(t):
    return incremental.incremental_by_ts(t.events, "ts", "2024-01-10 00:00:00", "event_id")


@query("copy_events", f"select {_EVENT_COLS} from events")
def _(t):
    root = run_dir(t.spark, "copy")
    state = WatermarkStore(t.spark, f"{root}/state")
    write = lambda df: sinks.append_rows(df, f"{root}/events")
    early = t.events.where("ts < timestamp_ntz '2024-01-15'")
    for source in (early, t.events, t.events):
        incremental.copy_by_id(source, "event_id", state, "events", write)
    return t.spark.read.parquet(f"{root}/events")


@query("copy_documents", f"""with now as (select event_id, user_id, case when event_id % 5 = 0 then 'changed' else event_type end as event_type,
  case when event_id % 5 = 0 then ts + interval 60 day else ts end as ts from events)
select event_id::varchar as object_id,
 '{{"event_id":' || event_id || ',"event_type":"' || event_type || '","ts":"' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '","user_id":' || user_id || '}}' as object_value,
 {ts_sql('ts')} as update_ts from now""")
def _(t):
    """Documents copied in four runs; a fifth of them change after they were copied and replace what was stored."""
    root = run_dir(t.spark, "docs")
    state = WatermarkStore(t.spark, f"{root}/state")
    store = incremental.document_store(t.spark, f"{root}/events")
    rows = t.events.select("event_id", "event_type", "ts", "user_id")
    later = rows.where("event_id % 5 = 0").withColumn("event_type", F.lit("changed")).withColumn("ts", F.expr("ts + interval 60 days"))
    for source in (rows.where("ts < timestamp_ntz '2024-01-15'"), rows, rows, rows.where("event_id % 5 <> 0").unionByName(later)):
        incremental.copy_documents(source, "event_id", "ts", state, "events", incremental.upsert_documents(store))
    return store.read()


@query("cursor_batch", f"""select {_EVENT_COLS} from events where event_id > 100 order by event_id limit 300""")
def _(t):
    """What a bounded run of an extract takes: the next rows in order of the cursor."""
    return incremental.incremental_by_id(t.events, "event_id", 100, 300)


@query("topic_messages", """select c_custkey, '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","c_nationkey":' || c_nationkey || '}' as value from customer""")
def _(t):
    return topic_value(t.customer.select("c_custkey", "c_name", "c_nationkey"), ["c_custkey", "c_name", "c_nationkey"]).select("c_custkey", "value")


_PROFILE_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]


@query("table_profile", "with r as (select count(*) as n from orders) " + " union all ".join(
    f"""select '{c}' as col_name, '{kind}' as data_type, n as n_rows, count(*) filter ({c} is null) as n_null, count(distinct {c}) as n_distinct,
 count(distinct {c}) = n as is_unique from orders, r group by n""" for c, kind in zip(_PROFILE_COLUMNS, ["bigint", "bigint", "string", "string"])))
def _(t):
    return quality.profile_table(t.orders.select(*_PROFILE_COLUMNS))


@query("bucketed_layout", """select o_orderkey, count(*) as cnt, sum(l_quantity::bigint) as quantity from orders join lineitem on l_orderkey = o_orderkey group by 1""")
def _(t):
    """Two tables laid out in buckets of the order: joined and grouped where they lie."""
    name = run_dir(t.spark, "layout").rsplit("-", 1)[1]
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_quantity")
    for table, rows in ((f"orders_{name}", t.orders.select("o_orderkey", "o_orderdate")), (f"lines_{name}", lines)):
        sinks.write_layout(rows, table, None, ["o_orderkey"], ["o_orderkey"], 8)
    both = t.spark.table(f"orders_{name}").join(t.spark.table(f"lines_{name}"), "o_orderkey")
    return both.groupBy("o_orderkey").agg(F.count("*").alias("cnt"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"))


# ---- files ---------------------------------------------------------------------------


@query("event_window", f"select {_EVENT_COLS}, strftime(ts, '%Y-%m-%d') as date from events where ts >= timestamp '2024-01-06' and ts < timestamp '2024-01-16'")
def _(t):
    root = run_dir(t.spark, "window")
    sinks.write_mart(t.events.withColumn("date", F.to_date("ts")), root, "events", partition_by=["date"])
    return files.read_event_window(t.spark, f"{root}/events", "2024-01-15", 10)


@query("city_file", """select c_custkey as id, c_name as city, round(c_acctbal / 1000, 5) as lat, round(radians(c_acctbal / 1000), 9) as lat_geo from customer""")
def _(t):
    path = run_dir(t.spark, "cities")
    coordinate = F.translate((F.col("c_acctbal") / 1000).cast("decimal(12,5)").cast("string"), ".", ",")
    t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("city"), coordinate.alias("lat"),
                      coordinate.alias("lng")).write.option("header", True).option("sep", ";").csv(path)
    return files.read_geo_cities(t.spark, path).select("id", "city", "lat", F.round("lat_geo", 9).alias("lat_geo"))


@query("order_increment_file", """select distinct o_orderkey::varchar as uniq_id, o_custkey as customer_id, 'shipped' as status from orders""")
def _(t):
    path = run_dir(t.spark, "increment")
    rows = t.orders.unionByName(t.orders.where("o_orderstatus = 'F'")).select(
        F.monotonically_increasing_id().alias("id"), F.col("o_orderkey").alias("uniq_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("date_time"), F.col("o_custkey").alias("customer_id"))
    rows.write.option("header", True).csv(path)
    return files.read_order_increment(t.spark, path).select("uniq_id", "customer_id", "status")


@query("staging_csv", f"""select o_orderkey as message_id, {ts_sql('o_orderdate')} as message_ts, o_custkey as message_from, o_custkey as message_to,
o_orderpriority as message, case when o_orderstatus <> 'O' then 1 end::bigint as message_group from orders""")
def _(t):
    path = run_dir(t.spark, "csv")
    t.orders.select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS"), "o_custkey", F.col("o_custkey").alias("b"),
        "o_orderpriority", F.when(F.col("o_orderstatus") != "O", 1).alias("g")).write.csv(path)
    return files.load_staging_csv(t.spark, path, schemas.CHAT_DIALOGS)


@query("paged_source", "select c_custkey, c_name from customer")
def _(t):
    path, size = f"{t.sf_dir}/customer.parquet", 500

    def fetch(offset: int, limit: int) -> list[dict]:
        import pyarrow.dataset as ds
        rows = ds.dataset(path).scanner(columns=["c_custkey", "c_name"]).head(offset + limit).slice(offset)
        return rows.to_pylist()

    pages = -(-t.customer.count() // size)
    return read_paged(t.spark, fetch, "c_custkey bigint, c_name string", pages, size)


# ---- JSON ----------------------------------------------------------------------------


@query("json_fields", "select event_id, json_extract_string(props, '$.k')::bigint as k from events")
def _(t):
    return t.events.select("event_id", json_field(F.col("props"), "k", "bigint").alias("k"))


@query("json_canonical", """select event_id, '{"event_type":"' || event_type || '","ts":"' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '","user_id":' || user_id || '}' as doc
from events""")
def _(t):
    return t.events.select("event_id", canonical_json({c: F.col(c) for c in ("user_id", "ts", "event_type")}).alias("doc"))


# ---- documents to star schema --------------------------------------------------------


def order_documents(t: Tables) -> DataFrame:
    """Orders as stored JSON documents with their items."""
    items = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_list(F.struct(
        F.col("l_partkey").cast("string").alias("id"), F.col("l_quantity").cast("int").alias("quantity"),
        money("l_extendedprice").alias("price"))).alias("order_items"))
    return t.orders.join(items, "o_orderkey", "left").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderkey").cast("string").alias("object_id"),
        F.to_json(F.struct(
            F.col("o_orderkey").cast("string").alias("_id"), F.struct(F.col("o_custkey").cast("string").alias("id")).alias("user"),
            F.struct((F.col("o_custkey") % 10).cast("string").alias("id")).alias("restaurant"),
            F.when(F.col("o_orderstatus") == "P", "CANCELLED").otherwise("CLOSED").alias("final_status"),
            money("o_totalprice").alias("cost"), "order_items")).alias("object_value"),
        (F.col("o_orderdate") + F.make_dt_interval(secs=F.col("o_orderkey") % 86400)).alias("update_ts"))


def bonus_events(t: Tables) -> DataFrame:
    price = money("l_extendedprice")
    return t.lineitem.where("l_returnflag = 'R'").groupBy(F.col("l_orderkey").alias("id")).agg(
        F.max("l_shipdate").alias("event_ts"),
        F.to_json(F.struct(
            F.first("l_orderkey").cast("string").alias("order_id"),
            F.collect_list(F.struct(
                F.col("l_partkey").cast("string").alias("product_id"), (price * money("l_discount")).cast("decimal(14,2)").alias("bonus_payment"),
                (price * money("l_tax")).cast("decimal(14,2)").alias("bonus_grant"))).alias("product_payments"))).alias("event_value"),
    ).withColumn("event_type", F.lit(delivery.BONUS_EVENT))


@query("product_sales_fact", """with bonus as (select l_orderkey, l_partkey,
   max((l_extendedprice::decimal(14,2) * l_discount::decimal(14,2))::decimal(14,2)) as pay,
   max((l_extendedprice::decimal(14,2) * l_tax::decimal(14,2))::decimal(14,2)) as gain from lineitem where l_returnflag = 'R' group by all)
select l.l_partkey as product_id, l.l_orderkey as order_id, l_quantity::bigint as count, l_extendedprice::decimal(14,2)::double as price,
 (l_quantity::bigint * l_extendedprice::decimal(14,2))::decimal(14,2)::double as total_sum, coalesce(pay, 0)::double as bonus_payment,
 coalesce(gain, 0)::double as bonus_grant
from lineitem l join orders on o_orderkey = l.l_orderkey and o_orderstatus <> 'P' join part on p_partkey = l.l_partkey
left join bonus b on b.l_orderkey = l.l_orderkey and b.l_partkey = l.l_partkey""")
def _(t):
    orders = delivery.parsed_orders(stored(order_documents(t)))
    dm_orders = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderkey").cast("string").alias("order_key"))
    dm_products = t.part.select(F.col("p_partkey").alias("id"), F.col("p_partkey").cast("string").alias("product_id"))
    return delivery.fact_product_sales(orders, delivery.order_bonuses(stored(bonus_events(t))), dm_orders, dm_products)[0]


@query("fact_orders", """with o as (select *, o_orderdate + interval 1 second * (o_orderkey % 86400) as ts from orders),
 u as (select c_custkey::varchar as k, row_number() over (order by c_custkey::varchar) as id from customer)
select o_orderkey::varchar as order_key, case when o_orderstatus = 'P' then 'CANCELLED' else 'CLOSED' end as order_status, u.id as user_id,
 s_suppkey as restaurant_id, dense_rank() over (order by ts) as timestamp_id
from o join u on u.k = o_custkey::varchar join supplier on s_suppkey = o_custkey % 10""")
def _(t):
    return _order_facts(t)[0]


@query("fact_orders_rejects", """with o as (select * from orders)
select o_orderkey::varchar as order_key, 'user' as missing from o where o_custkey not in (select c_custkey from customer)
union all select o_orderkey::varchar, 'restaurant' from o where o_custkey in (select c_custkey from customer)
 and o_custkey % 10 not in (select s_suppkey from supplier)""")
def _(t):
    return _order_facts(t)[1]


def _order_facts(t: Tables) -> tuple[DataFrame, DataFrame]:
    docs = stored(order_documents(t))
    user_docs = t.customer.select(
        F.col("c_custkey").cast("string").alias("object_id"), F.to_json(F.struct(
            F.col("c_custkey").cast("string").alias("_id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("login"))).alias("object_value"),
        F.lit("2000-01-01").cast("timestamp_ntz").alias("update_ts"))
    users = dims.assign_ids(delivery.dim_users(user_docs), ["user_id"])
    places = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_suppkey").cast("string").alias("restaurant_id"))
    return delivery.fact_orders(delivery.parsed_orders(docs), users, places, dims.time_dimension(docs, "update_ts"))


@query("fact_deliveries", f"""with d as (select l_orderkey || '-' || l_linenumber as delivery_id, l_orderkey as order_id, o_orderdate as order_ts,
  l_suppkey::varchar as courier_key, l_returnflag as address, l_shipdate as delivery_ts, l_extendedprice::decimal(14,2) as sum,
  (l_extendedprice::decimal(14,2) * l_tax::decimal(14,2))::decimal(14,2) as tip_sum, 1 + l_linenumber % 5 as rate
  from lineitem join orders on o_orderkey = l_orderkey),
 c as (select s_suppkey::varchar as courier_key, row_number() over (order by s_suppkey::varchar) as courier_id from supplier),
 one as (select d.*, courier_id from d join c using (courier_key) qualify row_number() over (partition by delivery_id
   order by order_ts, order_id, courier_id, address, delivery_ts, sum, tip_sum, rate) = 1)
select order_id, {ts_sql('order_ts')} as order_ts, delivery_id, courier_id, address, {ts_sql('delivery_ts')} as delivery_ts, sum::double as sum,
 tip_sum::double as tip_sum, rate::bigint as rate from one""")
def _(t):
    price = money("l_extendedprice")
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS")
    docs = t.lineitem.join(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"), "l_orderkey").select(
        F.col("l_orderkey").cast("string").alias("object_id"),
        F.to_json(F.struct(
            F.col("l_orderkey").cast("string").alias("order_id"), iso("o_orderdate").alias("order_ts"),
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("delivery_id"), F.col("l_suppkey").cast("string").alias("courier_id"),
            F.col("l_returnflag").alias("address"), iso("l_shipdate").alias("delivery_ts"), price.alias("sum"),
            (price * money("l_tax")).cast("decimal(14,2)").alias("tip_sum"), (1 + F.col("l_linenumber") % 5).alias("rate"))).alias("object_value"))
    # as the join dealt them: documents are not moved once more to be stored
    docs = stored(docs)
    courier_docs = t.supplier.select(
        F.col("s_suppkey").cast("string").alias("object_id"),
        F.to_json(F.struct(F.col("s_suppkey").cast("string").alias("_id"), F.col("s_name").alias("name"))).alias("object_value"),
        F.lit("2000-01-01").cast("timestamp_ntz").alias("update_ts"))
    couriers = dims.assign_ids(delivery.dim_couriers(courier_docs), ["courier_id"])
    dm_orders = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderkey").cast("string").alias("order_key"))
    return delivery.fact_deliveries(docs, couriers, dm_orders)


@query("enrich_items", """select l_orderkey, l_partkey, l_quantity::bigint as quantity, p_name as name, p_type as category
from lineitem left join part on p_partkey = l_partkey and p_size <= 40""")
def _(t):
    orders = t.lineitem.groupBy("l_orderkey").agg(F.collect_list(F.struct(
        F.col("l_partkey"), F.col("l_quantity").cast("int").alias("quantity"))).alias("items"))
    menu = t.part.where("p_size <= 40").select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("name"), F.col("p_type").alias("category"))
    rich = enrich_items(orders, "l_orderkey", "items", "l_partkey", menu, [], ["name", "category"])
    return rich.select("l_orderkey", F.inline("items"))


# ---- dimensions ----------------------------------------------------------------------


@query("time_dimension", f"""with s as (select distinct date_trunc('second', ts) as ts from events)
select row_number() over (order by ts) as id, {ts_sql('ts')} as ts, year(ts) as year, month(ts) as month, day(ts) as day,
 strftime(ts, '%H:%M:%S') as time, strftime(ts, '%Y-%m-%d') as date from s""")
def _(t):
    return dims.time_dimension(t.events, "ts")


@query("dense_ids", "select p_partkey, p_name, row_number() over (order by p_name, p_partkey) as id from part")
def _(t):
    return dense_ids(t.part.select("p_partkey", "p_name"), ["p_name", "p_partkey"])


@query("scd_validity", f"""select o_custkey, o_orderkey, o_orderstatus, {ts_sql('o_orderdate')} as active_from,
 {ts_sql("coalesce(lead(o_orderdate) over (partition by o_custkey order by o_orderdate, o_orderkey), timestamp '2099-12-31')")} as active_to from orders""")
def _(t):
    history = t.orders.select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate")
    return dims.scd_validity(history, ["o_custkey"], "o_orderdate", ["o_orderkey"]).drop("o_orderdate")


@query("dim_reload", """select row_number() over (partition by c_acctbal > 5000 order by c_custkey)
 + case when c_acctbal > 5000 then 0 else (select count(*) from customer where c_acctbal > 5000) end as id, c_custkey, c_name from customer""")
def _(t):
    """Two loads: customers of the first keep their ids, the others follow after the largest one."""
    rows = t.customer.select("c_custkey", "c_name")
    first = reliable(dims.assign_ids(t.customer.where("c_acctbal > 5000").select("c_custkey", "c_name"), ["c_custkey"]))
    return appended(first, dims.extend_dim(first, rows, "c_custkey", ["c_name"]))


@query("validity_upsert", f"""select c_custkey, c_mktsegment as name,
 {ts_sql("case when c_acctbal > 0 then timestamp '2000-01-01' else timestamp '2001-08-01' end")} as active_from,
 {ts_sql("timestamp '2099-12-31'")} as active_to from customer""")
def _(t):
    """Names follow the source, the first active_from stays."""
    def version(rows, name, start):
        return rows.select("c_custkey", name.alias("name"), F.lit(start).cast("timestamp_ntz").alias("active_from"),
                           F.lit("2099-12-31").cast("timestamp_ntz").alias("active_to"))
    dim = version(t.customer.where("c_acctbal > 0"), F.col("c_name"), "2000-01-01")
    return dims.upsert_validity(dim, version(t.customer, F.col("c_mktsegment"), "2001-08-01"), "c_custkey", ["name"])


@query("dim_keys_missing", """select c_custkey, c_name from customer
where not exists (select 1 from orders where o_custkey = c_custkey and o_orderstatus = 'F')""")
def _(t):
    present = t.orders.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return missing_keys(t.customer.select("c_custkey", "c_name"), present, "c_custkey")


@query("first_returned_item", """select l_orderkey, x.n as line_number, x.p as part_key from (
  select l_orderkey, min({'n': l_linenumber, 'p': l_partkey}) filter (l_returnflag = 'R') as x from lineitem group by l_orderkey)""")
def _(t):
    items = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_returnflag")))
    found = array_find(F.col("items"), lambda item: item["l_returnflag"] == "R")
    return t.lineitem.groupBy("l_orderkey").agg(items.alias("items")).select(
        "l_orderkey", found["l_linenumber"].alias("line_number"), found["l_partkey"].alias("part_key"))


@query("mart_reread", "select o_custkey, count(*) as cnt from orders group by o_custkey")
def _(t):
    root = run_dir(t.spark, "marts")
    sinks.write_mart(count_by(t.orders, "o_custkey"), root, "orders_per_customer")
    return files.read_mart(t.spark, root, "orders_per_customer")


@query("snapshot_rewrite", f"select {_ORDER_COLS} from orders where o_orderstatus = 'F'")
def _(t):
    """The snapshot holds the rows of the last write only."""
    path = run_dir(t.spark, "snapshot")
    for status in ("O", "F"):
        sinks.write_snapshot(t.orders.where(F.col("o_orderstatus") == status), path)
    return t.spark.read.parquet(path)


@query("close_missing", f"""select c_custkey, c_name, {ts_sql("case when exists (select 1 from orders where o_custkey = c_custkey and o_orderstatus = 'F') then timestamp '2099-12-31' else timestamp '2001-08-01' end")} as active_to
from customer""")
def _(t):
    dim = t.customer.select("c_custkey", "c_name").withColumn("active_to", F.lit("2099-12-31").cast("timestamp_ntz"))
    present = t.orders.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return dims.close_missing(dim, present, "c_custkey", F.lit("2001-08-01").cast("timestamp_ntz"))


@query("schema_evolution", f"""select {_ORDER_COLS} from orders where o_orderdate >= timestamp '1998-01-01'
union all select {_ORDER_COLS.replace(', o_orderpriority', ", 'shipped' as o_orderpriority")} from orders where o_orderdate < timestamp '1998-01-01'""")
def _(t):
    old = t.orders.where("o_orderdate < timestamp_ntz '1998-01-01'").drop("o_orderpriority")
    new = t.orders.where("o_orderdate >= timestamp_ntz '1998-01-01'")
    return dims.union_evolved(old, new, {"o_orderpriority": "shipped"})


@query("running_max", """select event_id, user_id, max(value) over (partition by user_id order by ts) as top from events""")
def _(t):
    return running_max(t.events.select("event_id", "user_id", "ts", "value"), ["user_id"], "ts", "value", "top").select("event_id", "user_id", "top")


# ---- layout and quality --------------------------------------------------------------


@query("calendar_partition", """select strftime(case when 2001 - year(o_orderdate) >= 2 then date_trunc('year', o_orderdate)
 when (2001 - year(o_orderdate)) * 12 + 8 - month(o_orderdate) >= 3 then date_trunc('month', o_orderdate) else o_orderdate end, '%Y-%m-%d') as part,
 count(*) as cnt from orders group by 1""")
def _(t):
    part = calendar_partition(F.col("o_orderdate"), 3, 2, dt.date(2001, 8, 1))
    return t.orders.groupBy(part.alias("part")).agg(F.count("*").alias("cnt"))


@query("quality_uniqueness", """select 'customer' as dataset, count(*) as total, count(distinct c_custkey) as uniq from customer
union all select 'orders', count(*), count(distinct o_orderkey) from orders
union all select 'lineitem', count(*), count(distinct l_orderkey * 10 + l_linenumber) from lineitem""")
def _(t):
    return quality.uniqueness_report({
        "customer": (t.customer, "c_custkey"), "orders": (t.orders, "o_orderkey"),
        "lineitem": (t.lineitem.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("k")), "k")})


@query("quality_duplicates", "select l_orderkey, l_linenumber, count(*) as cnt from lineitem group by 1, 2 having count(*) > 1")
def _(t):
    from martworks.operators.grouping import duplicate_keys
    return duplicate_keys(t.lineitem, "l_orderkey", "l_linenumber")


@query("hash_collisions", "select count(distinct o_orderkey) as keys, count(distinct md5(o_orderkey::varchar)) as hashes from orders")
def _(t):
    from martworks.functions.keys import hash_key
    return quality.hash_collisions(t.orders, "o_orderkey", hash_key(F.col("o_orderkey")))


@query("quality_dates", f"""select 'orders' as dataset, 'earliest' as info, {ts_sql('min(o_orderdate)')} as at from orders
union all select 'orders', 'latest', {ts_sql('max(o_orderdate)')} from orders
union all select 'events', 'earliest', {ts_sql('min(ts)')} from events union all select 'events', 'latest', {ts_sql('max(ts)')} from events""")
def _(t):
    return quality.date_range_report({"orders": (t.orders, "o_orderdate"), "events": (t.events, "ts")})


@query("quality_future_dates", """select 'orders' as dataset, max(o_orderdate) < timestamp '2010-01-01' as ok from orders
union all select 'events', max(ts) < timestamp '2010-01-01' from events""")
def _(t):
    return quality.no_future_dates({"orders": (t.orders, "o_orderdate"), "events": (t.events, "ts")}, F.lit("2010-01-01").cast("timestamp_ntz"))


@query("quality_orphans", """select 'missing customer' as info, count(*) as cnt from orders where o_custkey not in (select c_custkey from customer where c_acctbal > 0)
union all select 'missing order', count(*) from lineitem where l_orderkey not in (select o_orderkey from orders)
union all select 'matched customer', count(*) from orders where o_custkey in (select c_custkey from customer where c_acctbal > 0)""")
def _(t):
    rich = t.customer.where("c_acctbal > 0")
    return quality.orphan_report([
        (t.orders, "o_custkey", rich, "c_custkey", "missing customer"),
        (t.lineitem, "l_orderkey", t.orders, "o_orderkey", "missing order"),
    ]).unionByName(quality.matched_count(t.orders, "o_custkey", rich, "c_custkey", "matched customer"))


def _rules():
    return [quality.not_null("o_custkey"), quality.in_range("o_totalprice", 1000.0, 400000.0), quality.max_length("o_orderpriority", 8)]


@query("quality_violations", """select 'o_custkey_not_null' as rule, count(*) filter (o_custkey is null) as cnt from orders
union all select 'o_totalprice_range', count(*) filter (not (o_totalprice between 1000 and 400000)) from orders
union all select 'o_orderpriority_length', count(*) filter (length(o_orderpriority) > 8) from orders""")
def _(t):
    return quality.violation_counts(t.orders, _rules())


@query("quality_rejected_rows", """select o_orderkey, case when not (o_totalprice between 1000 and 400000) then 'o_totalprice_range' else '' end ||
 case when length(o_orderpriority) > 8 then (case when not (o_totalprice between 1000 and 400000) then ',' else '' end) || 'o_orderpriority_length' else '' end as violations
from orders where not (o_totalprice between 1000 and 400000) or length(o_orderpriority) > 8""")
def _(t):
    bad = quality.expect(t.orders, _rules())[1]
    return bad.select("o_orderkey", F.array_join("violations", ",").alias("violations"))
