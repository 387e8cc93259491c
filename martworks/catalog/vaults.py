"""Vault loads, keys and counters over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martworks.catalog.registry import Tables, money, query, ts_sql, uuid3_sql
from martworks.functions.keys import hash_key, uuid3
from martworks.operators.filters import union_all
from martworks.operators.vault import load_hub, load_link, load_satellite
from martworks.plans import chat_vault, order_vault
from martworks.session import reliable, staging

_LOAD = "2002-01-01 00:00:00"
_FIRST = "2001-01-01 00:00:00"

# ---- single loads --------------------------------------------------------------------


def _h_order(t: Tables, rows: DataFrame | None = None, existing: DataFrame | None = None, load_dt: str = _FIRST) -> DataFrame:
    src = (rows if rows is not None else t.orders).select("o_orderkey", "o_orderdate")
    return load_hub(src, "hk_order", "o_orderkey", existing, "files", load_dt, ["o_orderdate"])


@query("hub_load", f"""select md5(o_orderkey::varchar) as hk_order, o_orderkey, {ts_sql('o_orderdate')} as o_orderdate,
 case when o_orderdate < timestamp '1998-01-01' then '{_FIRST}.000000' else '{_LOAD}.000000' end as load_dt, 'files' as load_src from orders""")
def _(t):
    first = _h_order(t, t.orders.where("o_orderdate < timestamp_ntz '1998-01-01'"))
    return first.unionByName(_h_order(t, None, first, _LOAD))


@query("link_load", """select distinct md5('32:' || md5(l_orderkey::varchar) || '|32:' || md5(l_partkey::varchar)) as hk_order_part,
 md5(l_orderkey::varchar) as hk_order, md5(l_partkey::varchar) as hk_part, 'files' as load_src
from lineitem where not (l_orderkey in (select l_orderkey from lineitem where l_returnflag = 'R')
  and exists (select 1 from lineitem x where x.l_returnflag = 'R' and x.l_orderkey = lineitem.l_orderkey and x.l_partkey = lineitem.l_partkey))""")
def _(t):
    keys = lambda df: df.select("l_orderkey", "l_partkey")
    members = {"hk_order": hash_key(F.col("l_orderkey")), "hk_part": hash_key(F.col("l_partkey"))}
    known = load_link(keys(t.lineitem.where("l_returnflag = 'R'")), "hk_order_part", members, None, "files", _FIRST)
    return load_link(keys(t.lineitem), "hk_order_part", members, known, "files", _LOAD).drop("load_dt")


@query("satellite_changes", f"""select md5(o_orderkey::varchar) as hk_order, case when o_orderpriority = '5-LOW' then 'Z' else o_orderstatus end as status,
 {uuid3_sql("'32:' || md5(o_orderkey::varchar) || '|1:' || case when o_orderpriority = '5-LOW' then 'Z' else o_orderstatus end")} as hashdiff
from orders where o_orderpriority = '5-LOW' or o_orderdate >= timestamp '1998-01-01'""")
def _(t):
    keyed = t.orders.select(hash_key(F.col("o_orderkey")).alias("hk_order"), F.col("o_orderstatus").alias("status"), "o_orderdate", "o_orderpriority")
    old = load_satellite(keyed.where("o_orderdate < timestamp_ntz '1998-01-01'"), "hk_order", ["status"], None, "files", _FIRST)
    now = keyed.withColumn("status", F.when(F.col("o_orderpriority") == "5-LOW", "Z").otherwise(F.col("status")))
    return load_satellite(now, "hk_order", ["status"], old, "files", _LOAD).drop("load_dt", "load_src")


@query("uuid3_keys", f"select c_custkey, {uuid3_sql('c_name')} as pk from customer")
def _(t):
    return t.customer.select("c_custkey", uuid3(F.col("c_name")).alias("pk"))


# ---- group chat ----------------------------------------------------------------------


def chat_staging(t: Tables) -> dict[str, DataFrame]:
    """Customers as users, nations as groups, orders as messages, events as the group log."""
    day = F.lit("2000-01-01").cast("timestamp_ntz")
    later = lambda c: (day + F.make_dt_interval(days=F.col(c).cast("int"))).cast("timestamp_ntz")
    return {
        "users": t.customer.select(
            F.col("c_custkey").alias("id"), F.col("c_name").alias("chat_name"), later("c_nationkey").alias("registration_dt"),
            F.col("c_mktsegment").alias("country"), F.col("c_nationkey").alias("age")),
        "groups": t.nation.select(
            F.col("n_nationkey").alias("id"), F.col("n_nationkey").alias("admin_id"), F.col("n_name").alias("group_name"),
            later("n_nationkey").alias("registration_dt"), (F.col("n_regionkey") == 0).alias("is_private")),
        "dialogs": t.orders.select(
            F.col("o_orderkey").alias("message_id"), F.col("o_orderdate").alias("message_ts"), F.col("o_custkey").alias("message_from"),
            F.col("o_custkey").alias("message_to"), F.col("o_orderpriority").alias("message"),
            F.when(F.col("o_orderstatus") != "P", F.col("o_custkey") % 25).cast("int").alias("message_group")),
        "group_log": t.events.select(
            (F.col("user_id") % 25).cast("int").alias("group_id"), F.col("user_id"), F.when(F.col("event_type") == "signup", F.col("user_id")).alias("user_id_from"),
            F.when(F.col("event_type") == "signup", "add").otherwise("leave").alias("event"), F.col("ts").alias("datetime")),
    }


def _both(old: dict[str, DataFrame], new: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {table: old[table].unionByName(new[table]) for table in old}


def _stored(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {table: reliable(rows) for table, rows in tables.items()}


def _chat(t: Tables, upto: str) -> dict[str, DataFrame]:
    """Tables of one kind after two loads: the second one gets everything and adds what the first one did not have."""
    stg = chat_staging(t)
    first = {**stg, "dialogs": stg["dialogs"].where("message_id % 2 = 0"), "group_log": stg["group_log"].where("user_id % 2 = 0")}
    # what a load adds is stored, and the stored rows before it are not written again
    old = _stored(chat_vault.chat_hubs(first, {}, _FIRST))
    hubs = _both(old, chat_vault.chat_hubs(stg, old, _LOAD))
    if upto == "hubs":
        return hubs
    hubs = _both(old, _stored(chat_vault.chat_hubs(stg, old, _LOAD)))
    known = _stored(chat_vault.chat_links(first, hubs, {}, _FIRST))
    links = _both(known, chat_vault.chat_links(stg, hubs, known, _LOAD))
    if upto == "links":
        return links
    links = _both(known, _stored(chat_vault.chat_links(stg, hubs, known, _LOAD)))
    before = _stored(chat_vault.chat_satellites(first, hubs, links, {}, _FIRST))
    return _both(before, chat_vault.chat_satellites(stg, hubs, links, before, _LOAD))


def _stack(tables: dict[str, DataFrame], columns: dict[str, list[str]], names: str = "abc") -> DataFrame:
    """Rows of several tables as (tbl, a, b, c, …)."""
    return union_all([
        df.select(F.lit(name).alias("tbl"), *[
            (F.col(columns[name][i]).cast("string") if i < len(columns[name]) else F.lit("")).alias(out)
            for i, out in enumerate(names)])
        for name, df in tables.items()
    ])


@query("chat_hubs", """select 'h_users' as tbl, md5(c_custkey::varchar) as a, c_custkey::varchar as b, '' as c from customer
union all select 'h_groups', md5(n_nationkey::varchar), n_nationkey::varchar, '' from nation
union all select 'h_dialogs', md5(o_orderkey::varchar), o_orderkey::varchar, '' from orders""")
def _(t):
    return _stack(_chat(t, "hubs"), {
        "h_users": ["hk_user_id", "user_id"], "h_groups": ["hk_group_id", "group_id"], "h_dialogs": ["hk_message_id", "message_id"]})


_H = lambda x: f"md5(({x})::varchar)"


def _link_sql(x: str, y: str) -> str:
    return f"md5('32:' || {_H(x)} || '|32:' || {_H(y)}), {_H(x)}, {_H(y)}"


@query("chat_links", f"""select * from (values ('', '', '', '')) v(tbl, a, b, c) where tbl <> ''
union all select 'l_admins', {_link_sql('n_nationkey', 'n_nationkey')} from nation where n_nationkey in (select c_custkey from customer)
union all select 'l_user_message', {_link_sql('o_custkey', 'o_orderkey')} from orders where o_custkey in (select c_custkey from customer)
union all select 'l_groups_dialogs', {_link_sql('o_orderkey', 'o_custkey % 25')} from orders where o_orderstatus <> 'P'
union all select distinct 'l_user_group_activity', {_link_sql('user_id', 'user_id % 25')} from events where user_id in (select c_custkey from customer)""")
def _(t):
    return _stack(_chat(t, "links"), {
        "l_admins": ["hk_l_admin_id", "hk_group_id", "hk_user_id"], "l_user_message": ["hk_l_user_message", "hk_user_id", "hk_message_id"],
        "l_groups_dialogs": ["hk_l_groups_dialogs", "hk_message_id", "hk_group_id"],
        "l_user_group_activity": ["hk_l_user_group_activity", "hk_user_id", "hk_group_id"]})


@query("chat_satellites", f"""with d as (select timestamp '2000-01-01' as d0)
select 's_user_chatinfo' as tbl, {_H('c_custkey')} as a, c_name as b, '' as c, '' as d from customer
union all select 's_user_socdem', {_H('c_custkey')}, c_mktsegment, c_nationkey::varchar, '' from customer
union all select 's_group_private_status', {_H('n_nationkey')}, (n_regionkey = 0)::varchar, '', '' from nation
union all select 's_group_name', {_H('n_nationkey')}, n_name, '', '' from nation
union all select 's_dialog_info', {_H('o_orderkey')}, o_orderpriority, o_custkey::varchar, o_custkey::varchar from orders
union all select 's_admins', md5('32:' || {_H('n_nationkey')} || '|32:' || {_H('n_nationkey')}), 'true', (d0 + interval 1 day * n_nationkey)::varchar, ''
  from nation, d where n_nationkey in (select c_custkey from customer)
union all select distinct 's_auth_history', md5('32:' || {_H('user_id')} || '|32:' || {_H('user_id % 25')}), case when event_type = 'signup' then 'add' else 'leave' end,
  {ts_sql('ts')}, case when event_type = 'signup' then user_id::varchar end from events where user_id in (select c_custkey from customer)""")
def _(t):
    sats = _chat(t, "satellites")
    sats["s_auth_history"] = sats["s_auth_history"].withColumn("at", F.date_format("event_dt", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    return _stack(sats, {
        "s_admins": ["hk_l_admin_id", "is_admin", "admin_from"], "s_user_chatinfo": ["hk_user_id", "chat_name"],
        "s_user_socdem": ["hk_user_id", "country", "age"], "s_group_private_status": ["hk_group_id", "is_private"],
        "s_group_name": ["hk_group_id", "group_name"], "s_dialog_info": ["hk_message_id", "message", "message_from", "message_to"],
        "s_auth_history": ["hk_l_user_group_activity", "event", "at", "user_id_from"]}, "abcd")


@query("group_conversion", f"""with oldest as (select n_nationkey as g from nation order by n_nationkey limit 10),
talk as (select o_custkey % 25 as g, count(*) as cnt_messages, count(distinct o_custkey) filter (o_custkey in (select c_custkey from customer)) as cnt_users
  from orders where o_orderstatus <> 'P' group by 1),
added as (select user_id % 25 as g, count(distinct user_id) as cnt_added_users from events
  where event_type = 'signup' and user_id in (select c_custkey from customer) group by 1)
select {_H('added.g')} as hk_group_id, cnt_added_users, cnt_messages, cnt_users,
 ((2000000 * cnt_users + cnt_added_users) // (2 * cnt_added_users))::double / 1000000 as group_conversion
from added join oldest using (g) left join talk using (g)""")
def _(t):
    stg = chat_staging(t)
    hubs = chat_vault.chat_hubs(stg, {}, _LOAD)
    hubs = {**hubs, **_stored({name: hubs[name] for name in ("h_users", "h_groups")})}
    links = chat_vault.chat_links(stg, hubs, {}, _LOAD)
    sats = chat_vault.chat_satellites(stg, hubs, links, {}, _LOAD)
    return chat_vault.group_conversion(
        hubs["h_groups"], links["l_groups_dialogs"], links["l_user_message"], links["l_user_group_activity"], sats["s_auth_history"])


# ---- order vault and counters --------------------------------------------------------


def order_messages(t: Tables) -> DataFrame:
    """Orders as parsed messages with the array of their items."""
    items = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_list(F.struct(
        F.col("l_partkey").cast("string").alias("id"), F.lit(None).cast("string").alias("name"),
        F.col("l_extendedprice").cast("decimal(19,5)").alias("price"), F.col("l_quantity").cast("int").alias("quantity"))).alias("order_items"))
    return t.orders.join(items, "o_orderkey", "left").select(
        F.col("o_orderkey").alias("object_id"), F.lit("order").alias("object_type"), F.col("o_orderdate").cast("string").alias("sent_dttm"),
        F.struct(
            F.col("o_orderdate").cast("string").alias("date"), F.col("o_totalprice").cast("decimal(19,5)").alias("cost"),
            F.col("o_totalprice").cast("decimal(19,5)").alias("payment"), F.col("o_orderstatus").alias("final_status"),
            F.struct(F.concat(F.lit("R"), F.col("o_custkey") % 10).alias("id")).alias("restaurant"),
            F.struct(F.col("o_custkey").cast("string").alias("id")).alias("user"), "order_items").alias("payload"))


def order_dimensions(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Users, restaurants and menus: customers, suppliers and, per restaurant, the parts."""
    users = t.customer.select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"))
    restaurants = t.supplier.select(F.concat(F.lit("R"), "s_suppkey").alias("id"), F.col("s_name").alias("name"))
    menu = t.part.where("p_size <= 48").select(
        F.explode(F.array(*[F.lit(f"R{i}") for i in range(10)])).alias("restaurant_id"),
        F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("name"), F.col("p_type").alias("category"))
    return users, restaurants, menu


def known_orders(t: Tables) -> DataFrame:
    """Enriched orders as a stored table: the vault reads them once per table."""
    with staging(t.spark) as keep:
        return keep(order_vault.split_known(order_vault.enrich_orders(order_messages(t), *order_dimensions(t)))[0])


def _two_loads(t: Tables, kind: str) -> dict[str, DataFrame]:
    """Tables of a kind after two loads: the second one gets all orders and adds what the first one did not have."""
    known = known_orders(t)
    first = order_vault.vault_batch(known.where("object_id % 2 = 0"), {}, _FIRST)
    old = {table: reliable(rows) for table, rows in first.items() if table[0] == kind}
    new = order_vault.vault_batch(known, old, _LOAD)
    return {table: old[table].unionByName(new[table]) for table in old}


@query("order_rejects", """select o_orderkey as object_id, concat_ws(',', case when c_custkey is null then 'user' end,
 case when s_suppkey is null then 'restaurant' end, case when bad.l_orderkey is not null then 'item' end) as reasons
 from orders left join customer on c_custkey = o_custkey left join supplier on s_suppkey = o_custkey % 10
 left join (select distinct l_orderkey from lineitem left join part on p_partkey = l_partkey where coalesce(p_size, 99) > 48) bad on bad.l_orderkey = o_orderkey
 where c_custkey is null or s_suppkey is null or bad.l_orderkey is not null""")
def _(t):
    rejected = order_vault.split_known(order_vault.enrich_orders(order_messages(t), *order_dimensions(t)))[1]
    return rejected.select("object_id", F.array_join("reasons", ",").alias("reasons"))


# orders of known customers and restaurants whose items are all on the menu
KNOWN_SQL = """known as (select o_orderkey, o_custkey, o_orderdate, o_orderstatus, o_totalprice, 'R' || (o_custkey % 10) as rid, s_name, c_name
  from orders join customer on c_custkey = o_custkey join supplier on s_suppkey = o_custkey % 10
  where o_orderkey not in (select l_orderkey from lineitem left join part on p_partkey = l_partkey where coalesce(p_size, 99) > 48)),
item as (select o_orderkey, o_custkey, o_orderdate, rid, l_partkey, p_name, p_type from known join lineitem on l_orderkey = o_orderkey join part on p_partkey = l_partkey)"""
_U = uuid3_sql


def _key(name: str) -> str:
    return {"order": "o_orderkey::varchar", "user": "o_custkey::varchar", "restaurant": "rid", "product": "l_partkey::varchar", "category": "p_type"}[name]


def _hub_rows(name: str, table: str) -> str:
    return f"select distinct 'h_{name}' as tbl, {_U(_key(name))} as a, {_key(name)} as b, '' as c from {table}"


@query("order_vault_hubs", f"with {KNOWN_SQL} " + " union all ".join([
    _hub_rows("order", "known"), _hub_rows("user", "known"), _hub_rows("restaurant", "known"), _hub_rows("product", "item"), _hub_rows("category", "item")]))
def _(t):
    new = _two_loads(t, "h")
    keys = {"h_order": "order_id", "h_user": "user_id", "h_restaurant": "restaurant_id", "h_product": "product_id", "h_category": "category_name"}
    return _stack({h: new[h] for h in keys}, {h: [f"{h}_pk", k] for h, k in keys.items()})


def _link_rows(name: str, a: str, b: str, table: str) -> str:
    # keys first, then the pair key, so that each md5 runs once
    return (f"select 'l_{name}' as tbl, {_U('x || y')} as a, x as b, y as c from "
            f"(select distinct {_U(_key(a))} as x, {_U(_key(b))} as y from {table})")


@query("order_vault_links", f"with {KNOWN_SQL} " + " union all ".join([
    _link_rows("order_product", "order", "product", "item"), _link_rows("product_category", "product", "category", "item"),
    _link_rows("order_user", "order", "user", "known"), _link_rows("product_restaurant", "product", "restaurant", "item")]))
def _(t):
    new = _two_loads(t, "l")
    columns = {
        "l_order_product": ["hk_order_product_pk", "h_order_pk", "h_product_pk"],
        "l_product_category": ["hk_product_category_pk", "h_product_pk", "h_category_pk"],
        "l_order_user": ["hk_order_user_pk", "h_order_pk", "h_user_pk"],
        "l_product_restaurant": ["hk_product_restaurant_pk", "h_product_pk", "h_restaurant_pk"]}
    return _stack({n: new[n] for n in columns}, columns)


def _sat_rows(name: str, key: str, attrs: list[str], table: str) -> str:
    text = " || '|' || ".join(f"length({p})::varchar || ':' || {p}" for p in ["x", *[f"a{i}" for i in range(len(attrs))]])
    cols = ", ".join(f"{a} as a{i}" for i, a in enumerate(attrs))
    second = "a1" if len(attrs) > 1 else "''"
    return (f"select 's_{name}' as tbl, x as a, {_U(text)} as b, a0 as c, {second} as d from "
            f"(select distinct {_U(_key(key))} as x, {cols} from {table})")


@query("order_vault_satellites", f"with {KNOWN_SQL} " + " union all ".join([
    _sat_rows("order_cost", "order", ["(o_totalprice::decimal(19,5))::varchar", "(o_totalprice::decimal(19,5))::varchar"], "known"),
    _sat_rows("order_status", "order", ["o_orderstatus"], "known"), _sat_rows("product_names", "product", ["p_name"], "item"),
    _sat_rows("restaurant_names", "restaurant", ["s_name"], "known"), _sat_rows("user_names", "user", ["c_name", "o_custkey::varchar"], "known")]))
def _(t):
    new = _two_loads(t, "s")
    shown = {"s_order_cost": ("h_order_pk", "cost", "payment"), "s_order_status": ("h_order_pk", "status"), "s_product_names": ("h_product_pk", "name"),
             "s_restaurant_names": ("h_restaurant_pk", "name"), "s_user_names": ("h_user_pk", "username", "userlogin")}
    return _stack({s: new[s] for s in shown}, {s: [k, f"hk_{s[2:]}_hashdiff", *a] for s, (k, *a) in shown.items()}, "abcd")


PRODUCT_COUNTERS = f"""with {KNOWN_SQL} select {_U('o_custkey::varchar')} as user_id, {_U('l_partkey::varchar')} as product_id, max(p_name) as product_name,
 count(distinct o_orderkey) as order_cnt from item group by o_custkey, l_partkey"""
CATEGORY_COUNTERS = f"""with {KNOWN_SQL} select {_U('o_custkey::varchar')} as user_id, {_U('p_type')} as category_id, p_type as category_name,
 count(distinct o_orderkey) as order_cnt from item group by o_custkey, p_type"""


@query("user_product_counters", PRODUCT_COUNTERS)
def _(t):
    return order_vault.user_product_counters(order_vault.user_message(known_orders(t)))


@query("user_category_counters", CATEGORY_COUNTERS)
def _(t):
    return order_vault.user_category_counters(order_vault.user_message(known_orders(t)))
