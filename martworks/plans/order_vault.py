"""Enriched orders into a vault, and per-user counters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from martworks.functions.arrays import array_pluck, explode_items, zip_arrays
from martworks.functions.keys import hash_key, hashdiff, uuid3
from martworks.operators.filters import union_all, with_load_meta
from martworks.operators.joins import enrich_items, growing
from martworks.operators.vault import load_hub, load_link, load_satellite
from martworks.session import reliable

SOURCE = "stg-order-service"


def enrich_orders(orders: DataFrame, users: DataFrame, restaurants: DataFrame, menu: DataFrame, at: str | None = None) -> DataFrame:
    """Names of user and restaurant, name and category of every item.

    `orders` is parsed messages; `users` (id, name[, login]), `restaurants`
    (id, name), `menu` (restaurant_id, id, name, category). Every order stays:
    unknown users, restaurants and items keep null names, an order without items
    has an empty array, see `split_known`. With `at`, the column with the time of
    a message, every message of an order is a row, equal messages are one.
    """
    sent = [at] if at else []
    if sent:
        same = F.struct("object_id", *sent, F.sha2(F.to_json("payload"), 256))
        orders = orders.withColumn("_same", same).dropDuplicates(["_same"])
    p = F.col("payload")
    flat = orders.select(
        "object_id", "object_type", *sent, p["date"].alias("date"), p["cost"].alias("cost"), p["payment"].alias("payment"),
        p["final_status"].alias("status"), p["restaurant"]["id"].alias("restaurant_id"), p["user"]["id"].alias("user_id"),
        F.transform(p["order_items"], lambda i: F.struct(i["id"].alias("id"), i["price"].alias("price"),
                                                       i["quantity"].alias("quantity"))).alias("products"))
    # written, because users, items and the order itself are looked up by its row number
    flat = reliable(flat.withColumn("_row", F.monotonically_increasing_id()))
    login = F.coalesce(F.col("login"), F.col("id")) if "login" in users.columns else F.col("id")
    # the order waits while its number and user go to the users
    who = flat.where("user_id is not null").select("_row", "user_id").join(growing(users.select(
        F.col("id").alias("user_id"), F.col("name").alias("user_name"), login.alias("user_login"), F.lit(True).alias("_user"))), "user_id").drop("user_id")
    full = enrich_items(flat, "_row", "products", "id", menu, ["restaurant_id"], ["name", "category"])
    full = full.join(growing(who), "_row", "left").join(
        restaurants.select(F.col("id").alias("restaurant_id"), F.col("name").alias("restaurant_name"), F.lit(True).alias("_restaurant")),
        "restaurant_id", "left")
    return full.select(
        "object_id", "object_type", *sent,
        F.struct(
            F.col("object_id").alias("id"), "date", "cost", "payment", "status",
            F.struct(F.col("restaurant_id").alias("id"), F.col("restaurant_name").alias("name")).alias("restaurant"),
            F.struct(F.col("user_id").alias("id"), F.col("user_name").alias("name"), F.col("user_login").alias("login")).alias("user"),
            F.coalesce("products", F.array().cast(full.schema["products"].dataType)).alias("products")).alias("payload"),
        _reasons(F.col("_user"), F.col("_restaurant"), F.col("products")).alias("reasons"))


def _reasons(user: Column, restaurant: Column, products: Column) -> Column:
    """What an order names that no dimension knows."""
    unknown = F.coalesce(F.exists(products, lambda i: i["name"].isNull() | i["category"].isNull()), F.lit(False))
    return F.array_compact(F.array(
        F.when(user.isNull(), "user"), F.when(restaurant.isNull(), "restaurant"), F.when(unknown, "item")))


def split_known(enriched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(orders whose user, restaurant and items are all known, the other orders with their `reasons`)."""
    known = F.size("reasons") == 0
    return enriched.where(known).drop("reasons"), enriched.where(~known)


def _flat_orders(enriched: DataFrame, at: list[str]) -> DataFrame:
    p = F.col("payload")
    return enriched.select(
        *at, F.col("object_id").alias("order_id"), p["date"].cast("timestamp_ntz").alias("order_dt"),
        p["cost"].alias("cost"), p["payment"].alias("payment"), p["status"].alias("status"),
        p["restaurant"]["id"].alias("restaurant_id"), p["restaurant"]["name"].alias("restaurant_name"),
        p["user"]["id"].alias("user_id"), p["user"]["name"].alias("username"), p["user"]["login"].alias("userlogin"),
        p["products"].alias("products"),
    )


def _flat_items(orders: DataFrame, at: list[str]) -> DataFrame:
    items = explode_items(orders.select(*at, "order_id", "restaurant_id", "order_dt", "products"), "products")
    return items.select(
        *at, "order_id", "restaurant_id", "order_dt", F.col("id").alias("product_id"), F.col("name").alias("product_name"),
        F.col("category").alias("category_name"))


# entity -> its business key column
_BUSINESS_KEY = {"order": "order_id", "user": "user_id", "restaurant": "restaurant_id", "product": "product_id", "category": "category_name"}


def _hub_key(entity: str):
    return uuid3(F.col(_BUSINESS_KEY[entity]))


_LINKS = {
    "l_order_product": ("order", "product"), "l_product_category": ("product", "category"),
    "l_order_user": ("order", "user"), "l_product_restaurant": ("product", "restaurant"),
}
_SATELLITES = {
    "s_order_cost": ("order", ["cost", "payment"]), "s_order_status": ("order", ["status"]), "s_product_names": ("product", ["name"]),
    "s_restaurant_names": ("restaurant", ["name"]), "s_user_names": ("user", ["username", "userlogin"]),
}
_HUBS = ["order", "user", "restaurant", "product", "category"]
_OF_ITEMS = {"product", "category"}


def _sources(enriched: DataFrame) -> Callable[[str], DataFrame]:
    """table name -> the rows it is loaded from, with the names of its attributes."""
    orders = _flat_orders(enriched, [])
    items = _flat_items(orders, [])

    def rows(table: str) -> DataFrame:
        entities = {table[2:]} if table[0] == "h" else set(_LINKS[table]) if table[0] == "l" else {_SATELLITES[table][0]}
        src = items if entities & _OF_ITEMS else orders
        named = {"s_product_names": "product_name", "s_restaurant_names": "restaurant_name"}
        return src.withColumnRenamed(named[table], "name") if table in named else src

    return rows


def vault_batch(enriched: DataFrame, dds: dict[str, DataFrame], load_dt: str) -> dict[str, DataFrame]:
    """New rows of 5 hubs, 4 links and 5 satellites of a batch of orders; of a key the latest version in the batch counts."""
    src = _sources(enriched)
    out = {}
    for entity in _HUBS:
        hub = f"h_{entity}"
        out[hub] = load_hub(src(hub), f"{hub}_pk", _BUSINESS_KEY[entity], dds.get(hub), SOURCE, load_dt,
                            ["order_dt"] if entity == "order" else [], key=_hub_key(entity))
    for table, (a, b) in _LINKS.items():
        members = {f"h_{a}_pk": _hub_key(a), f"h_{b}_pk": _hub_key(b)}
        out[table] = load_link(
            src(table).select(_BUSINESS_KEY[a], _BUSINESS_KEY[b]), f"hk_{table[2:]}_pk", members, dds.get(table), SOURCE, load_dt,
            key=uuid3(F.concat(*members)))
    for table, (entity, attrs) in _SATELLITES.items():
        # later orders name it
        out[table] = load_satellite(
            src(table), f"h_{entity}_pk", attrs, dds.get(table), SOURCE, load_dt, ["order_dt", *attrs],
            diff=f"hk_{table[2:]}_hashdiff", business_key=(_BUSINESS_KEY[entity], _hub_key(entity)))
    return out


def _entries(rows: DataFrame, keep: list[str], wanted: dict[str, list[str]], width: int) -> DataFrame:
    """One row per table and input row: `keep`, tbl, and the table's columns as texts x0, x1, … (`width` of them)."""
    def entry(table: str, columns: list[str]) -> Column:
        values = [F.col(c).cast("string") for c in columns] + [F.lit(None).cast("string")] * (width - len(columns))
        return F.struct(F.lit(table).alias("tbl"), *[v.alias(f"x{i}") for i, v in enumerate(values)])

    return rows.select(*keep, F.inline(F.array(*[entry(t, c) for t, c in wanted.items()])))


def vault_rows(enriched: DataFrame, load_dt: str, at: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(hubs, links, versions) of a batch of messages, each kind of table in one layout with its name in `tbl`.

    hubs: tbl, pk, business_key, order_dt, load_dt, load_src; links: tbl, pk, a, b,
    load_dt, load_src; versions: tbl, pk, a0, a1, hashdiff, load_dt (the time in
    column `at` of the message; null and first if it cannot be read), load_src.
    The rows are those of `vault_batch`, for all tables of a kind from one aggregate; none is repeated.
    Nothing is compared with what is stored.
    """
    orders = _flat_orders(enriched, [at])
    items = _flat_items(orders, [at])
    sources = {False: orders, True: items}

    def both(keep: list[str], wanted: dict[str, list[str]], of_items: set[str], width: int) -> DataFrame:
        parts = [_entries(sources[side], keep, {t: c for t, c in wanted.items() if (t in of_items) == side}, width) for side in sources]
        return union_all(parts)

    keys = {f"h_{e}": [_BUSINESS_KEY[e]] for e in _HUBS}
    hubs = both(["order_dt"], keys, {f"h_{e}" for e in _OF_ITEMS}, 1).where("x0 is not null").groupBy("tbl", "x0").agg(
        F.min(F.when(F.col("tbl") == "h_order", F.col("order_dt"))).alias("order_dt"))
    hubs = hubs.select("tbl", uuid3(F.col("x0")).alias("pk"), F.col("x0").alias("business_key"), "order_dt")

    pairs = {t: [_BUSINESS_KEY[a], _BUSINESS_KEY[b]] for t, (a, b) in _LINKS.items()}
    links = both([], pairs, {t for t, ends in _LINKS.items() if set(ends) & _OF_ITEMS}, 2).where(
        "x0 is not null and x1 is not null").distinct().select("tbl", uuid3(F.col("x0")).alias("a"), uuid3(F.col("x1")).alias("b"))
    links = links.select("tbl", uuid3(F.concat("a", "b")).alias("pk"), "a", "b")

    named = {"s_product_names": ["product_name"], "s_restaurant_names": ["restaurant_name"]}
    told = {t: [_BUSINESS_KEY[e], *named.get(t, attrs)] for t, (e, attrs) in _SATELLITES.items()}
    versions = both([at], told, {t for t, (e, _) in _SATELLITES.items() if e in _OF_ITEMS}, 3).where("x0 is not null")
    # the time is read first: two texts of one time are one version
    versions = versions.withColumn(at, F.try_to_timestamp(F.col(at).cast("string")).cast("timestamp_ntz")).distinct()
    two = F.col("tbl").isin([t for t, (_, attrs) in _SATELLITES.items() if len(attrs) == 2])
    pk, a0, a1 = F.col("pk"), F.col("x1"), F.col("x2")
    versions = versions.withColumn("pk", uuid3(F.col("x0"))).select(
        "tbl", "pk", a0.alias("a0"), a1.alias("a1"), F.when(two, hashdiff(pk, a0, a1)).otherwise(hashdiff(pk, a0)).alias("hashdiff"),
        F.col(at).alias("load_dt"), F.lit(SOURCE).alias("load_src"))
    return with_load_meta(hubs, SOURCE, load_dt), with_load_meta(links, SOURCE, load_dt), versions


_TYPES = {"order_id": "bigint", "cost": "decimal(19,5)", "payment": "decimal(19,5)"}


def vault_table(rows: DataFrame, table: str) -> DataFrame:
    """The rows of one table in the layout of `vault_rows` under the names and types of `vault_batch`."""
    own = rows.where(F.col("tbl") == table)

    def named(old: str, name: str) -> Column:
        return F.col(old).cast(_TYPES.get(name, "string")).alias(name)

    if table[0] == "h":
        entity = table[2:]
        extra = ["order_dt"] if entity == "order" else []
        return own.select(F.col("pk").alias(f"{table}_pk"), named("business_key", _BUSINESS_KEY[entity]), *extra, "load_dt", "load_src")
    if table[0] == "l":
        a, b = _LINKS[table]
        return own.select(F.col("pk").alias(f"hk_{table[2:]}_pk"), F.col("a").alias(f"h_{a}_pk"), F.col("b").alias(f"h_{b}_pk"), "load_dt", "load_src")
    entity, attrs = _SATELLITES[table]
    return own.select(F.col("pk").alias(f"h_{entity}_pk"), *[named(f"a{i}", a) for i, a in enumerate(attrs)],
                      F.col("hashdiff").alias(f"hk_{table[2:]}_hashdiff"), "load_dt", "load_src")


def missing_keys(unknown: DataFrame) -> Column:
    """What an enriched order lacks, as an array of (kind, key): user and restaurant by id, an item by the hash of restaurant and item."""
    p = F.col("payload")
    lacking = F.filter(p["products"], lambda i: i["name"].isNull() | i["category"].isNull())
    named = lambda kind, key: F.struct(F.lit(kind).alias("kind"), key.alias("key"))
    one = lambda kind, key: F.when(F.array_contains("reasons", kind), F.array(named(kind, key)))
    parts = [one("user", p["user"]["id"]), one("restaurant", p["restaurant"]["id"]),
             F.transform(lacking, lambda i: named("item", hash_key(p["restaurant"]["id"], i["id"])))]
    none = F.array().cast("array<struct<kind:string,key:string>>")
    return F.array_distinct(F.concat(*[F.coalesce(x, none) for x in parts]))


def dimension_keys(users: DataFrame, restaurants: DataFrame, menu: DataFrame) -> DataFrame:
    """(kind, key) of dimension rows, as `missing_keys` names them."""
    return union_all([
        users.select(F.lit("user").alias("kind"), F.col("id").alias("key")),
        restaurants.select(F.lit("restaurant").alias("kind"), F.col("id").alias("key")),
        menu.select(F.lit("item").alias("kind"), hash_key(F.col("restaurant_id"), F.col("id")).alias("key"))]).where(
        "key is not null").distinct()


def as_message(enriched: DataFrame) -> Column:
    """The payload of an enriched order as it came, without names."""
    p = F.col("payload")
    return F.to_json(F.struct(
        p["date"].alias("date"), p["cost"].alias("cost"), p["payment"].alias("payment"), p["status"].alias("final_status"),
        F.struct(p["restaurant"]["id"].alias("id")).alias("restaurant"), F.struct(p["user"]["id"].alias("id")).alias("user"),
        F.transform(p["products"], lambda i: F.struct(i["id"].alias("id"), i["price"].alias("price"), i["quantity"].alias("quantity"))).alias("order_items")))


def user_message(enriched: DataFrame) -> DataFrame:
    """Per order the keys and names of its products and categories, as parallel arrays."""
    products = F.col("payload.products")
    return enriched.select(
        F.col("object_id").alias("order_id"), uuid3(F.col("payload.user.id")).alias("user_id"),
        F.transform(products, lambda i: uuid3(i["id"])).alias("product_id_list"),
        array_pluck(products, "name").alias("product_name_list"),
        F.transform(products, lambda i: uuid3(i["category"])).alias("category_id_list"),
        array_pluck(products, "category").alias("category_name_list"))


def message_products(messages: DataFrame, keep: list[str] = ()) -> DataFrame:
    rows = messages.select("order_id", "user_id", *keep, zip_arrays(
        product_id=F.col("product_id_list"), product_name=F.col("product_name_list")).alias("_items"))
    return explode_items(rows, "_items")


def message_categories(messages: DataFrame, keep: list[str] = ()) -> DataFrame:
    rows = messages.select("order_id", "user_id", *keep, zip_arrays(
        category_id=F.col("category_id_list"), category_name=F.col("category_name_list")).alias("_items"))
    return explode_items(rows, "_items")


def order_counters(rows: DataFrame, key: str, label: str) -> DataFrame:
    """Distinct orders per user and key; a resent message changes nothing."""
    return rows.groupBy("user_id", key).agg(
        F.max(label).alias(label), F.countDistinct("order_id").alias("order_cnt"))


def user_product_counters(messages: DataFrame) -> DataFrame:
    return order_counters(message_products(messages), "product_id", "product_name")


def user_category_counters(messages: DataFrame) -> DataFrame:
    return order_counters(message_categories(messages), "category_id", "category_name")
