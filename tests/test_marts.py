"""Hand-made cases: each known trap of the marts with the meaning built here."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from martworks.plans import chat_vault, delivery, metrics, order_vault, recommendations, rfm, sales, settlement, shipping
from martworks.plans.user_mart import home_by_stay, user_cities, user_mart
from martworks.plans.zone_mart import geo_zone_mart

LOAD = "2022-01-01 00:00:00"


def ts(c):
    return F.col(c).cast("timestamp_ntz").alias(c)


# ---- segments ------------------------------------------------------------------------


def test_users_without_orders_are_ranked_lowest(spark, rows):
    users = spark.createDataFrame([(i,) for i in range(1, 6)], "id int")
    closed = spark.createDataFrame([(i, f"2022-01-0{i}", i * 10) for i in range(2, 6)], "user_id int, order_ts string, payment int").select(
        "user_id", ts("order_ts"), F.col("payment").cast("decimal(19,5)"))
    assert rows(rfm.rfm_segments(users, closed)) == [(i, i, i, i) for i in range(1, 6)]


def test_latest_status_tie_goes_to_the_larger_log_id(spark, rows):
    orders = spark.createDataFrame([(1, 7)], "order_id int, user_id int")
    log = spark.createDataFrame([(1, "2022-01-01", 1, 4), (1, "2022-01-01", 2, 5)], "order_id int, dttm string, id int, status_id int")
    assert rows(rfm.orders_with_latest_status(orders, log), "order_id", "status") == [(1, 5)]
    statuses = spark.createDataFrame([(4, "Closed"), (5, "Cancelled")], "id int, key string")
    assert rfm.closed_orders(rfm.orders_with_latest_status(orders, log), statuses).count() == 0


# ---- shipping ------------------------------------------------------------------------


def shipping_log(spark):
    base = dict(payment=100, vendor=1, country="ru", agreement="0:a-1:0.02:0.10", transfer="1p::car", trate=0.025)
    log = [
        (1, "booked", "2021-01-01", "2021-01-10", 0.05, "in_progress"), (1, "recieved", "2021-02-14", "2021-01-10", 0.05, "finished"),
        (1, "recieved", "2021-02-12", "2021-01-10", 0.05, "finished"),
        (2, "booked", "2021-01-01", "2021-01-10", 0.07, "in_progress"), (2, "recieved", "2021-01-05", "2021-01-10", 0.07, "finished"),
        (3, "booked", "2021-01-01", "2021-01-10", 0.05, "in_progress"),
    ]
    df = spark.createDataFrame([(*r, *base.values()) for r in log], (
        "shipping_id int, state string, state_datetime string, shipping_plan_datetime string, rate double, status string, payment int, "
        "vendor_id int, shipping_country string, vendor_agreement_description string, shipping_transfer_description string, trate double"))
    return df.select("shipping_id", "state", ts("state_datetime"), ts("shipping_plan_datetime"), "status",
                     F.col("payment").cast("decimal(14,2)"), "vendor_id", "shipping_country", "vendor_agreement_description",
                     "shipping_transfer_description", F.col("rate").cast("decimal(14,3)").alias("shipping_country_base_rate"),
                     F.col("trate").cast("decimal(14,3)").alias("shipping_transfer_rate"))


def test_shipping_mart(spark, rows):
    log = shipping_log(spark)
    rates, transfers, agreements = (
        shipping.shipping_country_rates(log), shipping.shipping_transfer(log), shipping.shipping_agreement(log))
    assert rows(rates, "id", "shipping_country") == [(1, "ru"), (2, "ru")]
    info = shipping.shipping_info(log, rates, transfers, agreements)
    assert info.count() == 3  # a country with two rates does not multiply rows
    mart = shipping.shipping_datamart(info, shipping.shipping_status(log), transfers, agreements, rates)
    got = rows(mart, "shipping_id", "is_delay", "is_shipping_finish", "delay_day_at_shipping", "delay_total_days", "shipping_months", "shipping_days")
    assert got == [(1, 1, 1, 4, 35, 1, 13), (2, 0, 1, 0, 0, 0, 4)]  # not received: left out; one month four days shows four
    straight = shipping.shipping_datamart_of_log(log)
    assert straight.columns == mart.columns
    assert sorted(map(str, straight.collect())) == sorted(map(str, mart.collect()))
    first = mart.where("shipping_id = 1").select(F.col("vat").cast("double"), F.col("profit").cast("double")).first()
    assert tuple(first) == (9.5, 10.0)


# ---- sales ---------------------------------------------------------------------------


def test_retention_counts_and_signs(spark, rows):
    inc = spark.createDataFrame([
        ("1", "2022-05-02", 1, "shipped", 10), ("2", "2022-05-03", 2, "shipped", 5), ("3", "2022-05-04", 2, "refunded", 5),
        ("4", "2022-05-04", 3, "refunded", 4), ("5", "2022-05-04", 3, "refunded", 4)], "uniq_id string, date_time string, customer_id int, status string, payment_amount int")
    inc = inc.select("uniq_id", ts("date_time"), "customer_id", "status", F.col("payment_amount").cast("decimal(10,2)"),
                     F.lit(1).alias("item_id"), F.lit(1).alias("city_id"), F.lit(1).alias("quantity"))
    cal = sales.calendar(inc, "date_time")
    facts = sales.fact_sales(inc, cal)
    assert sales.fact_sales(inc, cal, "2022-05-04").count() == 3
    got = sales.customer_retention(facts, cal).first()
    assert (got.new_customers_count, got.returning_customers_count, got.refunded_customer_count) == (1, 2, 2)
    assert (got.new_customers_revenue, got.returning_customers_revenue, got.customers_refunded) == (10, -8, -8)
    assert (got.period_name, got.period_id) == ("weekly", 18)


def test_sale_on_a_date_outside_the_calendar_is_kept(spark):
    inc = spark.createDataFrame([("1", "2022-05-02", 1, "shipped", 10, 1, 1, 1)],
                                "uniq_id string, date_time string, customer_id int, status string, payment_amount int, item_id int, city_id int, quantity int")
    inc = inc.withColumn("date_time", F.col("date_time").cast("timestamp_ntz"))
    assert sales.fact_sales(inc, sales.calendar(inc, "date_time").where("false")).first().date_id is None


def test_customer_with_two_names_gives_one_row(spark, rows):
    inc = spark.createDataFrame([(1, "2022-01-01", "a", "Old", "X", 3), (1, "2022-01-02", "b", "New", "X", 2), (None, "2022-01-02", "c", "N", "X", 2)],
                                "customer_id int, date_time string, uniq_id string, first_name string, last_name string, city_id int")
    existing = spark.createDataFrame([(None,)], "customer_id int")
    assert rows(sales.new_customers(inc, existing)) == [(1, "New", "X", 3)]


# ---- settlement, couriers, metrics ---------------------------------------------------


def test_settlement_uses_closed_orders_and_current_versions(spark, rows):
    facts = spark.createDataFrame([(1, 1, 100, 10, 1), (1, 2, 50, 0, 1), (2, 1, 70, 0, 0)], "order_id int, product_id int, total_sum int, bonus_payment int, bonus_grant int")
    facts = facts.select("order_id", "product_id", *[F.col(c).cast("decimal(14,2)") for c in ("total_sum", "bonus_payment", "bonus_grant")])
    orders = spark.createDataFrame([(1, 5, 9, "CLOSED"), (2, 5, 9, "CANCELLED")], "id int, restaurant_id int, timestamp_id int, order_status string")
    days = spark.createDataFrame([(9, "2022-05-01")], "id int, date string")
    products = spark.createDataFrame([(1, 5, "2099-12-31"), (2, 5, "2000-01-01")], "id int, restaurant_id int, active_to string").select("id", "restaurant_id", ts("active_to"))
    places = spark.createDataFrame([(5, "R", "2099-12-31")], "id int, restaurant_name string, active_to string").select("id", "restaurant_name", ts("active_to"))
    got = settlement.settlement_report(facts, orders, days, products, places, F.lit("2022-06-01").cast("timestamp_ntz")).first()
    assert (got.orders_count, got.orders_total_sum, got.order_processing_fee, got.restaurant_reward_sum) == (1, 100, 25, 65)


def test_courier_pay_is_not_below_the_floor(spark):
    deliveries = spark.createDataFrame([(1, 3, "d1", 4)], "order_id int, courier_id int, delivery_id string, rate int").select(
        "*", F.lit("100").cast("decimal(14,2)").alias("sum"), F.lit("10").cast("decimal(14,2)").alias("tip_sum"))
    couriers = spark.createDataFrame([(3, "C")], "id int, courier_name string")
    orders = spark.createDataFrame([(1, 7)], "id int, timestamp_id int")
    days = spark.createDataFrame([(7, 2022, 5)], "id int, year int, month int")
    got = settlement.courier_ledger(deliveries, couriers, orders, days).first()
    assert (got.courier_order_sum, got.courier_reward_sum, got.order_processing_fee) == (150, 159.5, 25)


def test_metrics_filters_and_dates(spark, rows):
    tx = spark.createDataFrame([
        ("a", 1, 2, 430, "RU", "done", "sbp_incoming", 100), ("b", 1, 2, 430, "RU", "done", "sbp_incoming", 50), ("c", -1, 2, 430, "RU", "done", "sbp_incoming", 50),
        ("d", 1, 2, 430, "RU", "blocked", "sbp_incoming", 50), ("e", 1, 2, 430, "RU", "done", "other", 50), ("f", 1, 2, 440, "RU", "done", "sbp_incoming", 50)],
        "operation_id string, account_number_from int, account_number_to int, currency_code int, country string, status string, transaction_type string, amount int")
    tx = tx.withColumn("transaction_dt", F.lit("2022-10-01 12:00:00").cast("timestamp_ntz"))
    rates = spark.createDataFrame([(430, 420), (430, 999)], "currency_code int, currency_code_with int").select(
        F.lit("2022-10-01").cast("timestamp_ntz").alias("date_update"), "*", F.lit("1.10").cast("decimal(5,2)").alias("currency_with_div"))
    got = metrics.global_metrics(tx, rates, "2022-10-02").collect()
    assert len(got) == 1 and got[0].date_update.isoformat() == "2022-10-02T00:00:00"
    assert (float(got[0].amount_total), got[0].cnt_transactions, float(got[0].avg_transactions_per_account)) == (1.65, 2, 2.0)
    assert metrics.global_metrics(tx, rates, "2022-10-03").count() == 0


# ---- documents -----------------------------------------------------------------------


def docs(spark, items):
    return spark.createDataFrame([(i, str(d.get("_id", i)), json.dumps(d, ensure_ascii=False)) for i, d in enumerate(items)],
                                 "id int, object_id string, object_value string").withColumn("update_ts", F.lit("2022-05-01 10:00:00").cast("timestamp_ntz"))


def test_product_sales(spark, rows):
    orders = delivery.parsed_orders(docs(spark, [
        {"_id": "o1", "final_status": "CLOSED", "order_items": [{"id": "p1", "quantity": 2, "price": 10}, {"id": "p2", "quantity": 1, "price": 5}]},
        {"_id": "o2", "final_status": "CANCELLED", "order_items": [{"id": "p1", "quantity": 1, "price": 10}]},
        {"_id": "o3", "final_status": "CLOSED", "order_items": [{"id": "p1", "quantity": 1, "price": 10}, {"id": "p9", "quantity": 1, "price": 1}]}]))
    bonus = lambda pay: json.dumps({"order_id": "o1", "product_payments": [{"product_id": "p1", "bonus_payment": pay, "bonus_grant": 1}]})
    events = spark.createDataFrame([(1, "2022-05-01", "bonus_transaction", bonus(3)), (2, "2022-05-02", "bonus_transaction", bonus(4)), (3, "2022-05-03", "other", bonus(9))],
                                   "id int, event_ts string, event_type string, event_value string")
    dm_orders = spark.createDataFrame([(1, "o1"), (2, "o2"), (3, "o3")], "id int, order_key string")
    dm_products = spark.createDataFrame([(11, "p1"), (12, "p2")], "id int, product_id string")
    facts, rejects = delivery.fact_product_sales(orders, delivery.order_bonuses(events), dm_orders, dm_products)
    got = [tuple(float(x) for x in r) for r in rows(facts, "order_id", "product_id", "total_sum", "bonus_payment", "bonus_grant")]
    assert got == [(1, 11, 20, 4, 1), (1, 12, 5, 0, 0), (3, 11, 10, 0, 0)]  # last bonus event; 0 for an item without bonus
    assert rows(rejects) == [("o3", "p9", "product")]


def test_dimensions_from_documents(spark, rows):
    people = docs(spark, [{"_id": "u1", "name": "O'Hara", "login": "x"}, {"_id": "u2", "name": "Жан", "login": "y"}])
    assert rows(delivery.dim_users(people)) == [("u1", "O'Hara", "x"), ("u2", "Жан", "y")]
    assert rows(delivery.dim_users(people, spark.createDataFrame([("u1",)], "user_id string")), "user_id") == [("u2",)]
    menus = docs(spark, [{"_id": "r1", "name": "R", "menu": [{"_id": "p1", "name": "Tea", "price": 3.5}]}, {"_id": "r2", "name": "S", "menu": [{"_id": "p2", "name": "Pie", "price": 1}]}])
    dim = spark.createDataFrame([(7, "r1")], "id int, restaurant_id string")
    known, rejects = delivery.dim_products(menus, dim)
    assert rows(known, "restaurant_id", "product_id") == [(7, "p1")] and rows(rejects, "product_id") == [("p2",)]
    couriers = delivery.dim_couriers(docs(spark, [{"_id": "c1", "name": "C"}]))
    assert couriers.first().active_to.isoformat() == "2099-12-31T00:00:00"


def test_deliveries_keep_time_and_ignore_repeats(spark):
    d = {"order_id": "o1", "order_ts": "2022-05-01T10:11:12", "delivery_id": "d1", "courier_id": "c1", "address": "a", "delivery_ts": "2022-05-01T11:00:00", "sum": 100, "tip_sum": 5, "rate": 5}
    stored = docs(spark, [d, d]).withColumn("object_id", F.lit("o1"))
    couriers, orders = spark.createDataFrame([(1, "c1")], "id int, courier_id string"), spark.createDataFrame([(2, "o1")], "id int, order_key string")
    facts = delivery.fact_deliveries(stored, couriers, orders)
    assert facts.count() == 1 and facts.first().order_ts.isoformat() == "2022-05-01T10:11:12"
    assert delivery.fact_deliveries(stored, couriers, orders, facts).count() == 0


# ---- vaults --------------------------------------------------------------------------


def chat(spark):
    t = "timestamp_ntz"
    return {
        "users": spark.createDataFrame([(1, "a", "x", 20), (2, "b", "y", 30)], "id int, chat_name string, country string, age int").withColumn("registration_dt", F.lit("2020-01-01").cast(t)),
        "groups": spark.createDataFrame([(10, 1, "g", False), (11, 9, "h", True)], "id int, admin_id int, group_name string, is_private boolean").withColumn("registration_dt", F.lit("2020-01-01").cast(t)),
        "dialogs": spark.createDataFrame([(100, 1, 2, "hi", 10), (101, 1, 2, "yo", 10), (102, 2, 1, "dm", None)],
                                         "message_id int, message_from int, message_to int, message string, message_group int").withColumn("message_ts", F.lit("2020-02-01").cast(t)),
        "group_log": spark.createDataFrame([(10, 1, None, "add"), (10, 2, 1, "add"), (10, 2, 1, "leave")], "group_id int, user_id int, user_id_from int, event string").withColumn("datetime", F.lit("2020-02-01").cast(t)),
    }


def test_chat_vault_and_conversion(spark):
    stg = chat(spark)
    hubs = chat_vault.chat_hubs(stg, {}, LOAD)
    links = chat_vault.chat_links(stg, hubs, {}, LOAD)
    sats = chat_vault.chat_satellites(stg, hubs, links, {}, LOAD)
    assert {k: v.count() for k, v in (hubs | links | sats).items()} == {
        "h_users": 2, "h_groups": 2, "h_dialogs": 3, "l_admins": 1, "l_user_message": 3, "l_groups_dialogs": 2, "l_user_group_activity": 2,
        "s_admins": 1, "s_user_chatinfo": 2, "s_user_socdem": 2, "s_group_private_status": 2, "s_group_name": 2, "s_dialog_info": 3, "s_auth_history": 3}
    again = chat_vault.chat_satellites(stg, hubs, links, sats, "2022-01-02 00:00:00")
    assert sum(v.count() for v in again.values()) == 0
    got = chat_vault.group_conversion(hubs["h_groups"], links["l_groups_dialogs"], links["l_user_message"], links["l_user_group_activity"], sats["s_auth_history"]).collect()
    assert [(r.cnt_added_users, r.cnt_messages, r.cnt_users, float(r.group_conversion)) for r in got] == [(2, 2, 1, 0.5)]


def test_order_items_missing_from_the_menu_are_set_aside(spark, rows):
    orders = spark.sql("""select cast(1 as bigint) object_id, 'order' object_type, named_struct('date', '2022-01-01 00:00:00', 'cost', 1.0, 'payment', 1.0,
        'final_status', 'CLOSED', 'restaurant', named_struct('id', 'r'), 'user', named_struct('id', 'u'),
        'order_items', array(named_struct('id', 'a', 'name', '', 'price', 1.0, 'quantity', 1), named_struct('id', 'z', 'name', '', 'price', 1.0, 'quantity', 1))) payload""")
    dims_ = (spark.createDataFrame([("u", "U")], "id string, name string"), spark.createDataFrame([("r", "R")], "id string, name string"))
    menu = spark.createDataFrame([("r", "a", "A", "c1"), ("r", "z", "Z", "c1")], "restaurant_id string, id string, name string, category string")
    known, unknown = order_vault.split_known(order_vault.enrich_orders(orders, *dims_, menu.where("id = 'a'")))
    assert (known.count(), unknown.count()) == (0, 1)
    known, _ = order_vault.split_known(order_vault.enrich_orders(orders, *dims_, menu))
    message = order_vault.user_message(known)
    assert rows(order_vault.user_category_counters(message.unionByName(message)), "category_name", "order_cnt") == [("c1", 1)]  # two items, one order, sent twice
    new = order_vault.vault_batch(known, {}, LOAD)
    again = order_vault.vault_batch(known, new, "2022-01-02 00:00:00")
    assert new["l_order_product"].count() == 2 and sum(v.count() for v in again.values()) == 0


# ---- geo -----------------------------------------------------------------------------


def geo_event(kind, user, when, lat, lon, channel=None, to=None):
    return ((user if kind == "message" else None, to, channel if kind == "message" else None, when, str(user) if kind == "reaction" else None,
             str(user) if kind == "subscription" else None, channel if kind == "subscription" else None), kind, lat, lon)


def events(spark, items):
    from martworks.schemas import GEO_EVENT
    return spark.createDataFrame([geo_event(*i) for i in items], GEO_EVENT.replace("event struct", "event struct"))


def cities(spark):
    return spark.createDataFrame([(1, "Sydney", -33.87, 151.21), (2, "Perth", -31.95, 115.86), (3, "Newcastle", -32.93, 151.78)],
                                 "place_id int, place string, lat double, lon double")


def test_user_mart(spark, rows):
    ev = events(spark, [
        ("message", 1, "2022-05-01 10:00:00", -33.8, 151.2, 5), ("message", 1, "2022-05-02 10:00:00", -31.9, 115.8, 5), ("message", 1, "2022-05-03 10:00:00", -33.8, 151.2, 5),
        ("message", 1, "2022-05-20 10:00:00", -32.9, 151.7, 5), ("message", 1, "2022-05-21 10:00:00", -31.9, 115.8, None, 2), ("message", 2, "2022-05-30 00:00:00", -31.9, 115.8, 5),
        ("message", 3, "2022-05-30 00:00:00", None, None, 5)])
    got = rows(user_mart(ev, cities(spark), "2022-05-31"))
    assert [r[:5] for r in got] == [(1, "Newcastle", "Sydney", 4, "Sydney, Perth, Sydney, Newcastle"), (2, "Perth", "Perth", 1, "Perth")]
    assert [r[5].isoformat() for r in got] == ["2022-05-20T20:00:00", "2022-05-30T08:00:00"]  # Newcastle takes Sydney's zone
    from martworks.plans.geo_events import channel_messages, geo_events
    located = geo_events(channel_messages(ev), cities(spark))
    assert rows(home_by_stay(located, "2022-05-31", 15)) == [(1, "Sydney")]
    assert rows(user_cities(located, "2022-05-31", 29), "user_id", "home_city") == [(1, "Perth"), (2, "Perth")]


def test_zone_mart_base_is_weeks_with_messages(spark, rows):
    ev = events(spark, [
        ("message", 1, "2022-05-02 10:00:00", -33.8, 151.2, 5), ("message", 1, "2022-05-03 10:00:00", -33.8, 151.2, 5),
        ("reaction", 1, "2022-05-03 10:00:00", -33.8, 151.2), ("reaction", 1, "2022-05-12 10:00:00", -33.8, 151.2), ("subscription", 2, "2022-05-03 10:00:00", None, None, 5)])
    cols = ["week_message", "week_reaction", "week_subscription", "week_user", "month_reaction"]
    assert rows(geo_zone_mart(ev, cities(spark)), *cols) == [(2, 1, None, 1, 2)]
    assert rows(geo_zone_mart(ev, cities(spark), full=True, zero=True), *cols) == [(0, 1, 0, 0, 2), (2, 1, 0, 1, 2)]


def test_recommendations(spark, rows):
    near = [(-33.870, 151.210), (-33.871, 151.211), (-33.872, 151.209), (-33.873, 151.210), (-33.990, 151.210)]
    items = [("message", u, "2022-05-01 10:00:00", lat, lon, 5) for u, (lat, lon) in enumerate(near, 1)]
    items += [("subscription", u, "2022-05-01 10:00:00", -33.0, 151.0, c) for u in (1, 2, 3, 5) for c in (7, 8)] + [("subscription", 4, "2022-05-01 10:00:00", -33.0, 151.0, 9)]
    items += [("message", 3, "2022-04-01 10:00:00", -33.0, 151.0, None, 1)]
    users = spark.createDataFrame([(i, "t") for i in range(1, 6)], "user_id bigint, local_time string")
    mart = recommendations.recommendation_mart(events(spark, items), cities(spark), users, "2022-05-31")
    # 1-3 wrote to each other, 4 shares no channel, 5 is 13 km away; two shared channels give one row
    assert rows(mart, "user_left", "user_right", "zone_id") == [(1, 2, 1), (2, 3, 1)]


def test_near_pairs_equal_brute_force(spark):
    pts = spark.range(300).select(
        F.col("id").alias("user_id"), (F.col("id") % 3).alias("channel"), (60 + (F.col("id") * 7919 % 400) / 10000).alias("lat"),
        (179.98 + (F.col("id") * 104729 % 400) / 10000).alias("lon")).withColumn("lon", F.when(F.col("lon") > 180, F.col("lon") - 360).otherwise(F.col("lon")))
    from martworks.functions.geo import haversine_km
    a, b = pts.alias("a"), pts.alias("b")
    want = a.join(b, (F.col("a.channel") == F.col("b.channel")) & (F.col("a.user_id") < F.col("b.user_id"))).where(
        haversine_km(F.col("a.lat"), F.col("a.lon"), F.col("b.lat"), F.col("b.lon")) <= 1).select(
            F.col("a.user_id").alias("user_left"), F.col("b.user_id").alias("user_right"))
    for block in (5000, 2):
        got = recommendations.near_pairs(pts, "channel", 1.0, block)
        assert got.count() == want.count() > 100 and got.exceptAll(want).count() == 0


def test_a_pair_with_several_shared_channels_has_one_owner(spark):
    base = spark.range(60).select(
        F.col("id").alias("user_id"), (10 + (F.col("id") * 7919 % 200) / 10000).alias("lat"), (20 + (F.col("id") * 104729 % 200) / 10000).alias("lon"))
    # user n is in channels n % 4 to 11, so pairs share up to twelve; user 59 is alone far away
    pts = base.withColumn("lat", F.when(F.col("user_id") == 59, -50.0).otherwise(F.col("lat"))).withColumn(
        "channel", F.explode(F.sequence(F.col("user_id") % 4, F.lit(11))))
    from martworks.functions.geo import haversine_km
    a, b = pts.alias("a"), pts.alias("b")
    want = a.join(b, (F.col("a.channel") == F.col("b.channel")) & (F.col("a.user_id") < F.col("b.user_id"))).where(
        haversine_km(F.col("a.lat"), F.col("a.lon"), F.col("b.lat"), F.col("b.lon")) <= 1).select(
            F.col("a.user_id").alias("user_left"), F.col("b.user_id").alias("user_right")).distinct()
    # all lists short, some short, none short
    for block, most in ((5000, 256), (3, 256), (3, 10), (5000, 0)):
        got = recommendations.near_pairs(pts, "channel", 1.0, block, most)
        assert got.count() == want.count() > 100 and got.exceptAll(want).count() == 0
    whole = recommendations.near_pairs(pts, "channel", 1.0)
    assert "HashAggregate(keys=[user_left" not in whole._jdf.queryExecution().executedPlan().toString()


def test_near_pairs_of_nobody(spark):
    none = spark.createDataFrame([], "user_id bigint, channel bigint, lat double, lon double")
    assert recommendations.near_pairs(none, "channel", 1.0).count() == 0
