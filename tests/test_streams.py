"""Streams on files: two runs over one checkpoint, resends, repeated batches, late and malformed messages."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from martworks import schemas
from martworks.plans.order_vault import user_category_counters, user_product_counters
from martworks.sources.ledger import BatchLedger, fenced
from martworks.sources.static import StaticSide
from martworks.streaming import campaigns, counters, orders
from martworks.streaming.letters import DeadLetters, ParkedOrders, read_messages
from martworks.streaming.sinks import batch_sink, start
from martworks.streaming.vault import VAULT_TABLES, OrderVault

NOW = 1_000


def put(folder, name, items):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps({"value": v if v is None or isinstance(v, str) else json.dumps(v)}) for v in items))


def topic(spark, folder):
    return spark.readStream.schema("value string").json(str(folder))


def campaign(i, begin, end, restaurant="r1"):
    return {"restaurant_id": restaurant, "adv_campaign_id": str(i), "adv_campaign_content": "c", "adv_campaign_owner": "o",
            "adv_campaign_owner_contact": "k", "adv_campaign_datetime_start": begin, "adv_campaign_datetime_end": end, "datetime_created": 1}


def test_campaigns(spark, tmp_path, rows):
    box = tmp_path / "in"
    put(box, "1.json", [campaign(1, 1, 5_000), campaign(2, NOW, 5_000), campaign(3, 1, NOW), "{broken", campaign(4, 1, 5_000, "nobody")])
    raw = spark.createDataFrame([(1, "a", "r1"), (2, "a", "r1"), (3, "b", "r1")], "id int, client_id string, restaurant_id string")
    subscribers = StaticSide(spark, f"{tmp_path}/static", f"subscribers_{tmp_path.name}", "restaurant_id", campaigns.SUBSCRIBER)
    assert subscribers.refresh(raw, "v1", 4)
    sinks = campaigns.campaign_sinks(f"{tmp_path}/snapshot", None, None, batch_sink(f"{tmp_path}/feedback"))
    run = lambda: campaigns.run_campaigns(topic(spark, box), subscribers, sinks, f"{tmp_path}/ck", f"{tmp_path}/dead", F.lit(NOW)).awaitTermination()
    run()
    feedback = lambda: spark.read.parquet(f"{tmp_path}/feedback")
    assert rows(feedback(), "adv_campaign_id", "client_id", "trigger_datetime_created") == [("1", "a", NOW), ("1", "b", NOW)]
    assert rows(DeadLetters(spark, f"{tmp_path}/dead").read()) == [("{broken", "malformed", 1)]
    put(box, "2.json", [campaign(5, 1, 5_000)])
    run()
    assert feedback().count() == 4  # the first message is not delivered again
    assert rows(spark.read.parquet(f"{tmp_path}/snapshot"), "adv_campaign_id") == [("5",), ("5",)]


def test_static_side_reads_the_raw_table_once_per_version(spark, tmp_path, rows):
    read = spark.sparkContext.accumulator(0)

    def counted(frames):
        for frame in frames:
            read.add(len(frame))
            yield frame

    raw = lambda n: spark.range(n).selectExpr("string(id % 5) as k", "id % 3 as v").mapInPandas(counted, "k string, v long")
    side = StaticSide(spark, f"{tmp_path}/s", f"side_{tmp_path.name}", "k", ["k", "v"])
    with pytest.raises(ValueError):
        side.read()
    assert side.refresh(raw(60), "v1", 4) and not side.refresh(raw(60), "v1", 4)
    batch = spark.createDataFrame([("1",), ("9",)], "k string")
    assert rows(side.join(batch)) == rows(side.join(batch)) == [("1", 0), ("1", 1), ("1", 2)]
    assert read.value == 60
    assert side.refresh(raw(1), "v2", 4) and read.value == 61 and rows(side.read(), "k", "v") == [("0", 0)]
    # another session, which does not know the table, reads the same files
    spark.sql(f"drop table side_{tmp_path.name}_v2")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = StaticSide(spark, f"{tmp_path}/b", f"big_{tmp_path.name}", "k", ["k", "v"])
        big.refresh(raw(60), "v1", 4)
        plan = big.join(batch.repartition(4, "k"))._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1  # of the micro-batch only
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_sink_with_a_ledger_takes_a_batch_once(spark, tmp_path):
    taken, ledger = [], BatchLedger(spark, f"{tmp_path}/ledger")
    sink = fenced(ledger, "topic", lambda df, batch: taken.append(batch))
    for batch in (0, 0, 1, 1, 0, 2):
        sink(None, batch)
    assert taken == [0, 1, 2] and ledger.last("topic") == 2 and ledger.last("other") == -1

    def fails(df, batch):
        raise RuntimeError("no connection")

    with pytest.raises(RuntimeError):
        fenced(ledger, "topic", fails)(None, 3)
    assert ledger.last("topic") == 2  # it is sent again


def test_now_is_taken_per_batch(spark):
    plan = campaigns.active_campaigns(spark.createDataFrame([campaign(1, 1, 2)], schemas.CAMPAIGN))
    assert plan.count() == 0  # ended in 1970


def test_every_message_has_a_reason_or_fields(spark):
    texts = [json.dumps(order(1, "OPEN", ["a"])), "{broken", None, "  ", "{}", "[1]", "7", '{"object_id":"x"}', '{"object_id":2,"payload":{"cost":"no number"}}']
    got = read_messages(spark.createDataFrame([(t,) for t in texts], "value string"), schemas.ORDER_MESSAGE, "object_id").collect()
    assert [r.reason for r in got] == [None, "malformed", "empty", "empty", "no object_id", "malformed", "malformed", "malformed", "malformed"]
    assert got[0].object_id == 1 and got[0].payload.order_items[0].id == "a"


def message(order, user, products):
    return (order, user, [f"p{p}" for p in products], [f"name{p}" for p in products], ["c"] * len(products), ["cat"] * len(products))


def test_counters_equal_batch_and_ignore_resends(spark, tmp_path, rows):
    box, out = f"{tmp_path}/in", f"{tmp_path}/out"
    sent = []

    def send(*items):
        sent.extend(items)
        spark.createDataFrame(list(items), schemas.USER_MESSAGE).coalesce(1).write.mode("append").parquet(box)

    def run():
        stream = spark.readStream.schema(schemas.USER_MESSAGE).parquet(box)
        counters.run_counters(stream, "product", out, f"{tmp_path}/ck").awaitTermination()
        return rows(counters.read_counters(spark, out, "product"), "user_id", "product_id", "order_cnt")

    send(message(1, "u", [1, 2]), message(2, "u", [1]), message(3, "v", [1]))
    assert run() == [("u", "p1", 2), ("u", "p2", 1), ("v", "p1", 1)]
    send(message(2, "u", [1]), message(4, "u", [2]))  # order 2 is sent again
    got = run()
    batch = user_product_counters(spark.createDataFrame(sent, schemas.USER_MESSAGE))
    assert got == rows(batch, "user_id", "product_id", "order_cnt") == [("u", "p1", 2), ("u", "p2", 2), ("v", "p1", 1)]
    assert rows(user_category_counters(spark.createDataFrame(sent, schemas.USER_MESSAGE)), "user_id", "order_cnt") == [("u", 3), ("v", 1)]


def test_late_orders_count_once(spark, tmp_path, rows):
    box, out = f"{tmp_path}/in", f"{tmp_path}/out"
    ddl = schemas.USER_MESSAGE + ", seen_at timestamp"
    sent = [[(1, "2022-01-01 00:00:00"), (1, "2022-01-01 00:05:00"), (2, "2022-01-01 00:06:00")],
            [(3, "2022-06-01 00:00:00")], [(4, "2021-01-01 00:00:00"), (1, "2021-01-01 00:00:00")]]
    for part in sent:
        frame = spark.createDataFrame([(*message(o, "u", [1]), t) for o, t in part], schemas.USER_MESSAGE + ", t string")
        frame.withColumn("seen_at", F.col("t").cast("timestamp")).drop("t").coalesce(1).write.mode("append").parquet(box)
        stream = spark.readStream.schema(ddl).parquet(box)
        counters.run_counters(stream, "product", out, f"{tmp_path}/ck").awaitTermination()
    assert rows(counters.read_counters(spark, out, "product"), "order_cnt") == [(4,)]


def test_counters_of_a_repeated_batch(spark, tmp_path, rows):
    write = counters.counter_writer(f"{tmp_path}/out", "product_id", "product_name", fan=2)
    ddl = "user_id string, product_id string, order_id long, product_name string"
    batch = lambda *sent: spark.createDataFrame([("u", *r, "name") for r in sent], ddl)
    for number, df in ((0, batch()), (1, batch(("p", 1), ("p", 2), (None, 1))), (2, batch(("p", 2), ("p", 3), (None, 1))), (3, batch(("p", 4)))):
        for _ in range(2):
            write(df, number)
    assert rows(counters.read_counters(spark, f"{tmp_path}/out", "product"), "product_id", "order_cnt") == [("p", 4), (None, 1)]


def test_a_counter_batch_that_failed_half_way_is_completed(spark, tmp_path, rows):
    ddl = "user_id string, product_id string, order_id long, product_name string"
    df = spark.createDataFrame([("u", "p", 1, "name"), ("u", "p", 2, "name")], ddl)
    store = counters.CounterStore(spark, f"{tmp_path}/out", "product_id", "product_name", {f.name: f.dataType for f in df.schema})
    real = store.orders.append
    store.orders.append = lambda *a: (_ for _ in ()).throw(RuntimeError("lost"))
    with pytest.raises(RuntimeError):
        store.add(df, 0)
    store.orders.append = real
    store.add(df, 0)
    store.add(df, 1)
    assert rows(store.counts.read(), "order_cnt") == [(2,)]


def order(i, status, items, sent="2022-01-01 00:00:00"):
    return {"object_id": i, "object_type": "order", "sent_dttm": sent, "payload": {
        "date": sent, "cost": 10, "payment": 9, "final_status": status, "restaurant": {"id": "r"}, "user": {"id": "u"},
        "order_items": [{"id": p, "price": 1, "quantity": 1} for p in items]}}


def dims(spark, items=(("r", "a", "A", "c1"), ("r", "b", "B", "c1"))):
    return (spark.createDataFrame([("u", "U")], "id string, name string"), spark.createDataFrame([("r", "R")], "id string, name string"),
            spark.createDataFrame(list(items), "restaurant_id string, id string, name string, category string"))


def sizes_of(vault):
    return {t: vault.table(t).count() for t in VAULT_TABLES}


def test_order_stream(spark, tmp_path, rows):
    box, root = tmp_path / "in", f"{tmp_path}/dds"
    write = orders.order_writer(root, *dims(spark), lambda b: f"2022-02-{b + 1:02d} 00:00:00", 2)
    run = lambda: orders.run_orders(topic(spark, box), write, f"{tmp_path}/ck").awaitTermination()
    vault = OrderVault(spark, f"{root}/vault", 2)
    put(box, "1.json", [order(1, "OPEN", ["a", "b"]), order(2, "OPEN", ["a"]), order(3, "OPEN", ["zzz"]), "{broken", None, order(2, "OPEN", ["a"])])
    run()
    sizes = sizes_of(vault)
    assert sizes == {
        "h_order": 2, "h_user": 1, "h_restaurant": 1, "h_product": 2, "h_category": 1, "l_order_product": 3, "l_product_category": 2,
        "l_order_user": 2, "l_product_restaurant": 2, "s_order_cost": 2, "s_order_status": 2, "s_product_names": 2, "s_restaurant_names": 1, "s_user_names": 1}
    assert rows(vault.table("s_order_cost"), "cost", "payment")[0][0] == 10
    counted = lambda: rows(spark.read.parquet(f"{root}/batches"), "batch_id", "n_in", "n_malformed", "n_repeated", "n_known", "n_parked")
    assert counted() == [(0, 6, 2, 1, 2, 1)]
    assert rows(ParkedOrders(spark, root, 2).parked(), "object_id") == [(3,)]
    assert rows(DeadLetters(spark, f"{root}/dead", 2).read(), "reason", "n") == [("empty", 1), ("malformed", 1)]
    put(box, "2.json", [order(1, "OPEN", ["a", "b"]), order(2, "CLOSED", ["a"], "2022-01-02 00:00:00")])
    run()
    after = sizes_of(vault)
    assert {t: n - sizes[t] for t, n in after.items() if n != sizes[t]} == {"s_order_status": 1}  # only the changed status
    raw = orders.raw_store(spark, root, 2).read()
    assert rows(raw, "object_id") == [(1,), (2,), (3,)] and "CLOSED" in rows(raw.where("object_id = 2"), "payload")[0][0]


def test_a_parked_order_appears_once_its_keys_do(spark, tmp_path, rows):
    root = f"{tmp_path}/dds"
    users, restaurants, menu = dims(spark)
    write = orders.order_writer(root, users.where("false"), restaurants, menu.where("id = 'a'"), lambda b: "2022-02-01 00:00:00", 2)
    sent = [order(1, "OPEN", ["a"]), order(2, "OPEN", ["a", "b"]), order(3, "OPEN", []), order(1, "CLOSED", ["a"], "2022-01-05 00:00:00")]
    write(spark.createDataFrame([(json.dumps(m),) for m in sent], "value string"), 0)
    vault, parking = OrderVault(spark, f"{root}/vault", 2), ParkedOrders(spark, root, 2)
    assert vault.table("h_order").count() == 0
    assert rows(parking.parked().select("object_id", F.transform("lacks", lambda x: x["kind"]).alias("k")), "object_id", "k") == [
        (1, ["user"]), (1, ["user"]), (2, ["item", "user"]), (3, ["user"])]
    none = (users.where("false"), restaurants.where("false"), menu.where("false"))
    # the user arrives, the item does not
    first = (users, none[1], none[2]), (users, restaurants, menu.where("id = 'a'"))
    assert rows(orders.release_parked(root, *first, 0, "2022-02-02 00:00:00", 2), "object_id", "released") == [(1, True), (1, True), (2, False), (3, True)]
    assert rows(vault.table("h_order"), "order_id") == [(1,), (3,)]
    assert rows(vault.table("s_order_status"), "status") == [("CLOSED",), ("OPEN",), ("OPEN",)]
    assert orders.release_parked(root, *first, 0, "2022-02-02 00:00:00", 2).count() == 0  # repeated
    second = (none[0], none[1], menu.where("id = 'b'")), (users, restaurants, menu)
    assert rows(orders.release_parked(root, *second, 1, "2022-02-03 00:00:00", 2), "object_id", "released") == [(2, True)]
    assert parking.parked().count() == 0 and vault.table("h_order").count() == 3
    messages = spark.read.parquet(f"{root}/messages")
    assert sorted(r.order_id for r in messages.collect()) == [1, 1, 2, 3]
    # a release reads the buckets of the new keys only
    hits = parking.store.near(spark.createDataFrame([("user", "u")], "kind string, key string"))
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "bucket" in plan.split("PartitionFilters")[1][:200]


def test_a_repeated_batch_writes_the_same_rows(spark, tmp_path):
    path = f"{tmp_path}/out"
    sink = batch_sink(path)
    for _ in range(2):
        sink(spark.range(5), 0)
    assert spark.read.parquet(path).count() == 5


def test_bounded_batches(spark, tmp_path):
    box, seen = tmp_path / "in", []
    for i in range(3):
        put(box, f"{i}.json", [str(i)])
    stream = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).json(str(box))
    start(stream, lambda df, b: seen.append(df.count()), f"{tmp_path}/ck").awaitTermination()
    assert seen == [1, 1, 1]


@pytest.mark.parametrize("deal", [[[0, 2], [1]], [[2, 2], [1, 0]]])
def test_status_history_is_the_same_however_messages_arrive(spark, tmp_path, rows, deal):
    sent = [order(1, s, ["a"], f"2022-01-0{d} 00:00:00") for d, s in ((1, "A"), (2, "B"), (3, "A"))]
    root = f"{tmp_path}/dds"
    write = orders.order_writer(root, *dims(spark), lambda b: "2022-02-01 00:00:00", 2)
    for number, part in enumerate(deal):
        write(spark.createDataFrame([(json.dumps(sent[i]),) for i in part], "value string"), number)
    vault = OrderVault(spark, f"{root}/vault", 2)
    assert rows(vault.table("s_order_status").select(F.dayofmonth("load_dt").alias("d"), "status"), "d", "status") == [(1, "A"), (2, "B"), (3, "A")]
    assert vault.table("s_order_cost").count() == 1 and vault.table("s_user_names").count() == 1


def test_rows_for_the_stores_are_those_of_the_batch_load(spark, rows):
    from martworks.plans import order_vault
    sent = [order(1, "OPEN", ["a", "b"]), order(2, "CLOSED", ["a"], "2022-01-02 00:00:00"), order(3, "OPEN", [])]
    frame = spark.createDataFrame([(json.dumps(m),) for m in sent], "value string")
    enriched = order_vault.enrich_orders(read_messages(frame, schemas.ORDER_MESSAGE, "object_id"), *dims(spark), "sent_dttm").drop("reasons")
    whole = order_vault.vault_batch(enriched, {}, "2022-02-01 00:00:00")
    for part in order_vault.vault_rows(enriched, "2022-02-01 00:00:00", "sent_dttm"):
        for name in {r.tbl for r in part.select("tbl").distinct().collect()}:
            mine, theirs = order_vault.vault_table(part, name).drop("load_dt").distinct(), whole[name].drop("load_dt")
            assert mine.columns == theirs.columns
            assert rows(mine) == rows(theirs), name
