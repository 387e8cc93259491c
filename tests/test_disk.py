"""What a load or a written table leaves on disk: its result, and nothing of the way there."""

from __future__ import annotations

import os
import re

from pyspark.sql import functions as F

from martworks import session
from martworks.catalog import QUERIES
from martworks.functions.keys import uuid3
from martworks.operators.grouping import latest_per_key
from martworks.operators.joins import enrich_items
from martworks.operators.vault import load_link
from martworks.plans.recommendations import near_pairs
from martworks.sources.history import HistoryStore
from martworks.streaming.counters import counter_writer
from martworks.streaming.orders import order_writer, release_parked


# pairs dealt by both users, or joined by one of them
PAIRS_MOVED = r"hashpartitioning\(user_left#\d+L?, user_right|Join \[user_left"


def staged(spark):
    root = os.path.dirname(session.run_dir(spark, "x"))
    return {f for f in os.listdir(root) if f.startswith("stage-")} if os.path.isdir(root) else set()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def dims(spark):
    return (spark.createDataFrame([("u1", "Ann")], "id string, name string"), spark.createDataFrame([("r1", "Rest")], "id string, name string"),
            spark.createDataFrame([("r1", "p1", "Soup", "Hot")], "restaurant_id string, id string, name string, category string"))


def order(number, user="u1"):
    return (f'{{"object_id": {number}, "object_type": "order", "sent_dttm": "2022-01-01 00:00:00", "payload": {{"date": "2022-01-01 00:00:00", '
            f'"cost": 1, "payment": 1, "final_status": "CLOSED", "restaurant": {{"id": "r1"}}, "user": {{"id": "{user}"}}, '
            f'"order_items": [{{"id": "p1", "price": 1, "quantity": 1}}]}}}}',)


def test_batches_of_orders_leave_no_staged_tables(spark, tmp_path):
    users, places, menu = dims(spark)
    root, at = str(tmp_path / "dds"), lambda batch: "2022-02-01 00:00:00"
    before = staged(spark)
    write = order_writer(root, users, places, menu, at, buckets=2)
    write(spark.createDataFrame([order(1), order(2, "u2"), ("no",)], "value string"), 0)
    write(spark.createDataFrame([order(1), order(3), ("no",)], "value string"), 1)
    assert staged(spark) == before
    counts = spark.read.parquet(f"{root}/batches").agg(*[F.sum(c) for c in ("n_in", "n_malformed", "n_known", "n_parked", "n_repeated")]).first()
    assert tuple(counts) == (6, 2, 3, 1, 0)

    late = spark.createDataFrame([("u2", "Bob")], "id string, name string")
    gone = release_parked(root, (late, places.where("false"), menu.where("false")), (users.unionByName(late), places, menu), 0, at(0), 2)
    # what became of the orders is told by a table that stays
    assert [tuple(r) for r in gone.collect()] == [(2, "2022-01-01 00:00:00", True)]
    assert len(staged(spark) - before) == 1


def test_counters_and_histories_leave_no_staged_tables(spark, tmp_path):
    before = staged(spark)
    write = counter_writer(str(tmp_path / "c"), "k", "name", 2)
    for batch in range(2):
        write(spark.createDataFrame([("u", "k", 1, "n"), ("u", "k", 1 + batch, "n")], "user_id string, k string, order_id long, name string"), batch)
    store = HistoryStore(spark, str(tmp_path / "h"), ["k"], "k string, v string", buckets=2)
    rows = spark.createDataFrame([("a", "x", "dx", "s"), ("a", "x", "dx", "s"), ("a", "y", "dy", "s")], "k string, v string, hashdiff string, load_src string")
    rows = rows.withColumn("load_dt", F.lit("2022-01-01").cast("timestamp_ntz"))
    assert store.load(rows, 0) and store.load(rows, 1) and not store.load(rows, 1)
    assert staged(spark) == before
    assert store.versions().count() == 2


def test_a_written_table_leaves_no_shuffle_files(spark):
    tracker = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {b.toString() for b in _each(tracker.getAllBlocks()) if b.toString().startswith("shuffle_")}
    before = files()
    session.reliable(spark.range(1000).repartition(3, "id"))
    assert not files() - before


def _each(seq):
    return [seq.apply(i) for i in range(seq.size())]


def test_a_key_of_keys_is_hashed_once_per_row(spark):
    assert str(uuid3(F.col("a"))._jc.toString()).count("md5") == 1
    src = spark.createDataFrame([("a", "b"), ("a", "c")], "x string, y string")
    members = {"a": uuid3(F.col("x")), "b": uuid3(F.col("y"))}
    key = uuid3(F.concat("a", "b"))
    old = session.reliable(load_link(src.where("y = 'b'"), "pk", members, None, "s", "2001-01-01", key))
    new = load_link(src, "pk", members, old, "s", "2002-01-01", key)
    assert [line for line in plan_of(new).splitlines() if "Filter" in line and "md5" in line] == []
    both = old.unionByName(new)
    assert sorted(map(tuple, both.select("pk", "a", "b").collect())) == sorted(
        map(tuple, load_link(src, "pk", members, None, "s", "2001-01-01", key).select("pk", "a", "b").collect()))


def test_only_keys_and_menu_fields_travel(spark):
    orders = spark.createDataFrame([(1, "r", [("p", 1.5), ("q", 2.5)]), (2, "r", []), (3, "r", None)],
                                   "o long, r string, items array<struct<id:string,price:double>>")
    menu = spark.createDataFrame([("r", "p", "Soup")], "r string, id string, name string")
    rich = enrich_items(orders, "o", "items", "id", menu, ["r"], ["name"])
    assert {r.o: r["items"] and [tuple(i) for i in r["items"]] for r in rich.collect()} == {
        1: [("p", 1.5, "Soup"), ("q", 2.5, None)], 2: None, 3: None}
    assert [line for line in plan_of(rich).splitlines() if "collect_list" in line and "price" in line] == []


def test_latest_row_is_not_carried_twice(spark):
    df = spark.createDataFrame([(1, "a", "x", 1), (1, "b", "y", 2), (2, None, "z", 3)], "k long, t string, v string, n int")
    best = latest_per_key(df, ["k"], ["t", "v"])
    assert sorted(map(tuple, best.collect())) == [(1, "b", "y", 2), (2, None, "z", 3)]
    assert "_row, v," not in plan_of(best) and "struct(v, " not in plan_of(best)
    assert sorted(map(tuple, latest_per_key(df.drop("n"), ["k"], ["t", "v"]).collect())) == [(1, "b", "y"), (2, None, "z")]


def test_pairs_are_not_shuffled_for_what_their_users_know(spark):
    points = spark.createDataFrame([(u, c, -33.0 - (u * 7 % 10) / 500, 151.0 + (u * 3 % 10) / 500) for u in range(30) for c in (u % 3, 3)],
                                   "user_id long, channel long, lat double, lon double")
    apart = spark.createDataFrame([(u, v) for u in range(30) for v in range(u + 1, 30) if (u * v) % 5 == 1 or u == 2], "user_left long, user_right long")
    about = spark.createDataFrame([(u, f"z{u}") for u in range(30) if u % 4], "user_id long, zone string")
    plain = {(r.user_left, r.user_right) for r in near_pairs(points, "channel", 1.0).collect()}
    want = sorted((u, v, f"z{u}") for u, v in plain - {tuple(r) for r in apart.collect()} if u % 4)
    assert 0 < len(want) < len(plain)
    for most in (256, 2, 1):
        got = near_pairs(points, "channel", 1.0, 5000, most, about, apart)
        assert sorted(tuple(r) for r in got.select("user_left", "user_right", "zone").collect()) == want, most
        assert most < 256 or not re.search(PAIRS_MOVED, plan_of(got))
    mart = plan_of(QUERIES["recommendation_mart"](spark, "/root/testdata/sf0.001"))
    assert not re.search(PAIRS_MOVED, mart)
