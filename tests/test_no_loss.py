"""Rows that earlier versions lost or mixed up."""

from __future__ import annotations

from pyspark.sql import functions as F

from martworks import schemas
from martworks.functions import keys
from martworks.operators import joins, sequences, upsert
from martworks.plans import order_vault
from martworks.sources.incremental import incremental_by_id, incremental_by_ts, without_cursor


def test_no_order_vanishes(spark):
    item = lambda i: {"id": i, "name": None, "price": None, "quantity": 1}
    rows = [("o1", "u1", "r1", [item("i1")]), ("o2", "u1", "r1", []), ("o3", "u9", "r1", [item("i1")]),
            ("o4", "u1", "r9", [item("i1")]), ("o5", "u1", "r1", [item("i1"), item("i9")]), ("o6", "u1", "r1", None)]
    messages = spark.createDataFrame([
        {"object_id": i, "object_type": "order", "payload": {"restaurant": {"id": r}, "user": {"id": u}, "order_items": x}}
        for i, u, r, x in [(n, u, r, x) for n, (_, u, r, x) in enumerate(rows, 1)]], schemas.ORDER_MESSAGE)
    users = spark.createDataFrame([("u1", "Una")], "id string, name string")
    places = spark.createDataFrame([("r1", "Roma")], "id string, name string")
    menu = spark.createDataFrame([("r1", "i1", "Soup", "Hot")], "restaurant_id string, id string, name string, category string")
    known, rejects = order_vault.split_known(order_vault.enrich_orders(messages, users, places, menu))
    assert sorted(r.object_id for r in known.collect()) == [1, 2, 6]
    # an unknown restaurant has no menu, so its items are unknown too
    assert {r.object_id: r.reasons for r in rejects.collect()} == {3: ["user"], 4: ["restaurant", "item"], 5: ["item"]}
    assert {r.object_id: len(r.payload.products) for r in known.collect()} == {1: 1, 2: 0, 6: 0}


def test_keys_of_different_parts_differ(spark):
    row = spark.range(1).select(
        keys.hash_key(F.lit("a|b"), F.lit("c")).alias("a"), keys.hash_key(F.lit("a"), F.lit("b|c")).alias("b"),
        keys.hashdiff(F.lit("a|b"), F.lit("c")).alias("c"), keys.hashdiff(F.lit("a"), F.lit("b|c")).alias("d"),
        keys.hashdiff(F.lit("a"), F.lit(None)).alias("e"), keys.hashdiff(F.lit("a"), F.lit("-")).alias("f")).first()
    assert row.a != row.b and row.c != row.d and row.e != row.f


def test_null_keys_carry_over_slots(spark):
    rows = [(None, "2024-01-01 10:00:00", 9), (None, "2024-01-02 10:00:00", 1), ("k", "2024-01-01 10:00:00", 5), ("k", "2024-01-03 10:00:00", 2)]
    frame = spark.createDataFrame(rows, "k string, ts string, v int").withColumn("ts", F.col("ts").cast("timestamp"))
    top = sequences.running_max(frame, ["k"], "ts", "v", "top")
    assert sorted((r.k or "", r.v, r.top) for r in top.collect()) == [("", 1, 9), ("", 9, 9), ("k", 2, 5), ("k", 5, 5)]
    before = sequences.neighbour(frame, ["k"], "ts", [], "v", "before")
    assert sorted((r.k or "", r.v, r.before or 0) for r in before.collect()) == [("", 1, 9), ("", 9, 0), ("k", 2, 5), ("k", 5, 0)]


def test_first_run_reads_everything(spark):
    frame = spark.createDataFrame([(-5, "2021-03-01 00:00:00"), (3, "2023-01-01 00:00:00"), (None, None)], "id int, at string").withColumn(
        "at", F.col("at").cast("timestamp"))
    assert incremental_by_id(frame, "id").count() == 2 and incremental_by_id(frame, "id", 0).count() == 1
    assert incremental_by_ts(frame, "at", None).count() == 2
    assert without_cursor(frame, "id").count() == 1


def test_lookup_splits_without_loss(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "n int, key string")
    dim = spark.createDataFrame([("a", 10)], "code string, id int")
    known, rejects = joins.resolve_ids(facts, dim, "key", "code", "id", "dim_id")
    assert [(r.n, r.dim_id) for r in known.collect()] == [(1, 10)]
    assert sorted(r.n for r in rejects.collect()) == [2, 3] and rejects.columns == facts.columns
    target = spark.createDataFrame([("a", 1)], "key string, n int")
    fresh = upsert.insert_ignore(target, facts.select("key", "n").unionByName(facts.select("key", "n")), ["key"], ["n"])
    assert [(r.key, r.n) for r in fresh.collect()] == [("b", 2)]


def test_two_cities_of_one_name_stay_two(spark):
    from martworks.plans.user_mart import user_mart
    from martworks.schemas import GEO_EVENT
    from tests.test_marts import geo_event
    items = [("message", 1, "2022-05-01 10:00:00", -33.8, 151.2, 5), ("message", 1, "2022-05-02 10:00:00", -31.9, 115.8, 5)]
    places = spark.createDataFrame([(1, "Sydney", -33.87, 151.21), (2, "Perth", -31.95, 115.86), (3, "Perth", -42.0, 147.0)],
                                   "place_id int, place string, lat double, lon double")
    got = user_mart(spark.createDataFrame([geo_event(*i) for i in items], GEO_EVENT), places, "2022-05-31").collect()
    assert [(r.actual_city, r.travel_count) for r in got] == [("Perth", 2)]


def test_nearest_place_is_the_same_for_short_and_long_lists(spark):
    from martworks.functions.geo import nearest_place
    places = spark.range(60).selectExpr("cast(id as int) place_id", "string(id) place", "10 + id * 1e-8 lat", "20 + id % 7 * 1e-8 lon")
    points = spark.range(200).selectExpr("id", "10 + id * 3e-9 lat", "20 + id % 11 * 1e-8 lon")
    short, long = ({r.id: (r.place_id, r.km) for r in nearest_place(points, places, inline_limit=n).collect()} for n in (64, 59))
    assert short == long and len(short) == 200


def test_measures_without_a_common_decimal_are_ranked_apart(spark):
    from martworks.operators.ranking import tiles
    df = spark.range(10).selectExpr("id", "id * 1e-9 as a", "cast(9 - id as int) as b", "cast(id as decimal(38,9)) * 1e-9bd as c")
    got = tiles(df, {"ta": "a", "tb": "b", "tc": "c"}, "id", 5).orderBy("id").collect()
    assert [(r.ta, r.tb, r.tc) for r in got] == [(1 + i // 2, 5 - i // 2, 1 + i // 2) for i in range(10)]


def test_another_bucket_count_is_an_error(spark, tmp_path):
    import pytest
    from martworks.sources import sinks
    path = f"{tmp_path}/t"
    sinks.write_bucketed(spark.range(50).withColumn("v", F.lit(0)), path, ["id"], 8)
    with pytest.raises(ValueError):
        sinks.upsert_table(spark, path, spark.range(50).withColumn("v", F.lit(1)), ["id"], ["v"], 4)
    sinks.upsert_table(spark, path, spark.range(60).withColumn("v", F.lit(1)), ["id"], ["v"], 8)
    assert spark.read.parquet(path).where("v = 1").count() == 60


def test_increments_with_another_header_are_an_error(spark, tmp_path):
    import pytest
    from martworks.sources import files
    (tmp_path / "a.csv").write_text("id,uniq_id,date_time,customer_id\n1,x,2022-01-01T00:00:00,5\n2,x,2022-01-02T00:00:00,6\n")
    assert [r.customer_id for r in files.read_order_increment(spark, str(tmp_path)).collect()] == [6]
    (tmp_path / "b.csv").write_text("id,customer_id,date_time,uniq_id\n1,7,2022-01-01T00:00:00,y\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_order_increment(spark, str(tmp_path)).collect()
