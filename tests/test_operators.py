from __future__ import annotations

from hypothesis import given, settings, strategies as st
from pyspark.sql import Window, functions as F

from martworks.operators import dims, filters, grouping, joins, quality, ranking, sequences, upsert, vault

LOAD = "2022-01-01 00:00:00"


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=0, max_size=60), st.integers(1, 9))
def test_tiles_equal_ntile(spark, values, n):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v int")
    got = {r.id: r.tile for r in ranking.quintile(df, "v", "id", n).collect()}
    assert got == {r.id: r.tile for r in ranking.tile_window(df, "v", "id", n).collect()}


def test_tiles_of_several_measures_with_one_hot_value(spark):
    df = spark.range(997).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") * 7919 % 100).alias("a"),
                                 (F.col("id") * 31 % 211).cast("decimal(12,2)").alias("b"))
    got = ranking.tiles(df, {"ta": "a", "tb": "b"}, "id", 5)
    want = got.select("*", F.ntile(5).over(Window.orderBy("a", "id")).alias("wa"), F.ntile(5).over(Window.orderBy("b", "id")).alias("wb"))
    assert want.where("ta <> wa or tb <> wb").count() == 0


def test_dense_ids(spark):
    df = spark.range(500).select((F.col("id") * 7919 % 500).alias("k"))
    assert [r.id - r.k for r in ranking.dense_ids(df, ["k"], start=10).collect()] == [10] * 500


def test_latest_per_key_breaks_ties_by_log_id(spark, rows):
    df = spark.createDataFrame([(1, 5, 1, "a"), (1, 5, 2, "b"), (2, 1, 3, "c")], "k int, t int, id int, s string")
    assert rows(grouping.latest_per_key(df, ["k"], ["t", "id"])) == [(1, 5, 2, "b"), (2, 1, 3, "c")]
    assert rows(grouping.first_per_key(df, ["k"], ["t", "id"])) == [(1, 5, 1, "a"), (2, 1, 3, "c")]


def test_rows_of_numbers_are_picked_without_a_sort(spark, rows):
    df = spark.range(3000).select(
        (F.col("id") % 7).alias("k"),
        F.when(F.col("id") % 11 > 0, (F.lit("0001-01-01").cast("timestamp_ntz") + F.make_dt_interval(days=(F.col("id") * 37 % 3000000).cast("int")))).cast("timestamp_ntz").alias("t"),
        F.when(F.col("id") % 5 > 0, F.col("id") - 1500).otherwise(-9223372036854775807 + F.col("id")).alias("n"), (F.col("id") / 3).alias("x"),
        F.col("id").cast("decimal(30,2)").alias("d"))
    for fn, best in ((grouping.latest_per_key, F.max), (grouping.first_per_key, F.min)):
        got = fn(df, ["k"], ["t", "n"])
        want = df.groupBy("k").agg(best(F.struct("t", "n", "x", "d")).alias("b")).select("k", "b.*")
        assert rows(got) == rows(want)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "HashAggregate" in plan and "Sort" not in plan
    tied = df.withColumn("t", F.to_date(F.lit("2024-01-01"))).drop("n")
    assert rows(grouping.latest_per_key(tied, ["k"], ["t"])) == rows(grouping.latest_per_key(tied.repartition(7), ["k"], ["t"]))
    mixed = df.withColumn("t", F.col("t").cast("date")).withColumn("b", F.col("n") > 3)
    assert rows(grouping.latest_per_key(mixed, ["k"], ["b", "t"]), "k", "b", "t") == rows(
        mixed.groupBy("k").agg(F.max(F.struct("b", "t")).alias("m")).select("k", "m.b", "m.t"))


def test_neighbour_over_ranges_equals_lag(spark):
    df = spark.range(400).select(
        "id", F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id") % 5).alias("u"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(hours=(F.col("id") * 37 % 300).cast("int"))).cast("timestamp_ntz").alias("ts"),
        F.when(F.col("id") % 4 == 0, None).otherwise(F.col("id") % 2).alias("v"))
    w = Window.partitionBy("u").orderBy("ts", "id")
    for forward, fn in ((False, F.lag), (True, F.lead)):
        got = sequences.neighbour(df, ["u"], "ts", ["id"], "v", "n", forward).withColumn("w", fn("v").over(w))
        assert got.where("not (n <=> w)").count() == 0 and got.count() == 400
    top = sequences.running_max(df, ["u"], "ts", "id", "m").withColumn("w", F.max("id").over(Window.partitionBy("u").orderBy("ts")))
    assert top.where("m <> w").count() == 0


def test_one_key_with_all_rows_spreads_over_the_ranges(spark, rows):
    from martworks.operators.ranges import Ranges
    df = spark.range(5000).select(F.lit("k").alias("u"), (F.col("id") * 7919 % 5000).alias("t"), (F.col("id") * 31 % 977).alias("v"))
    laid = Ranges(df, ["u"], ["t"])
    sizes = [r["count"] for r in laid.rows.groupBy("_range").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 2500
    w = Window.partitionBy("u").orderBy("t")
    for got, want in (
            (sequences.neighbour(df, ["u"], "t", [], "v", "n"), F.lag("v").over(w)),
            (sequences.running_max(df, ["u"], "t", "v", "n"), F.max("v").over(w)),
            (sequences.running_sum(df, ["u"], ["t"], F.col("v"), "n"), F.sum("v").over(w)),
            (sequences.numbered(df, ["u"], ["t"], "n"), F.row_number().over(w))):
        assert rows(got, "t", "n") == rows(df.select("t", want.alias("n")))


def test_ranges_of_few_rows_and_none(spark, rows):
    df = spark.createDataFrame([(None, 1, "x"), (None, 2, None), ("a", None, "y")], "u string, t int, v string")
    assert rows(sequences.neighbour(df, ["u"], "t", [], "v", "n"), "u", "t", "n", "n_exists") == [
        ("a", None, None, False), (None, 1, None, False), (None, 2, "x", True)]
    for few in (df.where("false"), df.where("t = 1")):
        assert sequences.neighbour(few, ["u"], "t", [], "v", "n", True).count() == few.count()
        assert sequences.running_max(few, ["u"], "t", "v", "n").count() == few.count()


def test_changes_keep_a_return_to_the_first_city(spark, rows):
    df = spark.createDataFrame([(1, "2024-01-01", "A"), (1, "2024-01-02", "A"), (1, "2024-01-03", "B"), (1, "2024-01-05", "A")],
                               "u int, d string, city string").withColumn("ts", F.col("d").cast("timestamp_ntz"))
    moved = sequences.changes(df, ["u"], "ts", [], "city")
    assert rows(moved, "d", "city") == [("2024-01-01", "A"), ("2024-01-03", "B"), ("2024-01-05", "A")]
    assert rows(sequences.ordered_runs(moved, ["u"], "ts", [], "city", "trip")) == [(1, 3, "A, B, A")]


def test_upsert_twice_is_upsert_once(spark, rows):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, s string, n int")
    source = spark.createDataFrame([(2, "x", 21, 1), (2, "y", 22, 2), (3, "z", 30, 1), (None, "q", 0, 1)], "k int, s string, n int, v int")
    once = upsert.upsert(target, source, ["k"], ["n"], ["v"])
    assert rows(once) == [(1, "a", 10), (2, "b", 22), (3, "z", 30)]
    assert rows(upsert.upsert(once, source, ["k"], ["n"], ["v"])) == rows(once)


def test_upsert_can_set_null(spark, rows):
    target = spark.createDataFrame([(1, "a")], "k int, s string")
    source = spark.createDataFrame([(1, None)], "k int, s string")
    assert rows(upsert.upsert(target, source, ["k"], ["s"])) == [(1, None)]


def test_insert_new_is_not_stopped_by_a_null_in_the_target(spark, rows):
    target = spark.createDataFrame([(1,), (None,)], "k int")
    source = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    assert rows(upsert.insert_new(target, source, "k")) == [(2,)]


def test_counter_replay_changes_nothing(spark, rows):
    state = spark.createDataFrame([("u", "p", 1)], "u string, p string, n bigint")
    counts = spark.createDataFrame([("u", "p", 2), ("u", "q", 1)], "u string, p string, n bigint")
    once = upsert.upsert_counter(state, counts, ["u", "p"], "n")
    assert rows(once) == rows(upsert.upsert_counter(once, counts, ["u", "p"], "n")) == [("u", "p", 2), ("u", "q", 1)]


def test_resolve_ids_returns_rejects(spark, rows):
    df = spark.createDataFrame([("a",), ("x",)], "key string")
    dim = spark.createDataFrame([(1, "a")], "id int, code string")
    ok, bad = joins.resolve_ids(df, dim, "key", "code", "id", "dim_id")
    assert rows(ok) == [("a", 1)] and rows(bad) == [("x",)]


def test_with_all_fills_defaults(spark, rows):
    base, agg = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(1, 5)], "k int, n int")
    assert rows(joins.with_all(base, agg, "k", {"n": F.lit(0)}), "k", "n") == [(1, 5), (2, 0)]


def test_salted_pairs_equal_a_join(spark):
    left = spark.range(60).select(F.when(F.col("id") < 40, 0).otherwise(F.col("id") % 5).alias("k"), F.col("id").alias("u"))
    right = left.withColumnRenamed("u", "v")
    plain = left.join(right, "k")
    salted = joins.salted_pairs(left, right, ["k"], F.col("u"), F.col("v"), 7)
    assert salted.count() == plain.count() == salted.distinct().count()
    assert salted.select("k", "u", "v").exceptAll(plain).count() == 0


def test_enrich_keeps_order_and_unknown_items(spark):
    orders = spark.sql("select 1 as o, 'r' as r, array(named_struct('id', 'b'), named_struct('id', 'x'), named_struct('id', 'a')) as items")
    menu = spark.createDataFrame([("r", "a", "A"), ("r", "b", "B"), ("s", "x", "X")], "r string, id string, name string")
    got = joins.enrich_items(orders, "o", "items", "id", menu, ["r"], ["name"]).first()
    assert [tuple(i) for i in got["items"]] == [("b", "B"), ("x", None), ("a", "A")]


def test_active_at_excludes_both_ends(spark, rows):
    df = spark.createDataFrame([(1, 5, 9), (2, 1, 5), (3, 4, 6)], "id int, a int, b int")
    assert rows(filters.active_at(df, "a", "b", F.lit(5)), "id") == [(3,)]


def test_on_day_is_half_open(spark, rows):
    df = spark.createDataFrame([("2022-01-01 00:00:00",), ("2022-01-01 23:59:59.9",), ("2022-01-02 00:00:00",)], "s string").withColumn(
        "ts", F.col("s").cast("timestamp_ntz"))
    assert filters.on_day(df, "ts", "2022-01-01").count() == 2


def test_week_across_two_months_is_split(spark, rows):
    df = spark.createDataFrame([("2022-01-31",), ("2022-02-01",), ("2022-02-14",)], "d string").select(F.col("d").cast("date"), F.lit("c").alias("city"))
    got = grouping.week_and_month_counts(df, "d", ["city"], "message").select(
        F.col("month").cast("string"), F.col("week").cast("string"), "week_message", "month_message")
    assert rows(got) == [("2022-01-01", "2022-01-31", 1, 1), ("2022-02-01", "2022-01-31", 1, 2), ("2022-02-01", "2022-02-14", 1, 2)]


def test_hub_and_link_reload_adds_nothing(spark):
    src = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    hub = vault.load_hub(src, "hk", "k", None, "s3", LOAD)
    assert hub.count() == 2 and vault.load_hub(src, "hk", "k", hub, "s3", LOAD).count() == 0
    pairs = hub.select(F.col("hk").alias("a"), F.col("hk").alias("b"))
    link = vault.load_link(pairs, "lk", ["a", "b"], None, "s3", LOAD)
    assert link.count() == 2 and vault.load_link(pairs, "lk", ["a", "b"], link, "s3", LOAD).count() == 0


def test_satellite_stores_changes_only(spark, rows):
    first = vault.load_satellite(spark.createDataFrame([(1, "a"), (2, "b")], "k int, n string"), "k", ["n"], None, "s3", LOAD)
    later = spark.createDataFrame([(1, "a"), (2, "c")], "k int, n string")
    second = vault.load_satellite(later, "k", ["n"], first, "s3", "2022-01-02 00:00:00")
    assert rows(second, "k", "n") == [(2, "c")]
    both = first.unionByName(second)
    assert vault.load_satellite(later, "k", ["n"], both, "s3", "2022-01-03 00:00:00").count() == 0
    assert rows(vault.current_satellite(both, "k"), "k", "n") == [(1, "a"), (2, "c")]


def test_close_missing_closes_open_rows_once(spark, rows):
    dim = spark.createDataFrame([(1, "2099-12-31"), (2, "2099-12-31"), (3, "2020-01-01")], "k int, t string").select(
        "k", F.col("t").cast("timestamp_ntz").alias("active_to"))
    source = spark.createDataFrame([(1,)], "k int")
    at = lambda d: F.lit(d).cast("timestamp_ntz")
    once = dims.close_missing(dim, source, "k", at("2022-01-01"))
    got = once.select("k", F.col("active_to").cast("date").cast("string"))
    assert rows(got) == [(1, "2099-12-31"), (2, "2022-01-01"), (3, "2020-01-01")]
    assert rows(dims.close_missing(once, source, "k", at("2023-01-01"))) == rows(once)


def test_validity_update_keeps_the_first_active_from(spark, rows):
    dim = spark.createDataFrame([("c", "old", 1)], "key string, name string, active_from int")
    source = spark.createDataFrame([("c", "new", 2), ("d", "x", 2)], "key string, name string, active_from int")
    assert rows(dims.upsert_validity(dim, source, "key", ["name"])) == [("c", "new", 1), ("d", "x", 2)]


def test_evolve(spark, rows):
    from pyspark.sql.types import StructType
    old = spark.createDataFrame([(1,)], "a int")
    assert rows(dims.evolve(old, StructType.fromDDL("a bigint, status string"), {"status": "shipped"})) == [(1, "shipped")]


def test_expectations(spark, rows):
    df = spark.createDataFrame([(1, 5, "ab"), (None, 9, "abcdef")], "k int, n int, s string")
    rules = [quality.not_null("k"), quality.in_range("n", 1, 8), quality.max_length("s", 3)]
    good, bad = quality.expect(df, rules)
    assert rows(good, "n") == [(5,)]
    assert bad.first().violations == ["k_not_null", "n_range", "s_length"]
    assert rows(quality.violation_counts(df, rules)) == [("k_not_null", 1), ("n_range", 1), ("s_length", 1)]
    assert quality.describe_table(df).count() == 3
