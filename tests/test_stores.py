"""Run stores and histories: batches, compaction, buckets, late versions."""

from __future__ import annotations

import itertools
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from martworks.sources import jdbc, kafka
from martworks.sources.history import HistoryStore
from martworks.sources.runs import RunStore


def test_runs_stay_few_and_rows_whole(spark, tmp_path, rows):
    store = RunStore(spark, f"{tmp_path}/t", "k long, batch int", ["k"], buckets=4, fan=3)
    assert store.read().count() == 0
    seen = []
    for batch in range(13):
        old = store.manifest()
        assert store.append(spark.range(batch, batch + 2).select(F.col("id").alias("k"), F.lit(batch).alias("batch")), batch)
        seen.append(len(store.manifest().runs))
        # a reader with the manifest before sees the table before, merged or not
        assert store.read(manifest=old).count() == 2 * batch
    assert max(seen) <= 2 * 3 and store.read().count() == 26
    assert not store.append(spark.range(5).select(F.col("id").alias("k"), F.lit(99).alias("batch")), 12)
    assert store.append(spark.range(1).select(F.col("id").alias("k"), F.lit(99).alias("batch")), 0, "other")
    assert store.read().count() == 27
    store.compact()
    assert len(store.manifest().runs) == 1 and store.read().count() == 27


def test_a_load_reads_touched_buckets_only(spark, tmp_path):
    store = RunStore(spark, f"{tmp_path}/t", "k long, v int", ["k"], buckets=8, fan=4)
    for batch in range(20):  # as many batches as leave several levels
        store.append(spark.range(batch * 50, batch * 50 + 50).select(F.col("id").alias("k"), F.lit(1).alias("v")), batch)
    one = spark.createDataFrame([(7,)], "k long")
    assert len(store.touched(one)) == 1
    near = store.near(one)
    files = {f.split("/bucket=")[1].split("/")[0] for f in near.inputFiles()}
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters") == len(store.manifest().runs) <= 6 and "bucket" in plan.split("PartitionFilters")[1][:120]
    assert len(files) >= 1 and near.where("k = 7").count() == 1 and near.count() < 400


def test_a_run_that_was_not_listed_is_written_again(spark, tmp_path, rows):
    store = RunStore(spark, f"{tmp_path}/t", "k long", ["k"], buckets=2)
    real = store._switch
    store._switch = lambda new: (_ for _ in ()).throw(RuntimeError("lost"))
    with pytest.raises(RuntimeError):
        store.append(spark.range(9).select(F.col("id").alias("k")), 0)
    store._switch = real
    assert store.read().count() == 0 and store.append(spark.range(3).select(F.col("id").alias("k")), 0)
    assert rows(store.read()) == [(0,), (1,), (2,)]


def test_another_bucket_count_is_an_error(spark, tmp_path):
    RunStore(spark, f"{tmp_path}/t", "k long", ["k"], buckets=2).append(spark.range(3).select(F.col("id").alias("k")), 0)
    with pytest.raises(ValueError):
        RunStore(spark, f"{tmp_path}/t", "k long", ["k"], buckets=4).near(spark.range(1).select(F.col("id").alias("k")))


def test_rows_that_replace_each_other(spark, tmp_path, rows):
    latest = lambda df: df.groupBy("k").agg(F.max_by("v", "at").alias("v"), F.max("at").alias("at"))
    store = RunStore(spark, f"{tmp_path}/t", "k string, v int, at int", ["k"], 2, 2, latest)
    for at, batch in enumerate([[("a", 1), (None, 5)], [("a", 2)], [("b", 3)], [("b", 4), (None, 6)], [("c", 7)]]):
        store.append(spark.createDataFrame([(k, v, at) for k, v in batch], "k string, v int, at int"), at)
    assert rows(store.read(), "k", "v") == [("a", 2), ("b", 4), ("c", 7), (None, 6)]


def history(spark, path, deal, fan=8):
    store = HistoryStore(spark, path, ["k"], "k string, v string", buckets=2, fan=fan)
    for batch, part in enumerate(deal):
        frame = spark.createDataFrame([("k", v, v, t) for v, t in part], "k string, v string, hashdiff string, t string")
        store.load(frame.select("k", "v", "hashdiff", F.col("t").cast("timestamp_ntz").alias("load_dt"), F.lit("s").alias("load_src")), batch)
    return store


def test_any_deal_gives_the_same_history(spark, tmp_path):
    a, b, c = ("A", "2022-01-01"), ("B", "2022-01-02"), ("A", "2022-01-03")
    deals = []
    for order in itertools.permutations((a, b, c)):
        for cut in ((3,), (1, 2), (2, 1), (1, 1, 1)):
            it = iter(order)
            deals.append([[next(it) for _ in range(n)] for n in cut])
    # a part of them; each is a table of its own
    for i, deal in enumerate([*deals[::7], deals[7]]):
        got = history(spark, f"{tmp_path}/{i}", deal).changes().select("v", F.dayofmonth("load_dt").alias("d")).orderBy("d").collect()
        assert [(r.v, r.d) for r in got] == [("A", 1), ("B", 2), ("A", 3)], deal


def test_a_late_version_mends_its_successor(spark, tmp_path):
    deal = [[("A", "2022-01-01"), ("A", "2022-01-05"), ("B", None)], [("B", "2022-01-03"), ("A", "2022-01-05")], [("A", "2022-01-02"), ("B", "2022-01-04")], []]
    for fan in (2, 8):
        store = history(spark, f"{tmp_path}/{fan}", deal, fan)
        got = store.changes().select("v", F.dayofmonth("load_dt").alias("d")).orderBy(F.col("d").asc_nulls_first()).collect()
        assert [(r.v, r.d) for r in got] == [("B", None), ("A", 1), ("B", 3), ("A", 5)]
        assert store.versions().count() == 6 and not store.load(store.versions().drop("changed"), 2)


def test_jdbc_ledger_statements_move_a_batch_once():
    con = duckdb.connect()
    con.execute("create table feedback (a int, b text); create table ledger (sink text, batch_id bigint)")
    for batch, a in ((0, 1), (0, 1), (1, 2), (0, 9), (1, 2)):
        con.execute(f"create or replace table staged as select {a} as a, 'x' as b")
        con.execute("begin")
        for statement in jdbc.once_statements("feedback", "staged", "ledger", "it's", batch, ["a", "b"]):
            con.execute(statement)
        con.execute("commit")
    assert con.execute("select a from feedback order by a").fetchall() == [(1,), (2,)]
    assert con.execute("select * from ledger order by 2").fetchall() == [("it's", 0), ("it's", 1)]


def test_topic_rows_carry_their_batch(spark):
    row = kafka.topic_rows(spark.range(1), ["id"], 7).first()
    assert row.value == '{"id":0}' and row.headers[0].key == "batch_id" and bytes(row.headers[0].value) == b"7"
    assert kafka.topic_rows(spark.range(1), ["id"]).columns == ["value"]


def test_nothing_is_written_outside_the_store(spark, tmp_path):
    store = RunStore(spark, f"{tmp_path}/t", "k long, p string", ["k"], buckets=2, parts=("p",))
    store.append(spark.createDataFrame([(1, "x"), (2, None)], "k long, p string"), 0)
    assert sorted(os.listdir(f"{tmp_path}/t")) == ["manifest", "run-stream-0"]
    assert sorted((r.k, r.p) for r in store.read().collect()) == [(1, "x"), (2, None)]
