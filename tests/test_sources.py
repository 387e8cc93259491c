from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from martworks import schemas
from martworks.sources import files, incremental, jdbc, kafka, sinks
from martworks.sources.paged import read_paged
from martworks.sources.state import WatermarkStore


def test_event_window_prunes_partitions(spark, tmp_path, rows):
    df = spark.createDataFrame([(i, f"2022-05-{i:02d}") for i in range(1, 21)], "id int, d string").select("id", F.col("d").cast("date").alias("date"))
    sinks.write_mart(df, str(tmp_path), "events", partition_by=["date"])
    window = files.read_event_window(spark, f"{tmp_path}/events", "2022-05-15", 3)
    assert rows(window, "id") == [(13,), (14,), (15,)]
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_order_increment_with_and_without_status(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text("id,uniq_id,customer_id\n1,x,7\n2,x,7\n3,y,8\n")
    (tmp_path / "b.csv").write_text("id,uniq_id,customer_id,status\n1,x,7,refunded\n")
    assert rows(files.read_order_increment(spark, f"{tmp_path}/a.csv")) == [("x", 7, "shipped"), ("y", 8, "shipped")]
    assert rows(files.read_order_increment(spark, f"{tmp_path}/b.csv")) == [("x", 7, "refunded")]


def test_geo_cities(spark, tmp_path):
    (tmp_path / "geo.csv").write_text("id;city;lat;lng\n1;Sydney;-33,865;151,2094\n")
    city = files.read_geo_cities(spark, f"{tmp_path}/geo.csv")
    assert (city.first().lat, round(city.first().lon_geo, 6)) == (-33.865, 2.639102)
    assert files.as_places(city).columns == ["place_id", "place", "lat", "lon"]


def test_staging_csv_preview_and_views(spark, tmp_path):
    (tmp_path / "groups.csv").write_text("1,2,main,2020-01-01T00:00:00,true\n2,2,other,2020-01-01T00:00:00,false\n")
    df = files.load_staging_csv(spark, f"{tmp_path}/groups.csv", schemas.CHAT_GROUPS)
    assert files.preview(df, 1).count() == 1
    files.register_views(spark, {"groups_view": df})
    assert spark.sql("select count(*) from groups_view where is_private").first()[0] == 1


def test_watermark_first_run_default_and_microseconds(spark, tmp_path):
    state = WatermarkStore(spark, f"{tmp_path}/state")
    assert state.get("k", -1) == -1
    state.save("k", 5)
    state.save("other", 9)
    state.save("k", dt.datetime(2022, 1, 1, 0, 0, 0, 123456))
    assert state.get("k") == "2022-01-01 00:00:00.123456" and state.get("other") == 9


def test_cursor_does_not_lose_equal_times_at_a_batch_edge(spark, tmp_path):
    df = spark.createDataFrame([(i, "2022-02-01 00:00:00") for i in range(10)], "id int, t string").select("id", F.col("t").cast("timestamp_ntz").alias("t"))
    state, out = WatermarkStore(spark, f"{tmp_path}/state"), f"{tmp_path}/docs"
    for _ in range(5):
        incremental.copy_documents(df, "id", "t", state, "docs", lambda b: sinks.append_rows(b, out), limit=3)
    stored = spark.read.parquet(out)
    assert stored.count() == 10 == stored.select("object_id").distinct().count()


def test_copy_by_id_moves_past_everything_read(spark, tmp_path):
    df = spark.range(1, 8)
    state, out = WatermarkStore(spark, f"{tmp_path}/state"), f"{tmp_path}/rows"
    seen = [incremental.copy_by_id(df, "id", state, "k", lambda b: sinks.append_rows(b, out), limit=3) for _ in range(4)]
    assert seen == [3, 6, 7, None] and spark.read.parquet(out).count() == 7


def test_replace_partition_keeps_the_others(spark, tmp_path, rows):
    path = f"{tmp_path}/t"
    sinks.replace_partition(spark.createDataFrame([(1, "a"), (2, "b")], "n int, d string"), path, "d")
    for _ in range(2):
        sinks.replace_partition(spark.createDataFrame([(9, "b")], "n int, d string"), path, "d")
    assert rows(spark.read.parquet(path)) == [(1, "a"), (9, "b")]


def test_layout_joins_without_a_shuffle(spark):
    spark.sql("drop table if exists layout_a")
    spark.sql("drop table if exists layout_b")
    df = spark.range(1000).withColumn("d", F.lit("2022-01-01").cast("date"))
    for name in ("layout_a", "layout_b"):
        sinks.write_layout(df, name, F.to_date("d"), ["id"], ["id"], 4, "part")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("layout_a").join(spark.table("layout_b"), "id")
        assert joined.count() == 1000
        assert "Exchange hashpartitioning" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_paged_source_reads_past_the_expected_pages(spark):
    def fetch(offset, limit):
        return [{"id": i, "name": f"n'{i}"} for i in range(offset, min(offset + limit, 130))]
    df = read_paged(spark, fetch, "id int, name string", pages=2, page_size=20, ranges=2)
    assert df.count() == 130 and df.where("name = \"n'129\"").count() == 1


def test_jdbc_and_topic_options():
    conn = {"url": "jdbc:postgresql://example/db", "user": "u"}
    assert jdbc.scan_options(conn, "t", ("id", 0, 100, 8)) == {
        **conn, "dbtable": "t", "partitionColumn": "id", "lowerBound": "0", "upperBound": "100", "numPartitions": "8"}
    assert jdbc.day_range("ts", "2022-12-31") == "ts >= timestamp '2022-12-31 00:00:00' and ts < timestamp '2023-01-01 00:00:00'"
    assert kafka.topic_options("b:9092", {"sasl.mechanism": "X"}) == {"kafka.bootstrap.servers": "b:9092", "kafka.sasl.mechanism": "X"}


def test_topic_value(spark):
    df = spark.createDataFrame([("r", 1)], "a string, b int")
    assert kafka.topic_value(df, ["a", "b"]).first().value == '{"a":"r","b":1}'
