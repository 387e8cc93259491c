from __future__ import annotations

import datetime as dt
import math
import random
import uuid

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from martworks.functions import arrays, geo, keys, money, text, time as mt


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_decimal_comma(spark):
    assert one(spark, text.decimal_comma(F.lit("-33,865"))) == -33.865
    assert one(spark, text.decimal_comma(F.lit("north"))) is None


def test_split_part_counts_from_one_and_joins_repeated_separators(spark):
    c = F.lit("0::agreement:0.01:0.02")
    assert one(spark, text.split_part(c, ":+", 1, "int")) == 0
    assert one(spark, text.split_part(c, ":+", 2)) == "agreement"
    assert one(spark, text.split_part(c, ":+", 5)) is None


def test_canonical_json(spark):
    doc = text.canonical_json({"name": F.lit("Кафе 'У'"), "at": F.lit("2022-05-01 10:11:12.5").cast("timestamp_ntz"), "a": F.lit(None).cast("int")})
    assert one(spark, doc) == '{"a":null,"at":"2022-05-01 10:11:12","name":"Кафе \'У\'"}'


def test_malformed_json_is_null(spark):
    assert one(spark, text.parse_json(F.lit("{oops"), "a int")) is None or one(spark, text.parse_json(F.lit("{oops"), "a int")).a is None


def test_age_equals_the_calendar_method(spark):
    rng = random.Random(7)
    start = dt.datetime(1999, 1, 1)
    pairs = [(start + dt.timedelta(seconds=rng.randrange(10**8)), start + dt.timedelta(seconds=rng.randrange(10**8))) for _ in range(2000)]
    pairs += [(dt.datetime(2000, 3, 1), dt.datetime(2000, 2, 29, 12)), (dt.datetime(2021, 3, 31), dt.datetime(2021, 2, 28)),
              (dt.datetime(2021, 2, 28), dt.datetime(2021, 3, 31)), (dt.datetime(2021, 5, 5), dt.datetime(2021, 5, 5))]
    df = spark.createDataFrame(pairs, "a timestamp_ntz, b timestamp_ntz")
    parts = mt.calendar_age(F.col("a"), F.col("b"))
    got = [tuple(r) for r in df.select("a", "b", parts["months"], parts["days"], parts["seconds"].cast("long")).collect()]
    con = duckdb.connect()
    for a, b, months, days, seconds in got:
        want = con.execute("select datepart('year', x) * 12 + datepart('month', x), datepart('day', x), "
                           "datepart('hour', x) * 3600 + datepart('minute', x) * 60 + datepart('second', x) from (select age(?, ?) as x)", [a, b]).fetchone()
        assert (months, days, seconds) == want, (a, b)


def test_delay_of_one_month_four_days_shows_four_days(spark):
    age = mt.calendar_age(F.lit("2021-03-05").cast("timestamp_ntz"), F.lit("2021-02-01").cast("timestamp_ntz"))
    assert (one(spark, age["months"]), one(spark, age["days"])) == (1, 4)


def test_calendar_partition(spark):
    days = spark.createDataFrame([(d,) for d in ("2001-07-20", "2001-05-31", "2000-11-11", "1999-12-31")], "d string").select(F.col("d").cast("date"))
    got = [r.p.isoformat() for r in days.select(mt.calendar_partition(F.col("d"), 3, 2, dt.date(2001, 8, 1)).alias("p")).collect()]
    assert got == ["2001-07-20", "2001-05-01", "2000-11-01", "1999-01-01"]


def test_run_dates():
    assert mt.run_dates("2022-03-01", 3) == ["2022-03-01", "2022-02-28", "2022-02-27"]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(max_size=20), min_size=1, max_size=20))
def test_uuid3_equals_python(spark, texts):
    texts = [t for t in texts if t.encode("utf-8", "ignore").decode() == t]
    if not texts:
        return
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for row in df.select("t", keys.uuid3(F.col("t")).alias("u")).collect():
        assert row.u == str(uuid.uuid3(uuid.NAMESPACE_DNS, row.t))


def test_hash_key_is_null_for_a_null_part(spark):
    assert one(spark, keys.hash_key(F.lit("a"), F.lit(None).cast("string"))) is None
    assert one(spark, keys.hash_key(F.lit("a"), F.lit("b"))) != one(spark, keys.hash_key(F.lit("b"), F.lit("a")))
    assert isinstance(one(spark, keys.hash_key(F.lit(1), method="xxhash64")), int)


def test_hashdiff_tells_null_from_empty(spark):
    assert one(spark, keys.hashdiff(F.lit("k"), F.lit(None).cast("string"))) != one(spark, keys.hashdiff(F.lit("k"), F.lit("")))


def test_arrays(spark):
    df = spark.sql("select array(named_struct('id', 1, 'n', 'a'), named_struct('id', 2, 'n', 'b')) as items, array(1, 2) x, array('p', 'q') y")
    assert df.select(arrays.array_find(F.col("items"), lambda i: i["id"] == 2)["n"]).first()[0] == "b"
    assert df.select(arrays.array_find(F.col("items"), lambda i: i["id"] == 9)).first()[0] is None
    assert df.select(arrays.array_pluck(F.col("items"), "n")).first()[0] == ["a", "b"]
    zipped = df.select(arrays.zip_arrays(k=F.col("x"), v=F.col("y")).alias("z"))
    assert [tuple(r) for r in arrays.explode_items(zipped, "z", "at").collect()] == [(0, 1, "p"), (1, 2, "q")]


@pytest.mark.parametrize("rate,total,pay", [
    ("3.99", 1000, 100), ("3.99", 10000, 500), ("4.0", 1000, 150), ("4.5", 1000, 175), ("4.9", 1000, 200), ("4.9", 10000, 1000)])
def test_courier_tiers(spark, rate, total, pay):
    assert one(spark, money.courier_pay(F.lit(rate).cast("decimal(10,4)"), F.lit(total).cast("decimal(14,2)"))) == pay


def test_base_currency_rounds_half_up_before_division(spark):
    assert float(one(spark, money.to_base_currency(F.lit(5), F.lit("0.50").cast("decimal(5,2)")))) == 0.03


def test_ratio_with_zero(spark):
    assert one(spark, money.safe_ratio(F.lit(1), F.lit(0))) is None


def brute_force(points, places):
    def xyz(a):
        la, lo = np.radians(a[:, 0]), np.radians(a[:, 1])
        return np.stack([np.cos(la) * np.cos(lo), np.cos(la) * np.sin(lo), np.sin(la)], axis=1)
    chord = np.linalg.norm(xyz(points)[:, None, :] - xyz(places)[None, :, :], axis=2)
    return 2 * geo.EARTH_KM * np.arcsin(np.minimum(chord.min(axis=1) / 2, 1.0))


@pytest.mark.parametrize("n_places,limit", [(1, 64), (25, 64), (64, 64), (25, 5), (400, 64)])
def test_nearest_place_equals_brute_force(spark, n_places, limit):
    rng = np.random.default_rng(n_places + limit)
    points = np.column_stack([rng.uniform(-90, 90, 300), rng.uniform(-180, 180, 300)])
    places = np.column_stack([rng.uniform(-60, 60, n_places), rng.uniform(-180, 180, n_places)])
    p = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(points)], "id int, lat double, lon double")
    c = spark.createDataFrame([(i, f"c{i}", float(a), float(b)) for i, (a, b) in enumerate(places)],
                              "place_id int, place string, lat double, lon double")
    got = {r.id: r for r in geo.nearest_place(p, c, inline_limit=limit).collect()}
    want = brute_force(points, places)
    assert len(got) == 300
    assert max(abs(got[i].km - want[i]) for i in got) < 1e-5
    assert all(got[i].place == f"c{got[i].place_id}" for i in got)


def test_nearest_place_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(geo, "LIST_PLACES", 40)
    test_nearest_place_equals_brute_force(spark, 100, 5)


def test_points_without_coordinates_are_left_out(spark):
    p = spark.createDataFrame([(1, None, 1.0), (2, 1.0, 1.0)], "id int, lat double, lon double")
    c = spark.createDataFrame([(1, "a", 0.0, 0.0)], "place_id int, place string, lat double, lon double")
    assert [r.id for r in geo.nearest_place(p, c).collect()] == [2]


def test_haversine_of_a_quarter_circle(spark):
    km = one(spark, geo.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(90.0)))
    assert abs(km - math.pi / 2 * geo.EARTH_KM) < 1e-6


def test_nearest_place_searches_dense_lists_in_small_cells(spark, rows):
    """Lists follow the density: a dense spot has no long list rows, far points still find their place, equal spots give the smaller id."""
    places = spark.range(3000).select(
        F.col("id").alias("place_id"), F.concat(F.lit("p"), F.col("id").cast("string")).alias("place"),
        (F.lit(50.0) + (F.col("id") % 50) / 10_000).alias("lat"), (F.lit(10.0) + F.floor(F.col("id") % 2500 / 50) / 10_000).alias("lon"))
    vec = geo._with_vector(places, "lat", "lon")
    assert geo._finest_edge(vec, 2500) < geo.CELL_EDGES[0] / 100
    spots = [(1, 50.00101, 10.00002), (2, 50.0, 10.0), (3, -50.0, -170.0), (4, 51.0, 10.0)]
    got = geo.nearest_place(spark.createDataFrame(spots, "id int, lat double, lon double"), places).collect()
    want = brute_force(np.array([s[1:] for s in spots]), np.array([(r.lat, r.lon) for r in places.collect()]))
    assert all(abs(r.km - want[r.id - 1]) < 1e-4 for r in got) and len(got) == 4
    assert {r.id: r.place_id for r in got}[2] == 0
