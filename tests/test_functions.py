import math

import pytest
from pyspark.sql import functions as F

from cabmetrics.functions import day_name, haversine, near_airport, parse_pickup_time, pct_of_total, weekday_monday0


def _hav(lat1, lon1, lat2, lon2, r=6371.0):
    p1, p2 = math.radians(lat1), math.radians(lat2)
    a = math.sin(math.radians(lat2 - lat1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * r * math.asin(min(1.0, math.sqrt(a)))


def test_zero_distance(spark):
    df = spark.createDataFrame([(40.7, -73.9)], "lat double, lon double")
    assert df.select(haversine("lat", "lon", "lat", "lon").alias("d")).first().d == 0.0


def test_known_pair_matches_hand_formula(spark):
    # Times Square -> JFK terminal area
    row = spark.range(1).select(haversine(40.7580, -73.9855, 40.6413, -73.7781).alias("d")).first()
    assert row.d == pytest.approx(_hav(40.7580, -73.9855, 40.6413, -73.7781), rel=1e-12)
    assert 21.0 < row.d < 22.0


def test_antipodal_points_are_clamped(spark):
    row = spark.range(1).select(haversine(0.0, 0.0, 0.0, 180.0).alias("d")).first()
    assert row.d == pytest.approx(math.pi * 6371.0, rel=1e-12)
    assert not math.isnan(row.d)


def test_null_coordinate_gives_null(spark):
    df = spark.createDataFrame([(None, -73.9)], "lat double, lon double")
    assert df.select(haversine("lat", "lon", 40.0, -73.0).alias("d")).first().d is None


def test_near_airport_bound_included(spark):
    df = spark.createDataFrame([(40.6413, -73.7781), (40.70, -73.7781)], "lat double, lon double")
    got = [r.n for r in df.select(near_airport("lat", "lon", 40.6413, -73.7781).alias("n")).collect()]
    assert got == [True, False]
    # a radius exactly equal to the distance keeps the point
    d = _hav(40.70, -73.7781, 40.6413, -73.7781)
    row = df.filter(F.col("lat") == 40.70).select(near_airport("lat", "lon", 40.6413, -73.7781, radius_km=d).alias("n")).first()
    assert row.n is True


def test_parse_time_and_bad_text(spark):
    df = spark.createDataFrame([("2009-06-15 17:26:21 UTC",), ("not a time",), (None,)], "t string")
    got = [r.ts for r in df.select(parse_pickup_time("t").alias("ts")).collect()]
    assert str(got[0]) == "2009-06-15 17:26:21"
    assert got[1] is None and got[2] is None


def test_day_names_and_weekday(spark):
    # 2024-01-07 is a Sunday
    df = spark.createDataFrame([("2024-01-07 10:00:00",), ("2024-01-13 10:00:00",)], "t string").select(
        F.to_timestamp("t").alias("ts")
    )
    rows = df.select(F.dayofweek("ts").alias("d"), weekday_monday0("ts").alias("w")).withColumn("n", day_name("d")).collect()
    assert [(r.d, r.w, r.n) for r in rows] == [(1, 6, "Sun"), (7, 5, "Sat")]


def test_pct_of_total_zero_total(spark):
    df = spark.createDataFrame([(1, 0), (1, 3)], "a long, b long")
    got = [r.p for r in df.select(pct_of_total("a", "b").alias("p")).collect()]
    assert got == [None, 33.33]
