import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cabmetrics.operators import zones as Z
from cabmetrics.schema import CODE_PROFILE


@pytest.mark.parametrize("share", [0.3, 0.05, 0.01])
def test_no_key_above_the_share_is_lost(spark, share):
    rng = random.Random(4)
    keys = [7] * 4000 + [8] * 600 + [9] * 120 + [rng.randrange(100, 5000) for _ in range(6000)] + [None] * 50
    rng.shuffle(keys)
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(16)
    want = {k: n for k, n in Counter(keys).items() if k is not None and n >= share * len(keys)}
    assert {r["k"]: r["n"] for r in Z.heavy_hitters(df, "k", share).collect()} == want


def test_no_rows_have_no_heavy_hitters(spark):
    assert Z.heavy_hitters(spark.createDataFrame([], "k long"), "k", 0.1).collect() == []


def test_cell_numbers_are_reversible(spark):
    points = [(-73.995, 40.751), (0.0, 0.0), (-0.001, -0.001), (179.99, -89.99), (float("nan"), 1.0), (None, 1.0)]
    df = spark.createDataFrame(points, "lon double, lat double").withColumn("key", Z.cell_key(F.col("lon"), F.col("lat"), 0.01))
    x, y = Z.cell_parts(F.col("key"))
    assert [tuple(r) for r in df.select(x, y).collect()] == [(-7400, 4075), (0, 0), (-1, -1), (17999, -8999), (None, None), (None, None)]


def test_errors_of_heavy_cells_and_of_the_rest(spark):
    rows = [(-73.995, 40.755, 10.0, 8.0)] * 6 + [(-73.985, 40.755, 10.0, 13.0)] * 3 + [(-73.9, 40.7, 5.0, 5.0), (None, 40.7, 5.0, 6.0)]
    df = spark.createDataFrame(rows, "pickup_longitude double, pickup_latitude double, label double, prediction double")
    found = {(r["cell_x"], r["cell_y"]): tuple(r)[2:] for r in Z.error_by_zone(df, share=0.2).collect()}
    assert found == {(-7400, 4075): (6, 2.0, 2.0, 2.0), (-7399, 4075): (3, 3.0, 3.0, -3.0), (None, None): (2, pytest.approx(0.707107), 0.5, -0.5)}


def test_quadtree_leaves_hold_every_pickup_once(spark):
    rng = random.Random(6)
    p = CODE_PROFILE
    points = [(rng.uniform(p.lon_min, p.lon_max), rng.uniform(p.lat_min, p.lat_max)) for _ in range(900)]
    points += [(-73.7781, 40.6413)] * 400 + [(p.lon_max, p.lat_max), (p.lon_min, p.lat_min), (0.0, 0.0), (None, 40.6), (float("nan"), 40.6)]
    df = spark.createDataFrame(points, "pickup_longitude double, pickup_latitude double")
    leaves = Z.quadtree(df, most=25, levels=6).collect()
    assert sum(r["n"] for r in leaves) == 1302
    assert all(r["n"] <= 25 or r["level"] == 6 for r in leaves)
    areas = {(r["level"], r["cell"]) for r in leaves}
    assert all((lv - up, c >> 2 * up) not in areas for lv, c in areas for up in range(1, lv + 1))  # no leaf within a leaf
    inside = [(x, y) for x, y in points if x and x == x and x != 0.0]
    for r in leaves:
        eps = 1e-9
        held = sum(r["west"] - eps <= x < r["east"] + eps and r["south"] - eps <= y < r["north"] + eps for x, y in inside)
        assert held >= r["n"]
    assert Z.quadtree(df.limit(0), most=25).collect() == []


def plainly_inside(x, y, ring):
    hits = 0
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True):
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            hits += 1
    return hits % 2 == 1


def test_trips_in_polygons_of_any_shape(spark):
    rng = random.Random(9)
    rings = {
        "star": [(-73.99, 40.70), (-73.985, 40.715), (-73.97, 40.72), (-73.985, 40.725), (-73.99, 40.74), (-73.995, 40.725), (-74.01, 40.72), (-73.995, 40.715)],
        "small": [(-73.9801, 40.7201), (-73.9799, 40.7201), (-73.98, 40.7203)],
        "large": [(-74.05, 40.65), (-73.90, 40.66), (-73.91, 40.80), (-74.04, 40.79)],
        "hook": [(-73.95, 40.70), (-73.93, 40.70), (-73.93, 40.73), (-73.94, 40.73), (-73.94, 40.71), (-73.95, 40.71)],
    }
    points = [(i, rng.uniform(-74.08, -73.88), rng.uniform(40.64, 40.82)) for i in range(3000)] + [(3000, -73.98, 40.7202), (3001, None, 40.7), (3002, float("nan"), 40.7)]
    trips = spark.createDataFrame(points, "key long, pickup_longitude double, pickup_latitude double")
    zones = spark.createDataFrame([(k, [{"x": x, "y": y} for x, y in v]) for k, v in rings.items()], "zone string, ring array<struct<x: double, y: double>>")
    found = Z.trips_in_zones(trips, zones, 0.004)
    assert sorted((r["key"], r["zone"]) for r in found.collect()) == sorted((i, k) for i, x, y in points if x is not None and x == x for k, ring in rings.items() if plainly_inside(x, y, ring))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_covers_tell_whole_cells_from_border_cells(spark):
    zones = spark.createDataFrame([("a", [{"x": 0.0, "y": 0.0}, {"x": 10.0, "y": 0.0}, {"x": 10.0, "y": 10.0}, {"x": 0.0, "y": 10.0}])], "zone string, ring array<struct<x: double, y: double>>")
    cells = Z.cover(zones, 1.0).collect()
    assert sum(r["edges"] is None for r in cells) == 64
    assert len({r["cover_cell"] for r in cells}) == len(cells)
