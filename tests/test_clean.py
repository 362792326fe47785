import math

from cabmetrics.operators.clean import cleaning_stage_counts, clean_trips, drop_nulls, outside_bbox
from cabmetrics.schema import REPORT_PROFILE, TRIP_SCHEMA


def _row(key, fare=10.0, plon=-74.0, plat=40.7, dlon=-73.9, dlat=40.8, pc=1):
    import datetime as dt

    return (key, fare, dt.datetime(2024, 1, 1, 12), plon, plat, dlon, dlat, pc)


def test_bounds_inclusive_and_just_outside(spark):
    rows = [
        _row("lo_fare", fare=1.0),
        _row("hi_fare", fare=500.0),
        _row("below_fare", fare=0.99),
        _row("above_fare", fare=500.01),
        _row("pc6", pc=6),
        _row("pc0", pc=0),
        _row("pc7", pc=7),
        _row("lon_edge", plon=-74.3, dlon=-72.9),
        _row("lat_edge", plat=40.5, dlat=41.0),
        _row("lon_out", plon=-74.3000001),
        _row("lat_out", dlat=41.0000001),
    ]
    df = spark.createDataFrame(rows, TRIP_SCHEMA)
    kept = {r.key for r in clean_trips(df).collect()}
    assert kept == {"lo_fare", "hi_fare", "pc6", "lon_edge", "lat_edge"}


def test_nan_and_null_rejected(spark):
    rows = [_row("nan", fare=math.nan), _row("null", dlat=None), _row("ok")]
    df = spark.createDataFrame(rows, TRIP_SCHEMA)
    assert {r.key for r in drop_nulls(df).collect()} == {"ok"}
    assert {r.key for r in clean_trips(df).collect()} == {"ok"}


def test_nan_outside_closed_range_even_without_null_rule(spark):
    from dataclasses import replace

    df = spark.createDataFrame([_row("nan", plon=math.nan)], TRIP_SCHEMA)
    assert clean_trips(df, replace(REPORT_PROFILE, drop_nulls=False)).count() == 0


def test_stage_counts_single_pass(spark):
    rows = [_row("a"), _row("b", dlat=None), _row("c", fare=-3.0), _row("d")]
    df = spark.createDataFrame(rows, TRIP_SCHEMA)
    got = [(r.stage, r.n_rows, r.removed, r.pct_removed) for r in cleaning_stage_counts(df).orderBy("stage_no").collect()]
    assert got == [("original", 4, 0, 0.0), ("no_nulls", 3, 1, 25.0), ("no_outliers", 2, 1, 33.33)]


def test_outside_bbox_null_is_not_outside(spark):
    rows = [_row("in"), _row("out", plon=-80.0), _row("null", dlat=None)]
    r = outside_bbox(spark.createDataFrame(rows, TRIP_SCHEMA)).first()
    assert (r.n_outside, r.n_total, r.pct_outside) == (1, 3, 33.33)


def test_empty_input(spark):
    df = spark.createDataFrame([], TRIP_SCHEMA)
    assert clean_trips(df).count() == 0
    got = [r.n_rows for r in cleaning_stage_counts(df).orderBy("stage_no").collect()]
    assert got == [0, 0, 0]


def test_null_in_every_column_in_turn(spark):
    base = _row("ok")
    rows = [base]
    for i in range(len(base)):
        r = list(base)
        r[0] = f"null{i}" if i else None
        if i:
            r[i] = None
        rows.append(tuple(r))
    df = spark.createDataFrame(rows, TRIP_SCHEMA)
    assert [r.key for r in drop_nulls(df).collect()] == ["ok"]
    assert [r.key for r in clean_trips(df).collect()] == ["ok"]
