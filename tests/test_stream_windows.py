import datetime as dt
import os

from cabmetrics.schema import TRIP_SCHEMA
from cabmetrics.session import scratch_path
from cabmetrics.streaming.hourly import WindowStream, fares_by_window

T0 = dt.datetime(2024, 3, 1)
PLACE = (-73.98, 40.75, -73.95, 40.78, 1)


def trip(key, hours, fare=10.0):
    return (key, float(fare), None if hours is None else T0 + dt.timedelta(hours=hours), *PLACE)


def deliver(spark, landing, rows):
    spark.createDataFrame(rows, TRIP_SCHEMA).coalesce(1).write.mode("append").parquet(landing)


def test_late_and_repeated_trips_over_restarts(spark):
    landing, out = scratch_path(spark, "landing"), scratch_path(spark, "windows")

    def stream():  # another object each time: only the folders carry over
        return WindowStream(spark, landing, out, delay="10 hours")

    def closed():
        return {int((r["window_start"] - T0).total_seconds() // 3600): (r["trip_count"], r["total_fare"], r["avg_fare"]) for r in stream().windows().collect()}

    deliver(spark, landing, [trip("a", 0.5), trip("b", 0.75, 20), trip("b", 0.75, 20), trip("c", 12.5), trip("bad", 1.5, -3)])
    first = stream().advance()
    assert (first.rows_in, first.late, first.repeated) == (5, 0, 1)
    assert closed() == {0: (2, 30.0, 15.0)}  # the watermark is at 2.5 hours

    # late: "d" before the watermark; in time: "e"; repeats: "c" (kept key) and "a" (late, so gone)
    deliver(spark, landing, [trip("d", 0.9), trip("e", 3.2, 7), trip("c", 12.5), trip("a", 0.5), trip("f", 40)])
    second = stream().advance()
    assert (second.rows_in, second.late, second.repeated) == (5, 2, 1)
    assert closed() == {0: (2, 30.0, 15.0), 3: (1, 7.0, 7.0), 12: (1, 10.0, 10.0)}

    third = stream().advance()  # nothing new
    assert third.rows_in == 0 and len(closed()) == 3


def test_batch_form_counts_each_trip_once(spark):
    rows = [trip("a", 0.5), trip("a", 0.5), trip(None, 0.6), trip(None, 0.6), trip(None, 0.6, 11), trip("x", None)]
    found = fares_by_window(spark.createDataFrame(rows, TRIP_SCHEMA)).collect()
    assert [(r["trip_count"], r["total_fare"]) for r in found] == [(3, 31.0)]
    daily = fares_by_window(spark.createDataFrame([trip("a", 1), trip("b", 23), trip("c", 25)], TRIP_SCHEMA), "1 day").collect()
    assert sorted(r["trip_count"] for r in daily) == [1, 2]


def test_state_partitions_are_bounded(spark):
    landing, out = scratch_path(spark, "landing"), scratch_path(spark, "windows")
    deliver(spark, landing, [trip("a", 0.5), trip("b", 12.5, 20)])
    asked = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 20)
    try:
        stream = WindowStream(spark, landing, out, delay="10 hours", state_partitions=3)
        assert stream.advance().rows_in == 2
        assert spark.conf.get("spark.sql.shuffle.partitions") == "20"  # the caller's own setting stays
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", asked)
    state = [f.path for op in (0, 1) for f in os.scandir(f"{out}-checkpoint/state/{op}".removeprefix("file:")) if f.name.isdigit()]
    assert len(state) == 2 * 3 and [r["trip_count"] for r in stream.windows().collect()] == [1]
