import datetime as dt

import pytest

from cabmetrics.session import scratch_path
from cabmetrics.sources.quarantine import ingest

GOOD = "a,7.5,2024-03-01 10:00:00.000000 UTC,-73.98,40.75,-73.95,40.78,1"
LINES = {
    GOOD: "good",
    "b,,,,,,,": "good",  # empty values are nulls, not faults
    '"c, the key",7.5,2024-03-01 10:00:00.000000 UTC,-73.98,40.75,-73.95,40.78,2': "good",
    "d,abc,2024-03-01 10:00:00.000000 UTC,-73.98,40.75,-73.95,40.78,1": "fare_amount",
    "e,7.5,yesterday,-73.98,40.75,-73.95,40.78,1": "pickup_datetime",
    "f,7.5,2024-03-01 10:00:00.000000 UTC,-73.98,40.75,-73.95,40.78,1.5": "passenger_count",
    "g,7.5,2024-03-01 10:00:00.000000 UTC,-73.98,40.75,-73.95,40.78": "columns",
    "h,7.5,2024-03-01 10:00:00.000000 UTC,-73.98,40.75,-73.95,40.78,1,more": "columns",
    "i,abc,yesterday,-73.98,40.75,-73.95,40.78,1": "fare_amount",  # the first fault in the order of the types, times last
    "j,7.5,2024-03-01 10:00:00.000000 UTC,west,40.75,-73.95,north,1": "pickup_longitude",
    '"k, quoted",x,2024-03-01 10:00:00.000000 UTC,-73.98,40.75,-73.95,40.78,1': "fare_amount",
}


@pytest.mark.parametrize("header", [True, False])
def test_every_line_is_good_or_has_a_reason(spark, header):
    path = scratch_path(spark, "lines")
    lines = ["key,fare_amount,pickup_datetime,pickup_longitude,pickup_latitude,dropoff_longitude,dropoff_latitude,passenger_count"] * header + list(LINES)
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    got = ingest(spark, path, scratch_path(spark, "ingested"), header)
    assert {r["line"]: r["reason"] for r in got.bad_rows().collect()} == {k: v for k, v in LINES.items() if v != "good"} | {
        "e,7.5,yesterday,-73.98,40.75,-73.95,40.78,1": "pickup_datetime"
    }
    trips = {r["key"]: r for r in got.trips().collect()}
    assert set(trips) == {"a", "b", "c, the key"}
    assert trips["a"]["pickup_datetime"] == dt.datetime(2024, 3, 1, 10) and trips["b"]["fare_amount"] is None
    report = {r["reason"]: r["n_rows"] for r in got.report().collect()}
    assert sum(report.values()) == len(LINES) and report["good"] == 3 and report["columns"] == 2


def test_an_empty_file(spark):
    path = scratch_path(spark, "lines")
    spark.createDataFrame([], "value string").write.text(path)
    got = ingest(spark, path, scratch_path(spark, "ingested"), header=False)
    assert got.trips().collect() == [] and got.bad_rows().collect() == [] and got.report().collect() == []
