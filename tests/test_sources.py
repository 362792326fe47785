import pytest
from pyspark.sql import functions as F

from cabmetrics.functions import nan_to_null
from cabmetrics.plans import common as K
from cabmetrics.session import scratch_path
from cabmetrics.sources import (
    MissingColumnsError,
    read_trips_csv,
    roundtrip_report,
    source_fallback,
    write_trips,
)


def test_csv_roundtrip_with_schema_and_inference(spark, sf_small):
    trips = K.raw_trips(spark, sf_small)
    path = write_trips(trips, scratch_path(spark, "t-csv"), fmt="csv")
    a = read_trips_csv(spark, path)
    b = read_trips_csv(spark, path, infer=True)
    assert a.dtypes == b.dtypes
    # fractions of a second survive; text has no NaN besides null
    doubles = [n for n, t in trips.dtypes if t == "double"]
    want = trips.withColumns({c: nan_to_null(c) for c in doubles})
    assert trips.filter("pickup_datetime != date_trunc('second', pickup_datetime)").count() > 0
    assert a.exceptAll(want).count() == 0 and want.exceptAll(b).count() == 0


def test_roundtrip_report_detects_change(spark, sf_small):
    trips = K.raw_trips(spark, sf_small)
    path = write_trips(trips, scratch_path(spark, "t-pq"))
    back = spark.read.parquet(path)
    r = roundtrip_report(trips, back, exact=True).first()
    assert r.same_content and r.rows_lost == 0 and r.rows_gained == 0
    changed = back.withColumn("fare_amount", F.when(F.col("key") == "7", F.lit(1.0)).otherwise(F.col("fare_amount")))
    r2 = roundtrip_report(trips, changed, exact=True).first()
    assert not r2.same_content and r2.rows_lost == 1 and r2.rows_gained == 1


def test_fallback_and_column_validation(spark, sf_small):
    raw = write_trips(K.raw_trips(spark, sf_small), scratch_path(spark, "t-raw"), fmt="csv")
    df = source_fallback(spark, scratch_path(spark, "absent"), raw)
    assert df.count() == 1000
    # a processed file lacking the trip columns must fail early (the reference's train.csv)
    processed = scratch_path(spark, "processed")
    spark.range(3).withColumnRenamed("id", "label").write.parquet(processed)
    with pytest.raises(MissingColumnsError):
        source_fallback(spark, processed, raw)


def test_fixture_counts(spark, sf_small):
    """What the checks must be able to tell apart is there (FIXTURES.md §2)."""
    trips, feats = K.raw_trips(spark, sf_small), K.features(spark, sf_small)
    assert trips.count() == 1000 and 600 < feats.count() < 749
    fare = F.col("fare_amount")
    for cond in (fare.isNull(), F.isnan(fare), fare == 1e6, fare < 0, (fare > 0) & (fare < 1), (fare > 100) & (fare < 500), fare * 100 != F.round(fare * 100)):
        assert trips.filter(cond).count() > 0
    for cond in ("key is null", "pickup_datetime is null", "passenger_count is null", "isnan(pickup_latitude)"):
        assert trips.filter(cond).count() > 0
    assert feats.filter("distance_km > 50").count() > 0 and feats.filter("distance_km between 30 and 50").count() > 0
    assert feats.select("month").distinct().count() == 12 and feats.select("year").distinct().count() > 1


def test_new_files_under_a_path_are_seen(spark, sf_small):
    from cabmetrics.session import path_exists

    events, orders = (spark.read.parquet(f"{sf_small}/{t}.parquet") for t in ("events", "orders"))
    folder = scratch_path(spark, "sf")
    for part, mode in ((events.limit(100), "overwrite"), (events.limit(50), "append")):
        part.write.mode(mode).parquet(f"{folder}/events.parquet")
        orders.limit(1).write.mode("overwrite").parquet(f"{folder}/orders.parquet")
        assert K.raw_trips(spark, folder).count() == (100 if mode == "overwrite" else 150)
    assert path_exists(spark, folder) and not path_exists(spark, f"{folder}/absent")
    with pytest.raises(Exception, match="No FileSystem|UnsupportedFileSystem"):
        path_exists(spark, "nosuchscheme://host/x")


def test_cluster_without_shared_folder_is_refused():
    from types import SimpleNamespace

    from cabmetrics.session import shared_dir

    context = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: {}, master="spark://host:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(SimpleNamespace(sparkContext=context))


def test_small_rows(spark):
    from cabmetrics.sources import rows_to_df

    df = rows_to_df(spark, [("a", 1.5, None, -73.9, 40.7, -73.9, 40.8, 2)])
    assert df.columns[0] == "key" and df.first().passenger_count == 2


def test_partitioned_write_prunes_partitions(spark, sf_small):
    trips = K.raw_trips(spark, sf_small)
    path = write_trips(trips, scratch_path(spark, "t-part"), partition_by=["passenger_count"])
    df = spark.read.parquet(path).filter(F.col("passenger_count") == 3)
    jvm = spark._jvm
    plan = jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "PartitionFilters: [isnotnull(passenger_count" in plan
    assert df.count() == trips.filter(F.col("passenger_count") == 3).count()


def test_nan_text_in_csv_becomes_null(spark):
    import os

    d = scratch_path(spark, "nan-csv").replace("file:", "")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, "part.csv"), "w") as fh:
        fh.write("key,fare_amount,pickup_datetime,pickup_longitude,pickup_latitude,dropoff_longitude,dropoff_latitude,passenger_count\n")
        fh.write("a,NaN,2009-06-15 17:26:21 UTC,-73.9,40.7,-73.95,40.75,1\n")
        fh.write("b,7.5,not a time,-73.9,40.7,-73.95,40.75,2\n")
    rows = {r.key: r for r in read_trips_csv(spark, d).collect()}
    assert rows["a"].fare_amount is None and str(rows["a"].pickup_datetime) == "2009-06-15 17:26:21"
    assert rows["b"].pickup_datetime is None and rows["b"].fare_amount == 7.5


def test_fixture_derivation_has_no_overflow_for_huge_ids(spark):
    import datetime as dt

    from cabmetrics.sources.fixtures import trips_from_events

    big = 9_000_000_000_000_000_000  # close to the bigint maximum
    ev = spark.createDataFrame(
        [(big, dt.datetime(2024, 1, 1, 17), 123, 10.0), (12345, dt.datetime(2024, 1, 1, 3), 7, 5.0)],
        "event_id bigint, ts timestamp, user_id bigint, value double",
    )
    rows = {r.key: r for r in trips_from_events(ev).collect()}
    r = rows[str(big)]
    assert -74.05 <= r.dropoff_longitude < -73.85 and 40.65 <= r.dropoff_latitude < 40.85
    # small ids keep the plain formula's values
    small = rows["12345"]
    assert small.dropoff_longitude == -74.05 + ((12345 * 15485863 + 7 * 31) % 2000) / 1e4


def test_trip_table_layout_is_fixed(spark, sf_small):
    from cabmetrics.plans.common import MIN_TABLE_PARTITIONS, trips_table

    df = spark.read.parquet(trips_table(spark, sf_small))
    assert df.rdd.getNumPartitions() >= 1
    files = [f for f in spark.read.parquet(trips_table(spark, sf_small)).inputFiles() if f.endswith(".parquet")]
    assert len(files) == MIN_TABLE_PARTITIONS


def test_csv_write_honours_partitioning(spark, sf_small):
    import os

    path = write_trips(K.raw_trips(spark, sf_small), scratch_path(spark, "t-csv-part"), fmt="csv", partition_by=["passenger_count"])
    local = path.replace("file:", "")
    assert sorted(d for d in os.listdir(local) if d.startswith("passenger_count=")) == [*(f"passenger_count={i}" for i in range(8)), "passenger_count=__HIVE_DEFAULT_PARTITION__"]
