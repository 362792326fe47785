"""
scratch code on both engines, on the fixture without its later edge cases; the
library must reproduce them."""

import pytest
from pyspark.sql import functions as F

from cabmetrics.operators import profile as P
from cabmetrics.operators import split as S
from cabmetrics.operators.clean import clean_trips
from cabmetrics.operators.features import feature_projection
from cabmetrics.session import use_utc
from cabmetrics.sources.fixtures import trips_from_events

SF = "/root/testdata/sf0.01"


def plain(spark, sf):
    use_utc(spark)
    return trips_from_events(spark.read.parquet(f"{sf}/events.parquet"), edge_cases=False)


def test_flagship_hour_zero(spark):
    row = P.fare_by_hour(feature_projection(clean_trips(plain(spark, SF)))).filter("hour = 0").first()
    assert (row.trip_count, row.avg_fare) == (295, 24.484305)


def test_clean_counts_per_scale(spark):
    for sf, raw, clean in (("/root/testdata/sf0.001", 1000, 749), (SF, 10000, 7122)):
        assert plain(spark, sf).count() == raw
        assert clean_trips(plain(spark, sf)).count() == clean


def test_key_hash_split_sizes(spark):
    train, test = S.train_test_split(plain(spark, SF))
    assert (train.count(), test.count()) == (7971, 2029)


def test_key_hash_fold_sizes(spark):
    keys = spark.read.parquet(f"{SF}/events.parquet").select(F.col("event_id").cast("string").alias("key"))
    sizes = sorted(r["count"] for r in S.fold_column(keys, 3).groupBy("fold").count().collect())
    assert sizes == [3229, 3355, 3416]


def test_iqr_outliers_on_event_values(spark):
    events = spark.read.parquet(f"{SF}/events.parquet")
    assert P.iqr_outliers(events, "value").count() == 463


@pytest.mark.parametrize("sf,want", [("/root/testdata/sf0.1", 70411)])
def test_clean_count_sf01(spark, sf, want):
    assert clean_trips(plain(spark, sf)).count() == want
