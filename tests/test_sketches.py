import datetime as dt
import random

from pyspark.sql import functions as F

from cabmetrics.operators import sketches as S
from cabmetrics.session import scratch_path


def trips_of(spark, days, a_day=700, seed=2):
    rng = random.Random(seed)
    start = dt.datetime(2024, 1, 30)
    rows = [(start + dt.timedelta(days=d, seconds=rng.randrange(86400)), rng.expovariate(0.1)) for d in range(days) for _ in range(a_day)]
    return spark.createDataFrame([*rows, (start, None), (start, float("nan")), (None, 5.0)], "pickup_datetime timestamp, fare_amount double")


def test_merged_sketches_answer_within_their_bound(spark):
    trips = trips_of(spark, 12)
    path = scratch_path(spark, "sketches")
    S.save_sketches(S.daily_sketches(trips.filter("day(pickup_datetime) >= 30")), path)
    S.save_sketches(S.daily_sketches(trips.filter("day(pickup_datetime) < 30")), path)
    stored = S.read_sketches(spark, path)
    assert stored.count() == 12
    timed = trips.filter("pickup_datetime is not null")
    for chosen, part, parts in ((F.lit("all"), F.lit("all"), 1), (F.col("month"), F.date_format("pickup_datetime", "yyyy-MM"), 2)):
        found = S.merged_quantiles(stored, (0.0, 0.1, 0.5, 0.9, 1.0), [chosen.alias("part")])
        rows = S.rank_deviation(found, timed, part).join(found.select("part", "p", F.col("n").alias("sketch_n")), ["part", "p"]).collect()
        assert len(rows) == 5 * parts
        assert all(r["n"] == r["sketch_n"] and r["deviation"] <= S.rank_error() for r in rows)


def test_a_range_of_days_and_no_days(spark):
    trips = trips_of(spark, 4, a_day=50)
    stored = S.daily_sketches(trips)
    days = stored.filter(F.col("day").between("2024-01-31", "2024-02-01"))
    assert {r["n"] for r in S.merged_quantiles(days, (0.5,)).collect()} == {100}
    assert S.merged_quantiles(stored.filter("day is null"), (0.5,)).collect() == []
    assert S.merged_quantiles(stored.limit(0), (0.5,), ["day"]).collect() == []
