import numpy as np
import pandas as pd
import pytest

from cabmetrics.operators import profile as P


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(7)
    vals = rng.gamma(2.0, 10.0, 5000)
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    got = [r.n for r in P.equal_width_histogram(df, "x", 100).orderBy("bin").collect()]
    want, _ = np.histogram(vals, bins=100)
    assert got == want.tolist()


def test_histogram_constant_and_empty(spark):
    df = spark.createDataFrame([(2.0,)] * 5, "x double")
    rows = P.equal_width_histogram(df, "x", 10).orderBy("bin").collect()
    want, edges = np.histogram([2.0] * 5, bins=10)
    assert [r.n for r in rows] == want.tolist()
    assert rows[0].low == pytest.approx(edges[0]) and rows[-1].high == pytest.approx(edges[-1])
    empty = spark.createDataFrame([], "x double")
    assert P.equal_width_histogram(empty, "x", 10).count() == 0


def test_describe_matches_pandas(spark):
    pdf = pd.DataFrame({"a": [1.0, 2.0, None, 4.0, 10.0], "b": [3.0, 3.0, 3.0, 3.0, 3.0]})
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None).values.tolist(), "a double, b double")
    got = {r.column: r for r in P.describe_numeric(df, ["a", "b"]).collect()}
    d = pdf.describe()
    for c in ("a", "b"):
        assert got[c]["count"] == d[c]["count"]
        for k, pk in [("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("max", "max")]:
            assert got[c][k] == pytest.approx(round(d[c][pk], 6))


def test_corr_constant_column_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (3.0, 2.0)], "a double, b double")
    assert P.corr_pair(df, "a", "b").first().corr is None


def test_corr_pairwise_complete(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, None), (None, 1.0), (4.0, 8.0)], "a double, b double")
    assert P.corr_pair(df, "a", "b").first().corr == pytest.approx(1.0)


def test_null_profile_counts_nan(spark):
    df = spark.createDataFrame([(1.0, "x"), (float("nan"), None), (None, "y")], "a double, s string")
    got = {r.column: (r.n_null, r.pct_null) for r in P.null_profile(df).collect()}
    assert got == {"a": (2, 66.67), "s": (1, 33.33)}


def test_temporal_profile_single_scan(spark):
    df = spark.createDataFrame(
        [("k1", 10.0, 1, 2), ("k2", 20.0, 1, 3), ("k3", 30.0, 2, 3)], "key string, fare_amount double, hour int, day_of_week int"
    )
    got = sorted((r.kind, r.bucket, r.trip_count, r.avg_fare) for r in P.temporal_profile(df).collect())
    assert got == [("day", 2, 1, 10.0), ("day", 3, 2, 25.0), ("hour", 1, 2, 15.0), ("hour", 2, 1, 30.0)]
    plan = P.temporal_profile(df)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_histogram_ignores_nulls(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,), (float("nan"),), (3.0,)], "x double")
    rows = P.equal_width_histogram(df, "x", 2).orderBy("bin").collect()
    assert [r.n for r in rows] == [1, 2]


def test_means_are_plain_and_skip_nan(spark):
    rows = [("a", 5.333, 1), ("b", 5.333, 1), ("c", 1.004, 1), ("d", float("nan"), 1), ("e", None, 1), ("f", 1e12, 2), (None, 2.0, 2), ("g", float("nan"), 3)]
    df = spark.createDataFrame([(*r, r[2]) for r in rows], "key string, fare_amount double, hour int, day_of_week int")
    got = {r.hour: (r.avg_fare, r.trip_count) for r in P.fare_by_hour(df).collect()}
    assert got == {1: (3.89, 5), 2: (500000000001.0, 1), 3: (None, 1)}
    panels = {(r.kind, r.bucket): (r.avg_fare, r.trip_count) for r in P.temporal_profile(df).collect()}
    assert panels == {(kind, k): v for kind in ("hour", "day") for k, v in got.items()}


def test_histogram_of_infinite_values(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("inf"),)], "x double")
    with pytest.raises(ValueError, match="not finite"):
        P.equal_width_histogram(df, "x", 2)
    assert [r.n for r in P.equal_width_histogram(df, "x", 2, lo=1.0, hi=2.0).orderBy("bin").collect()] == [1, 1]
