import numpy as np
import pytest

from cabmetrics.operators.quantiles import approx_quantiles, exact_quantiles

PROBS = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]


def _frame(spark, values):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double")


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_refinement_passes_match_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    vals = np.concatenate([rng.normal(20, 8, 3000), np.full(1500, 7.25), rng.integers(0, 50, 500)])
    df = _frame(spark, vals.tolist() + [None, None]).repartition(5)
    # a coarse sketch and a short list force several passes
    got = exact_quantiles(df, ["x"], PROBS, limit=5, accuracy=10)["x"]
    want = np.percentile(vals, [p * 100 for p in PROBS])
    assert got == pytest.approx(want.tolist(), rel=1e-12, abs=1e-12)


def test_hot_value_one_third_of_rows(spark):
    vals = [5.0] * 4000 + list(range(8000))
    got = exact_quantiles(_frame(spark, vals), ["x"], [0.25, 0.5], limit=3, accuracy=10)["x"]
    assert got == pytest.approx(np.percentile(vals, [25, 50]).tolist())


def test_constant_empty_and_single(spark):
    assert exact_quantiles(_frame(spark, [3.0] * 10), ["x"], [0.5])["x"] == [3.0]
    assert exact_quantiles(_frame(spark, [None, None]), ["x"], [0.5])["x"] == [None]
    assert exact_quantiles(_frame(spark, [4.5]), ["x"], [0.25, 0.75])["x"] == [4.5, 4.5]


def test_nan_treated_as_missing(spark):
    got = exact_quantiles(_frame(spark, [1.0, float("nan"), 3.0]), ["x"], [0.5])["x"]
    assert got == [2.0]


def test_approx_close(spark):
    vals = list(range(1000))
    got = approx_quantiles(_frame(spark, vals), ["x"], [0.5])["x"][0]
    assert abs(got - 499.5) <= 2


@pytest.mark.parametrize("options", [{}, {"limit": 1, "accuracy": 10}])
def test_infinite_values_are_values(spark, options):
    vals = [float("-inf")] * 3 + list(range(100)) + [float("inf")] * 5
    got = exact_quantiles(_frame(spark, vals), ["x"], [0.0, 0.01, 0.5, 1.0], **options)["x"]
    assert got[0] == got[1] == float("-inf") and got[2] == np.median(vals) and got[3] == float("inf")


def test_two_heavy_values_around_one(spark):
    vals = [1.0] * 500 + [2.0] + [3.0] * 500
    assert exact_quantiles(_frame(spark, vals), ["x"], [0.5], limit=1, accuracy=10)["x"] == [2.0]
