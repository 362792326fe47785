"""Invariants of the registered fitted-model queries (the driver only checks
that they return rows, so the properties are checked here)."""

import math

import pytest

import __spark_entry__ as entry
from cabmetrics.plans import common as K

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def q():
    return entry.queries()


@pytest.fixture(scope="module")
def sizes(spark):
    train, test = K.split(spark, SF)
    return {"train": train.count(), "test": test.count(), "clean": K.clean(spark, SF).count()}


def test_fits_and_evaluation_agree(spark, q):
    single = {}
    for name in ("fit_linear", "fit_forest", "fit_gbt"):
        rows = q[name](spark, SF).collect()
        assert len(rows) == 1
        r = rows[0]
        assert r.RMSE > 0 and r.MAE > 0 and r.MAE <= r.RMSE and r.R2 > 0.5
        single[r.Model] = (r.RMSE, r.MAE, r.R2)
    together = {r.Model: (r.RMSE, r.MAE, r.R2) for r in q["evaluate_model"](spark, SF).collect()}
    assert together == single


def test_predictions(spark, q, sizes):
    rows = q["predict"](spark, SF).collect()
    assert len(rows) == sizes["test"]
    assert all(math.isfinite(r.prediction) for r in rows)
    renamed = q["rename_columns"](spark, SF)
    assert renamed.columns == ["Actual_Fare_($)", "Predicted_Fare_($)"] and renamed.count() == sizes["test"]
    assert q["actual_vs_predicted"](spark, SF).count() == 15
    assert q["load_model"](spark, SF).count() == sizes["test"]
    assert q["batch_score"](spark, SF).count() == sizes["clean"]


def test_importances(spark, q):
    imp = q["feature_importance"](spark, SF).collect()
    assert len(imp) == 10 and sum(r.importance for r in imp) == pytest.approx(1.0)
    ranked = q["rank_importance"](spark, SF).collect()
    assert [r["rank"] for r in ranked] == list(range(1, 11))
    assert [r.importance for r in ranked] == sorted((r.importance for r in ranked), reverse=True)
    csv = q["importance_csv"](spark, SF).collect()
    assert len(csv) == 10 and {r.feature for r in csv} == {r.feature for r in imp}


def test_tuning_and_params(spark, q):
    grid = q["cross_validate"](spark, SF).collect()
    assert {(r.numTrees, r.maxDepth) for r in grid} == {(n, d) for n in (50, 100, 150) for d in (5, 10, 15)}
    assert all(math.isfinite(r.avg_rmse) and r.avg_rmse > 0 for r in grid)
    best = min(grid, key=lambda r: r.avg_rmse)
    params = {r.Model: r for r in q["model_params"](spark, SF).collect()}
    assert params["Random Forest"].num_trees == 50 and params["Random Forest"].max_depth == 10
    assert params["Gradient Boosted Trees"].num_trees == 20
    terms = {r.term: r.value for r in q["linear_coefficients"](spark, SF).collect()}
    assert params["Linear Regression"].intercept == terms["intercept"] and terms["distance_km"] > 0
    assert (params["Random Forest (tuned)"].num_trees, params["Random Forest (tuned)"].max_depth) == (best.numTrees, best.maxDepth)
    fb = q["fit_with_fallback"](spark, SF).first()
    assert fb.status == "tuned" and fb.error is None


def test_saved_model_metadata(spark, q):
    meta = q["save_model"](spark, SF).first()
    assert meta["class"].endswith("PipelineModel")
