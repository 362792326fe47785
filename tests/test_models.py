import math

import pytest
from pyspark.sql import functions as F

from cabmetrics.operators import models as M
from cabmetrics.operators.evaluate import metrics_row, regression_metrics
from cabmetrics.operators.split import fold_column, key_hash32
from cabmetrics.plans import common as K
from cabmetrics.plans import fare_model as FM
from cabmetrics.schema import ModelProfile, TuningProfile
from cabmetrics.session import scratch_path

SMALL = ModelProfile(rf_num_trees=10, rf_max_depth=5, gbt_max_iter=5)


@pytest.fixture(scope="module")
def data(spark, sf_small):
    return K.split(spark, sf_small)


def test_models_beat_mean_predictor(spark, data):
    train, test = data
    for kind in ("lr", "rf", "gbt"):
        model = M.fit(kind, train, profile=SMALL)
        preds = M.predict(model, test)
        m = regression_metrics(preds).first()
        assert m.n == test.count()
        assert m.r2 > 0.5, kind
        assert preds.filter(F.isnan("prediction") | F.col("prediction").isNull()).count() == 0


def test_importances_sum_to_one_and_rank(spark, data):
    train, _ = data
    model = M.fit("rf", train, profile=SMALL)
    imp = M.feature_importance(spark, model).collect()
    assert sum(r.importance for r in imp) == pytest.approx(1.0)
    assert [r.rank for r in imp] == list(range(1, 11))
    assert "distance_km" in [r.feature for r in imp[:3]]


def test_save_load_predicts_same(spark, data):
    train, test = data
    model = M.fit("gbt", train, profile=SMALL)
    path = M.save_model(model, scratch_path(spark, "m"))
    a = M.predict(model, test).withColumnRenamed("prediction", "a")
    b = M.predict(M.load_model(path), test).withColumnRenamed("prediction", "b")
    j = a.join(b, ["key", "label"])
    assert j.count() == test.count()
    assert j.filter(F.abs(F.col("a") - F.col("b")) > 1e-9).count() == 0


def test_cross_validate_table(spark, data):
    from cabmetrics.operators.split import fold_column

    train, _ = data
    tuning = TuningProfile(num_trees=(3, 5), max_depth=(2,), num_folds=2, parallelism=2)
    cv_model, table = M.cross_validate(fold_column(train, 2), tuning)
    rows = table.collect()
    assert {(r.numTrees, r.maxDepth) for r in rows} == {(3, 2), (5, 2)}
    assert all(math.isfinite(r.avg_rmse) for r in rows)


def test_error_mode_fails_on_null_only_when_materialised(spark, sf_small):
    raw = K.raw_features(spark, sf_small)
    df = M.assemble_features(raw, handle_invalid="error")
    assert df.count() == 1000  # count alone does not build the vectors
    with pytest.raises(Exception):
        df.select(F.col("features")).collect()
    assert M.assemble_features(raw, handle_invalid="skip").count() < 1000


def test_metrics_row_matches_evaluator(spark, data):
    from pyspark.ml.evaluation import RegressionEvaluator

    train, test = data
    preds = M.predict(M.fit("lr", train, profile=SMALL), test)
    r = metrics_row(preds, "lr", digits=None).first()
    for name, v in (("rmse", r.RMSE), ("mae", r.MAE), ("r2", r.R2)):
        want = RegressionEvaluator(labelCol="label", predictionCol="prediction", metricName=name).evaluate(preds)
        assert v == pytest.approx(want, rel=1e-9)


def test_model_cache_is_per_dataset(spark, sf_small):
    a = FM.fitted(spark, sf_small, "lr")
    assert FM.fitted(spark, sf_small, "lr") is a


def test_scaler_zero_deviation_gives_zero(spark):
    from pyspark.ml.functions import vector_to_array

    df = spark.createDataFrame([("a", 1.0, 5.0), ("b", 3.0, 5.0), ("c", 5.0, 5.0)], "key string, x double, c double")
    model = M.feature_pipeline(["x", "c"]).fit(df)
    rows = {r.key: r.v for r in model.transform(df).select("key", vector_to_array("features").alias("v")).collect()}
    assert rows["a"] == pytest.approx([-1.0, 0.0]) and rows["b"] == pytest.approx([0.0, 0.0])


def test_stable_layout_independent_of_input_partitioning(spark, sf_small):
    from cabmetrics.plans.common import stable_layout

    train, _ = K.split(spark, sf_small)
    a = stable_layout(train.select("key", "fare_amount"), 8)
    b = stable_layout(train.select("key", "fare_amount").coalesce(1), 8)
    pa = a.rdd.glom().map(lambda rows: [r.key for r in rows]).collect()
    assert a.rdd.getNumPartitions() == 8
    # same rows in the same partitions in the same order, whatever the input layout
    assert pa == b.rdd.glom().map(lambda rows: [r.key for r in rows]).collect()


def test_fit_with_fallback_reports_failure(spark, data):
    train, test = data
    # no fold column: tuning with the key-hash folds must fail, and the
    # default forest is fitted instead, with the reason reported
    model, status, err = M.fit_with_fallback(
        train, TuningProfile(num_trees=(3,), max_depth=(2,), num_folds=2), profile=ModelProfile(rf_num_trees=3, rf_max_depth=2)
    )
    assert status == "fallback" and err and "fold" in err
    assert M.predict(model, test).count() == test.count()


def test_successive_halving_fits_few_combinations_on_all_rows(spark, sf_small):
    train = fold_column(K.split(spark, sf_small)[0], 2)
    tuning = TuningProfile(num_trees=(2, 4), max_depth=(2, 5), num_folds=2)
    cv_model, rows = M.successive_halving(train, tuning, keep=2, rungs=2)
    of_rung = {r: [x for x in rows if x[0] == r] for r in (1, 2)}
    assert [len(v) for v in of_rung.values()] == [4, 2]
    kept = {(t, d) for _, _, _, t, d, _, k in of_rung[1] if k}
    assert kept == {(t, d) for _, _, _, t, d, _, _ in of_rung[2]}
    assert {(t, d) for _, _, _, t, d, e, _ in of_rung[1] if e <= sorted(x[5] for x in of_rung[1])[1]} == kept
    assert of_rung[2][0][2] == train.count()
    assert of_rung[1][0][2] == train.filter(key_hash32("key", offset=17) < 2**31).count()
    best = next((t, d) for _, _, _, t, d, _, k in of_rung[2] if k)
    assert (cv_model.bestModel.getNumTrees, cv_model.bestModel.getOrDefault("maxDepth")) == best


@pytest.mark.parametrize("rows_per_partition, seen", [(100, 10), (300_000, 2)])
def test_a_task_of_a_fit_reads_no_more_rows_than_a_file_has(spark, sf_small, monkeypatch, rows_per_partition, seen):
    K.raw_trips(spark, sf_small)  # 1,000 rows in 8 files, read in two tasks below
    n_train = K.split(spark, sf_small)[0].count()
    monkeypatch.setattr(K, "ROWS_PER_PARTITION", rows_per_partition)
    monkeypatch.setattr(M, "fit", lambda kind, data, *_: (data.rdd.getNumPartitions(), data.count()))
    monkeypatch.setattr(FM, "_FITTED", {})
    spark.conf.set("spark.sql.files.minPartitionNum", 2)
    try:
        assert FM.fitted(spark, sf_small, "rf") == (seen, n_train)
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")


def test_the_folds_share_a_pool_and_the_grid_is_whole(spark, data, monkeypatch):
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.tuning import CrossValidator

    train = fold_column(data[0], 3).repartition(4).persist()
    tuning = TuningProfile(num_trees=(2, 4), max_depth=(2, 5), num_folds=3, parallelism=4)
    fits, fit = [], M.RandomForestRegressor.fit

    def seen(self, rows, params=None):
        fits.append((params[self.maxDepth], params[self.numTrees], rows.rdd.getNumPartitions(), rows.count()))
        return fit(self, rows, params)

    rf = M.RandomForestRegressor(seed=tuning.seed, cacheNodeIds=True, maxMemoryInMB=M.TREE_MEMORY_MB)
    rows = M.assembler().transform(train).selectExpr("features", "fare_amount as label", "fold")
    plain = CrossValidator(estimator=rf, estimatorParamMaps=M.param_grid(rf, tuning), evaluator=RegressionEvaluator(metricName="rmse"), numFolds=3, foldCol="fold").fit(rows)
    monkeypatch.setattr(M.RandomForestRegressor, "fit", seen)
    # the layout kept: what CrossValidator finds
    cv_model, table = M.cross_validate(train, tuning)
    assert [r["avg_rmse"] for r in table.collect()] == pytest.approx(plain.avgMetrics, rel=1e-9)
    assert cv_model.bestModel.getNumTrees == plain.bestModel.getNumTrees
    fits.clear()
    _, table = M.cross_validate(train, tuning, fold_partitions=2)
    assert [(r["numTrees"], r["maxDepth"]) for r in table.collect()] == [(2, 2), (2, 5), (4, 2), (4, 5)]
    *folds, last = fits
    sizes = {r["fold"]: train.count() - r["count"] for r in train.groupBy("fold").count().collect()}
    assert sorted(f[3] for f in folds) == sorted(list(sizes.values()) * 4)
    assert {f[2] for f in folds} == {2} and last[2:] == (4, train.count())
    train.unpersist()


def test_an_empty_fold_is_an_error(spark, data):
    tuning = TuningProfile(num_trees=(2,), max_depth=(2,), num_folds=2)
    with pytest.raises(ValueError, match="validation data of fold 1 is empty"):
        M.cross_validate(data[0].withColumn("fold", F.lit(0)).filter("fold = 0").unionByName(data[0].withColumn("fold", F.lit(2)).limit(3)), tuning)


@pytest.mark.parametrize("rows_per_partition, seen", [(100, (10, 4)), (300_000, (8, None))])
def test_folds_of_larger_tables_read_fewer_partitions(spark, sf_small, monkeypatch, rows_per_partition, seen):
    K.raw_trips(spark, sf_small)  # 1,000 rows in 8 files
    found = []

    def search(data, tuning, fold_partitions):
        found.append((data.rdd.getNumPartitions(), fold_partitions))
        raise ValueError("seen")

    monkeypatch.setattr(K, "ROWS_PER_PARTITION", rows_per_partition)
    monkeypatch.setattr(M, "cross_validate", search)
    monkeypatch.setattr(FM, "fitted", lambda *_: None)
    monkeypatch.setattr(FM, "_FITTED", {})
    spark.conf.set("spark.sql.files.minPartitionNum", 8)
    try:
        assert FM.tuned(spark, sf_small, TuningProfile())[2:] == ("fallback", "ValueError: seen")
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
    assert found == [seen]


@pytest.mark.parametrize("rows_per_partition, seen", [(3_000, (8, 3)), (30_000, (8, None))])
def test_folds_of_all_but_small_tables_read_fewer_partitions(spark, sf_small, monkeypatch, rows_per_partition, seen):
    n = K.raw_trips(spark, sf_small).count()  # 1,000 rows in 8 files: small up to a sixth of a partition's rows
    assert (n * FM.SMALL_TABLES > rows_per_partition) == (seen[1] is not None)
    found = []

    def search(data, tuning, fold_partitions):
        found.append((data.rdd.getNumPartitions(), fold_partitions))
        raise ValueError("seen")

    monkeypatch.setattr(K, "ROWS_PER_PARTITION", rows_per_partition)
    monkeypatch.setattr(M, "cross_validate", search)
    monkeypatch.setattr(FM, "fitted", lambda *_: None)
    monkeypatch.setattr(FM, "_FITTED", {})
    spark.conf.set("spark.sql.files.minPartitionNum", 8)
    try:
        assert FM.tuned(spark, sf_small, TuningProfile())[2:] == ("fallback", "ValueError: seen")
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
    assert found == [seen]


def test_deep_forests_on_few_rows_read_fewer_partitions():
    found = {(t, d): M._fit_partitions(M.estimator("rf"), 36_700, t, d, 10, 3) for t in (50, 100, 150) for d in (5, 10, 15)}
    assert found == {(t, d): 3 if d < 15 else {50: 1, 100: 1, 150: 2}[t] for t, d in found}
    # more rows: as many as there were, and never more
    assert [M._fit_partitions(M.estimator("rf"), rows, 150, 15, 10, 7) for rows in (50_000, 100_000, 220_000, 2_200_000)] == [2, 4, 7, 7]


def test_fits_of_fewer_partitions_read_all_rows_of_their_folds(spark, data, monkeypatch):
    train = fold_column(data[0], 2).repartition(4).persist()
    fits, fit = [], M.RandomForestRegressor.fit

    def seen(self, rows, params=None):
        fits.append((params[self.maxDepth], params[self.numTrees], rows.rdd.getNumPartitions(), rows.count()))
        return fit(self, rows, params)

    monkeypatch.setattr(M.RandomForestRegressor, "fit", seen)
    monkeypatch.setattr(M, "ROWS_TIMES_TREES", 2 * train.count())
    monkeypatch.setattr(M.RandomForestRegressor, "getMaxBins", lambda self: 220_000)  # statistics taken as large
    cv_model, table = M.cross_validate(train, TuningProfile(num_trees=(2, 6), max_depth=(2, 5), num_folds=2, parallelism=1), fold_partitions=3)
    *folds, last = fits
    sizes = sorted(r["count"] for r in train.groupBy("fold").count().collect())
    assert sorted(f[3] for f in folds) == sorted(sizes * 4) and last[2:] == (4, train.count())
    assert {f[:3] for f in folds} == {(2, 2, 3), (2, 6, 3), (5, 2, 1), (5, 6, 2)}
    assert [(r["numTrees"], r["maxDepth"]) for r in table.collect()] == [(2, 2), (2, 5), (6, 2), (6, 5)]
    train.unpersist()


SEARCHED = (
    "compare_tuning cross_validate model_params rank_importance tuned_residual_report tuned_residual_histogram tuned_error_by_segment "
    "check_compare_tuning check_grid check_model_params check_rank_importance check_tuned_residuals check_tuned_rows"
).split()


def test_a_failed_search_is_told_and_never_a_result(spark, sf_small, monkeypatch):
    from cabmetrics.plans import catalog

    def search(*_, **__):
        raise ValueError("the search broke")

    monkeypatch.setattr(M, "cross_validate", search)
    monkeypatch.setattr(catalog, "TUNING", TuningProfile(num_trees=(2,), max_depth=(2,), seed=7))  # none is kept of these
    for name in SEARCHED:
        with pytest.raises((ValueError, RuntimeError), match="the search broke"):
            catalog.REGISTRY[name](spark, sf_small).collect()
    told = catalog.REGISTRY["fit_with_fallback"](spark, sf_small).first()
    assert (told.status, told.error) == ("fallback", "ValueError: the search broke") and told.RMSE > 0


def test_a_failed_search_is_not_kept(spark, sf_small, monkeypatch):
    tuning = TuningProfile(num_trees=(2,), max_depth=(2,), num_folds=2, seed=8)
    with monkeypatch.context() as m:
        m.setattr(M, "cross_validate", lambda *_, **__: 1 / 0)
        assert FM.tuned(spark, sf_small, tuning)[2] == "fallback"
    best, table, status, error = FM.tuned(spark, sf_small, tuning)
    assert (status, error, table.count(), M.final_stage(best).getNumTrees) == ("tuned", None, 1, 2)


@pytest.mark.parametrize("limit, at_once", [(1, 1), (10**9, 2)])
def test_large_fits_run_one_at_a_time_with_less_memory_a_pass(spark, data, monkeypatch, limit, at_once):
    import threading
    import time

    train = fold_column(data[0], 2).repartition(4).persist()
    fits, running, lock, fit = [], [], threading.Lock(), M.RandomForestRegressor.fit

    def seen(self, rows, params=None):
        with lock:
            running.append(params)
            fits.append((len(running), self.getMaxMemoryInMB(), rows.count()))
        time.sleep(0.5)
        try:
            return fit(self, rows, params)
        finally:
            with lock:
                running.remove(params)

    monkeypatch.setattr(M.RandomForestRegressor, "fit", seen)
    monkeypatch.setattr(M, "LARGE_SEARCH_ROWS", train.count() - 1)
    monkeypatch.setattr(M, "ROWS_TIMES_TREES_AT_ONCE", limit)
    cv_model, table = M.cross_validate(train, TuningProfile(num_trees=(2, 3), max_depth=(2, 4), num_folds=2, parallelism=2))
    assert max(f[0] for f in fits) == at_once
    assert {f[1] for f in fits} == {256} and len(fits) == 9 and fits[-1][2] == train.count()
    assert table.count() == 4 and cv_model.bestModel.getNumTrees in (2, 3)
    train.unpersist()


def test_garbage_is_collected_while_a_large_search_runs():
    import time
    from types import SimpleNamespace

    calls = []
    session = SimpleNamespace(sparkContext=SimpleNamespace(_jvm=SimpleNamespace(System=SimpleNamespace(gc=lambda: calls.append(1)))))
    with M._collected(session, 0.01):
        time.sleep(0.5)
    n = len(calls)
    time.sleep(0.1)
    assert n > 1 and len(calls) == n
