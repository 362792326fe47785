"""End-to-end model plans: fit, evaluate, tune, save, score.

Fitted models are memoised per (application, data dir, kind, parameters)
so the many report queries of one session share one fit per model.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import models as M
from ..operators.evaluate import metrics_row, metrics_table
from ..operators.split import fold_column
from ..schema import TARGET, TREE_FEATURES, ModelProfile, TuningProfile
from ..session import scratch_path
from . import common

# Fixed value of our own: a trip table is small up to this part of a partition's rows (50,000).
SMALL_TABLES = 6

_FITTED: dict = {}


def _once(key: tuple, make):
    if key not in _FITTED:
        _FITTED[key] = make()
    return _FITTED[key]


def fitted(spark: SparkSession, sf_dir: str, kind: str, features: Sequence[str] = TREE_FEATURES, profile: ModelProfile = ModelProfile()) -> PipelineModel:
    def fit() -> PipelineModel:
        train, _ = common.split(spark, sf_dir)
        # MLlib reads its input several times before it caches its own binned
        # copy (metadata, split sampling, binning); persist only the columns
        # the pipeline uses, not the whole trip row, and drop it after the fit
        data = common.spread(spark, sf_dir, train.select(*features, TARGET)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            return M.fit(kind, data, features, profile)
        finally:
            data.unpersist()

    return _once(common.data_key(spark, sf_dir, kind, tuple(features), profile), fit)


def test_predictions(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    _, test = common.split(spark, sf_dir)
    return M.predict(fitted(spark, sf_dir, kind), test, keep=("key", "distance_km", "hour"))


def model_metrics(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return metrics_row(test_predictions(spark, sf_dir, kind), M.MODEL_NAMES[kind])


def evaluate_all(spark: SparkSession, sf_dir: str, kinds=("lr", "rf", "gbt")) -> DataFrame:
    """Metrics of several models from one scan of the test split: the
    pipelines are applied one after another to the same rows and a single
    aggregate computes every model's RMSE, MAE and R²."""
    _, test = common.split(spark, sf_dir)
    models = {M.MODEL_NAMES[k]: fitted(spark, sf_dir, k) for k in kinds}
    return metrics_table(M.predict_many(models, test), list(models), label="label")


def searched(spark: SparkSession, sf_dir: str, tuning: TuningProfile):
    """(best pipeline, grid table): one search shared by every report. What goes
    wrong in it is raised, and not kept: no other model answers in its place."""

    def search():
        train, _ = common.split(spark, sf_dir)
        data = common.spread(spark, sf_dir, fold_column(train, tuning.num_folds).select(*TREE_FEATURES, TARGET, "fold"))
        # each partition sends the statistics of every node, however few its rows,
        # up to 7 GB a level for 150 trees of depth 15: unless the table is small,
        # the folds' fits, several of which run at once, read a third of the
        # partitions (a million rows of the table each at most on average); small
        # ones, whose trees end early, keep their layout, and so their draws. The
        # last fit runs alone, on all.
        partitions = None
        if common.raw_trips(spark, sf_dir).count() * SMALL_TABLES > common.ROWS_PER_PARTITION:
            partitions = -(-data.rdd.getNumPartitions() // 3)
        data = data.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            cv_model, table = M.cross_validate(data, tuning, fold_partitions=partitions)
        finally:
            data.unpersist()
        best = PipelineModel(stages=[M.assembler(TREE_FEATURES), cv_model.bestModel])
        # the grid table has one row per parameter combination
        return best, table.collect(), table.schema

    best, rows, schema = _once(common.data_key(spark, sf_dir, "cv", tuning.num_trees, tuning.max_depth, tuning.num_folds, tuning.seed), search)
    return best, spark.createDataFrame(rows, schema)


def tuned(spark: SparkSession, sf_dir: str, tuning: TuningProfile):
    """(best pipeline, grid table, status, error) of the search; if it fails, the
    default forest stands in and the error is told. Only for what reports both."""
    try:
        return *searched(spark, sf_dir, tuning), "tuned", None
    except Exception as exc:  # noqa: BLE001 - reported in the status columns
        empty = spark.createDataFrame([], "numTrees int, maxDepth int, avg_rmse double")
        return fitted(spark, sf_dir, "rf"), empty, "fallback", f"{type(exc).__name__}: {exc}"


def tuning_predictions(spark: SparkSession, sf_dir: str, tuning: TuningProfile) -> DataFrame:
    """Test rows with the baseline forest's and the tuned forest's predictions, one pass."""
    _, test = common.split(spark, sf_dir)
    models = {"baseline": fitted(spark, sf_dir, "rf"), "tuned": searched(spark, sf_dir, tuning)[0]}
    return M.predict_many(models, test, keep=("key", "distance_km", "hour"))


def save_fitted(spark: SparkSession, sf_dir: str, kind: str) -> str:
    """Path of the saved model, written once per fitted model."""
    model = fitted(spark, sf_dir, kind)
    return _once(common.data_key(spark, sf_dir, "saved", kind), lambda: M.save_model(model, scratch_path(spark, f"model-{kind}")))


def batch_score(spark: SparkSession, model_path: str, trips: DataFrame) -> DataFrame:
    """Apply a saved pipeline to trips and write (key, prediction) as parquet;
    returns the written table."""
    model = M.load_model(model_path)
    out = scratch_path(spark, "scores")
    model.transform(trips).select("key", F.col("prediction")).write.mode("overwrite").parquet(out)
    return spark.read.parquet(out)
