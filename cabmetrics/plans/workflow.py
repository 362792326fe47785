"""The reference's load -> clean -> features -> train -> evaluate -> tune ->
save chain as one function in one session (its scripts ran as separate
processes and re-derived the same split three times)."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import evaluate as E
from ..operators import models as M
from ..operators.clean import clean_trips, cleaning_stage_counts, drop_nulls
from ..operators.features import feature_projection
from ..operators.split import fold_column, sample_to_size, train_test_split
from ..schema import CODE_PROFILE, TARGET, TREE_FEATURES, CleaningProfile, ModelProfile, TuningProfile
from ..sources.sinks import write_table


@dataclass
class WorkflowResult:
    metrics: DataFrame  # (Model, RMSE, MAE, R2) of the baseline models
    ranking: DataFrame  # metrics with rank by RMSE
    grid: DataFrame  # (numTrees, maxDepth, avg_rmse)
    comparison: DataFrame  # (metric, before, after, change) forest before / after tuning
    importance: DataFrame  # (feature, importance, rank) of the tuned forest
    stage_counts: DataFrame  # rows at each cleaning stage (actual counts, SURVEY §8 D8)
    run_id: str  # stamped on every written table (SURVEY §8 D11)
    paths: dict


def run_workflow(
    spark: SparkSession,
    trips: DataFrame,
    out_dir: str,
    cleaning: CleaningProfile = CODE_PROFILE,
    models: ModelProfile = ModelProfile(),
    tuning: TuningProfile = TuningProfile(),
    kinds=("lr", "rf", "gbt"),
    sample_size: int | None = None,
    clean: bool = True,
    run_id: str | None = None,
) -> WorkflowResult:
    """Fit, evaluate, tune and save; every table is also written under ``out_dir``.

    ``sample_size`` bounds the rows used to fit (the reference used 10,000): a
    stable key-hash Bernoulli sample of the training side; the test side stays
    whole. ``None`` (default) trains on all cleaned rows. The training rows are
    projected and persisted once for all fits and the tuning. ``clean=False`` only drops rows with missing values (the
    path the reference's published models most likely came from). Every
    written table carries ``run_id`` so that baseline and tuned numbers are
    known to come from one run.
    """
    run_id = run_id or uuid.uuid4().hex[:16]
    stamp = F.lit(run_id).alias("run_id")
    stages = cleaning_stage_counts(trips, cleaning).select("*", stamp)
    paths = {"stage_counts": write_table(stages, f"{out_dir}/stage_counts")}
    kept = clean_trips(trips, cleaning) if clean else drop_nulls(trips)
    feats = feature_projection(kept)
    train, test = train_test_split(feats)
    if sample_size is not None:
        train = sample_to_size(train, sample_size)
    train = fold_column(train, tuning.num_folds).select(*TREE_FEATURES, TARGET, "fold").persist(StorageLevel.MEMORY_AND_DISK)
    fitted = {M.MODEL_NAMES[k]: M.fit(k, train, TREE_FEATURES, models) for k in kinds}
    metrics = E.metrics_table(M.predict_many(fitted, test), list(fitted)).select("*", stamp)
    paths["metrics"] = write_table(metrics, f"{out_dir}/evaluation_results")
    metrics = spark.read.parquet(paths["metrics"])  # computed once, reused below
    paths["metrics_csv"] = write_table(metrics, f"{out_dir}/model_comparison", fmt="csv")

    cv_model, grid = M.cross_validate(train, tuning)
    train.unpersist()
    final = PipelineModel(stages=[M.assembler(TREE_FEATURES), cv_model.bestModel])
    tuned = E.metrics_row(M.predict(final, test), M.MODEL_NAMES["rf"])
    comparison = E.compare_before_after(metrics, tuned, M.MODEL_NAMES["rf"]).select("*", stamp)
    paths["comparison"] = write_table(comparison, f"{out_dir}/tuning_comparison")
    comparison = spark.read.parquet(paths["comparison"])
    importance = M.feature_importance(spark, final).select("*", stamp)

    for name, model in fitted.items():
        paths[f"model:{name}"] = M.save_model(model, f"{out_dir}/models/{name.lower().replace(' ', '_')}")
    paths["model:final"] = M.save_model(final, f"{out_dir}/models/final_model")
    paths["importance_csv"] = write_table(importance, f"{out_dir}/feature_importance", fmt="csv")
    stages = spark.read.parquet(paths["stage_counts"])
    return WorkflowResult(metrics, E.rank_models(metrics), grid, comparison, importance, stages, run_id, paths)
