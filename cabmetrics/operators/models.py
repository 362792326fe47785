"""Feature assembly, estimators, tuning and model introspection (MLlib).

Training is MLlib's distributed work (tree levels and gradient steps are
``treeAggregate`` jobs over partitions); this module only wires the stages
into ``Pipeline``s so that a fitted model carries its own feature assembly
and can be saved, loaded and applied to new trips unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager, nullcontext
from dataclasses import replace
from multiprocessing.pool import ThreadPool
from threading import Condition, Event, Thread

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import TARGET, TREE_FEATURES, ModelProfile, TuningProfile
from .split import key_hash32

# Memory for the node statistics of one pass. A level whose nodes don't fit is
# split over several passes; the default of 256 MB splits the deep levels of
# large forests many times.
TREE_MEMORY_MB = 1024
# Fixed value of our own: rows times trees that one partition of a fold's fit holds
# where the node statistics, of which each partition sends a copy, are large.
ROWS_TIMES_TREES = 4_000_000
# Fixed values of our own for searches over more than so many rows, whose deep levels
# fill a pass. Each task holds a pass's statistics (a third more than MLlib counts), so
# two at once take 700 MB of an executor; with 1 GB a pass, 2.7 GB.
LARGE_SEARCH_ROWS = 200_000
LARGE_SEARCH_MEMORY_MB = 256
# Rows times trees of the fits that run at once: MLlib keeps up to 20 bytes of each
# (draws, and node ids of the last passes) in storage, 5 GB in all, or one fit's.
ROWS_TIMES_TREES_AT_ONCE = 250_000_000
# Seconds between collections of the driver's garbage in a large search.
COLLECT_EVERY_S = 60

MODEL_NAMES = {"lr": "Linear Regression", "rf": "Random Forest", "gbt": "Gradient Boosted Trees"}


def assembler(features: Sequence[str] = TREE_FEATURES, output: str = "features", handle_invalid: str = "error") -> VectorAssembler:
    """``handle_invalid``: 'error' (fails when a null/NaN row is materialised),
    'skip' (drops such rows) or 'keep'."""
    return VectorAssembler(inputCols=list(features), outputCol=output, handleInvalid=handle_invalid)


def assemble_features(df: DataFrame, features: Sequence[str] = TREE_FEATURES, handle_invalid: str = "error", keep: Sequence[str] = ("key",)) -> DataFrame:
    return assembler(features, handle_invalid=handle_invalid).transform(df).select(*keep, "features")


def to_label_frame(df: DataFrame, features: Sequence[str] = TREE_FEATURES, target: str = TARGET, handle_invalid: str = "error") -> DataFrame:
    """(key, features, label) — the key is kept so predictions can be joined back."""
    return assembler(features, handle_invalid=handle_invalid).transform(df).select(
        "key", "features", F.col(target).cast("double").alias("label")
    )


def scaler(input_col: str = "features_raw", output: str = "features") -> StandardScaler:
    return StandardScaler(inputCol=input_col, outputCol=output, withMean=True, withStd=True)


def feature_pipeline(features: Sequence[str] = TREE_FEATURES, handle_invalid: str = "skip") -> Pipeline:
    """Assembler + standard scaler; fit it on the train split only."""
    return Pipeline(stages=[assembler(features, "features_raw", handle_invalid), scaler()])


def vector_columns(df: DataFrame, vec: str, names: Sequence[str], keep: Sequence[str] = ("key",), digits: int | None = 6) -> DataFrame:
    arr = vector_to_array(F.col(vec))
    cols = [arr[i] if digits is None else F.round(arr[i], digits) for i in range(len(names))]
    return df.select(*keep, *[c.alias(n) for c, n in zip(cols, names)])


def estimator(kind: str, profile: ModelProfile = ModelProfile(), features_col: str = "features", label_col: str = "label"):
    if kind == "lr":
        return LinearRegression(
            featuresCol=features_col, labelCol=label_col, maxIter=profile.lr_max_iter, regParam=profile.lr_reg_param
        )
    if kind == "rf":
        return RandomForestRegressor(
            featuresCol=features_col,
            labelCol=label_col,
            numTrees=profile.rf_num_trees,
            maxDepth=profile.rf_max_depth,
            seed=profile.seed,
            # keep each row's current node id next to the data instead of
            # shipping all trees to the executors every level (same model,
            # about half the time for deep forests; checkpointed to the
            # shared folder every 10 levels)
            cacheNodeIds=True,
            maxMemoryInMB=TREE_MEMORY_MB,
        )
    if kind == "gbt":
        return GBTRegressor(featuresCol=features_col, labelCol=label_col, maxIter=profile.gbt_max_iter, seed=profile.seed)
    raise ValueError(f"unknown model kind {kind!r}")


def model_pipeline(kind: str, features: Sequence[str] = TREE_FEATURES, profile: ModelProfile = ModelProfile(), handle_invalid: str = "error") -> Pipeline:
    """Assembler + estimator, label = fare_amount. The linear model takes raw
    features (MLlib standardises inside the fit), so its intercept and
    coefficients are in the features' own units."""
    est = estimator(kind, profile)
    est.setLabelCol(TARGET)
    return Pipeline(stages=[assembler(features, handle_invalid=handle_invalid), est])


def fit(kind: str, train: DataFrame, features: Sequence[str] = TREE_FEATURES, profile: ModelProfile = ModelProfile()) -> PipelineModel:
    return model_pipeline(kind, features, profile).fit(train)


def predict(model: PipelineModel, df: DataFrame, keep: Sequence[str] = ("key",)) -> DataFrame:
    """(key, label, prediction)."""
    return model.transform(df).select(*keep, F.col(TARGET).alias("label"), "prediction")


def predict_many(models: dict, df: DataFrame, keep: Sequence[str] = ("key",)) -> DataFrame:
    """(key, label, one prediction column per model name) from a single pass:
    each pipeline's output is renamed and its intermediate vectors dropped
    before the next pipeline runs on the same rows."""
    out = df
    for name, model in models.items():
        before = set(out.columns)
        out = model.transform(out).withColumnRenamed("prediction", name)
        out = out.drop(*[c for c in out.columns if c not in before and c != name])
    return out.select(*keep, F.col(TARGET).alias("label"), *models)


def param_grid(est: RandomForestRegressor, tuning: TuningProfile = TuningProfile()):
    return ParamGridBuilder().addGrid(est.numTrees, list(tuning.num_trees)).addGrid(est.maxDepth, list(tuning.max_depth)).build()


def cross_validate(
    train: DataFrame,
    tuning: TuningProfile = TuningProfile(),
    features: Sequence[str] = TREE_FEATURES,
    fold_col: str | None = "fold",
    combinations: Sequence[tuple[int, int]] | None = None,
    fold_partitions: int | None = None,
):
    """Grid search of the forest with k-fold CV on RMSE, over the profile's grid or the ``combinations`` (numTrees, maxDepth).

    With ``fold_col`` the folds come from the key hash (stable), and their fits
    read the rows in ``fold_partitions`` partitions, deep forests on few rows
    in less (``_fit_partitions``; the best combination's last fit, which runs
    alone, reads ``train`` as it is);
    otherwise CrossValidator draws random folds with ``tuning.seed``. Returns
    the CV model and a table (numTrees, maxDepth, avg_rmse).
    """
    rf = RandomForestRegressor(featuresCol="features", labelCol="label", seed=tuning.seed, cacheNodeIds=True, maxMemoryInMB=TREE_MEMORY_MB)
    grid = param_grid(rf, tuning) if combinations is None else [{rf.numTrees: t, rf.maxDepth: d} for t, d in combinations]
    data = assembler(features).transform(train).select(
        "features", F.col(TARGET).cast("double").alias("label"), *([fold_col] if fold_col else [])
    )
    evaluator = RegressionEvaluator(labelCol="label", predictionCol="prediction", metricName="rmse")
    if fold_col:
        cv_model = _search_folds(rf, grid, evaluator, data, fold_col, tuning, fold_partitions, len(features))
    else:
        cv = CrossValidator(
            estimator=rf,
            estimatorParamMaps=grid,
            evaluator=evaluator,
            numFolds=tuning.num_folds,
            seed=tuning.seed,
            parallelism=tuning.parallelism,
        )
        cv_model = cv.fit(data)
    spark = train.sparkSession
    rows = [
        (int(pm[rf.numTrees]), int(pm[rf.maxDepth]), float(m)) for pm, m in zip(grid, cv_model.avgMetrics)
    ]
    table = spark.createDataFrame(rows, "numTrees int, maxDepth int, avg_rmse double")
    return cv_model, table


def _fit_partitions(est: RandomForestRegressor, rows: int, trees: int, depth: int, features: int, most: int) -> int:
    """Partitions that one fit reads, ``most`` unless their copies of a level's statistics would outgrow a pass's memory.

    Each partition sends count, sum and sum of squares of every node, feature
    tried (a third of them) and bin, however few its rows. A deep forest's
    then outweigh the rows, and a partition more only pays with more rows.
    """
    nodes = trees * min(2 ** max(depth - 1, 0), max(rows // 2, 1))
    copy_mb = nodes * -(-features // 3) * est.getMaxBins() * 3 * 8 / 2**20
    if most * copy_mb <= TREE_MEMORY_MB:
        return most
    return min(most, max(1, -(-rows * trees // ROWS_TIMES_TREES)))


@contextmanager
def _collected(spark: SparkSession, every: float) -> Iterator[None]:
    """The driver's garbage is collected every so many seconds.

    Shuffle files and broadcasts of a pass that is over stay on the executors'
    disks until the driver finds that nothing refers to them. Each pass of a
    deep forest leaves the statistics of its nodes there, once a partition.
    """
    over = Event()

    def collect() -> None:
        while not over.wait(every):
            spark.sparkContext._jvm.System.gc()

    thread = Thread(target=collect, daemon=True)
    thread.start()
    try:
        yield
    finally:
        over.set()
        thread.join()


def _search_folds(rf, grid, evaluator, data: DataFrame, fold_col: str, tuning: TuningProfile, fold_partitions: int | None, features: int) -> CrossValidatorModel:
    """What CrossValidator does with a fold column, but the fits of all folds share one pool.

    CrossValidator waits at the end of each fold for its largest forest, which
    comes last. Here the next fold's fits start meanwhile, and a fold's largest
    forests start first. Where fits read less than ``fold_partitions``, the
    largest of all folds come first and up to twice as many run at once; these
    read no more partitions together than ``tuning.parallelism`` fits of
    ``fold_partitions`` would. Larger tables keep the order by fold, as the
    driver holds the forests being fitted, and fewer fits run at once, one at
    least, where these would keep more than ``ROWS_TIMES_TREES_AT_ONCE``. Above
    ``LARGE_SEARCH_ROWS`` a pass has less memory and garbage is collected.
    """
    spark = data.sparkSession
    held = {r[fold_col]: r["count"] for r in data.groupBy(fold_col).count().collect() if r[fold_col] is not None}
    sizes = [sum(n for f, n in held.items() if f != fold) for fold in range(tuning.num_folds)]
    for fold, size in enumerate(sizes):
        for name, n in (("train", size), ("validation", held.get(fold, 0))):
            if not n:
                raise ValueError(f"the {name} data of fold {fold} is empty")
    large = sum(held.values()) > LARGE_SEARCH_ROWS
    if large:
        rf = rf.copy({rf.maxMemoryInMB: LARGE_SEARCH_MEMORY_MB})
    size_of = [(params[rf.maxDepth], params[rf.numTrees]) for params in grid]
    tasks = [(fold, j) for fold in range(tuning.num_folds) for j in sorted(range(len(grid)), key=lambda j: size_of[j], reverse=True)]
    # partitions of each fit, 0 for the layout as it is; those that are free to be read now
    read, workers, free, turn = dict.fromkeys(tasks, 0), tuning.parallelism, 0, Condition()
    if fold_partitions is not None:
        read = {(fold, j): _fit_partitions(rf, sizes[fold], size_of[j][1], size_of[j][0], features, fold_partitions) for fold, j in tasks}
        free = tuning.parallelism * fold_partitions
        if min(read.values()) < fold_partitions:
            tasks.sort(key=lambda task: size_of[task[1]], reverse=True)
            workers *= 2

    running, load = 0, {(fold, j): sizes[fold] * size_of[j][1] for fold, j in tasks}

    def score(task: tuple[int, int]) -> tuple[int, int, float]:
        nonlocal free, running
        fold, j = task
        rows = data.coalesce(read[task]) if read[task] else data
        with turn:
            turn.wait_for(lambda: free >= read[task] and (not running or running + load[task] <= ROWS_TIMES_TREES_AT_ONCE))
            free -= read[task]
            running += load[task]
        try:
            model = rf.fit(rows.filter(F.col(fold_col) != fold), grid[j])
            return fold, j, evaluator.evaluate(model.transform(rows.filter(F.col(fold_col) == fold)))
        finally:
            with turn:
                free += read[task]
                running -= load[task]
                turn.notify_all()

    metrics = [[0.0] * len(grid) for _ in sizes]
    with _collected(spark, COLLECT_EVERY_S) if large else nullcontext():
        with ThreadPool(min(workers, len(tasks))) as pool:
            for fold, j, metric in pool.imap_unordered(inheritable_thread_target(spark)(score), tasks):
                metrics[fold][j] = metric
        average = [sum(m) / len(sizes) for m in zip(*metrics, strict=True)]
        best = min(range(len(grid)), key=average.__getitem__)
        return CrossValidatorModel(rf.fit(data, grid[best]), average)


def successive_halving(train: DataFrame, tuning: TuningProfile = TuningProfile(), features: Sequence[str] = TREE_FEATURES, keep: int = 3, rungs: int = 3):
    """Tuning on growing shares of the rows: all combinations on the least one, the best on the next, the last ones on all.

    Each rung has ``keep`` times the rows of the one before and a ``keep``-th
    of its combinations, so it costs about as much, where the full grid fits
    every combination on all rows. Rows belong to a rung by a hash of their
    key (digits that neither the split nor the folds use), and each rung's
    rows are among the next one's; the folds stay as they are. ``train`` has
    the columns key and fold. Returns the last rung's CV model and the rows
    (rung, fraction, n_rows, numTrees, maxDepth, avg_rmse, kept).
    """
    left = [(t, d) for t in tuning.num_trees for d in tuning.max_depth]
    out, cv_model = [], None
    for rung in range(1, rungs + 1):
        fraction = float(keep) ** (rung - rungs)
        part = train.filter(key_hash32("key", offset=17) < F.lit(int(fraction * 2**32))).select(*features, TARGET, "fold")
        part = part.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            # one fit at a time: the node statistics of several deep forests at once need several times the memory
            cv_model, table = cross_validate(part, replace(tuning, parallelism=1), features, combinations=left)
            n_rows = part.count()
        finally:
            part.unpersist()
        found = {(r["numTrees"], r["maxDepth"]): r["avg_rmse"] for r in table.collect()}
        left = sorted(left, key=lambda c: (found[c], c))[: max(1, -(-len(left) // keep)) if rung < rungs else 1]
        out += [(rung, fraction, n_rows, *c, e, c in left) for c, e in found.items()]
    return cv_model, out


def final_stage(model):
    return model.stages[-1] if isinstance(model, PipelineModel) else model


def feature_importance(spark: SparkSession, model, features: Sequence[str] = TREE_FEATURES) -> DataFrame:
    """(feature, importance, rank) of a tree model, highest first. The
    importances are a model attribute with one value per feature, so the
    ranking is done on that short list."""
    imp = final_stage(model).featureImportances.toArray()
    ranked = sorted(zip(features, (float(v) for v in imp)), key=lambda fv: (-fv[1], fv[0]))
    rows = [(f, v, i + 1) for i, (f, v) in enumerate(ranked)]
    return spark.createDataFrame(rows, "feature string, importance double, rank int")


def linear_coefficients(spark: SparkSession, model, features: Sequence[str] = TREE_FEATURES) -> DataFrame:
    """(term, value) of a linear model: the intercept and each feature's coefficient, in raw units."""
    m = final_stage(model)
    rows = [("intercept", float(m.intercept)), *((f, float(v)) for f, v in zip(features, m.coefficients.toArray()))]
    return spark.createDataFrame(rows, "term string, value double")


def model_params(spark: SparkSession, model, name: str) -> DataFrame:
    """One row of the fitted model's main parameters."""
    m = final_stage(model)
    row = {"Model": name, "intercept": None, "num_trees": None, "max_depth": None, "num_features": int(m.numFeatures)}
    if hasattr(m, "intercept"):
        row["intercept"] = float(m.intercept)
    if hasattr(m, "getNumTrees"):
        row["num_trees"] = int(m.getNumTrees)
    elif hasattr(m, "trees"):
        row["num_trees"] = len(m.trees)
    if m.hasParam("maxDepth"):
        row["max_depth"] = int(m.getOrDefault("maxDepth"))
    return spark.createDataFrame(
        [tuple(row.values())], "Model string, intercept double, num_trees int, max_depth int, num_features int"
    )


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def fit_with_fallback(train: DataFrame, tuning: TuningProfile, features=TREE_FEATURES, profile: ModelProfile = ModelProfile()):
    """Tune; if tuning raises, fit the default forest and say so (status
    column) instead of hiding the failure."""
    try:
        cv_model, _ = cross_validate(train, tuning, features)
        best = cv_model.bestModel
        model = PipelineModel(stages=[assembler(features), best])
        return model, "tuned", None
    except Exception as exc:  # noqa: BLE001 - reported to the caller
        return fit("rf", train, features, profile), "fallback", f"{type(exc).__name__}: {exc}"
