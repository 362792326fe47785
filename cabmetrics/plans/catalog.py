"""Named queries over a scale-factor directory: ``name -> f(spark, sf_dir) -> DataFrame``.

Each entry composes the library operators over the whole derived trip
table; nothing is sampled or capped except where the limit is the
operator itself (``head_n``, ``actual_vs_predicted``, ``sample_to_size``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.geo import haversine_sql, near_airport
from ..functions.scalar import numeric_to_label, passenger_valid_flag, pct_of_total
from ..functions.timeparts import day_name, parse_pickup_time, weekday_monday0
from ..operators import clean as C
from ..operators import evaluate as E
from ..operators import features as FE
from ..operators import grouped_quantiles as GQ
from ..operators import models as M
from ..operators import profile as P
from ..operators import sketches as SKE
from ..operators import split as S
from ..operators import zones as Z
from ..schema import (
    AIRPORTS,
    REPORT_PROFILE,
    NUMERIC_COLUMNS,
    PREP_FEATURES,
    TARGET,
    TREE_FEATURES,
    TuningProfile,
)
from ..session import scratch_path
from ..sources import publish as PB
from ..sources import quarantine as Q
from ..sources import sinks as SK
from ..sources import trips as TR
from . import checks as CH
from . import common as K
from . import fare_model as FM

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn

    return deco


# The reference's grid and folds: 3 x 3 combinations, 3 folds.
TUNING = TuningProfile()

# =============================================================================
# 2.1 Scans / sources
# =============================================================================


@query("scan_trips_schema")
def scan_trips_schema(spark, sf):
    return TR.read_trips_csv(spark, K.raw_csv(spark, sf))


@query("scan_trips_inferred")
def scan_trips_inferred(spark, sf):
    return TR.read_trips_csv(spark, K.raw_csv(spark, sf), infer=True)


@query("scan_parquet")
def scan_parquet(spark, sf):
    path = SK.write_trips(K.raw_trips(spark, sf), scratch_path(spark, "trips-parquet"))
    # the cleaning predicates reach the parquet reader (PushedFilters)
    return C.clean_trips(TR.read_trips_parquet(spark, path))


@query("source_fallback")
def source_fallback(spark, sf):
    missing = scratch_path(spark, "processed-absent")
    return TR.source_fallback(spark, missing, K.raw_csv(spark, sf))


_INGESTED: dict = {}


def _ingested(spark, sf):
    """The raw trips as lines, some of them spoilt, through the checked scan; once a session."""
    key = K.data_key(spark, sf, "ingested")
    if key not in _INGESTED:
        lines = scratch_path(spark, "spoilt-lines")
        K.spoilt_lines(spark, sf).write.text(lines)
        _INGESTED[key] = Q.ingest(spark, lines, scratch_path(spark, "ingested"), header=False)
    return _INGESTED[key]


@query("source_preferred")
def source_preferred(spark, sf):
    """The other branch of ``source_fallback``: the processed trips are there and are taken, not the raw ones."""
    return TR.source_fallback(spark, K.clean_table(spark, sf), K.raw_csv(spark, sf))


@query("source_without_columns")
def source_without_columns(spark, sf):
    """A preferred source that lacks columns is refused, by name, before anything reads it."""
    thin = scratch_path(spark, "processed-thin")
    K.clean(spark, sf).drop("pickup_datetime", "dropoff_latitude").write.parquet(thin)
    try:
        return TR.source_fallback(spark, thin, K.raw_csv(spark, sf)).limit(0).select(F.lit("").alias("missing"), F.lit(0).cast("long").alias("n_rows"))
    except TR.MissingColumnsError as e:
        missing = [c for c in TR.TRIP_COLUMNS if f"'{c}'" in str(e).split(";")[0]]
        return spark.read.parquet(thin).agg(F.lit(",".join(missing)).alias("missing"), F.count(F.lit(1)).alias("n_rows"))


@query("quarantine_report")
def quarantine_report(spark, sf):
    """Good rows, and bad ones by reason."""
    return _ingested(spark, sf).report()


@query("quarantine_good")
def quarantine_good(spark, sf):
    return _ingested(spark, sf).trips()


@query("quarantine_bad")
def quarantine_bad(spark, sf):
    """The key (first value) and reason of every bad line."""
    return _ingested(spark, sf).bad_rows().select(F.substring_index("line", ",", 1).alias("key"), "reason")


@query("temp_view")
def temp_view(spark, sf):
    TR.temp_view(K.raw_trips(spark, sf), "trips_view")
    return spark.sql("SELECT * FROM trips_view")


# =============================================================================
# 2.2 Sinks
# =============================================================================


@query("write_trips")
def write_trips(spark, sf):
    path = SK.write_trips(K.raw_trips(spark, sf), scratch_path(spark, "trips-out"))
    return spark.read.parquet(path)


@query("verify_roundtrip")
def verify_roundtrip(spark, sf):
    trips = K.raw_trips(spark, sf)
    path = SK.write_trips(trips, scratch_path(spark, "trips-rt"))
    return SK.roundtrip_report(trips, spark.read.parquet(path))


@query("verify_roundtrip_csv")
def verify_roundtrip_csv(spark, sf):
    """Header CSV written and read with the fixed schema. Text has no NaN
    besides null: both sides are compared with NaN as null."""
    trips = TR.conform_trips(K.raw_text_trips(spark, sf))
    return SK.roundtrip_report(trips, TR.read_trips_csv(spark, K.raw_csv(spark, sf)))


@query("write_split")
def write_split(spark, sf):
    train, test = K.split(spark, sf)
    paths = SK.write_split(M.to_label_frame(train), M.to_label_frame(test), scratch_path(spark, "split"))
    parts = [spark.read.parquet(p).withColumn("split", F.lit(name)) for name, p in paths.items()]
    return parts[0].unionByName(parts[1]).groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))


@query("republish_trips")
def republish_trips(spark, sf):
    """A table published twice: a reader of the first version sees it whole while and after the second is written."""
    place = PB.Published(spark, scratch_path(spark, "published-trips"))
    place.write_table(K.raw_trips(spark, sf))
    reader = place.read_table()
    place.write_table(K.clean(spark, sf))
    parts = [("first", place.read_table(1)), ("reader of the first", reader), ("latest", place.read_table())]
    counted = [df.agg(F.lit(name).alias("read"), F.count(F.lit(1)).alias("n_rows"), F.count_distinct("key").alias("n_keys")) for name, df in parts]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


@query("rerun_partitions")
def rerun_partitions(spark, sf):
    """A table by year, of which one year is written again with fewer rows: the others stay, nothing stale is left."""
    path = scratch_path(spark, "trips-by-year")
    year = F.year("pickup_datetime").alias("year")
    PB.replace_partitions(K.raw_trips(spark, sf).select("*", year), path, ["year"])
    PB.replace_partitions(K.clean(spark, sf).select("*", year).filter("year = 2025"), path, ["year"])
    return spark.read.parquet(path).groupBy("year").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("key").alias("n_keys"))


@query("check_republished_model")
def check_republished_model(spark, sf):
    """A model published over another one: what loads is the latest, and answers like it on every test row."""
    place = PB.Published(spark, scratch_path(spark, "published-model"))
    for kind in ("lr", "gbt"):
        place.publish(lambda path, kind=kind: M.save_model(FM.fitted(spark, sf, kind), path))
    _, test = K.split(spark, sf)
    both = M.predict_many({"fitted": FM.fitted(spark, sf, "gbt"), "loaded": M.load_model(place.path())}, test)
    return both.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(~F.col("fitted").eqNullSafe(F.col("loaded"))).alias("n_differences"), F.lit(len(place.versions())).alias("n_versions"))


def _rule_metrics(spark, sf):
    train, test = K.split(spark, sf)
    return E.rule_metrics(train, test)


@query("write_metrics")
def write_metrics(spark, sf):
    path = SK.write_table(_rule_metrics(spark, sf), scratch_path(spark, "metrics"))
    return spark.read.parquet(path)


@query("write_model_metrics")
def write_model_metrics(spark, sf):
    """Metrics of the three trained models through the sink."""
    path = SK.write_table(FM.evaluate_all(spark, sf), scratch_path(spark, "model-metrics"))
    return spark.read.parquet(path)


@query("metrics_csv")
def metrics_csv(spark, sf):
    path = SK.write_table(_rule_metrics(spark, sf), scratch_path(spark, "metrics-csv"), fmt="csv")
    return spark.read.option("header", True).schema("Model string, RMSE double, MAE double, R2 double").csv(path)


# =============================================================================
# 2.3 Projections, casts
# =============================================================================


@query("parse_pickup_time")
def q_parse_pickup_time(spark, sf):
    return K.raw_text_trips(spark, sf).select("key", parse_pickup_time("pickup_datetime").alias("pickup_datetime"))


@query("cast_features")
def cast_features(spark, sf):
    df = FE.cast_features(K.features(spark, sf, airport=True))
    return K.rounded(df.select("key", *PREP_FEATURES, TARGET))


@query("feature_projection")
def feature_projection(spark, sf):
    return K.rounded(K.features(spark, sf))


@query("select_columns")
def select_columns(spark, sf):
    return K.rounded(K.features(spark, sf).select("key", "distance_km", "fare_amount"))


@query("table_shape")
def table_shape(spark, sf):
    return P.table_shape(K.raw_trips(spark, sf))


# =============================================================================
# 2.4 Filters
# =============================================================================


@query("drop_nulls")
def drop_nulls(spark, sf):
    return C.drop_nulls(K.raw_trips(spark, sf))


@query("fare_range")
def fare_range(spark, sf):
    return C.fare_range(K.raw_trips(spark, sf))


@query("passenger_range")
def passenger_range(spark, sf):
    return C.passenger_range(K.raw_trips(spark, sf))


@query("bbox_filter")
def bbox_filter(spark, sf):
    return C.bbox_filter(K.raw_trips(spark, sf))


@query("clean_trips")
def clean_trips(spark, sf):
    return K.clean(spark, sf)


@query("clean_trips_report_rule")
def clean_trips_report_rule(spark, sf):
    """The looser rule stated in the project report."""
    return K.clean(spark, sf, REPORT_PROFILE)


@query("outside_bbox")
def outside_bbox(spark, sf):
    return C.outside_bbox(K.raw_trips(spark, sf))


@query("pickup_in_bbox")
def pickup_in_bbox(spark, sf):
    return C.bbox_filter(K.raw_trips(spark, sf), ends=("pickup",))


@query("fare_display_range")
def fare_display_range(spark, sf):
    f = F.col("fare_amount")
    return K.raw_trips(spark, sf).filter((f > 0) & (f <= 100))


@query("distance_cap")
def distance_cap(spark, sf):
    return K.rounded(K.features(spark, sf).filter(F.col("distance_km") <= 50))


@query("iqr_outliers")
def iqr_outliers(spark, sf):
    return P.iqr_outlier_summary(K.raw_trips(spark, sf), "fare_amount")


@query("airport_trips")
def airport_trips(spark, sf):
    return P.flag_share(K.features(spark, sf, airport=True), "is_airport_trip")


@query("invalid_vector_skip")
def invalid_vector_skip(spark, sf):
    df = M.assemble_features(K.raw_features(spark, sf), handle_invalid="skip")
    return M.vector_columns(df, "features", TREE_FEATURES)


@query("invalid_vector_error")
def invalid_vector_error(spark, sf):
    """The assembler's error mode: fails on rows with a missing value, passes on cleaned rows."""
    def assembled(df) -> int:
        return M.assemble_features(df, handle_invalid="error").select(F.col("features")).filter("features is not null").count()

    missing = C.drop_nulls(K.raw_trips(spark, sf), ["key", "pickup_datetime", "passenger_count", "fare_amount"])
    failed = False
    try:
        assembled(FE.feature_projection(missing))
    except Exception as exc:  # noqa: BLE001 - the JVM's error; any other is raised
        if "handleInvalid" not in str(exc):
            raise
        failed = True
    n = assembled(K.features(spark, sf))
    return spark.range(1).select(F.lit(failed).alias("failed_on_missing"), F.lit(n).cast("long").alias("n_assembled"))


# =============================================================================
# 2.5 Scalar functions
# =============================================================================


@query("haversine")
def haversine(spark, sf):
    return K.rounded(FE.add_distance(K.raw_trips(spark, sf)).select("key", "distance_km"))


@query("haversine_sql")
def q_haversine_sql(spark, sf):
    TR.temp_view(K.raw_trips(spark, sf), "trips_haversine")
    d = haversine_sql("pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude")
    return K.rounded(spark.sql(f"SELECT key, {d} AS distance_km FROM trips_haversine"))


@query("time_parts")
def time_parts(spark, sf):
    return FE.add_time_parts(K.raw_trips(spark, sf)).select("key", "hour", "day_of_week", "month", "year")


@query("time_parts_monday0")
def time_parts_monday0(spark, sf):
    return K.raw_trips(spark, sf).select("key", weekday_monday0("pickup_datetime").alias("weekday"))


@query("day_name")
def q_day_name(spark, sf):
    df = K.raw_trips(spark, sf).select("key", F.dayofweek("pickup_datetime").alias("day_of_week"))
    return df.withColumn("day_name", day_name("day_of_week"))


@query("near_airport")
def q_near_airport(spark, sf):
    cols = [
        near_airport(f"{end}_latitude", f"{end}_longitude", lat, lon).alias(f"{end}_near_{code.lower()}")
        for code, lat, lon in AIRPORTS
        for end in ("pickup", "dropoff")
    ]
    return K.raw_trips(spark, sf).select("key", *cols)


@query("is_airport_trip")
def is_airport_trip(spark, sf):
    return K.features(spark, sf, airport=True).select("key", "is_airport_trip")


@query("passenger_valid_flag")
def q_passenger_valid_flag(spark, sf):
    return K.raw_trips(spark, sf).select("key", "passenger_count", passenger_valid_flag().alias("validity"))


@query("pct_of_total")
def q_pct_of_total(spark, sf):
    counts = K.raw_trips(spark, sf).groupBy("passenger_count").agg(F.count(F.lit(1)).alias("n"))
    # the total is the sum of the few grouped counts, not another scan
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))
    return counts.withColumn("pct", pct_of_total(F.col("n"), total))


@query("numeric_to_label")
def q_numeric_to_label(spark, sf):
    return K.raw_trips(spark, sf).select("key", numeric_to_label("passenger_count").alias("passenger_label"))


# =============================================================================
# 2.6 Aggregations
# =============================================================================


@query("row_count")
def row_count(spark, sf):
    return P.row_count(K.raw_trips(spark, sf))


@query("null_profile")
def null_profile(spark, sf):
    return P.null_profile(K.raw_trips(spark, sf))


@query("describe_numeric")
def describe_numeric(spark, sf):
    return P.describe_numeric(K.raw_trips(spark, sf), NUMERIC_COLUMNS)


@query("fare_min_max_mean_median")
def fare_min_max_mean_median(spark, sf):
    return P.min_max_mean_median(K.raw_trips(spark, sf), "fare_amount")


@query("fare_quantiles_refined")
def fare_quantiles_refined(spark, sf):
    """Quantiles with a sketch so coarse that the search needs several rounds."""
    q = P.quantiles(K.raw_trips(spark, sf), ["fare_amount"], [0.01, 0.5, 0.99], limit=4, accuracy=20)["fare_amount"]
    return K.rounded(spark.range(1).select(*[F.lit(v).cast("double").alias(n) for v, n in zip(q, ("p01", "p50", "p99"))]))


@query("fare_quartiles")
def fare_quartiles(spark, sf):
    return P.quartiles_report(K.raw_trips(spark, sf), "fare_amount")


@query("passenger_dist")
def passenger_dist(spark, sf):
    return P.passenger_distribution(K.raw_trips(spark, sf))


@query("fare_histogram")
def fare_histogram(spark, sf):
    return P.equal_width_histogram(K.raw_trips(spark, sf), "fare_amount", 100)


@query("fare_histogram_display")
def fare_histogram_display(spark, sf):
    f = F.col("fare_amount")
    return P.equal_width_histogram(K.raw_trips(spark, sf).filter((f > 0) & (f <= 100)), "fare_amount", 100)


@query("distance_histogram")
def distance_histogram(spark, sf):
    return P.equal_width_histogram(K.features(spark, sf).filter(F.col("distance_km") <= 50), "distance_km", 80)


@query("fare_by_hour")
def fare_by_hour(spark, sf):
    return P.fare_by_hour(K.features(spark, sf))


@query("fare_by_day")
def fare_by_day(spark, sf):
    return P.fare_by_day(K.features(spark, sf))


@query("fare_by_hour_raw")
def fare_by_hour_raw(spark, sf):
    """The exploration notebook's variant: uncleaned trips, null fares skipped."""
    return P.fare_by_hour(K.raw_features(spark, sf))


@query("fare_by_day_raw")
def fare_by_day_raw(spark, sf):
    return P.fare_by_day(K.raw_features(spark, sf))


@query("fare_by_year")
def fare_by_year(spark, sf):
    return P.fare_by_year(K.yearly_trips(spark, sf))


@query("corr_with_target")
def corr_with_target(spark, sf):
    return P.corr_with_target(K.raw_trips(spark, sf), "fare_amount", [c for c in NUMERIC_COLUMNS if c != "fare_amount"])


@query("corr_matrix")
def corr_matrix(spark, sf):
    return P.corr_matrix(K.raw_trips(spark, sf), NUMERIC_COLUMNS)


@query("corr_distance_fare")
def corr_distance_fare(spark, sf):
    return P.corr_pair(K.features(spark, sf), "distance_km", "fare_amount")


@query("distance_mean_median")
def distance_mean_median(spark, sf):
    return P.mean_median(K.features(spark, sf).filter(F.col("distance_km") <= 50), "distance_km")


@query("cleaning_stage_counts")
def cleaning_stage_counts(spark, sf):
    return C.cleaning_stage_counts(K.raw_trips(spark, sf))


@query("rmse_mae_r2")
def rmse_mae_r2(spark, sf):
    train, test = K.split(spark, sf)
    preds = E.rule_predictions(train, test)
    return E.regression_metrics(preds, "label", "Distance rate")


# =============================================================================
# 2.7 Sorts, limits, top-k
# =============================================================================


@query("best_model")
def best_model(spark, sf):
    return E.best_model(_rule_metrics(spark, sf))


@query("rank_models")
def rank_models(spark, sf):
    return E.rank_models(_rule_metrics(spark, sf))


@query("sort_by_value")
def sort_by_value(spark, sf):
    return P.value_counts(K.raw_trips(spark, sf), "passenger_count")


@query("head_n")
def head_n(spark, sf):
    return K.raw_trips(spark, sf).orderBy("key").limit(10_000)


@query("head_n_1000")
def head_n_1000(spark, sf):
    return K.raw_trips(spark, sf).orderBy("key").limit(1000)


@query("rank_trained_models")
def rank_trained_models(spark, sf):
    return E.rank_models(FM.evaluate_all(spark, sf))


@query("best_trained_model")
def best_trained_model(spark, sf):
    return E.best_model(FM.evaluate_all(spark, sf))


# =============================================================================
# 2.8 Sampling and splitting
# =============================================================================


@query("sample_to_size")
def sample_to_size(spark, sf):
    return S.sample_to_size(K.raw_trips(spark, sf).select("key", "fare_amount"), 10_000)


@query("sample_to_size_3000")
def sample_to_size_3000(spark, sf):
    return S.sample_to_size(K.raw_trips(spark, sf).select("key", "fare_amount"), 3_000)


@query("train_test_split_raw")
def train_test_split_raw(spark, sf):
    """All trips, null keys among them: (key, fare, split, fold)."""
    return S.fold_column(S.split_label(K.raw_trips(spark, sf).select("key", "passenger_count")), 3)


@query("train_test_split")
def train_test_split(spark, sf):
    return S.split_label(K.features(spark, sf).select("key"))


@query("kfold")
def kfold(spark, sf):
    train, _ = K.split(spark, sf)
    return S.fold_column(train.select("key"), 3)


# =============================================================================
# 2.9 Lookup join
# =============================================================================


@query("compare_before_after")
def compare_before_after(spark, sf):
    """Distance-rate baseline fitted on uncleaned trips (nulls dropped) vs on
    cleaned trips, both scored on the cleaned test split."""
    _, test = K.split(spark, sf)
    raw_train, _ = S.train_test_split(C.drop_nulls(K.raw_features(spark, sf)))
    clean_train, _ = K.split(spark, sf)
    return E.rule_comparison(raw_train, clean_train, test, "Distance rate")


@query("compare_tuning")
def compare_tuning(spark, sf):
    """Baseline forest against tuned forest on one test split, scored in one pass."""
    return E.compare_columns(FM.tuning_predictions(spark, sf, TUNING), "baseline", "tuned")


# =============================================================================
# 2.10 Feature and model operators
# =============================================================================


@query("assemble_features")
def assemble_features(spark, sf):
    """The assembled vector, shown as one named column per element."""
    return M.vector_columns(M.assemble_features(K.features(spark, sf)), "features", TREE_FEATURES)


@query("to_label_frame")
def to_label_frame(spark, sf):
    df = M.to_label_frame(K.features(spark, sf))
    return M.vector_columns(df, "features", TREE_FEATURES, keep=("key", "label"))


@query("standard_scale")
def standard_scale(spark, sf):
    train, _ = K.split(spark, sf)
    model = M.feature_pipeline(TREE_FEATURES).fit(train)
    return M.vector_columns(model.transform(K.features(spark, sf)), "features", TREE_FEATURES)


@query("assemble_scale")
def assemble_scale(spark, sf):
    feats = K.features(spark, sf, airport=True, as_double=True)
    model = M.feature_pipeline(PREP_FEATURES).fit(S.train_test_split(feats)[0])
    return M.vector_columns(model.transform(feats), "features", PREP_FEATURES, keep=("key", TARGET))


@query("fit_linear")
def fit_linear(spark, sf):
    return FM.model_metrics(spark, sf, "lr")


@query("fit_forest")
def fit_forest(spark, sf):
    return FM.model_metrics(spark, sf, "rf")


@query("fit_gbt")
def fit_gbt(spark, sf):
    return FM.model_metrics(spark, sf, "gbt")


@query("cross_validate")
def cross_validate(spark, sf):
    return FM.searched(spark, sf, TUNING)[1]


@query("fit_with_fallback")
def fit_with_fallback(spark, sf):
    model, _, status, err = FM.tuned(spark, sf, TUNING)
    _, test = K.split(spark, sf)
    m = E.metrics_row(M.predict(model, test), "Random Forest")
    return m.withColumn("status", F.lit(status)).withColumn("error", F.lit(err).cast("string"))


@query("predict")
def predict(spark, sf):
    return FM.test_predictions(spark, sf, "rf").select("key", "label", "prediction")


@query("evaluate_model")
def evaluate_model(spark, sf):
    return FM.evaluate_all(spark, sf)


@query("model_params")
def model_params(spark, sf):
    """Main parameters of the three baseline models and of the tuned forest
    (its numTrees / maxDepth are the grid's best parameters)."""
    out = None
    for kind, name in M.MODEL_NAMES.items():
        p = M.model_params(spark, FM.fitted(spark, sf, kind), name)
        out = p if out is None else out.unionByName(p)
    best = FM.searched(spark, sf, TUNING)[0]
    return out.unionByName(M.model_params(spark, best, "Random Forest (tuned)"))


@query("linear_coefficients")
def linear_coefficients(spark, sf):
    """Intercept and coefficients of the linear model in raw feature units."""
    return M.linear_coefficients(spark, FM.fitted(spark, sf, "lr"))


@query("feature_importance")
def feature_importance(spark, sf):
    return M.feature_importance(spark, FM.fitted(spark, sf, "rf")).select("feature", "importance")


@query("rank_importance")
def rank_importance(spark, sf):
    best = FM.searched(spark, sf, TUNING)[0]
    return M.feature_importance(spark, best)


@query("rename_columns")
def rename_columns(spark, sf):
    preds = FM.test_predictions(spark, sf, "rf")
    return preds.select("label", "prediction").withColumnsRenamed(
        {"label": "Actual_Fare_($)", "prediction": "Predicted_Fare_($)"}
    )


@query("actual_vs_predicted")
def actual_vs_predicted(spark, sf):
    preds = FM.test_predictions(spark, sf, "rf")
    return (
        preds.orderBy("key")
        .limit(15)
        .select(F.col("label").alias("Actual_Fare_($)"), F.col("prediction").alias("Predicted_Fare_($)"))
    )


@query("save_model")
def save_model(spark, sf):
    path = FM.save_fitted(spark, sf, "rf")
    return spark.read.json(f"{path}/metadata").select("class", "sparkVersion")


@query("load_model")
def load_model(spark, sf):
    path = FM.save_fitted(spark, sf, "gbt")
    _, test = K.split(spark, sf)
    return M.predict(M.load_model(path), test)


# =============================================================================
# 2.11 Plot tables, 2.12 documented reports
# =============================================================================


@query("pickup_density")
def pickup_density(spark, sf):
    return P.pickup_density(K.raw_trips(spark, sf))


@query("pickup_quadtree")
def pickup_quadtree(spark, sf):
    """Pickups in cells that split until they hold at most 50 trips (the last level's may hold more)."""
    return K.rounded(Z.quadtree(K.raw_trips(spark, sf), most=50), 9)


# Fixed values of our own: cells with this share of all pickups are zones, six-sided, of this radius (degrees).
ZONE_SHARE, ZONE_CELL, ZONE_RADIUS = 0.0025, 0.01, 0.01317


@query("trips_by_zone")
def trips_by_zone(spark, sf):
    """Cleaned trips by pickup zone; the zones lie around the cells with most pickups and overlap."""
    trips = K.clean(spark, sf).withColumn("cell", Z.cell_key(F.col("pickup_longitude"), F.col("pickup_latitude"), ZONE_CELL))
    x, y = Z.cell_parts(F.col("cell"))
    heavy = Z.heavy_hitters(trips, "cell", ZONE_SHARE).select(x.alias("cell_x"), y.alias("cell_y"))
    return Z.fares_by_zone(trips, Z.zones_around(heavy, ZONE_CELL, ZONE_RADIUS))


@query("error_by_zone")
def error_by_zone(spark, sf):
    """Errors of the distance baseline in each high-traffic pickup cell."""
    train, test = K.split(spark, sf)
    line = E.rule_columns(E.rule_fit(train))[2]
    return Z.error_by_zone(test.select("pickup_longitude", "pickup_latitude", F.col("fare_amount").alias("label"), line.alias("prediction")), ZONE_SHARE, ZONE_CELL)


_SKETCHES: dict = {}
SKETCH_PROBS = (0.05, 0.25, 0.5, 0.75, 0.95)


def _stored_sketches(spark, sf):
    """The daily fare sketches of the cleaned trips, written once a session in two appends (before and from 2025 on)."""
    key = K.data_key(spark, sf, "sketches")
    if key not in _SKETCHES:
        path = scratch_path(spark, "fare-sketches")
        daily = SKE.daily_sketches(K.clean(spark, sf))
        for part in (daily.filter("year(day) < 2025"), daily.filter("year(day) >= 2025")):
            SKE.save_sketches(part, path)
        _SKETCHES[key] = path
    return SKE.read_sketches(spark, _SKETCHES[key])


@query("sketch_quantiles")
def sketch_quantiles(spark, sf):
    """Fare quantiles of each month, merged from the stored daily sketches."""
    return SKE.merged_quantiles(_stored_sketches(spark, sf), SKETCH_PROBS, ["month"])


@query("check_sketch_quantiles")
def check_sketch_quantiles(spark, sf):
    """Months and centuries: rows behind each answer, and whether its rank is within the sketch's bound."""
    stored, trips = _stored_sketches(spark, sf), K.clean(spark, sf)
    parts = []
    month = F.date_format("pickup_datetime", "yyyy-MM")
    for by, of in ((F.col("month"), month), (F.substring("month", 1, 2), F.substring(month, 1, 2))):
        found = SKE.merged_quantiles(stored, SKETCH_PROBS, [by.alias("part")])
        truth = SKE.rank_deviation(found, trips, of).select("part", "p", F.col("n").alias("n_true"), "deviation")
        parts.append(found.join(truth, ["part", "p"]).select("part", "p", (F.col("n") == F.col("n_true")).alias("all_rows"), F.col("n_true").alias("n"), (F.col("deviation") <= SKE.rank_error()).alias("within_bound")))
    return parts[0].unionByName(parts[1])


@query("temporal_profile")
def temporal_profile(spark, sf):
    return P.temporal_profile(K.features(spark, sf))


@query("yearly_trend")
def yearly_trend(spark, sf):
    return P.fare_by_year(K.yearly_trips(spark, sf))


@query("distance_fare_sample")
def distance_fare_sample(spark, sf):
    """The scatter plot's points: first 5,000 trips by key with distance <= 50
    (a top-k; the 2-D bins below cover all rows)."""
    df = K.features(spark, sf).filter(F.col("distance_km") <= 50).select("key", "distance_km", "fare_amount")
    return K.rounded(df.orderBy("key").limit(5000))


@query("distance_fare_scatter")
def distance_fare_scatter(spark, sf):
    return P.scatter_bins(K.features(spark, sf), "distance_km", "fare_amount", 1.0, 5.0, x_max=50.0)


def _rule_test_preds(spark, sf):
    train, test = K.split(spark, sf)
    return E.rule_predictions(train, test).withColumnRenamed("Distance rate", "prediction")


@query("residual_report")
def residual_report(spark, sf):
    return E.residual_report(_rule_test_preds(spark, sf))


@query("residual_histogram")
def residual_histogram(spark, sf):
    return P.equal_width_histogram(E.residuals(_rule_test_preds(spark, sf)), "residual", 50)


@query("tuned_residual_report")
def tuned_residual_report(spark, sf):
    return E.residual_report(FM.tuning_predictions(spark, sf, TUNING), prediction="tuned")


@query("tuned_residual_histogram")
def tuned_residual_histogram(spark, sf):
    return P.equal_width_histogram(E.residuals(FM.tuning_predictions(spark, sf, TUNING), prediction="tuned"), "residual", 50)


@query("tuned_error_by_segment")
def tuned_error_by_segment(spark, sf):
    return E.error_by_segment(FM.tuning_predictions(spark, sf, TUNING), prediction="tuned")


@query("error_by_segment")
def error_by_segment(spark, sf):
    return E.error_by_segment(_rule_test_preds(spark, sf))


@query("fare_quantiles_by_hour")
def fare_quantiles_by_hour(spark, sf):
    """Exact quartiles and tail quantiles of the cleaned fares of every hour."""
    return GQ.grouped_quantiles(K.features(spark, sf), ["hour"], "fare_amount", (0.05, 0.25, 0.5, 0.75, 0.95))


@query("error_quantiles_by_band")
def error_quantiles_by_band(spark, sf):
    """Exact quantiles of the absolute error within each distance band (rule baseline)."""
    preds = _rule_test_preds(spark, sf).withColumn("band", E.distance_band()).withColumn("size", F.abs(F.col("label") - F.col("prediction")))
    return GQ.grouped_quantiles(preds, ["band"], "size", (0.5, 0.9, 0.99))


# Share of new trips whose fare an interval is to hold, and the folds of the
# training side: the baseline is fitted on the first ones, the last one gives the widths.
COVERAGE, FOLDS = 0.9, 4


def _interval_parts(spark, sf):
    train, test = K.split(spark, sf)
    folds = S.fold_column(train, FOLDS)
    fit = E.rule_fit(folds.filter(F.col("fold") < FOLDS - 1))
    line = [c.alias("prediction") for c in E.rule_columns(fit)[2:]]
    parts = [df.select("key", F.col("fare_amount").alias("label"), E.distance_band().alias("band"), *line) for df in (folds.filter(F.col("fold") == FOLDS - 1), test)]
    return GQ.conformal_widths(parts[0], ["band"], coverage=COVERAGE), parts[1]


@query("prediction_intervals")
def prediction_intervals(spark, sf):
    """Split-conformal 90 % intervals per distance band, and their coverage of the held-out trips."""
    widths, test = _interval_parts(spark, sf)
    return GQ.interval_report(test, widths, ["band"])


@query("fare_intervals")
def fare_intervals(spark, sf):
    """Every held-out trip's predicted fare with its interval."""
    widths, test = _interval_parts(spark, sf)
    return K.rounded(GQ.with_intervals(test, widths, ["band"]).select("key", "band", "prediction", "low", "high"))


@query("importance_csv")
def importance_csv(spark, sf):
    imp = M.feature_importance(spark, FM.fitted(spark, sf, "rf"))
    path = SK.write_table(imp, scratch_path(spark, "importance-csv"), fmt="csv")
    return spark.read.option("header", True).schema("feature string, importance double, rank int").csv(path)


@query("batch_score")
def batch_score(spark, sf):
    path = FM.save_fitted(spark, sf, "rf")
    return FM.batch_score(spark, path, K.features(spark, sf))


# =============================================================================
# Checked facts about the fitted models (each has a twin)
# =============================================================================


@query("check_predict")
def check_predict(spark, sf):
    return CH.coverage(FM.test_predictions(spark, sf, "rf"))


@query("check_batch_score")
def check_batch_score(spark, sf):
    return CH.coverage(batch_score(spark, sf))


@query("check_load_model")
def check_load_model(spark, sf):
    return CH.reload_differences(spark, sf, "gbt")


@query("check_save_model")
def check_save_model(spark, sf):
    return CH.reload_differences(spark, sf, "rf").withColumn("class", F.lit(save_model(spark, sf).first()["class"]))


@query("check_fit_linear")
def check_fit_linear(spark, sf):
    return CH.linear_terms(spark, sf)


@query("check_models_beat_mean")
def check_models_beat_mean(spark, sf):
    return CH.beats_mean(spark, sf)


@query("check_feature_importance")
def check_feature_importance(spark, sf):
    return CH.importances(spark, FM.fitted(spark, sf, "rf"))


@query("check_rank_importance")
def check_rank_importance(spark, sf):
    return CH.importances(spark, FM.searched(spark, sf, TUNING)[0])


@query("check_importance_csv")
def check_importance_csv(spark, sf):
    return importance_csv(spark, sf).agg(F.count_distinct("feature").alias("n_features"), F.round(F.sum("importance"), 6).alias("total"), F.max("rank").alias("last_rank"))


@query("check_grid")
def check_grid(spark, sf):
    return CH.grid(spark, sf, TUNING)


@query("check_fit_with_fallback")
def check_fit_with_fallback(spark, sf):
    """A search that must fail (a forest without trees): the default forest stands in on every test row, and the error is told."""
    model, _, status, error = FM.tuned(spark, sf, TuningProfile(num_trees=(0,), max_depth=(5,)))
    _, test = K.split(spark, sf)
    both = M.predict_many({"used": model, "default": FM.fitted(spark, sf, "rf")}, test)
    told = "numTrees" in (error or "")
    return both.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(~F.col("used").eqNullSafe(F.col("default"))).alias("n_differences"), F.lit(status).alias("status"), F.lit(told).alias("error_is_told"))


@query("saved_parameters")
def saved_parameters(spark, sf):
    """What the saved forest's folder says of its stages: classes and the parameters they were fitted with."""
    stages = spark.read.json(f"{FM.save_fitted(spark, sf, 'rf')}/stages/*/metadata")
    params = "paramMap"
    return stages.select(
        F.substring_index("class", ".", -1).alias("stage"),
        *(F.col(f"{params}.{p}").cast("long").alias(name) for p, name in (("numTrees", "num_trees"), ("maxDepth", "max_depth"), ("seed", "seed"))),
        F.size(f"{params}.inputCols").alias("n_inputs"),
    )


@query("check_predict_rows")
def check_predict_rows(spark, sf):
    """Keys and labels that come with the predictions: the test rows' own."""
    return K.rounded(FM.test_predictions(spark, sf, "rf").select("key", "label"))


@query("check_tuned_rows")
def check_tuned_rows(spark, sf):
    """Keys, labels and report fields that come with the tuned forest's predictions."""
    return K.rounded(FM.tuning_predictions(spark, sf, TUNING).select("key", "label", "distance_km", "hour"))


@query("check_model_metrics")
def check_model_metrics(spark, sf):
    """The trained models' metrics as the sink has them: every model once, errors in their order of size."""
    return write_model_metrics(spark, sf).select("Model", (F.col("MAE") <= F.col("RMSE")).alias("mae_within_rmse"), (F.col("R2") < 1).alias("r2_below_one"))


@query("check_model_params")
def check_model_params(spark, sf):
    """Parameters that the profiles fix (the tuned forest's are the grid's)."""
    return model_params(spark, sf).filter("Model != 'Random Forest (tuned)'").select("Model", "num_trees", "max_depth", "num_features")


@query("check_rank_trained")
def check_rank_trained(spark, sf):
    return CH.ranking(FM.evaluate_all(spark, sf))


@query("check_compare_tuning")
def check_compare_tuning(spark, sf):
    return CH.comparison(compare_tuning(spark, sf))


@query("check_actual_vs_predicted")
def check_actual_vs_predicted(spark, sf):
    """The report's fares are those of the first 15 test trips by key."""
    return K.rounded(actual_vs_predicted(spark, sf).select(F.col("`Actual_Fare_($)`").alias("fare")))


@query("check_rename_columns")
def check_rename_columns(spark, sf):
    """The renamed fares are the test split's: count and sum."""
    return rename_columns(spark, sf).agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("`Actual_Fare_($)`"), 3).alias("fares"))


@query("check_tuned_residuals")
def check_tuned_residuals(spark, sf):
    """Residual report, histogram and segments of the tuned forest count every test row."""
    report = tuned_residual_report(spark, sf).first()["n"]
    bins = tuned_residual_histogram(spark, sf).agg(F.sum("n")).first()[0]
    segments = {r["segment"]: r["n"] for r in tuned_error_by_segment(spark, sf).groupBy("segment").agg(F.sum("n").alias("n")).collect()}
    return spark.range(1).select(*[F.lit(v).cast("long").alias(n) for n, v in (("report", report), ("histogram", bins), ("by_distance", segments["distance"]), ("by_hour", segments["hour"]))])


# =============================================================================
# Streaming form of the stateless feature plan
# =============================================================================


@query("stream_features")
def stream_features(spark, sf):
    from ..streaming.features import run_feature_stream

    return K.rounded(run_feature_stream(spark, sf))


_STREAMS: dict = {}


def _window_stream(spark, sf):
    from ..streaming.hourly import two_deliveries

    key = K.data_key(spark, sf, "windows")
    if key not in _STREAMS:
        _STREAMS[key] = two_deliveries(spark, K.raw_trips(spark, sf))
    return _STREAMS[key]


@query("stream_fare_by_hour")
def stream_fare_by_hour(spark, sf):
    """Hourly fares from a stream that was stopped and restarted between two deliveries."""
    return _window_stream(spark, sf).windows()


@query("stream_late_rows")
def stream_late_rows(spark, sf):
    """What each run of that stream did with its delivery."""
    rows = [(i, r.rows_in, r.late, r.repeated) for i, r in enumerate(_window_stream(spark, sf).runs, 1)]
    return spark.createDataFrame(rows, "run int, n_rows long, n_late long, n_repeated long")


__all__ = ["REGISTRY", "TUNING"]
