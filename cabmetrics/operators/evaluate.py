"""Prediction quality, rule baselines and model ranking.

Metrics are plain aggregates (one pass for RMSE, MAE and R² together,
instead of one evaluator job per metric).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import pct_of_total


def _r(c: Column, digits: int | None) -> Column:
    return F.round(c, digits) if digits is not None else c


def _metric_cols(label: Column, pred: Column, digits: int | None):
    e = label - pred
    return (
        _r(F.sqrt(F.avg(e * e)), digits),
        _r(F.avg(F.abs(e)), digits),
        _r(F.lit(1.0) - F.try_divide(F.sum(e * e), (F.count(label) - 1) * F.var_samp(label)), digits),
    )


def regression_metrics(
    preds: DataFrame, label: str = "label", prediction: str = "prediction", digits: int | None = 6
) -> DataFrame:
    """One row: n, rmse, mae, r2 (R² = 1 - SSE/SST, as RegressionEvaluator)."""
    rmse, mae, r2 = _metric_cols(F.col(label), F.col(prediction), digits)
    return preds.agg(F.count(F.lit(1)).alias("n"), rmse.alias("rmse"), mae.alias("mae"), r2.alias("r2"))


def metrics_row(preds: DataFrame, model: str, label: str = "label", prediction: str = "prediction", digits: int | None = 6) -> DataFrame:
    """(Model, RMSE, MAE, R2) for one model's predictions."""
    rmse, mae, r2 = _metric_cols(F.col(label), F.col(prediction), digits)
    return preds.agg(F.lit(model).alias("Model"), rmse.alias("RMSE"), mae.alias("MAE"), r2.alias("R2"))


def metrics_table(preds: DataFrame, models: Sequence[str], label: str = "label", digits: int | None = 6) -> DataFrame:
    """Metrics of several prediction columns of the same rows from one pass.

    ``preds`` holds ``label`` and one column per name in ``models``.
    """
    parts = []
    for i, m in enumerate(models):
        rmse, mae, r2 = _metric_cols(F.col(label), F.col(m), digits)
        parts += [rmse.alias(f"rmse{i}"), mae.alias(f"mae{i}"), r2.alias(f"r2{i}")]
    agg = preds.agg(*parts)
    return agg.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(m).alias("Model"),
                        F.col(f"rmse{i}").alias("RMSE"),
                        F.col(f"mae{i}").alias("MAE"),
                        F.col(f"r2{i}").alias("R2"),
                    )
                    for i, m in enumerate(models)
                ]
            )
        )
    )


# ---------------------------------------------------------------------------
# Rule baselines: predictors fitted by SQL aggregates on the train split
# ---------------------------------------------------------------------------

RULE_MODELS = ("Train mean", "Hourly mean", "Distance rate")


def rule_fit(train: DataFrame, label: str = "fare_amount") -> dict:
    """Fit the three baselines with one aggregate over ``train``:
    ``GROUPING SETS ((hour), ())`` gives the per-hour means and, in the
    grand-total row, the overall mean and the least-squares line on distance.
    The result has at most 26 rows (the hour domain plus null and the total).
    """
    rows = (
        train.groupingSets([["hour"], []], "hour")
        .agg(
            F.grouping("hour").alias("g"),
            F.avg(label).alias("mean"),
            F.regr_slope(F.col(label), F.col("distance_km")).alias("slope"),
            F.regr_intercept(F.col(label), F.col("distance_km")).alias("intercept"),
        )
        .collect()
    )
    total = next((r for r in rows if r["g"] == 1), None)
    return {
        "mean": total["mean"] if total else None,
        "slope": total["slope"] if total else None,
        "intercept": total["intercept"] if total else None,
        "hourly": {r["hour"]: r["mean"] for r in rows if r["g"] == 0 and r["hour"] is not None},
    }


def rule_columns(fit: dict, prefix: str = "") -> list[Column]:
    """The three baseline predictions as columns: the train mean, the train
    mean of the trip's hour, and the least-squares line on distance. The fitted
    constants enter as literals (the hour means as a literal map), so scoring
    is a projection: no join, no subquery."""
    mean = F.lit(fit["mean"]).cast("double")
    if fit["hourly"]:
        hour_map = F.create_map(*[x for h, m in sorted(fit["hourly"].items()) for x in (F.lit(h), F.lit(m))])
        hourly = F.coalesce(F.try_element_at(hour_map, F.col("hour")), mean)
    else:
        hourly = mean
    line = F.lit(fit["intercept"]).cast("double") + F.lit(fit["slope"]).cast("double") * F.col("distance_km")
    return [c.alias(prefix + n) for c, n in zip((mean, hourly, line), RULE_MODELS)]


def rule_predictions(train: DataFrame, test: DataFrame, label: str = "fare_amount") -> DataFrame:
    """Test rows with three baseline predictions fitted on ``train``."""
    return test.select("key", F.col(label).alias("label"), "distance_km", "hour", *rule_columns(rule_fit(train, label)))


def rule_metrics(train: DataFrame, test: DataFrame, label: str = "fare_amount", digits: int | None = 6) -> DataFrame:
    return metrics_table(rule_predictions(train, test, label), RULE_MODELS, digits=digits)


def rule_comparison(before: DataFrame, after: DataFrame, test: DataFrame, model: str, label: str = "fare_amount") -> DataFrame:
    """One baseline fitted on two training sets, from one scan of the test rows."""
    preds = test.select(F.col(label).alias("label"), "distance_km", "hour", *rule_columns(rule_fit(before, label), "before "), *rule_columns(rule_fit(after, label), "after "))
    return compare_columns(preds, f"before {model}", f"after {model}")


# ---------------------------------------------------------------------------
# Ranking and comparison over a metrics table (one row per model)
# ---------------------------------------------------------------------------


def rank_models(metrics: DataFrame, by: str = "RMSE") -> DataFrame:
    """All models by ``by`` ascending with their rank; models that tie in it and in name share one.

    The table has one row per model, so it is gathered into one sorted list.
    """
    order = F.struct(F.col(by).isNotNull(), F.col(by), F.col("Model"))  # nulls first, as in a sort
    rows = F.array_sort(F.collect_list(F.struct(order.alias("order"), F.struct(*metrics.columns).alias("row"))))
    listed = metrics.agg(rows.alias("rows")).select("rows", F.posexplode("rows").alias("at", "r"))
    earlier = F.size(F.filter("rows", lambda x: x["order"] < F.col("r.order")))
    return listed.select(F.col("r.row.*"), (earlier + 1).alias("rank")).orderBy("rank")


def best_model(metrics: DataFrame, by: str = "RMSE") -> DataFrame:
    """``ORDER BY RMSE LIMIT 1`` (ties broken by name): a top-1, planned as TakeOrderedAndProject."""
    return metrics.orderBy(F.col(by).asc(), F.col("Model").asc()).limit(1)


def compare_before_after(before: DataFrame, after: DataFrame, model: str, digits: int | None = 6) -> DataFrame:
    """Long form (metric, before, after, change) for one model; ``before`` is
    null (N/A) when the model is missing from the baseline table."""
    a = after.filter(F.col("Model") == model)
    b = before.filter(F.col("Model") == model).select(*[F.col(m).alias(f"b_{m}") for m in ("Model", "RMSE", "MAE", "R2")])
    j = a.join(b, a["Model"] == b["b_Model"], "left")
    return j.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(m).alias("metric"),
                        F.col(f"b_{m}").alias("before"),
                        F.col(m).alias("after"),
                        _r(F.col(m) - F.col(f"b_{m}"), digits).alias("change"),
                    )
                    for m in ("RMSE", "MAE", "R2")
                ]
            )
        )
    )


def compare_columns(preds: DataFrame, before: str, after: str, label: str = "label", digits: int | None = 6) -> DataFrame:
    """(metric, before, after, change) of two prediction columns of the same rows, one aggregate."""
    cols = [c.alias(f"{side}{i}") for side, p in (("b", before), ("a", after)) for i, c in enumerate(_metric_cols(F.col(label), F.col(p), digits))]
    return preds.agg(*cols).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(m).alias("metric"),
                        F.col(f"b{i}").alias("before"),
                        F.col(f"a{i}").alias("after"),
                        _r(F.col(f"a{i}") - F.col(f"b{i}"), digits).alias("change"),
                    )
                    for i, m in enumerate(("RMSE", "MAE", "R2"))
                ]
            )
        )
    )


# ---------------------------------------------------------------------------
# Residual reports
# ---------------------------------------------------------------------------


def residual_report(preds: DataFrame, label: str = "label", prediction: str = "prediction", big_error: float = 10.0, digits: int | None = 6) -> DataFrame:
    """One row: n, mean residual (bias), residual std, share of |error| > big_error."""
    e = F.col(label) - F.col(prediction)
    return preds.agg(
        F.count(F.lit(1)).alias("n"),
        _r(F.avg(e), digits).alias("mean_residual"),
        _r(F.stddev_samp(e), digits).alias("std_residual"),
        F.count_if(F.abs(e) > F.lit(big_error)).alias("n_big_error"),
    ).withColumn("pct_big_error", pct_of_total("n_big_error", "n"))


# Distance bands (km) of the error-by-segment report.
DISTANCE_BANDS = ((0.0, 5.0, "0-5 km"), (5.0, 20.0, "5-20 km"), (20.0, 30.0, "20-30 km"), (30.0, None, "30+ km"))


def distance_band(col: str = "distance_km") -> Column:
    c = F.col(col)
    expr = None
    for lo, hi, name in DISTANCE_BANDS:
        cond = (c >= lo) if hi is None else ((c >= lo) & (c < hi))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def residuals(preds: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """The errors (label - prediction) as column ``residual``, for a histogram."""
    return preds.select((F.col(label) - F.col(prediction)).alias("residual"))


def error_by_segment(preds: DataFrame, label: str = "label", prediction: str = "prediction", digits: int | None = 6) -> DataFrame:
    """RMSE/MAE/bias per distance band and per hour: segment ('distance' |
    'hour'), bucket, n, rmse, mae, bias.

    Rows are grouped once by (band, hour); both segments are rolled up from
    those groups (a band count times 25 at most)."""
    e = F.col(label) - F.col(prediction)
    cells = preds.groupBy(distance_band().alias("band"), F.col("hour").cast("string").alias("hour_s")).agg(
        F.count(F.lit(1)).alias("rows"), F.count(e).alias("errors"), F.sum(e * e).alias("squares"), F.sum(F.abs(e)).alias("sizes"), F.sum(e).alias("total")
    )
    segments = F.array(
        F.struct(F.lit("distance").alias("segment"), F.col("band").alias("bucket")), F.struct(F.lit("hour").alias("segment"), F.col("hour_s").alias("bucket"))
    )
    mean = lambda c: F.try_divide(F.sum(c), F.sum("errors"))
    return (
        cells.select(F.inline(segments), "rows", "errors", "squares", "sizes", "total")
        .filter(F.col("bucket").isNotNull())
        .groupBy("segment", "bucket")
        .agg(F.sum("rows").alias("n"), _r(F.sqrt(mean("squares")), digits).alias("rmse"), _r(mean("sizes"), digits).alias("mae"), _r(mean("total"), digits).alias("bias"))
    )
