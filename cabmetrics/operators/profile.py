"""Exploration reports as distributed aggregates.

Every report is a small table produced by one aggregation over the input
(partial aggregation on the map side, so the shuffle carries one row per
group per task regardless of how skewed the groups are). Where a report
needs a data-dependent constant (min/max of a histogram, quartiles of the
IQR rule) the constant enters as a scalar subquery or a literal, never as
a cross join.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import nan_to_null, passenger_valid_flag, pct_of_total, pearson
from ..functions.timeparts import day_name
from ..schema import CODE_PROFILE, NUMERIC_COLUMNS, CleaningProfile
from .quantiles import opening_sketch, quantiles


def _r(c: Column, digits: int | None) -> Column:
    return F.round(c, digits) if digits is not None else c


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def table_shape(df: DataFrame) -> DataFrame:
    """One row: rows and columns."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


def null_profile(df: DataFrame, cols: Sequence[str] | None = None, digits: int = 2) -> DataFrame:
    """Missing values per column from one pass: position, column, n_null, pct_null.

    NaN counts as missing (pandas' rule)."""
    cols = list(cols or df.columns)
    types = dict(df.dtypes)

    def missing(c: str) -> Column:
        m = F.col(c).isNull()
        return m | F.isnan(F.col(c)) if types[c] in ("double", "float") else m

    agg = df.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(missing(c)).alias(f"m{i}") for i, c in enumerate(cols)])
    return agg.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(i + 1).alias("position"),
                        F.lit(c).alias("column"),
                        F.col(f"m{i}").alias("n_null"),
                        pct_of_total(F.col(f"m{i}"), F.col("total"), digits).alias("pct_null"),
                    )
                    for i, c in enumerate(cols)
                ]
            )
        )
    )


def describe_numeric(
    df: DataFrame, cols: Sequence[str] = NUMERIC_COLUMNS, method: str = "exact", digits: int | None = 6
) -> DataFrame:
    """pandas-style describe: count, mean, std (n-1), min, 25/50/75 %, max per column.

    One aggregate gives the moments and, with them, the count, min, max and
    the sketch that the quantile search starts from; the quartiles then come from
    :func:`quantiles` (exact, bounded memory). The result has one row per
    column, built from those bounded numbers.
    """
    cols = list(cols)
    base = df.select(*[nan_to_null(F.col(c).cast("double")).alias(c) for c in cols])
    m = base.agg(
        *[
            e
            for i, c in enumerate(cols)
            for e in (
                F.count(c).alias(f"n{i}"),
                F.avg(c).alias(f"mean{i}"),
                F.stddev_samp(c).alias(f"std{i}"),
                F.min(c).alias(f"min{i}"),
                F.max(c).alias(f"max{i}"),
                opening_sketch(F.col(c), [0.25, 0.5, 0.75]).alias(f"sketch{i}"),
            )
        ]
    ).first()
    stats = {c: (m[f"n{i}"], m[f"min{i}"], m[f"max{i}"]) for i, c in enumerate(cols)}
    q = quantiles(df, cols, [0.25, 0.5, 0.75], method=method, stats=stats, sketches={c: m[f"sketch{i}"] for i, c in enumerate(cols)})
    rows = [
        (i + 1, c, m[f"n{i}"], m[f"mean{i}"], m[f"std{i}"], m[f"min{i}"], *q[c], m[f"max{i}"])
        for i, c in enumerate(cols)
    ]
    out = df.sparkSession.createDataFrame(
        rows,
        "position int, column string, count bigint, mean double, std double, min double, "
        "p25 double, p50 double, p75 double, max double",
    )
    return out.select(
        "position", "column", "count", *[_r(F.col(k), digits).alias(k) for k in ("mean", "std", "min", "p25", "p50", "p75", "max")]
    )


def _moments_and_median(df: DataFrame, col: str, method: str) -> tuple:
    c = nan_to_null(F.col(col).cast("double"))
    m = df.agg(F.count(c).alias("n"), F.min(c).alias("min"), F.max(c).alias("max"), F.avg(c).alias("mean"), opening_sketch(c, [0.5]).alias("sketch")).first()
    med = quantiles(df, [col], [0.5], method=method, stats={col: (m["n"], m["min"], m["max"])}, sketches={col: m["sketch"]})[col][0]
    return m, med


def min_max_mean_median(df: DataFrame, col: str, method: str = "exact", digits: int | None = 6) -> DataFrame:
    """min, max, mean and median of one column (nulls skipped); the
    moments' aggregate also seeds the median search."""
    m, med = _moments_and_median(df, col, method)
    out = df.sparkSession.createDataFrame(
        [(m["min"], m["max"], m["mean"], med)], "min double, max double, mean double, median double"
    )
    return out.select(*[_r(F.col(k), digits).alias(k) for k in ("min", "max", "mean", "median")])


def mean_median(df: DataFrame, col: str, method: str = "exact", digits: int | None = 6) -> DataFrame:
    m, med = _moments_and_median(df, col, method)
    out = df.sparkSession.createDataFrame([(m["mean"], med)], "mean double, median double")
    return out.select(*[_r(F.col(k), digits).alias(k) for k in ("mean", "median")])


def iqr_bounds(df: DataFrame, col: str, k: float = 1.5, method: str = "exact") -> dict[str, float | None]:
    q1, q3 = quantiles(df, [col], [0.25, 0.75], method=method)[col]
    if q1 is None:
        return {"q1": None, "q3": None, "iqr": None, "lower": None, "upper": None}
    iqr = q3 - q1
    return {"q1": q1, "q3": q3, "iqr": iqr, "lower": q1 - k * iqr, "upper": q3 + k * iqr}


def quartiles_report(df: DataFrame, col: str, k: float = 1.5, method: str = "exact", digits: int | None = 6) -> DataFrame:
    """One row: q1, q3, iqr, lower, upper."""
    b = iqr_bounds(df, col, k, method)
    spark = df.sparkSession
    row = spark.range(1).select(*[_r(F.lit(b[n]).cast("double"), digits).alias(n) for n in ("q1", "q3", "iqr", "lower", "upper")])
    return row


def iqr_outlier_condition(col: str, bounds: dict) -> Column:
    c = nan_to_null(F.col(col).cast("double"))
    return (c < F.lit(bounds["lower"])) | (c > F.lit(bounds["upper"]))


def iqr_outliers(df: DataFrame, col: str, k: float = 1.5, method: str = "exact") -> DataFrame:
    """Rows outside ``[q1 - k*iqr, q3 + k*iqr]``."""
    b = iqr_bounds(df, col, k, method)
    return df.filter(iqr_outlier_condition(col, b))


def iqr_outlier_summary(df: DataFrame, col: str, k: float = 1.5, method: str = "exact", digits: int | None = 6) -> DataFrame:
    """One row: n_outliers, n_total, pct_outliers and the bounds."""
    b = iqr_bounds(df, col, k, method)
    return df.agg(
        F.count_if(iqr_outlier_condition(col, b)).alias("n_outliers"),
        F.count(F.lit(1)).alias("n_total"),
    ).select(
        "n_outliers",
        "n_total",
        pct_of_total("n_outliers", "n_total").alias("pct_outliers"),
        *[_r(F.lit(b[n]).cast("double"), digits).alias(n) for n in ("q1", "q3", "iqr", "lower", "upper")],
    )


def value_counts(df: DataFrame, col: str, name: str = "n") -> DataFrame:
    """Counts per non-null value, ascending by value."""
    return df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(name)).orderBy(col)


def passenger_distribution(df: DataFrame, lo: int = 1, hi: int = 6) -> DataFrame:
    return value_counts(df, "passenger_count").withColumn("validity", passenger_valid_flag("passenger_count", lo, hi))


def equal_width_histogram(
    df: DataFrame,
    col: str,
    bins: int,
    lo: float | None = None,
    hi: float | None = None,
    digits: int | None = 6,
) -> DataFrame:
    """``bins`` equal-width bins over [lo, hi] (default: the column's min and
    max), last bin closed; empty bins get n = 0.

    The default range costs one aggregate returning a single row; it then
    enters the bucket expression as literals (a scalar subquery inside the
    grouping key defeats whole-stage codegen). A constant column gets the
    range [v - 0.5, v + 0.5] like NumPy, and a range that is not finite is an
    error as there: give ``lo`` and ``hi``, and infinite values lie outside.
    Columns: bin (1-based), low, high, n.
    """
    spark = df.sparkSession
    # x is computed once in a projection; the aggregate groups on it and the
    # null bucket is dropped afterwards. Filtering on x instead would make
    # Catalyst inline the (possibly large) expression into every predicate.
    vals = df.select(nan_to_null(F.col(col).cast("double")).alias("x"))
    explicit = lo is not None or hi is not None
    if lo is None or hi is None:
        mm = vals.agg(F.min("x").alias("lo"), F.max("x").alias("hi")).first()
        lo = mm["lo"] if lo is None else lo
        hi = mm["hi"] if hi is None else hi
    if lo is None or hi is None:  # no values: no range, no bins
        return spark.createDataFrame([], "bin bigint, low double, high double, n bigint")
    lo, hi = float(lo), float(hi)
    if not (math.isfinite(lo) and math.isfinite(hi)):
        raise ValueError(f"range of {col} is not finite: [{lo}, {hi}]; give lo and hi")
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    lo_e, hi_e = F.lit(lo), F.lit(hi)
    width = (hi_e - lo_e) / F.lit(bins)
    x = F.col("x")
    # first guess from width_bucket, then NumPy's one-step correction against
    # the bin edges i * width + lo, so a value on an edge lands where NumPy
    # puts it (`least` skips nulls, so the null guard must be explicit)
    b0 = F.least(F.width_bucket(x, lo_e, hi_e, F.lit(bins)), F.lit(bins))
    bucket = F.when(x.isNull(), F.lit(None)).otherwise(
        F.when(x < (b0 - 1) * width + lo_e, b0 - 1)
        .when((x >= b0 * width + lo_e) & (b0 != F.lit(bins)), b0 + 1)
        .otherwise(b0)
    )
    if explicit:
        # explicit bounds: values outside them belong to no bin
        bucket = F.when(x.between(lo_e, hi_e), bucket)
    counts = (
        vals.groupBy(bucket.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("bin").isNotNull())
    )
    # The bin list has exactly `bins` rows and the counts at most as many:
    # the join's build side is bounded by a parameter.
    grid = spark.range(1, bins + 1).select(F.col("id").alias("bin"))
    out = grid.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        _r((F.col("bin") - 1) * width + lo_e, digits).alias("low"),
        _r(F.when(F.col("bin") == bins, hi_e).otherwise(F.col("bin") * width + lo_e), digits).alias("high"),
        F.coalesce(F.col("n"), F.lit(0)).alias("n"),
    )
    return out


def grouped_fare(df: DataFrame, by: str, fare: str = "fare_amount", key: str = "key", digits: int | None = 6) -> DataFrame:
    """Mean fare (null and NaN skipped) and trip count (non-null keys) per
    value of ``by``; null groups dropped. Only the result is rounded."""
    return (
        df.filter(F.col(by).isNotNull())
        .groupBy(by)
        .agg(_r(F.avg(nan_to_null(fare)), digits).alias("avg_fare"), F.count(key).alias("trip_count"))
    )


def fare_by_hour(features: DataFrame, digits: int | None = 6) -> DataFrame:
    return grouped_fare(features, "hour", digits=digits)


def fare_by_day(features: DataFrame, digits: int | None = 6) -> DataFrame:
    return grouped_fare(features, "day_of_week", digits=digits).withColumn("day_name", day_name("day_of_week"))


def fare_by_year(features: DataFrame, digits: int | None = 6) -> DataFrame:
    return grouped_fare(features, "year", digits=digits).filter(F.col("avg_fare").isNotNull())


def temporal_profile(features: DataFrame, digits: int | None = 6) -> DataFrame:
    """Hour and weekday panels: kind ('hour' | 'day'), bucket, trip_count, avg_fare.

    The trips are grouped once by (hour, weekday); the two panels are rolled
    up from those groups (at most 25 x 8), not from the rows."""
    fare = nan_to_null("fare_amount")
    cells = features.groupBy("hour", "day_of_week").agg(
        F.count("key").alias("trips"), F.sum(fare).alias("total"), F.count(fare).alias("fares")
    )
    panels = F.array(
        F.struct(F.lit("hour").alias("kind"), F.col("hour").cast("int").alias("bucket")),
        F.struct(F.lit("day").alias("kind"), F.col("day_of_week").cast("int").alias("bucket")),
    )
    return (
        cells.select(F.inline(panels), "trips", "total", "fares")
        .filter(F.col("bucket").isNotNull())
        .groupBy("kind", "bucket")
        .agg(F.sum("trips").alias("trip_count"), _r(F.try_divide(F.sum("total"), F.sum("fares")), digits).alias("avg_fare"))
    )


def corr_with_target(df: DataFrame, target: str, cols: Sequence[str], digits: int | None = 6) -> DataFrame:
    """Pearson correlation of ``target`` with each column (pairwise-complete rows), one pass."""
    agg = df.agg(*[pearson(target, c).alias(f"c{i}") for i, c in enumerate(cols)])
    return agg.select(
        F.inline(
            F.array(*[F.struct(F.lit(c).alias("column"), _r(F.col(f"c{i}"), digits).alias("corr")) for i, c in enumerate(cols)])
        )
    )


def corr_matrix(df: DataFrame, cols: Sequence[str], complete_rows: bool = True, digits: int | None = 6) -> DataFrame:
    """All pairwise Pearson coefficients in one pass, long form (a, b, corr), a before b.

    ``complete_rows`` first drops rows with a null in any of ``cols`` (the
    heat map's rule)."""
    cols = list(cols)
    pairs = list(combinations(cols, 2))
    if complete_rows:
        from .clean import not_null_condition

        # every row has all values: one covariance per pair plus one
        # deviation per column (stable co-moment aggregates)
        df = df.filter(not_null_condition(df, cols)).select(*[F.col(c).cast("double").alias(c) for c in cols])
        agg = df.agg(
            *[F.covar_samp(a, b).alias(f"v{i}") for i, (a, b) in enumerate(pairs)],
            *[F.stddev_samp(c).alias(f"s{j}") for j, c in enumerate(cols)],
        )
        idx = {c: j for j, c in enumerate(cols)}
        corr = lambda i, a, b: F.try_divide(F.col(f"v{i}"), F.col(f"s{idx[a]}") * F.col(f"s{idx[b]}"))
    else:
        agg = df.agg(*[pearson(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
        corr = lambda i, a, b: F.col(f"c{i}")
    return agg.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), _r(corr(i, a, b), digits).alias("corr"))
                    for i, (a, b) in enumerate(pairs)
                ]
            )
        )
    )


def corr_pair(df: DataFrame, a: str, b: str, digits: int | None = 6) -> DataFrame:
    """One coefficient over rows where both values are present (unlike
    ``df.stat.corr``, which must not see nulls)."""
    return df.agg(_r(pearson(a, b), digits).alias("corr"))


def pickup_density(df: DataFrame, cell: float = 0.01, p: CleaningProfile = CODE_PROFILE) -> DataFrame:
    """Pickups inside the box counted per grid cell (cell_x, cell_y, n): the
    scatter plot as an aggregate over all rows."""
    from .clean import bbox_condition

    return (
        df.filter(bbox_condition(p, ends=("pickup",)))
        .groupBy(
            F.floor(F.col("pickup_longitude") / F.lit(cell)).cast("bigint").alias("cell_x"),
            F.floor(F.col("pickup_latitude") / F.lit(cell)).cast("bigint").alias("cell_y"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )


def scatter_bins(
    df: DataFrame, x: str, y: str, x_width: float, y_width: float, x_max: float | None = None
) -> DataFrame:
    """2-D bin counts (x_bin, y_bin, n) for a scatter plot over all rows."""
    src = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    if x_max is not None:
        src = src.filter(F.col(x) <= F.lit(x_max))
    return src.groupBy(
        F.floor(F.col(x) / F.lit(x_width)).cast("bigint").alias("x_bin"),
        F.floor(F.col(y) / F.lit(y_width)).cast("bigint").alias("y_bin"),
    ).agg(F.count(F.lit(1)).alias("n"))


def flag_share(df: DataFrame, flag: str, digits: int = 2) -> DataFrame:
    """Rows with ``flag = 1``, total rows and percent."""
    return df.agg(
        F.count_if(F.col(flag) == 1).alias("n_flagged"),
        F.count(F.lit(1)).alias("n_total"),
    ).withColumn("pct_flagged", pct_of_total("n_flagged", "n_total", digits))
