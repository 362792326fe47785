"""Quantiles of any date range from stored daily sketches.

A KLL sketch of each day's values is written once. The quantiles of a month,
a season or the whole history come from merging the days' sketches: a few
kilobytes a day are read in place of the trips. Sketches of a day are made
from partial sketches of its rows, so a hot day is no problem; new days are
appended without touching old ones.

A merged sketch of parameter ``k`` answers with a rank error of at most
``rank_error(k)``, a share of the rows, with 99 % confidence.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import nan_to_null

SKETCH_K = 800


def rank_error(k: int = SKETCH_K) -> float:
    """Bound of the normalised rank error of a KLL sketch (fixed values, as its authors fitted them)."""
    return 2.446 / k**0.9433


def daily_sketches(trips: DataFrame, value: str = "fare_amount", time: str = "pickup_datetime", k: int = SKETCH_K) -> DataFrame:
    """(day, sketch) of the values that are not null or NaN; trips without a time have no day."""
    rows = trips.select(F.to_date(time).alias("day"), nan_to_null(F.col(value).cast("double")).alias("x")).filter("day is not null and x is not null")
    return rows.groupBy("day").agg(F.kll_sketch_agg_double("x", F.lit(k)).alias("sketch"))


def save_sketches(sketches: DataFrame, path: str) -> str:
    """Append days to the store, by month; a day is stored once."""
    sketches.withColumn("month", F.date_format("day", "yyyy-MM")).write.mode("append").partitionBy("month").parquet(path)
    return path


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("day date, sketch binary, month string").parquet(path)


def merged_quantiles(sketches: DataFrame, probs: Sequence[float], groups: Sequence[str | Column] = (), k: int = SKETCH_K) -> DataFrame:
    """(groups, n, p, value): the quantiles of each group of stored sketches; no row for a group without any."""
    merged = sketches.groupBy(*groups).agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"), F.count(F.lit(1)).alias("days")).filter("days > 0")
    named = [c for c in merged.columns if c not in ("sketch", "days")]
    values = F.kll_sketch_get_quantile_double("sketch", F.array(*(F.lit(float(p)) for p in probs)))
    read = merged.select(*named, F.kll_sketch_get_n_double("sketch").alias("n"), values.alias("values"))
    pairs = F.arrays_zip(F.array(*(F.lit(float(p)) for p in probs)).alias("p"), F.col("values").alias("value"))
    return read.select(*named, "n", F.inline(pairs)).toDF(*named, "n", "p", "value")


def rank_deviation(found: DataFrame, trips: DataFrame, group: Column, value: str = "fare_amount") -> DataFrame:
    """(part, n, p, deviation): how far each answer's true ranks lie from ``p``, by exact counts.

    ``found`` has the columns part, p and value. One scan of the trips: each
    meets the few answers of its part and is counted in their order.
    """
    rows = trips.select(group.alias("part"), nan_to_null(F.col(value).cast("double")).alias("x")).filter("part is not null and x is not null")
    answers = found.groupBy("part").agg(F.sort_array(F.collect_list(F.struct("p", "value"))).alias("answers"))
    counted = rows.join(answers, "part").select("part", "x", F.inline("answers")).groupBy("part", "p").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("x") < F.col("value")).alias("below"), F.count_if(F.col("x") <= F.col("value")).alias("upto")
    )
    low, high = F.col("below") / F.col("n"), F.col("upto") / F.col("n")
    return counted.select("part", "n", "p", F.greatest(F.lit(0.0), low - F.col("p"), F.col("p") - high).alias("deviation"))
