"""Trip scans: CSV with a fixed schema, CSV with inference, parquet, fallback."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import nan_to_null
from ..functions.timeparts import parse_pickup_time
from ..schema import PICKUP_TIME_FORMAT, RAW_TRIP_SCHEMA, TRIP_COLUMNS, TRIP_SCHEMA
from ..session import path_exists


class MissingColumnsError(ValueError):
    """A source lacks columns the next stage needs."""


def conform_trips(df: DataFrame, fmt: str = PICKUP_TIME_FORMAT) -> DataFrame:
    """Cast any trip-shaped frame to ``TRIP_SCHEMA``.

    A frame that has these types already is returned as it is: wrapped columns
    would keep the cleaning bounds from reaching a parquet scan, and the
    cleaning rule drops NaN by itself. Otherwise text times are parsed with ``fmt`` (bad text -> null); NaN becomes null so
    that Spark and pandas agree on what is missing.
    """
    validate_columns(df, TRIP_COLUMNS)
    types = dict(df.dtypes)
    if all(types[f.name] == f.dataType.simpleString() for f in TRIP_SCHEMA.fields):
        return df.select(*TRIP_COLUMNS)
    ts = F.col("pickup_datetime")
    if types["pickup_datetime"] == "string":
        ts = parse_pickup_time(ts, fmt)
    cols = []
    for f in TRIP_SCHEMA.fields:
        c = ts if f.name == "pickup_datetime" else F.col(f.name)
        if isinstance(f.dataType, T.DoubleType):
            c = nan_to_null(c.cast("double"))
        else:
            c = c.cast(f.dataType)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def validate_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise MissingColumnsError(f"missing required columns {missing}; have {df.columns}")
    return df


def read_trips_csv(
    spark: SparkSession, path: str, infer: bool = False, parse_time: bool = True, sampling_ratio: float | None = None
) -> DataFrame:
    """CSV with header. The explicit schema avoids the extra inference pass;
    ``infer=True`` keeps the reference's inferred-schema read, which scans
    the whole input once more unless ``sampling_ratio`` limits it."""
    reader = spark.read.option("header", True)
    if infer:
        reader = reader.option("inferSchema", True)
        if sampling_ratio is not None:
            reader = reader.option("samplingRatio", sampling_ratio)
        df = reader.csv(path)
    else:
        df = reader.schema(RAW_TRIP_SCHEMA).csv(path)
    return conform_trips(df) if parse_time else df


def read_trips_parquet(spark: SparkSession, path: str) -> DataFrame:
    return conform_trips(spark.read.parquet(path))


def read_trips(spark: SparkSession, path: str, fmt: str = "parquet", **kw) -> DataFrame:
    if fmt == "parquet":
        return read_trips_parquet(spark, path)
    if fmt == "csv":
        return read_trips_csv(spark, path, **kw)
    raise ValueError(f"unknown format {fmt!r}")


def source_fallback(
    spark: SparkSession,
    preferred: str,
    fallback: str,
    required: Sequence[str] = TRIP_COLUMNS,
    preferred_fmt: str = "parquet",
    fallback_fmt: str = "csv",
) -> DataFrame:
    """Read ``preferred`` when it exists, else ``fallback``; either way the
    result must carry ``required`` columns (fails early instead of at the
    first SELECT, see SURVEY §8 D1)."""
    path, fmt = (preferred, preferred_fmt) if path_exists(spark, preferred) else (fallback, fallback_fmt)
    raw = spark.read.parquet(path) if fmt == "parquet" else spark.read.option("header", True).schema(RAW_TRIP_SCHEMA).csv(path)
    validate_columns(raw, required)
    return conform_trips(raw) if set(TRIP_COLUMNS) <= set(raw.columns) else raw


def rows_to_df(spark: SparkSession, rows: Sequence, schema: T.StructType = TRIP_SCHEMA) -> DataFrame:
    """Small local rows -> DataFrame (unit inputs and tiny dimension tables only)."""
    return spark.createDataFrame(list(rows), schema=schema)


def temp_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df
