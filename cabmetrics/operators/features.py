"""Derived trip columns: distance, calendar fields, airport flag, casts.

All are projections (narrow, codegen'd); no shuffle, no UDF.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import is_airport_trip, trip_distance
from ..functions.timeparts import time_parts
from ..schema import PREP_FEATURES, TARGET, TRIP_COLUMNS


def add_distance(df: DataFrame, name: str = "distance_km") -> DataFrame:
    return df.withColumn(name, trip_distance())


def add_time_parts(df: DataFrame, as_double: bool = False) -> DataFrame:
    return time_parts(df, as_double=as_double)


def add_airport_flag(df: DataFrame, name: str = "is_airport_trip") -> DataFrame:
    return df.withColumn(name, is_airport_trip())


def feature_projection(df: DataFrame, airport: bool = False, as_double: bool = False) -> DataFrame:
    """Base trip columns + distance_km + hour, day_of_week, month, year
    (+ is_airport_trip), as one projection."""
    out = time_parts(df.select(*TRIP_COLUMNS).withColumn("distance_km", trip_distance()), as_double=as_double)
    if airport:
        out = out.withColumn("is_airport_trip", is_airport_trip())
    return out.select(
        *TRIP_COLUMNS, "distance_km", "hour", "day_of_week", "month", "year", *(["is_airport_trip"] if airport else [])
    )


def cast_features(df: DataFrame, features=PREP_FEATURES, target: str = TARGET) -> DataFrame:
    """Feature and target columns as double (one projection)."""
    return df.withColumns({c: F.col(c).cast("double") for c in [*features, target]})
