"""Types, fixed constants and parameter objects shared by every operator."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Trip table
# ---------------------------------------------------------------------------

TRIP_COLUMNS = [
    "key",
    "fare_amount",
    "pickup_datetime",
    "pickup_longitude",
    "pickup_latitude",
    "dropoff_longitude",
    "dropoff_latitude",
    "passenger_count",
]

COORD_COLUMNS = [
    "pickup_longitude",
    "pickup_latitude",
    "dropoff_longitude",
    "dropoff_latitude",
]

NUMERIC_COLUMNS = ["fare_amount", *COORD_COLUMNS, "passenger_count"]

# Raw CSV layout: the pickup time is still text.
RAW_TRIP_SCHEMA = T.StructType(
    [
        T.StructField("key", T.StringType(), True),
        T.StructField("fare_amount", T.DoubleType(), True),
        T.StructField("pickup_datetime", T.StringType(), True),
        T.StructField("pickup_longitude", T.DoubleType(), True),
        T.StructField("pickup_latitude", T.DoubleType(), True),
        T.StructField("dropoff_longitude", T.DoubleType(), True),
        T.StructField("dropoff_latitude", T.DoubleType(), True),
        T.StructField("passenger_count", T.LongType(), True),
    ]
)

# Parsed layout used by every operator downstream of the scan.
TRIP_SCHEMA = T.StructType(
    [
        f if f.name != "pickup_datetime" else T.StructField("pickup_datetime", T.TimestampType(), True)
        for f in RAW_TRIP_SCHEMA.fields
    ]
)

# Text pattern of the pickup time, e.g. "2009-06-15 17:26:21 UTC".
# Fractions of a second are read where they are given.
PICKUP_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS] z"
# Pattern used when writing raw CSV text (literal zone token, session zone is UTC).
PICKUP_TIME_WRITE_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS 'UTC'"

# ---------------------------------------------------------------------------
# Geography
# ---------------------------------------------------------------------------

# Mean Earth radius (km), airport points and catchment radius.
EARTH_RADIUS_KM = 6371.0
AIRPORTS = (
    ("JFK", 40.6413, -73.7781),
    ("LGA", 40.7769, -73.8740),
    ("EWR", 40.6895, -74.1745),
)
AIRPORT_RADIUS_KM = 2.0

# Weekday labels for dayofweek() numbering 1=Sunday .. 7=Saturday.
DAY_NAMES = ("Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat")


@dataclass(frozen=True)
class CleaningProfile:
    """Closed ranges a trip must satisfy; ``None`` disables a rule."""

    fare_min: float | None = 1.0
    fare_max: float | None = 500.0
    passengers_min: int | None = 1
    passengers_max: int | None = 6
    lon_min: float = -74.3
    lon_max: float = -72.9
    lat_min: float = 40.5
    lat_max: float = 41.0
    drop_nulls: bool = True


# The cleaning rule of the preprocessing code (default) and the
# looser rule stated in the project report.
CODE_PROFILE = CleaningProfile()
REPORT_PROFILE = CleaningProfile(
    fare_min=0.0, fare_max=500.0, lon_min=-75.0, lon_max=-72.0, lat_min=40.0, lat_max=42.0
)

# ---------------------------------------------------------------------------
# Features and models
# ---------------------------------------------------------------------------

# Feature order of the modeling scripts (10 columns) ...
TREE_FEATURES = [
    "distance_km",
    "hour",
    "day_of_week",
    "month",
    "year",
    "passenger_count",
    "pickup_longitude",
    "pickup_latitude",
    "dropoff_longitude",
    "dropoff_latitude",
]
# ... and of the preprocessing notebook (11 columns, adds the airport flag).
PREP_FEATURES = [
    "distance_km",
    "passenger_count",
    "hour",
    "day_of_week",
    "month",
    "year",
    "is_airport_trip",
    "pickup_longitude",
    "pickup_latitude",
    "dropoff_longitude",
    "dropoff_latitude",
]
TARGET = "fare_amount"


@dataclass(frozen=True)
class ModelProfile:
    """Estimator parameters; defaults are the reference's values."""

    lr_max_iter: int = 20
    lr_reg_param: float = 0.01
    rf_num_trees: int = 50
    rf_max_depth: int = 10
    gbt_max_iter: int = 20
    seed: int = 42


@dataclass(frozen=True)
class TuningProfile:
    """Random-forest grid search; defaults are the reference's grid."""

    num_trees: tuple[int, ...] = (50, 100, 150)
    max_depth: tuple[int, ...] = (5, 10, 15)
    num_folds: int = 3
    parallelism: int = 4
    seed: int = 42
    extra: dict = field(default_factory=dict)


# Train fraction of the split and the sample target size.
TRAIN_FRACTION = 0.8
SAMPLE_SIZE = 10_000
SEED = 42
