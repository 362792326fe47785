"""Column-level functions (all built-in expressions, no Python UDF)."""

from .geo import haversine, haversine_sql, is_airport_trip, near_airport, trip_distance
from .scalar import nan_to_null, numeric_to_label, passenger_valid_flag, pct_of_total, pearson
from .timeparts import day_name, parse_pickup_time, time_parts, weekday_monday0

__all__ = [
    "haversine",
    "haversine_sql",
    "is_airport_trip",
    "near_airport",
    "trip_distance",
    "nan_to_null",
    "numeric_to_label",
    "passenger_valid_flag",
    "pct_of_total",
    "pearson",
    "day_name",
    "parse_pickup_time",
    "time_parts",
    "weekday_monday0",
]
