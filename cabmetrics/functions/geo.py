"""Great-circle distance and airport proximity as built-in column expressions.

Everything here stays inside whole-stage codegen: no Python UDF.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import AIRPORT_RADIUS_KM, AIRPORTS, EARTH_RADIUS_KM


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(float(x))


def haversine(lat1, lon1, lat2, lon2, radius_km: float = EARTH_RADIUS_KM) -> Column:
    """Haversine distance in km between two points given in degrees.

    ``sqrt(a)`` is clamped to 1 so rounding on near-antipodal points cannot
    push ``asin`` out of its domain (it would return NaN). The clamp is a
    CASE, not ``least``: ``least`` skips nulls and would turn a missing
    coordinate into half the Earth's circumference. NaN compares as largest in
    Spark, so it is let through explicitly and stays NaN.
    """
    lat1, lon1, lat2, lon2 = map(_c, (lat1, lon1, lat2, lon2))
    half_dlat = F.sin(F.radians(lat2 - lat1) / 2)
    half_dlon = F.sin(F.radians(lon2 - lon1) / 2)
    a = half_dlat * half_dlat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_dlon * half_dlon
    root = F.sqrt(a)
    return F.lit(2.0 * radius_km) * F.asin(F.when((root > F.lit(1.0)) & ~F.isnan(root), F.lit(1.0)).otherwise(root))


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str, radius_km: float = EARTH_RADIUS_KM) -> str:
    """The same distance as SQL text, for ``spark.sql`` / ``selectExpr`` users."""
    root = (
        f"sqrt(sin(radians({lat2} - {lat1}) / 2) * sin(radians({lat2} - {lat1}) / 2) + "
        f"cos(radians({lat1})) * cos(radians({lat2})) * "
        f"sin(radians({lon2} - {lon1}) / 2) * sin(radians({lon2} - {lon1}) / 2))"
    )
    return f"({2.0 * radius_km!r} * asin(CASE WHEN {root} > 1.0D AND NOT isnan({root}) THEN 1.0D ELSE {root} END))"


def trip_distance(prefix_pick: str = "pickup", prefix_drop: str = "dropoff") -> Column:
    """Distance between the pickup and dropoff columns of a trip row."""
    return haversine(
        f"{prefix_pick}_latitude",
        f"{prefix_pick}_longitude",
        f"{prefix_drop}_latitude",
        f"{prefix_drop}_longitude",
    )


def near_airport(lat, lon, airport_lat: float, airport_lon: float, radius_km: float = AIRPORT_RADIUS_KM) -> Column:
    """True when the point lies within ``radius_km`` of the airport (bound included)."""
    return haversine(lat, lon, airport_lat, airport_lon) <= F.lit(float(radius_km))


def is_airport_trip(airports=AIRPORTS, radius_km: float = AIRPORT_RADIUS_KM) -> Column:
    """1.0 when either end of the trip is near any airport, else 0.0 (null if a coordinate is null)."""
    conds = []
    for _, alat, alon in airports:
        conds.append(near_airport("pickup_latitude", "pickup_longitude", alat, alon, radius_km))
        conds.append(near_airport("dropoff_latitude", "dropoff_longitude", alat, alon, radius_km))
    return reduce(or_, conds).cast("double")
