"""Trip tables derived from the driver's tables (design in FIXTURES.md §2).

The derivation is a pure projection of ``events`` (or ``orders``), so it is
a narrow, shuffle-free stage whose cost grows linearly with the input; only
the columns it needs are read from parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import TRIP_COLUMNS


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def trips_from_events(events: DataFrame, edge_cases: bool = True) -> DataFrame:
    """Trip rows with planted defects: negative and null fares, zero GPS fixes,
    null dropoff latitudes and passenger counts 0 and 7.

    ``edge_cases`` adds what the reports must tell apart: fares of many
    decimals, below 1, above 100, very large and NaN; trips to JFK and EWR,
    of 30-50 km and of more than 50 km, and ends that only the wide box
    holds; a NaN coordinate; null keys, times and passenger counts; pickup
    times spread over 900 days.
    """
    eid, uid, ts, value = F.col("event_id"), F.col("user_id"), F.col("ts"), F.col("value")

    def mod2000(*terms):
        # (sum of a_i * b_i) % 2000 reduced term by term, so the products stay
        # small: the same values as the plain formula, without the bigint
        # overflow (an ANSI error) the plain products hit for ids above ~2.8e11
        return sum(((a % 2000) * (b % 2000) for a, b in terms), F.lit(0)) % 2000

    def cases(default, *pairs):
        out = default
        for cond, v in reversed(pairs):
            out = F.when(cond, F.lit(v) if isinstance(v, float) else v).otherwise(out)
        return out

    def every(m, r):
        return F.lit(edge_cases) & (eid % m == r)

    # Fixed values of the fixture design (FIXTURES.md §2): multipliers,
    # moduli and offsets that spread the points over the city box.
    null = F.lit(None).cast("double")
    plon = cases(F.lit(-74.05) + mod2000((eid, 7919)) / 1e4, (eid % 20 == 0, -73.7781), (every(113, 4), -74.2))
    plat = cases(F.lit(40.65) + mod2000((eid, 104729)) / 1e4, (eid % 20 == 0, 40.6413), (every(113, 4), 40.55))
    ends = (every(40, 1), -74.1745, 40.6895), (every(40, 2), -73.7781, 40.6413), (every(113, 4), -73.0, 40.95), (every(109, 5), -73.6, 40.9), (every(103, 6), -74.6, 40.7)
    dlon = cases(F.lit(-74.05) + mod2000((eid, 15485863), (uid, 31)) / 1e4, *((c, lon) for c, lon, _ in ends))
    dlat = cases(F.lit(40.65) + mod2000((eid, 32452843), (uid, 17)) / 1e4, *((c, lat) for c, _, lat in ends))
    rush = F.when(F.hour(ts).between(16, 19), F.lit(1.0)).otherwise(F.lit(0.0))
    base = F.round(F.lit(2.5) + F.lit(160.0) * (F.abs(plon - dlon) + F.abs(plat - dlat)) + value / 1e2 + rush, 2)
    decimals = (eid % 997) / F.lit(997.0) * F.lit(0.01)
    fare = cases(
        base + decimals if edge_cases else base,
        (eid % 67 == 0, -value),
        (eid % 71 == 0, null),
        (every(1979, 12), 1e6),
        (every(1973, 13), float("nan")),
        (every(89, 8), 0.55),
        (every(97, 10), F.lit(150.25) + decimals),
    )
    time = ts + F.make_dt_interval(days=(eid % 900).cast("int")) if edge_cases else ts
    return events.select(
        F.when(~every(2003, 11), eid.cast("string")).alias("key"),
        fare.alias("fare_amount"),
        F.when(~every(1999, 7), time).cast("timestamp").alias("pickup_datetime"),
        F.when(eid % 53 == 0, F.lit(0.0)).otherwise(plon).alias("pickup_longitude"),
        cases(plat, (eid % 53 == 0, 0.0), (every(1987, 9), float("nan"))).alias("pickup_latitude"),
        dlon.alias("dropoff_longitude"),
        cases(dlat, (eid % 101 == 0, null)).alias("dropoff_latitude"),
        F.when(~every(1997, 3), uid % 8).alias("passenger_count"),
    )


def trips_from_orders(orders: DataFrame) -> DataFrame:
    """Multi-year trip-like rows (key, fare_amount, pickup_datetime) for yearly reports."""
    return orders.select(
        F.col("o_orderkey").cast("string").alias("key"),
        (F.col("o_totalprice") / 1000).alias("fare_amount"),
        F.col("o_orderdate").cast("timestamp").alias("pickup_datetime"),
    )


def fixture_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw (uncleaned) trips of a scale-factor directory."""
    return trips_from_events(load_table(spark, sf_dir, "events")).select(*TRIP_COLUMNS)


def fixture_yearly_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips_from_orders(load_table(spark, sf_dir, "orders"))
