"""


The Spark side lives in ``cabmetrics.plans.catalog``; this file only wires
names to it and holds the independent DuckDB text of each answer. Model
training queries (MLlib) have no SQL twin and get the rows-only check.
"""

from __future__ import annotations

import math
import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# the package sits next to this file; the driver may load this module by path
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

SF_SMOKE = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: raw trips -> cleaning -> distance + calendar -> mean fare by hour."""
    from cabmetrics.plans.catalog import REGISTRY

    return REGISTRY["fare_by_hour"](spark, SF_SMOKE)


def _training_data():
    """The training-data queries and the pipeline, or None: they are optional, and so is what they import."""
    try:
        import corpus_pipeline
        from cabmetrics.llm import queries as training
    except ImportError:
        return None
    return training, corpus_pipeline


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from cabmetrics.plans.catalog import REGISTRY

    found = dict(REGISTRY)
    training = _training_data()
    if training is not None:
        found |= training[0].QUERIES | {"pipeline": training[1].run}
    return found


# =============================================================================
# DuckDB oracle
# =============================================================================

_TRIPS = """
ev AS (
  SELECT event_id, ts, user_id, value,
    CASE WHEN event_id % 20 = 0 THEN CAST(-73.7781 AS DOUBLE)
         WHEN event_id % 113 = 4 THEN CAST(-74.2 AS DOUBLE)
         ELSE CAST(-74.05 AS DOUBLE) + ((event_id*7919) % 2000)/1e4 END AS plon,
    CASE WHEN event_id % 20 = 0 THEN CAST(40.6413 AS DOUBLE)
         WHEN event_id % 113 = 4 THEN CAST(40.55 AS DOUBLE)
         ELSE CAST(40.65 AS DOUBLE) + ((event_id*104729) % 2000)/1e4 END AS plat,
    CASE WHEN event_id % 40 = 1 THEN CAST(-74.1745 AS DOUBLE)
         WHEN event_id % 40 = 2 THEN CAST(-73.7781 AS DOUBLE)
         WHEN event_id % 113 = 4 THEN CAST(-73.0 AS DOUBLE)
         WHEN event_id % 109 = 5 THEN CAST(-73.6 AS DOUBLE)
         WHEN event_id % 103 = 6 THEN CAST(-74.6 AS DOUBLE)
         ELSE CAST(-74.05 AS DOUBLE) + ((event_id*15485863 + user_id*31) % 2000)/1e4 END AS dlon,
    CASE WHEN event_id % 40 = 1 THEN CAST(40.6895 AS DOUBLE)
         WHEN event_id % 40 = 2 THEN CAST(40.6413 AS DOUBLE)
         WHEN event_id % 113 = 4 THEN CAST(40.95 AS DOUBLE)
         WHEN event_id % 109 = 5 THEN CAST(40.9 AS DOUBLE)
         WHEN event_id % 103 = 6 THEN CAST(40.7 AS DOUBLE)
         ELSE CAST(40.65 AS DOUBLE) + ((event_id*32452843 + user_id*17) % 2000)/1e4 END AS dlat,
    (event_id % 997) / CAST(997 AS DOUBLE) * CAST(0.01 AS DOUBLE) AS decimals
  FROM events),
trips AS (
  SELECT CASE WHEN event_id % 2003 <> 11 THEN CAST(event_id AS VARCHAR) END AS key,
    CASE WHEN event_id % 67 = 0 THEN -value
         WHEN event_id % 71 = 0 THEN CAST(NULL AS DOUBLE)
         WHEN event_id % 1979 = 12 THEN CAST(1000000 AS DOUBLE)
         WHEN event_id % 1973 = 13 THEN CAST('NaN' AS DOUBLE)
         WHEN event_id % 89 = 8 THEN CAST(0.55 AS DOUBLE)
         WHEN event_id % 97 = 10 THEN CAST(150.25 AS DOUBLE) + decimals
         ELSE round(CAST(2.5 AS DOUBLE) + 160.0e0*(abs(plon-dlon)+abs(plat-dlat)) + value/1e2
                    + (CASE WHEN hour(ts) BETWEEN 16 AND 19 THEN 1e0 ELSE 0e0 END), 2) + decimals END AS fare_amount,
    CASE WHEN event_id % 1999 <> 7 THEN CAST(ts + to_days(CAST(event_id % 900 AS INTEGER)) AS TIMESTAMP) END AS pickup_datetime,
    CASE WHEN event_id % 53 = 0 THEN 0e0 ELSE plon END AS pickup_longitude,
    CASE WHEN event_id % 53 = 0 THEN 0e0 WHEN event_id % 1987 = 9 THEN CAST('NaN' AS DOUBLE) ELSE plat END AS pickup_latitude,
    dlon AS dropoff_longitude,
    CASE WHEN event_id % 101 = 0 THEN CAST(NULL AS DOUBLE) ELSE dlat END AS dropoff_latitude,
    CASE WHEN event_id % 1997 <> 3 THEN user_id % 8 END AS passenger_count
  FROM ev)"""


def _dist(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    root = (
        f"sqrt(sin(radians({lat2} - {lat1})/2)*sin(radians({lat2} - {lat1})/2) + "
        f"cos(radians({lat1}))*cos(radians({lat2}))*"
        f"sin(radians({lon2} - {lon1})/2)*sin(radians({lon2} - {lon1})/2))"
    )
    return f"(2*6371.0e0*asin(CASE WHEN {root} > 1e0 AND NOT isnan({root}) THEN 1e0 ELSE {root} END))"


_TRIP_DIST = _dist("pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude")

_NOT_NULL = " AND ".join(
    [
        "key IS NOT NULL",
        "pickup_datetime IS NOT NULL",
        "passenger_count IS NOT NULL",
        *[
            f"{c} IS NOT NULL AND NOT isnan({c})"
            for c in ("fare_amount", "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude")
        ],
    ]
)
_FARE_OK = "fare_amount >= 1.0e0 AND fare_amount <= 500.0e0"
_PASS_OK = "passenger_count >= 1 AND passenger_count <= 6"
_BOX = {
    "pickup": "pickup_longitude BETWEEN -74.3e0 AND -72.9e0 AND pickup_latitude BETWEEN 40.5e0 AND 41.0e0",
    "dropoff": "dropoff_longitude BETWEEN -74.3e0 AND -72.9e0 AND dropoff_latitude BETWEEN 40.5e0 AND 41.0e0",
}
_BBOX = f"{_BOX['pickup']} AND {_BOX['dropoff']}"

# Airport points and radius (km).
_AIRPORTS = (("jfk", "40.6413e0", "-73.7781e0"), ("lga", "40.7769e0", "-73.8740e0"), ("ewr", "40.6895e0", "-74.1745e0"))


def _near(end: str, lat: str, lon: str) -> str:
    return f"({_dist(f'{end}_latitude', f'{end}_longitude', lat, lon)} <= 2.0e0)"


_AIRPORT_FLAG = "CAST((" + " OR ".join(_near(e, la, lo) for _, la, lo in _AIRPORTS for e in ("pickup", "dropoff")) + ") AS DOUBLE)"

_CALENDAR = """CAST(hour(pickup_datetime) AS INTEGER) AS hour,
    CAST(dayofweek(pickup_datetime) + 1 AS INTEGER) AS day_of_week,
    CAST(month(pickup_datetime) AS INTEGER) AS month,
    CAST(year(pickup_datetime) AS INTEGER) AS year"""

_BUCKET = "CAST(('0x' || substr(md5(coalesce(key, '')), 1, 8)) AS BIGINT) % 100"

_STAGES = f"""{_TRIPS},
clean AS (SELECT * FROM trips WHERE {_NOT_NULL} AND {_FARE_OK} AND {_PASS_OK} AND {_BBOX}),
feat AS (SELECT *, {_TRIP_DIST} AS distance_km, {_CALENDAR} FROM clean),
feat_air AS (SELECT *, {_AIRPORT_FLAG} AS is_airport_trip FROM feat),
rawfeat AS (SELECT *, {_TRIP_DIST} AS distance_km, {_CALENDAR} FROM trips),
split AS (SELECT *, {_BUCKET} AS bucket FROM feat),
train AS (SELECT * FROM split WHERE bucket < 80),
test AS (SELECT * FROM split WHERE bucket >= 80),
ytrips AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS key, o_totalprice/1000 AS fare_amount,
         CAST(o_orderdate AS TIMESTAMP) AS pickup_datetime, CAST(year(o_orderdate) AS INTEGER) AS year
  FROM orders)"""


def _q(body: str, extra: str = "") -> str:
    return f"WITH {_STAGES}{extra}\n{body}"


def _rnd(body: str, cols: list[str], extra: str = "") -> str:
    rep = ", ".join(f"round({c}, 6) AS {c}" for c in cols)
    return _q(f"SELECT * REPLACE ({rep}) FROM ({body}) q", extra)


def _pct(a: str, b: str) -> str:
    return f"round(100e0 * ({a}) / nullif(CAST(({b}) AS DOUBLE), 0), 2)"


def _rule_preds(train: str = "train") -> str:
    return f""",
st_{train} AS (SELECT avg(fare_amount) AS mean, regr_slope(fare_amount, distance_km) AS slope,
                 regr_intercept(fare_amount, distance_km) AS intercept FROM {train}),
hr_{train} AS (SELECT hour, avg(fare_amount) AS hour_mean FROM {train} GROUP BY hour),
preds_{train} AS (
  SELECT t.key, t.fare_amount AS label, t.distance_km, t.hour, s.mean AS p_mean,
         coalesce(h.hour_mean, s.mean) AS p_hour, s.intercept + s.slope * t.distance_km AS p_dist
  FROM test t CROSS JOIN st_{train} s LEFT JOIN hr_{train} h ON t.hour = h.hour)"""


def _metric_sql(name: str, p: str, src: str) -> str:
    e = f"(label - {p})"
    return (
        f"SELECT '{name}' AS Model, round(sqrt(avg({e}*{e})), 6) AS RMSE, round(avg(abs({e})), 6) AS MAE, "
        f"round(1e0 - sum({e}*{e}) / ((count(label) - 1) * var_samp(label)), 6) AS R2 FROM {src}"
    )


def _metrics_cte(train: str = "train") -> str:
    src = f"preds_{train}"
    return (
        _rule_preds(train)
        + f""",
metrics_{train} AS ({_metric_sql('Train mean', 'p_mean', src)}
  UNION ALL {_metric_sql('Hourly mean', 'p_hour', src)}
  UNION ALL {_metric_sql('Distance rate', 'p_dist', src)})"""
    )


_RAWTRAIN = f""",
rawclean AS (SELECT * FROM rawfeat WHERE {_NOT_NULL} AND distance_km IS NOT NULL AND NOT isnan(distance_km)
             AND hour IS NOT NULL AND day_of_week IS NOT NULL AND month IS NOT NULL AND year IS NOT NULL),
rawtrain AS (SELECT * FROM rawclean WHERE {_BUCKET} < 80)"""


# A stream of two deliveries: what reaches the windows, and which of them are closed.
_STREAM = f""",
delivered AS (
  SELECT *, coalesce(pickup_datetime < (SELECT min(pickup_datetime) FROM trips) + INTERVAL 450 DAY, true) AS early,
         coalesce(TRY_CAST(key AS BIGINT) % 41 = 5, false) AS held_back, coalesce(TRY_CAST(key AS BIGINT) % 50 = 7, false) AS again
  FROM trips),
arrived AS (
  SELECT *, 1 AS run FROM delivered WHERE early AND NOT held_back
  UNION ALL SELECT *, 2 FROM delivered WHERE NOT early OR held_back OR again),
sound AS (SELECT * FROM arrived WHERE {_NOT_NULL} AND {_FARE_OK} AND {_PASS_OK} AND {_BBOX}),
marks AS (
  SELECT date_trunc('millisecond', max(pickup_datetime) FILTER (WHERE run = 1)) - INTERVAL 30 DAY AS first_mark,
         date_trunc('millisecond', max(pickup_datetime)) - INTERVAL 30 DAY AS last_mark FROM sound),
intime AS (SELECT sound.* FROM sound, marks WHERE run = 1 OR pickup_datetime > first_mark),
once AS (SELECT * FROM intime QUALIFY row_number() OVER (PARTITION BY key ORDER BY run) = 1)"""


_BAND = """CASE WHEN distance_km >= 0 AND distance_km < 5 THEN '0-5 km' WHEN distance_km >= 5 AND distance_km < 20 THEN '5-20 km'
  WHEN distance_km >= 20 AND distance_km < 30 THEN '20-30 km' WHEN distance_km >= 30 THEN '30+ km' END"""


def _quantiles(col: str, probs) -> str:
    return ", ".join(f"round(quantile_cont({col}, {p}), 6) AS p{p * 100:g}" for p in probs)


# Intervals of the rule baseline: fitted on folds 0-2 of the training side, widths from fold 3.
_INTERVALS = f""",
folded AS (SELECT *, CAST(('0x' || substr(md5(coalesce(key, '')), 9, 8)) AS BIGINT) % 4 AS fold, {_BAND} AS band FROM train),
line AS (SELECT regr_slope(fare_amount, distance_km) AS slope, regr_intercept(fare_amount, distance_km) AS intercept FROM folded WHERE fold < 3),
sizes AS (SELECT band, abs(fare_amount - (intercept + slope * distance_km)) AS size FROM folded, line WHERE fold = 3),
ranked AS (SELECT band, size, row_number() OVER (PARTITION BY band ORDER BY size) AS place, count(*) OVER (PARTITION BY band) AS n FROM sizes),
widths AS (SELECT band, any_value(n) AS n, max(size) FILTER (WHERE place = CAST(ceil((n + 1) * 0.9e0 - 1e-9) AS BIGINT)) AS half_width FROM ranked GROUP BY band),
guess AS (SELECT key, fare_amount AS label, {_BAND} AS band, intercept + slope * distance_km AS prediction FROM test, line),
ends AS (
  SELECT guess.*, n, half_width, CASE WHEN half_width IS NOT NULL THEN greatest(0e0, prediction - half_width) END AS low, prediction + half_width AS high
  FROM guess LEFT JOIN widths ON widths.band IS NOT DISTINCT FROM guess.band)"""


_LEVELS = 12


def _bits(v: str, up: int) -> str:
    return " + ".join(f"((({v} >> {b}) & 1) << {2 * b + up})" for b in range(_LEVELS))


def _unbits(v: str, up: int) -> str:
    return "(" + " + ".join(f"((({v} >> {2 * b + up}) & 1) << {b})" for b in range(_LEVELS)) + ")"


_QUADTREE = f""",
spots AS (SELECT least(CAST(floor((pickup_longitude - (-74.3e0)) / (-72.9e0 - (-74.3e0)) * 4096) AS BIGINT), 4095) AS x,
                 least(CAST(floor((pickup_latitude - 40.5e0) / (41e0 - 40.5e0) * 4096) AS BIGINT), 4095) AS y
          FROM trips WHERE {_BOX['pickup']} AND NOT isnan(pickup_longitude) AND NOT isnan(pickup_latitude)),
fine AS (SELECT {_bits('x', 0)} + {_bits('y', 1)} AS z FROM spots),
cells AS (SELECT CAST(level AS INTEGER) AS level, z >> (2 * ({_LEVELS} - CAST(level AS INTEGER))) AS cell, count(*) AS n FROM fine, range({_LEVELS} + 1) r(level) GROUP BY ALL),
leaves AS (
  SELECT c.* FROM cells c WHERE (c.n <= 50 OR c.level = {_LEVELS})
  AND (c.level = 0 OR EXISTS (SELECT 1 FROM cells p WHERE p.level = c.level - 1 AND p.cell = c.cell >> 2 AND p.n > 50)))"""

# Six-sided zones around the heavy pickup cells; a point lies in one if no side has it on the right.
_CORNERS = [(f"(x + 0.5e0) * 0.01e0 + {math.cos(math.pi * k / 3 + 0.3) * 0.01317!r}", f"(y + 0.5e0) * 0.01e0 + {math.sin(math.pi * k / 3 + 0.3) * 0.01317!r}") for k in range(6)]
_INSIDE = " AND ".join(
    f"(({x2}) - ({x1})) * (pickup_latitude - ({y1})) - (({y2}) - ({y1})) * (pickup_longitude - ({x1})) > 0"
    for (x1, y1), (x2, y2) in zip(_CORNERS, _CORNERS[1:] + _CORNERS[:1], strict=True)
)


def _heavy(src: str) -> str:
    return f""",
celled AS (SELECT *, CAST(floor(pickup_longitude / 0.01e0) AS BIGINT) AS px, CAST(floor(pickup_latitude / 0.01e0) AS BIGINT) AS py FROM {src}),
heavy AS (SELECT px AS x, py AS y FROM celled GROUP BY px, py HAVING count(*) >= 0.0025e0 * (SELECT count(*) FROM celled))"""


_N = "TRY_CAST(key AS BIGINT)"
_SPOILT = f""",
told AS (SELECT *, CASE WHEN {_N} % 223 = 5 OR {_N} % 227 = 7 THEN 'columns' WHEN {_N} % 211 = 3 THEN 'fare_amount'
                        WHEN {_N} % 233 = 13 THEN 'passenger_count' WHEN {_N} % 229 = 11 THEN 'pickup_datetime' ELSE 'good' END AS reason FROM trips)"""


def _hist(src: str, col: str, bins: int) -> str:
    w = f"((he.hi - he.lo) / {bins})"
    b0 = f"least(CAST(floor({bins}e0 * (x - he.lo) / (he.hi - he.lo)) AS BIGINT) + 1, {bins})"
    return f""",
hv AS (SELECT {col} AS x FROM {src} WHERE {col} IS NOT NULL AND NOT isnan({col})),
hmm AS (SELECT min(x) AS lo, max(x) AS hi FROM hv),
he AS (SELECT CASE WHEN lo = hi THEN lo - 0.5e0 ELSE lo END AS lo,
              CASE WHEN lo = hi THEN hi + 0.5e0 ELSE hi END AS hi FROM hmm),
hb AS (SELECT x, {b0} AS b0 FROM hv, he),
hc AS (SELECT CASE WHEN x < (b0 - 1) * {w} + he.lo THEN b0 - 1
                   WHEN x >= b0 * {w} + he.lo AND b0 <> {bins} THEN b0 + 1 ELSE b0 END AS bin, count(*) AS n
       FROM hb, he GROUP BY 1),
hg AS (SELECT range AS bin FROM range(1, {bins + 1}))"""


_HIST_BODY = """SELECT hg.bin, round((hg.bin - 1) * ((he.hi - he.lo) / {bins}) + he.lo, 6) AS low,
       round(CASE WHEN hg.bin = {bins} THEN he.hi ELSE hg.bin * ((he.hi - he.lo) / {bins}) + he.lo END, 6) AS high,
       coalesce(hc.n, 0) AS n
FROM hg CROSS JOIN he LEFT JOIN hc ON hg.bin = hc.bin WHERE he.lo IS NOT NULL"""


def _hist_q(src: str, col: str, bins: int, extra: str = "") -> str:
    return _q(_HIST_BODY.format(bins=bins), extra + _hist(src, col, bins))


_TRIP_COLS = [
    "key",
    "fare_amount",
    "pickup_datetime",
    "pickup_longitude",
    "pickup_latitude",
    "dropoff_longitude",
    "dropoff_latitude",
    "passenger_count",
]
_FEAT_DOUBLES = ["fare_amount", "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude", "distance_km"]
_NUMERIC = ["fare_amount", "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude", "passenger_count"]
# The feature orders of the two feature sets.
_TREE = [
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
_PREP = [
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
_FEAT_SELECT = ", ".join(_TRIP_COLS + ["distance_km", "hour", "day_of_week", "month", "year"])
_DOUBLES = ["fare_amount", "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude"]


def _number(c: str) -> str:
    """The column as a number, NaN as null."""
    return f"(CASE WHEN isnan({c}) THEN NULL ELSE {c} END)" if c in _DOUBLES else f"CAST({c} AS DOUBLE)"


_NO_NAN = "SELECT * REPLACE (" + ", ".join(f"{_number(c)} AS {c}" for c in _DOUBLES) + ") FROM trips"
_METRICS = "SELECT * FROM metrics_train"
_IMPORTANCES = "SELECT CAST(10 AS BIGINT) AS n_features, 1e0 AS total, true AS ranked FROM train HAVING count(*) > 0"
_DN = ["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"]
_DAY_NAME = "[" + ", ".join(f"'{d}'" for d in _DN) + "][day_of_week]"
_VALIDITY = (
    "CASE WHEN passenger_count IS NULL THEN NULL WHEN passenger_count BETWEEN 1 AND 6 THEN 'valid' ELSE 'anomaly' END"
)


def _mean(col: str = "fare_amount") -> str:
    return f"round(avg({_number(col)}), 6)"


def _grouped(src: str, by: str) -> str:
    return f"SELECT {by}, {_mean()} AS avg_fare, count(key) AS trip_count FROM {src} WHERE {by} IS NOT NULL GROUP BY {by}"


def _corr_union(pairs, src: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS corr FROM {src}"
        for a, b in pairs
    )


def _null_profile() -> str:
    parts = []
    for i, c in enumerate(_TRIP_COLS):
        miss = f"{c} IS NULL" + (f" OR isnan({c})" if c in _NUMERIC and c != "passenger_count" else "")
        parts.append(
            f"SELECT {i + 1} AS position, '{c}' AS \"column\", count_if({miss}) AS n_null, "
            f"{_pct(f'count_if({miss})', 'count(*)')} AS pct_null FROM trips"
        )
    return " UNION ALL ".join(parts)


def _describe() -> str:
    parts = []
    for i, c in enumerate(_NUMERIC):
        x = _number(c)
        parts.append(
            f"SELECT {i + 1} AS position, '{c}' AS \"column\", count({x}) AS count, round(avg({x}), 6) AS mean, "
            f"round(stddev_samp({x}), 6) AS std, round(min({x}), 6) AS min, "
            f"round(quantile_cont({x}, 0.25), 6) AS p25, round(quantile_cont({x}, 0.5), 6) AS p50, "
            f"round(quantile_cont({x}, 0.75), 6) AS p75, round(max({x}), 6) AS max FROM trips"
        )
    return " UNION ALL ".join(parts)


def _stage_counts() -> str:
    nn = f"({_NOT_NULL})"
    ok = f"({_NOT_NULL} AND {_FARE_OK} AND {_PASS_OK} AND {_BBOX})"
    return f""",
sc AS (SELECT count(*) AS n0, count_if({nn}) AS n1, count_if({ok}) AS n2 FROM trips)"""


def _scale(feats: list[str] = _TREE, src: str = "feat", train: str = "train", keep: str = "") -> str:
    stats = ", ".join(
        f"avg(CAST({c} AS DOUBLE)) AS m_{c}, stddev_samp(CAST({c} AS DOUBLE)) AS s_{c}" for c in feats
    )
    cols = ", ".join(
        f"round(CASE WHEN s.s_{c} = 0 THEN 0e0 ELSE (CAST(f.{c} AS DOUBLE) - s.m_{c}) * (1e0 / s.s_{c}) END, 6) AS {c}"
        for c in feats
    )
    return _q(f"SELECT f.key, {keep}{cols} FROM {src} f CROSS JOIN sstats s", f",\nsstats AS (SELECT {stats} FROM {train})")


def _vector_cols(src: str, feats: list[str], where: str = "", keep: str = "") -> str:
    cols = ", ".join(f"round(CAST({c} AS DOUBLE), 6) AS {c}" for c in feats)
    return _q(f"SELECT key, {keep}{cols} FROM {src}{where}")


def _residuals() -> str:
    e = "(label - p_dist)"
    return _q(
        f"SELECT count(*) AS n, round(avg({e}), 6) AS mean_residual, round(stddev_samp({e}), 6) AS std_residual, "
        f"count_if(abs({e}) > 10e0) AS n_big_error, {_pct(f'count_if(abs({e}) > 10e0)', 'count(*)')} AS pct_big_error "
        "FROM preds_train",
        _rule_preds("train"),
    )


def _segments() -> str:
    e = "(label - p_dist)"
    band = (
        "CASE WHEN distance_km >= 0e0 AND distance_km < 5e0 THEN '0-5 km' "
        "WHEN distance_km >= 5e0 AND distance_km < 20e0 THEN '5-20 km' "
        "WHEN distance_km >= 20e0 AND distance_km < 30e0 THEN '20-30 km' "
        "WHEN distance_km >= 30e0 THEN '30+ km' END"
    )
    agg = f"count(*) AS n, round(sqrt(avg({e}*{e})), 6) AS rmse, round(avg(abs({e})), 6) AS mae, round(avg({e}), 6) AS bias"
    return _q(
        f"SELECT 'distance' AS segment, {band} AS bucket, {agg} FROM preds_train WHERE {band} IS NOT NULL GROUP BY 2 "
        f"UNION ALL SELECT 'hour' AS segment, CAST(hour AS VARCHAR) AS bucket, {agg} FROM preds_train "
        "WHERE hour IS NOT NULL GROUP BY 2",
        _rule_preds("train"),
    )


def _compare() -> str:
    return _q(
        """SELECT m.metric, m.before, m.after, round(m.after - m.before, 6) AS change FROM (
  SELECT 'RMSE' AS metric, b.RMSE AS before, a.RMSE AS after FROM metrics_train a LEFT JOIN metrics_rawtrain b ON a.Model = b.Model WHERE a.Model = 'Distance rate'
  UNION ALL SELECT 'MAE', b.MAE, a.MAE FROM metrics_train a LEFT JOIN metrics_rawtrain b ON a.Model = b.Model WHERE a.Model = 'Distance rate'
  UNION ALL SELECT 'R2', b.R2, a.R2 FROM metrics_train a LEFT JOIN metrics_rawtrain b ON a.Model = b.Model WHERE a.Model = 'Distance rate') m""",
        _RAWTRAIN + _metrics_cte("train") + _metrics_cte("rawtrain"),
    )


def _bigint_counts(sql: str) -> str:
    """``count_if(c)`` is HUGEINT in DuckDB; ``count(*) FILTER (WHERE c)`` is BIGINT like Spark's."""
    out, i, tok = [], 0, "count_if("
    while True:
        j = sql.find(tok, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        out.append(sql[i:j])
        depth, k = 1, j + len(tok)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        out.append(f"(count(*) FILTER (WHERE {_bigint_counts(sql[j + len(tok):k - 1])}))")
        i = k


def oracle_sql() -> dict[str, str]:
    """DuckDB text of each answer over the pre-registered tables."""
    found = {k: _bigint_counts(v) for k, v in _oracle_sql().items()}
    training = _training_data()
    if training is not None:
        found |= training[0].ORACLE_SQL
        if training[1].ORACLE_SQL is not None:
            found["pipeline"] = training[1].ORACLE_SQL
    return found


def _oracle_sql() -> dict[str, str]:
    near_cols = ", ".join(
        f"{_near(end, la, lo)} AS {end}_near_{code}" for code, la, lo in _AIRPORTS for end in ("pickup", "dropoff")
    )
    box_any = " OR ".join(
        f"coalesce({c}, false)"
        for e in ("pickup", "dropoff")
        for c in (
            f"{e}_longitude < -74.3e0",
            f"{e}_longitude > -72.9e0",
            f"{e}_latitude < 40.5e0",
            f"{e}_latitude > 41.0e0",
        )
    )
    quart = """,
fq AS (SELECT quantile_cont(fare_amount, 0.25) AS q1, quantile_cont(fare_amount, 0.75) AS q3 FROM trips
       WHERE fare_amount IS NOT NULL AND NOT isnan(fare_amount)),
fb AS (SELECT q1, q3, q3 - q1 AS iqr, q1 - 1.5e0 * (q3 - q1) AS lower, q3 + 1.5e0 * (q3 - q1) AS upper FROM fq)"""
    def sample(size: int) -> str:
        return (
            "SELECT key, fare_amount FROM trips WHERE "
            "CAST(('0x' || substr(md5(coalesce(key, '') || ':42'), 1, 8)) AS BIGINT) / 4294967296e0 "
            f"< least({size}e0 / (SELECT count(*) FROM trips), 1e0)"
        )

    temporal = (
        f"SELECT 'hour' AS kind, hour AS bucket, count(key) AS trip_count, {_mean()} AS avg_fare "
        "FROM feat WHERE hour IS NOT NULL GROUP BY hour UNION ALL "
        f"SELECT 'day', day_of_week, count(key), {_mean()} FROM feat "
        "WHERE day_of_week IS NOT NULL GROUP BY day_of_week"
    )
    pairs = [(a, b) for i, a in enumerate(_NUMERIC) for b in _NUMERIC[i + 1 :]]
    corr_target = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", round(corr({_number('fare_amount')}, {_number(c)}), 6) AS corr FROM trips"
        for c in _NUMERIC[1:]
    )
    complete = " AND ".join(f"{c} IS NOT NULL" + (f" AND NOT isnan({c})" if c != "passenger_count" else "") for c in _NUMERIC)
    return {
        # facts about fitted models
        "check_fit_with_fallback": _q("SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_differences, 'fallback' AS status, true AS error_is_told FROM test"),
        "saved_parameters": "SELECT * FROM (VALUES ('VectorAssembler', NULL::BIGINT, NULL::BIGINT, NULL::BIGINT, 10), ('RandomForestRegressionModel', 50, 10, 42, NULL)) v(stage, num_trees, max_depth, seed, n_inputs)",
        "check_predict_rows": _rnd("SELECT key, fare_amount AS label FROM test", ["label"]),
        "check_tuned_rows": _rnd("SELECT key, fare_amount AS label, distance_km, hour FROM test", ["label", "distance_km"]),
        "check_model_metrics": "SELECT Model, true AS mae_within_rmse, true AS r2_below_one FROM (VALUES ('Linear Regression'), ('Random Forest'), ('Gradient Boosted Trees')) v(Model)",
        # quarantine, sinks that run again
        "quarantine_report": _q("SELECT reason, count(*) AS n_rows FROM told GROUP BY reason", _SPOILT),
        "quarantine_good": _q(_NO_NAN.replace("FROM trips", "FROM (SELECT * EXCLUDE (reason) FROM told WHERE reason = 'good')"), _SPOILT),
        "quarantine_bad": _q("SELECT key, reason FROM told WHERE reason <> 'good'", _SPOILT),
        "source_preferred": _q("SELECT * FROM clean"),
        "source_without_columns": _q("SELECT 'pickup_datetime,dropoff_latitude' AS missing, count(*) AS n_rows FROM clean"),
        "republish_trips": _q(
            "SELECT 'first' AS read, count(*) AS n_rows, count(DISTINCT key) AS n_keys FROM trips UNION ALL "
            "SELECT 'reader of the first', count(*), count(DISTINCT key) FROM trips UNION ALL SELECT 'latest', count(*), count(DISTINCT key) FROM clean"
        ),
        "rerun_partitions": _q(
            "SELECT CAST(year(pickup_datetime) AS INTEGER) AS year, count(*) AS n_rows, count(DISTINCT key) AS n_keys FROM "
            "(SELECT * FROM trips WHERE year(pickup_datetime) IS DISTINCT FROM 2025 UNION ALL SELECT * FROM clean WHERE year(pickup_datetime) = 2025) GROUP BY 1"
        ),
        "check_republished_model": _q("SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_differences, 2 AS n_versions FROM test"),
        # zones, adaptive cells, stored sketches
        "pickup_quadtree": _q(
            f"SELECT level, cell, n, round(-74.3e0 + {_unbits('cell', 0)} * (1e0 / (1 << level)) * (-72.9e0 - (-74.3e0)), 9) AS west, "
            f"round(40.5e0 + {_unbits('cell', 1)} * (1e0 / (1 << level)) * (41e0 - 40.5e0), 9) AS south, "
            f"round(-74.3e0 + ({_unbits('cell', 0)} + 1) * (1e0 / (1 << level)) * (-72.9e0 - (-74.3e0)), 9) AS east, "
            f"round(40.5e0 + ({_unbits('cell', 1)} + 1) * (1e0 / (1 << level)) * (41e0 - 40.5e0), 9) AS north FROM leaves",
            _QUADTREE,
        ),
        "trips_by_zone": _q(
            f"SELECT concat_ws('_', x, y) AS zone, count(*) AS trip_count, round(avg(fare_amount), 6) AS avg_fare FROM clean, heavy WHERE {_INSIDE} GROUP BY x, y",
            _heavy("clean"),
        ),
        "error_by_zone": _q(
            "SELECT h.x AS cell_x, h.y AS cell_y, count(*) AS n, round(sqrt(avg(e * e)), 6) AS rmse, round(avg(abs(e)), 6) AS mae, round(avg(e), 6) AS bias FROM "
            "(SELECT *, fare_amount - (intercept + slope * distance_km) AS e FROM celled, st_train) c LEFT JOIN heavy h ON px = h.x AND py = h.y GROUP BY h.x, h.y",
            _rule_preds() + _heavy("test"),
        ),
        "check_sketch_quantiles": _q(
            "SELECT part, p::DOUBLE AS p, true AS all_rows, n, true AS within_bound FROM "
            "(SELECT strftime(pickup_datetime, '%Y-%m') AS part, count(*) AS n FROM clean GROUP BY 1 UNION ALL SELECT strftime(pickup_datetime, '%Y')[1:2], count(*) FROM clean GROUP BY 1), "
            "(VALUES (0.05), (0.25), (0.5), (0.75), (0.95)) v(p)"
        ),
        # quantiles of groups, intervals
        "fare_quantiles_by_hour": _q(
            f"SELECT hour, count(*) AS n, {_quantiles('fare_amount', (0.05, 0.25, 0.5, 0.75, 0.95))} FROM feat GROUP BY hour"
        ),
        "error_quantiles_by_band": _q(
            f"SELECT band, count(*) AS n, {_quantiles('size', (0.5, 0.9, 0.99))} FROM "
            f"(SELECT {_BAND} AS band, abs(label - p_dist) AS size FROM preds_train) GROUP BY band",
            _rule_preds(),
        ),
        "prediction_intervals": _q(
            "SELECT band, coalesce(any_value(n), 0) AS n_calibration, round(any_value(half_width), 6) AS half_width, count(*) AS n_test, "
            "count(*) FILTER (WHERE label BETWEEN low AND high) AS n_covered, round(count(*) FILTER (WHERE label BETWEEN low AND high) / count(*), 6) AS coverage "
            "FROM ends GROUP BY band",
            _INTERVALS,
        ),
        "fare_intervals": _rnd("SELECT key, band, prediction, low, high FROM ends", ["prediction", "low", "high"], _INTERVALS),
        # 2.13 streaming with state
        "stream_fare_by_hour": _q(
            "SELECT window_start, count(*) AS trip_count, round(sum(fare_amount), 2) AS total_fare, round(avg(fare_amount), 6) AS avg_fare "
            "FROM (SELECT date_trunc('hour', pickup_datetime) AS window_start, fare_amount FROM once), marks "
            "WHERE window_start + INTERVAL 1 HOUR <= last_mark GROUP BY window_start",
            _STREAM,
        ),
        "stream_late_rows": _q(
            "SELECT a.run, a.n_rows, a.n_late, b.n_sound - a.n_late - c.n_once AS n_repeated FROM "
            "(SELECT run, count(*) AS n_rows, 0 + (SELECT count(*) FROM sound, marks WHERE sound.run = 2 AND arrived.run = 2 AND pickup_datetime <= first_mark) AS n_late FROM arrived GROUP BY run) a "
            "JOIN (SELECT run, count(*) AS n_sound FROM sound GROUP BY run) b USING (run) JOIN (SELECT run, count(*) AS n_once FROM once GROUP BY run) c USING (run)",
            _STREAM,
        ),
        # 2.1 / 2.2 scans and sinks
        "scan_trips_schema": _q(_NO_NAN),
        "scan_trips_inferred": _q(_NO_NAN),
        "scan_parquet": _q("SELECT * FROM clean"),
        "source_fallback": _q(_NO_NAN),
        "temp_view": _q("SELECT * FROM trips"),
        "write_trips": _q("SELECT * FROM trips"),
        "verify_roundtrip": _q(
            "SELECT count(*) AS rows_written, count(*) AS rows_read, 8 AS cols_written, 8 AS cols_read, "
            "true AS same_content FROM trips"
        ),
        "verify_roundtrip_csv": _q(
            "SELECT count(*) AS rows_written, count(*) AS rows_read, 8 AS cols_written, 8 AS cols_read, "
            "true AS same_content FROM trips"
        ),
        "write_split": _q(
            "SELECT CASE WHEN bucket < 80 THEN 'train' ELSE 'test' END AS split, count(*) AS n_rows FROM split GROUP BY 1"
        ),
        "write_metrics": _q(_METRICS, _metrics_cte()),
        "metrics_csv": _q(_METRICS, _metrics_cte()),
        # 2.3 projections
        "parse_pickup_time": _q("SELECT key, pickup_datetime FROM trips"),
        "cast_features": _rnd(
            "SELECT key, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _PREP) + ", fare_amount FROM feat_air",
            _PREP + ["fare_amount"],
        ),
        "feature_projection": _rnd(f"SELECT {_FEAT_SELECT} FROM feat", _FEAT_DOUBLES),
        "select_columns": _rnd("SELECT key, distance_km, fare_amount FROM feat", ["distance_km", "fare_amount"]),
        "table_shape": _q("SELECT count(*) AS n_rows, 8 AS n_cols FROM trips"),
        # 2.4 filters
        "drop_nulls": _q(f"SELECT * FROM trips WHERE {_NOT_NULL}"),
        "fare_range": _q(f"SELECT * FROM trips WHERE {_FARE_OK}"),
        "passenger_range": _q(f"SELECT * FROM trips WHERE {_PASS_OK}"),
        "bbox_filter": _q(f"SELECT * FROM trips WHERE {_BBOX}"),
        "clean_trips": _q("SELECT * FROM clean"),
        "clean_trips_report_rule": _q(
            f"SELECT * FROM trips WHERE {_NOT_NULL} AND fare_amount >= 0e0 AND fare_amount <= 500e0 AND {_PASS_OK} "
            "AND pickup_longitude BETWEEN -75e0 AND -72e0 AND pickup_latitude BETWEEN 40e0 AND 42e0 "
            "AND dropoff_longitude BETWEEN -75e0 AND -72e0 AND dropoff_latitude BETWEEN 40e0 AND 42e0"
        ),
        "outside_bbox": _q(
            f"SELECT count_if({box_any}) AS n_outside, count(*) AS n_total, "
            f"{_pct(f'count_if({box_any})', 'count(*)')} AS pct_outside FROM trips"
        ),
        "pickup_in_bbox": _q(f"SELECT * FROM trips WHERE {_BOX['pickup']}"),
        "fare_display_range": _q("SELECT * FROM trips WHERE fare_amount > 0 AND fare_amount <= 100e0"),
        "distance_cap": _rnd(f"SELECT {_FEAT_SELECT} FROM feat WHERE distance_km <= 50e0", _FEAT_DOUBLES),
        "iqr_outliers": _q(
            "SELECT count_if(NOT isnan(t.fare_amount) AND (t.fare_amount < fb.lower OR t.fare_amount > fb.upper)) AS n_outliers, count(*) AS n_total, "
            + _pct("count_if(NOT isnan(t.fare_amount) AND (t.fare_amount < fb.lower OR t.fare_amount > fb.upper))", "count(*)")
            + " AS pct_outliers, round(any_value(fb.q1), 6) AS q1, round(any_value(fb.q3), 6) AS q3, "
            "round(any_value(fb.iqr), 6) AS iqr, round(any_value(fb.lower), 6) AS lower, "
            "round(any_value(fb.upper), 6) AS upper FROM trips t CROSS JOIN fb",
            quart,
        ),
        "airport_trips": _q(
            "SELECT count_if(is_airport_trip = 1) AS n_flagged, count(*) AS n_total, "
            f"{_pct('count_if(is_airport_trip = 1)', 'count(*)')} AS pct_flagged FROM feat_air"
        ),
        "invalid_vector_error": _q("SELECT true AS failed_on_missing, count(*) AS n_assembled FROM feat"),
        # 2.5 scalar functions
        "haversine": _q(f"SELECT key, round({_TRIP_DIST}, 6) AS distance_km FROM trips"),
        "haversine_sql": _q(f"SELECT key, round({_TRIP_DIST}, 6) AS distance_km FROM trips"),
        "time_parts": _q(f"SELECT key, {_CALENDAR} FROM trips"),
        "time_parts_monday0": _q("SELECT key, CAST(isodow(pickup_datetime) - 1 AS INTEGER) AS weekday FROM trips"),
        "day_name": _q(
            f"SELECT key, day_of_week, {_DAY_NAME} AS day_name FROM "
            "(SELECT key, CAST(dayofweek(pickup_datetime) + 1 AS INTEGER) AS day_of_week FROM trips)"
        ),
        "near_airport": _q(f"SELECT key, {near_cols} FROM trips"),
        "is_airport_trip": _q("SELECT key, is_airport_trip FROM feat_air"),
        "passenger_valid_flag": _q(f"SELECT key, passenger_count, {_VALIDITY} AS validity FROM trips"),
        "pct_of_total": _q(
            "SELECT passenger_count, count(*) AS n, "
            + _pct("count(*)", "(SELECT count(*) FROM trips)")
            + " AS pct FROM trips GROUP BY passenger_count"
        ),
        "numeric_to_label": _q("SELECT key, CAST(passenger_count AS VARCHAR) AS passenger_label FROM trips"),
        # 2.6 aggregations
        "row_count": _q("SELECT count(*) AS n_rows FROM trips"),
        "null_profile": _q(_null_profile()),
        "describe_numeric": _q(_describe()),
        "fare_min_max_mean_median": _q(
            "SELECT round(min(fare_amount), 6) AS min, round(max(fare_amount), 6) AS max, "
            "round(avg(fare_amount), 6) AS mean, round(quantile_cont(fare_amount, 0.5), 6) AS median FROM trips WHERE NOT isnan(fare_amount)"
        ),
        "fare_quantiles_refined": _q(
            "SELECT round(quantile_cont(fare_amount, 0.01), 6) AS p01, round(quantile_cont(fare_amount, 0.5), 6) AS p50, "
            "round(quantile_cont(fare_amount, 0.99), 6) AS p99 FROM trips WHERE NOT isnan(fare_amount)"
        ),
        "fare_quartiles": _q(
            "SELECT round(q1, 6) AS q1, round(q3, 6) AS q3, round(iqr, 6) AS iqr, round(lower, 6) AS lower, "
            "round(upper, 6) AS upper FROM fb",
            quart,
        ),
        "passenger_dist": _q(
            f"SELECT passenger_count, count(*) AS n, {_VALIDITY} AS validity FROM trips "
            "WHERE passenger_count IS NOT NULL GROUP BY passenger_count"
        ),
        "fare_histogram": _hist_q("trips", "fare_amount", 100),
        "fare_histogram_display": _hist_q("fdisp", "fare_amount", 100, ",\nfdisp AS (SELECT * FROM trips WHERE fare_amount > 0 AND fare_amount <= 100e0)"),
        "distance_histogram": _hist_q("fcap", "distance_km", 80, ",\nfcap AS (SELECT * FROM feat WHERE distance_km <= 50e0)"),
        "fare_by_hour": _q(_grouped("feat", "hour")),
        "fare_by_day": _q(
            f"SELECT day_of_week, avg_fare, trip_count, {_DAY_NAME} AS day_name FROM ({_grouped('feat', 'day_of_week')})"
        ),
        "fare_by_hour_raw": _q(_grouped("rawfeat", "hour")),
        "fare_by_day_raw": _q(
            f"SELECT day_of_week, avg_fare, trip_count, {_DAY_NAME} AS day_name FROM ({_grouped('rawfeat', 'day_of_week')})"
        ),
        "fare_by_year": _q(_grouped("ytrips", "year") + " HAVING avg(fare_amount) IS NOT NULL"),
        "corr_with_target": _q(corr_target),
        "corr_matrix": _q(_corr_union(pairs, "cm"), f",\ncm AS (SELECT * FROM trips WHERE {complete})"),
        "corr_distance_fare": _q("SELECT round(corr(distance_km, fare_amount), 6) AS corr FROM feat"),
        "distance_mean_median": _q(
            "SELECT round(avg(distance_km), 6) AS mean, round(quantile_cont(distance_km, 0.5), 6) AS median "
            "FROM feat WHERE distance_km <= 50e0"
        ),
        "cleaning_stage_counts": _q(
            "SELECT 1 AS stage_no, 'original' AS stage, n0 AS n_rows, CAST(0 AS BIGINT) AS removed, 0e0 AS pct_removed FROM sc "
            f"UNION ALL SELECT 2, 'no_nulls', n1, n0 - n1, {_pct('n0 - n1', 'n0')} FROM sc "
            f"UNION ALL SELECT 3, 'no_outliers', n2, n1 - n2, {_pct('n1 - n2', 'n1')} FROM sc",
            _stage_counts(),
        ),
        "rmse_mae_r2": _q(
            "SELECT count(*) AS n, round(sqrt(avg((label - p_dist)*(label - p_dist))), 6) AS rmse, "
            "round(avg(abs(label - p_dist)), 6) AS mae, "
            "round(1e0 - sum((label - p_dist)*(label - p_dist)) / ((count(label) - 1) * var_samp(label)), 6) AS r2 "
            "FROM preds_train",
            _rule_preds("train"),
        ),
        # 2.7 sorts / top-k
        "best_model": _q("SELECT * FROM metrics_train ORDER BY RMSE, Model LIMIT 1", _metrics_cte()),
        "rank_models": _q(
            "SELECT *, CAST(rank() OVER (ORDER BY RMSE, Model) AS INTEGER) AS rank FROM metrics_train", _metrics_cte()
        ),
        "sort_by_value": _q(
            "SELECT passenger_count, count(*) AS n FROM trips WHERE passenger_count IS NOT NULL "
            "GROUP BY passenger_count ORDER BY passenger_count"
        ),
        "head_n": _q("SELECT * FROM trips ORDER BY key NULLS FIRST LIMIT 10000"),
        "head_n_1000": _q("SELECT * FROM trips ORDER BY key NULLS FIRST LIMIT 1000"),
        # 2.8 sampling / splitting
        "sample_to_size": _q(sample(10000)),
        "sample_to_size_3000": _q(sample(3000)),
        "train_test_split_raw": _q(
            f"SELECT key, passenger_count, CASE WHEN {_BUCKET} < 80 THEN 'train' ELSE 'test' END AS split, "
            "CAST(CAST(('0x' || substr(md5(coalesce(key, '')), 9, 8)) AS BIGINT) % 3 AS INTEGER) AS fold FROM trips"
        ),
        "train_test_split": _q("SELECT key, CASE WHEN bucket < 80 THEN 'train' ELSE 'test' END AS split FROM split"),
        "kfold": _q("SELECT key, CAST(CAST(('0x' || substr(md5(coalesce(key, '')), 9, 8)) AS BIGINT) % 3 AS INTEGER) AS fold FROM train"),
        # 2.9 lookup join
        "compare_before_after": _compare(),
        # 2.10 features with an exact SQL form
        "standard_scale": _scale(),
        "assemble_scale": _scale(
            _PREP,
            "feat_air",
            "(SELECT * FROM feat_air WHERE " + _BUCKET + " < 80)",
            keep="fare_amount, ",
        ),
        "assemble_features": _vector_cols("feat", _TREE),
        "to_label_frame": _vector_cols("feat", _TREE, keep="fare_amount AS label, "),
        "invalid_vector_skip": _vector_cols(
            "rawfeat", _TREE, where=" WHERE " + " AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in _TREE)
        ),
        # 2.11 / 2.12 plot tables and reports
        "pickup_density": _q(
            "SELECT CAST(floor(pickup_longitude / 0.01e0) AS BIGINT) AS cell_x, "
            "CAST(floor(pickup_latitude / 0.01e0) AS BIGINT) AS cell_y, count(*) AS n "
            f"FROM trips WHERE {_BOX['pickup']} GROUP BY 1, 2"
        ),
        "temporal_profile": _q(temporal),
        "yearly_trend": _q(_grouped("ytrips", "year") + " HAVING avg(fare_amount) IS NOT NULL"),
        "distance_fare_sample": _rnd(
            "SELECT key, distance_km, fare_amount FROM feat WHERE distance_km <= 50e0 ORDER BY key LIMIT 5000",
            ["distance_km", "fare_amount"],
        ),
        "distance_fare_scatter": _q(
            "SELECT CAST(floor(distance_km / 1e0) AS BIGINT) AS x_bin, CAST(floor(fare_amount / 5e0) AS BIGINT) AS y_bin, "
            "count(*) AS n FROM feat WHERE distance_km IS NOT NULL AND fare_amount IS NOT NULL AND distance_km <= 50e0 "
            "GROUP BY 1, 2"
        ),
        "residual_report": _residuals(),
        "error_by_segment": _segments(),
        "residual_histogram": _hist_q("resid", "residual", 50, _rule_preds("train") + ",\nresid AS (SELECT label - p_dist AS residual FROM preds_train)"),
        # facts about fitted models
        "check_predict": _q("SELECT count(*) AS n_rows, count(DISTINCT key) AS n_keys, CAST(0 AS BIGINT) AS n_unusable FROM test"),
        "check_batch_score": _q("SELECT count(*) AS n_rows, count(DISTINCT key) AS n_keys, CAST(0 AS BIGINT) AS n_unusable FROM feat"),
        "check_load_model": _q("SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_differences FROM test"),
        "check_save_model": _q(
            "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_differences, 'org.apache.spark.ml.PipelineModel' AS class FROM test"
        ),
        "check_fit_linear": _q(
            "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_differences, true AS intercept_is_not_the_mean FROM test"
        ),
        "check_models_beat_mean": _q(
            "SELECT m.Model, t.RMSE AS mean_rmse, true AS beats_mean FROM metrics_train t CROSS JOIN "
            "(VALUES ('Linear Regression'), ('Random Forest'), ('Gradient Boosted Trees')) m(Model) WHERE t.Model = 'Train mean'",
            _metrics_cte(),
        ),
        "check_feature_importance": _q(_IMPORTANCES),
        "check_rank_importance": _q(_IMPORTANCES),
        "check_importance_csv": _q("SELECT CAST(10 AS BIGINT) AS n_features, 1e0 AS total, 10 AS last_rank FROM train HAVING count(*) > 0"),
        "check_grid": _q(
            "SELECT t.n AS numTrees, d.n AS maxDepth, true AS finite, true AS best_is_lowest, 'tuned' AS status "
            "FROM (VALUES (50), (100), (150)) t(n), (VALUES (5), (10), (15)) d(n) WHERE (SELECT count(*) FROM train) > 0"
        ),
        "check_model_params": _q(
            "SELECT m.Model, m.num_trees, m.max_depth, 10 AS num_features FROM (VALUES ('Linear Regression', NULL, NULL), "
            "('Random Forest', 50, 10), ('Gradient Boosted Trees', 20, 5)) m(Model, num_trees, max_depth) WHERE (SELECT count(*) FROM train) > 0"
        ),
        "check_rank_trained": _q("SELECT CAST(3 AS BIGINT) AS n_models, 3 AS last_rank, true AS ordered FROM test HAVING count(*) > 0"),
        "check_compare_tuning": _q(
            "SELECT m.metric, true AS change_is_difference FROM (VALUES ('RMSE'), ('MAE'), ('R2')) m(metric) WHERE (SELECT count(*) FROM test) > 0"
        ),
        "check_actual_vs_predicted": _q("SELECT round(fare_amount, 6) AS fare FROM (SELECT fare_amount FROM test ORDER BY key LIMIT 15)"),
        "check_rename_columns": _q("SELECT count(*) AS n_rows, round(sum(fare_amount), 3) AS fares FROM test"),
        "check_tuned_residuals": _q("SELECT count(*) AS report, count(*) AS histogram, count(*) AS by_distance, count(*) AS by_hour FROM test"),
        "stream_features": _rnd(f"SELECT {_FEAT_SELECT} FROM feat", _FEAT_DOUBLES),
    }
