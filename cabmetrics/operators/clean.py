"""Row filters of the cleaning stage.

Every rule is a plain predicate on base columns, so on a parquet source the
null checks and range bounds reach the scan (``PushedFilters``) and row
groups whose statistics fall outside the box are skipped.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import pct_of_total
from ..schema import CODE_PROFILE, CleaningProfile


def _all(conds: list[Column]) -> Column:
    return reduce(and_, conds) if conds else F.lit(True)


def not_null_condition(df: DataFrame, subset: list[str] | None = None) -> Column:
    """True when no column of ``subset`` is null (or NaN for float columns),
    the rule of ``DataFrame.dropna``, written as pushable predicates."""
    types = dict(df.dtypes)
    conds = []
    for c in subset or df.columns:
        cond = F.col(c).isNotNull()
        if types[c] in ("double", "float"):
            cond = cond & ~F.isnan(F.col(c))
        conds.append(cond)
    return _all(conds)


def drop_nulls(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    return df.filter(not_null_condition(df, subset))


def _range(col: str, lo, hi) -> list[Column]:
    c = F.col(col)
    out = []
    if lo is not None:
        out.append(c >= F.lit(lo))
    if hi is not None:
        out.append(c <= F.lit(hi))
    return out


def fare_condition(p: CleaningProfile = CODE_PROFILE) -> Column:
    return _all(_range("fare_amount", p.fare_min, p.fare_max))


def passenger_condition(p: CleaningProfile = CODE_PROFILE) -> Column:
    return _all(_range("passenger_count", p.passengers_min, p.passengers_max))


def bbox_condition(p: CleaningProfile = CODE_PROFILE, ends=("pickup", "dropoff")) -> Column:
    """Both ends (or the given ones) inside the box, bounds included."""
    conds = []
    for end in ends:
        conds.append(F.col(f"{end}_longitude").between(p.lon_min, p.lon_max))
        conds.append(F.col(f"{end}_latitude").between(p.lat_min, p.lat_max))
    return _all(conds)


def fare_range(df: DataFrame, p: CleaningProfile = CODE_PROFILE) -> DataFrame:
    return df.filter(fare_condition(p))


def passenger_range(df: DataFrame, p: CleaningProfile = CODE_PROFILE) -> DataFrame:
    return df.filter(passenger_condition(p))


def bbox_filter(df: DataFrame, p: CleaningProfile = CODE_PROFILE, ends=("pickup", "dropoff")) -> DataFrame:
    return df.filter(bbox_condition(p, ends))


def outlier_condition(p: CleaningProfile = CODE_PROFILE) -> Column:
    return fare_condition(p) & passenger_condition(p) & bbox_condition(p)


def clean_trips(df: DataFrame, p: CleaningProfile = CODE_PROFILE) -> DataFrame:
    """Null rule plus all range rules as one filter (one pass, no shuffle)."""
    cond = outlier_condition(p)
    if p.drop_nulls:
        cond = not_null_condition(df) & cond
    return df.filter(cond)


def outside_bbox_condition(p: CleaningProfile = CODE_PROFILE) -> Column:
    """Any of the eight coordinate comparisons out of bounds (null compares false)."""
    conds = []
    for end in ("pickup", "dropoff"):
        lon, lat = F.col(f"{end}_longitude"), F.col(f"{end}_latitude")
        conds += [lon < p.lon_min, lon > p.lon_max, lat < p.lat_min, lat > p.lat_max]
    return F.coalesce(reduce(or_, [F.coalesce(c, F.lit(False)) for c in conds]), F.lit(False))


def outside_bbox(df: DataFrame, p: CleaningProfile = CODE_PROFILE) -> DataFrame:
    """One row: rows outside the box, total rows and percent."""
    return df.agg(
        F.count_if(outside_bbox_condition(p)).alias("n_outside"),
        F.count(F.lit(1)).alias("n_total"),
    ).withColumn("pct_outside", pct_of_total("n_outside", "n_total"))


def cleaning_stage_counts(df: DataFrame, p: CleaningProfile = CODE_PROFILE) -> DataFrame:
    """Rows at each cleaning stage in a single scan.

    Columns: stage_no, stage, n_rows, removed, pct_removed (of the previous stage).
    """
    nn = not_null_condition(df)
    agg = df.agg(
        F.count(F.lit(1)).alias("n0"),
        F.count_if(nn).alias("n1"),
        F.count_if(nn & outlier_condition(p)).alias("n2"),
    )
    stage = lambda no, name, n, prev: F.struct(
        F.lit(no).alias("stage_no"),
        F.lit(name).alias("stage"),
        F.col(n).alias("n_rows"),
        (F.col(prev) - F.col(n) if prev else F.lit(0).cast(T.LongType())).alias("removed"),
        (pct_of_total(F.col(prev) - F.col(n), F.col(prev)) if prev else F.lit(0.0)).alias("pct_removed"),
    )
    return agg.select(
        F.inline(
            F.array(
                stage(1, "original", "n0", None),
                stage(2, "no_nulls", "n1", "n0"),
                stage(3, "no_outliers", "n2", "n1"),
            )
        )
    )
