"""Pickup-time parsing and calendar fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import DAY_NAMES, PICKUP_TIME_FORMAT


def parse_pickup_time(col: str | Column = "pickup_datetime", fmt: str = PICKUP_TIME_FORMAT) -> Column:
    """Text -> timestamp; unparsable text becomes null instead of failing the job.

    A column that is already a timestamp should not be passed here.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.try_to_timestamp(c, F.lit(fmt))


def time_parts(df: DataFrame, ts: str = "pickup_datetime", as_double: bool = False) -> DataFrame:
    """Adds ``hour`` (0-23), ``day_of_week`` (1=Sunday..7=Saturday), ``month``, ``year``.

    Integer by default (modeling scripts); ``as_double`` gives the notebook's
    double-typed fields.
    """
    t = F.col(ts)
    cols = {
        "hour": F.hour(t),
        "day_of_week": F.dayofweek(t),
        "month": F.month(t),
        "year": F.year(t),
    }
    if as_double:
        cols = {k: v.cast("double") for k, v in cols.items()}
    return df.withColumns(cols)


def weekday_monday0(ts: str | Column = "pickup_datetime") -> Column:
    """Weekday with 0=Monday .. 6=Sunday (the pandas numbering)."""
    t = F.col(ts) if isinstance(ts, str) else ts
    return F.weekday(t)


def day_name(day_of_week: str | Column = "day_of_week") -> Column:
    """Label for a 1=Sunday .. 7=Saturday weekday number."""
    d = F.col(day_of_week) if isinstance(day_of_week, str) else day_of_week
    names = F.array(*[F.lit(n) for n in DAY_NAMES])
    return F.when(d.between(1, 7), F.element_at(names, d.cast("int")))
