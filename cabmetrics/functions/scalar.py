"""Small scalar helpers used by the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def pct_of_total(part, total, digits: int | None = 2) -> Column:
    """``100 * part / total``; null when the total is 0 or null."""
    v = F.lit(100.0) * _c(part) / F.nullif(_c(total).cast("double"), F.lit(0.0))
    return F.round(v, digits) if digits is not None else v


def passenger_valid_flag(col="passenger_count", lo: int = 1, hi: int = 6) -> Column:
    """'valid' inside the closed range, 'anomaly' outside, null for null input."""
    c = _c(col)
    return F.when(c.isNull(), F.lit(None).cast("string")).when(c.between(lo, hi), "valid").otherwise("anomaly")


def numeric_to_label(col) -> Column:
    """Number as category text (axis labels)."""
    return _c(col).cast("string")


def nan_to_null(col) -> Column:
    """NaN (pandas' missing marker) becomes a real null."""
    c = _c(col)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def pearson(a, b) -> Column:
    """Pearson correlation over rows where both values are present (pandas'
    pairwise rule); null for fewer than two rows or a constant side.

    Written as covariance over deviations with ``try_divide`` because the
    built-in ``corr`` raises DIVIDE_BY_ZERO on a constant column under ANSI
    mode (Spark 4's default).
    """
    x, y = nan_to_null(_c(a).cast("double")), nan_to_null(_c(b).cast("double"))
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))
