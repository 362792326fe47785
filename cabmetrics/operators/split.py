"""Reproducible sampling, train/test split and k-fold assignment.

``randomSplit``/``sample`` draw per partition, so the same seed gives
different rows when the partitioning changes (SURVEY §7). Here membership
is a function of the row key alone: a 32-bit slice of ``md5(key)``. The
rule is a per-row projection (no shuffle, no coordination) and DuckDB can
evaluate the same expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import SAMPLE_SIZE, SEED, TRAIN_FRACTION

_TWO32 = float(2**32)


def key_hash32(key: str | Column = "key", offset: int = 1, salt: str | None = None) -> Column:
    """Unsigned 32-bit integer from hex digits ``offset..offset+7`` of md5(key[:salt]).

    A null key counts as the empty text, so such rows have a side and a fold too."""
    k = F.coalesce((F.col(key) if isinstance(key, str) else key).cast("string"), F.lit(""))
    if salt is not None:
        k = F.concat(k, F.lit(f":{salt}"))
    return F.conv(F.substring(F.md5(k), offset, 8), 16, 10).cast("bigint")


def key_bucket(key: str | Column = "key", buckets: int = 100) -> Column:
    """0..buckets-1 from the first 32 bits of md5(key)."""
    return key_hash32(key) % F.lit(buckets)


def train_test_split(df: DataFrame, train_fraction: float = TRAIN_FRACTION, key: str = "key") -> tuple[DataFrame, DataFrame]:
    """Stable 80/20 (default) split by key: bucket < 100*fraction -> train."""
    cut = int(round(train_fraction * 100))
    b = key_bucket(key)
    return df.filter(b < cut), df.filter(b >= cut)


def split_label(df: DataFrame, train_fraction: float = TRAIN_FRACTION, key: str = "key", name: str = "split") -> DataFrame:
    cut = int(round(train_fraction * 100))
    return df.withColumn(name, F.when(key_bucket(key) < cut, F.lit("train")).otherwise(F.lit("test")))


def sample_to_size(df: DataFrame, size: int | None = SAMPLE_SIZE, seed: int = SEED, key: str = "key") -> DataFrame:
    """Bernoulli sample with fraction ``min(size / rows, 1)``; ``None`` keeps all rows.

    The row count enters as a scalar subquery (no driver round trip) and the
    draw is a hash of (key, seed), so the sample does not depend on
    partitioning.
    """
    if size is None:
        return df
    n = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    fraction = F.least(F.try_divide(F.lit(float(size)), n), F.lit(1.0))
    u = key_hash32(key, salt=str(seed)) / F.lit(_TWO32)
    return df.filter(u < fraction)


def fold_column(df: DataFrame, k: int = 3, key: str = "key", name: str = "fold") -> DataFrame:
    """Fold number 0..k-1 from digits 9..16 of md5(key), independent of the split bits."""
    return df.withColumn(name, (key_hash32(key, offset=9) % F.lit(k)).cast("int"))
