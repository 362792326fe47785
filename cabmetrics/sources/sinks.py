"""Writers and round-trip checks.

All writes go under the shared folder (``spark.checkpoint.dir`` on a
cluster) and use a fresh path per call, so a re-run after a lost executor
never reads a half-written directory of another attempt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import PICKUP_TIME_WRITE_FORMAT


def to_raw_text(trips: DataFrame, fmt: str = PICKUP_TIME_WRITE_FORMAT) -> DataFrame:
    """Trips with the pickup time rendered as raw CSV text."""
    return trips.withColumn("pickup_datetime", F.date_format("pickup_datetime", fmt))


def write_trips(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> str:
    """Write trips; parquet by default, CSV with header for the raw layout."""
    if fmt not in ("parquet", "csv"):
        raise ValueError(f"unknown format {fmt!r}")
    w = (to_raw_text(df) if fmt == "csv" else df).write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "parquet":
        w.parquet(path)
    else:
        w.option("header", True).csv(path)
    return path


def roundtrip_report(written: DataFrame, read_back: DataFrame, exact: bool = False) -> DataFrame:
    """One row: row and column counts on both sides and whether the contents
    are the same multiset of rows.

    By default the contents are compared by row counts and an order-free sum of
    64-bit row hashes: one aggregate over one scan of either side, no shuffle of
    rows (the sum is decimal, so it cannot overflow). ``exact=True`` adds ``rows_lost``/``rows_gained`` from
    ``exceptAll`` both ways, which shuffles every row twice.
    """
    cols = written.columns
    hashed = F.xxhash64(*[F.col(c) for c in cols]).cast("decimal(38,0)").alias("h")
    both = written.select(F.lit(1).alias("side"), hashed).union(read_back.select(F.lit(2).alias("side"), hashed))
    zero = F.lit(0).cast("decimal(38,0)")
    sums = {i: F.coalesce(F.sum(F.when(F.col("side") == i, F.col("h"))), zero) for i in (1, 2)}
    counts = {i: F.count_if(F.col("side") == i) for i in (1, 2)}
    out = both.agg(
        counts[1].alias("rows_written"),
        counts[2].alias("rows_read"),
        F.lit(len(cols)).alias("cols_written"),
        F.lit(len(read_back.columns)).alias("cols_read"),
        ((counts[1] == counts[2]) & (sums[1] == sums[2])).alias("same_content"),
    )
    if exact:
        lost = written.select(*cols).exceptAll(read_back.select(*cols)).agg(F.count(F.lit(1)).alias("n"))
        gained = read_back.select(*cols).exceptAll(written.select(*cols)).agg(F.count(F.lit(1)).alias("n"))
        out = out.withColumn("rows_lost", lost.scalar()).withColumn("rows_gained", gained.scalar())
    return out


def write_split(train: DataFrame, test: DataFrame, path: str) -> dict[str, str]:
    """Save both parts as parquet (a vector column survives, unlike CSV)."""
    out = {"train": f"{path}/train", "test": f"{path}/test"}
    train.write.mode("overwrite").parquet(out["train"])
    test.write.mode("overwrite").parquet(out["test"])
    return out


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)
    return path
