"""Scans that keep bad rows apart instead of turning them into nulls.

Each line of a raw CSV is read with the trip schema; a line that does not fit
comes with a reason: ``columns`` (too few or too many values) or the name of
the first column whose text is not a value of its type, the pickup time's
pattern included. ``ingest`` writes good and bad rows in one pass, a folder
for each reason, so that nothing is read twice and no row is lost.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timeparts import parse_pickup_time
from ..schema import PICKUP_TIME_FORMAT, RAW_TRIP_SCHEMA, TRIP_COLUMNS
from .trips import conform_trips

GOOD = "good"
_LINE = "_bad_line"


def _values(line: Column) -> Column:
    """Number of values of a CSV line; commas within quotes do not part values."""
    return F.length(F.regexp_replace(F.regexp_replace(line, '"(?:[^"]|"")*"', ""), "[^,]", "")) + 1


def read_checked(spark: SparkSession, path: str, header: bool = True, fmt: str = PICKUP_TIME_FORMAT) -> DataFrame:
    """Raw trip columns, ``line`` (of a bad row; its columns are null) and ``reason`` (``good``, or what is wrong)."""
    schema = T.StructType([*RAW_TRIP_SCHEMA.fields, T.StructField(_LINE, T.StringType(), True)])
    rows = spark.read.schema(schema).option("header", header).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _LINE).csv(path)
    # the bad line's values once more, as text: which of them is no value of its type?
    texts = T.StructType([T.StructField(f.name, T.StringType(), True) for f in RAW_TRIP_SCHEMA.fields])
    rows = rows.withColumn("_texts", F.when(F.col(_LINE).isNotNull(), F.from_csv(_LINE, texts.simpleString()[len("struct<") : -1].replace(":", " "))))
    reason = F.when(_values(F.col(_LINE)) != len(RAW_TRIP_SCHEMA.fields), F.lit("columns"))
    for f in RAW_TRIP_SCHEMA.fields:
        if not isinstance(f.dataType, T.StringType):
            text = F.col(f"_texts.{f.name}")
            reason = reason.when(text.isNotNull() & (text != "") & text.try_cast(f.dataType).isNull(), F.lit(f.name))
    time = F.coalesce(F.col("_texts.pickup_datetime"), F.col("pickup_datetime"))
    reason = reason.when(time.isNotNull() & (time != "") & parse_pickup_time(time, fmt).isNull(), F.lit("pickup_datetime")).when(F.col(_LINE).isNotNull(), F.lit("line")).otherwise(F.lit(GOOD))
    rows = rows.withColumn("reason", reason)
    bad = F.col("reason") != GOOD
    # a line whose only fault is its time was read whole; its text is put together again
    line = F.when(bad, F.coalesce(F.col(_LINE), F.to_csv(F.struct(*RAW_TRIP_SCHEMA.names))))
    return rows.select(*(F.when(~bad, F.col(c)).alias(c) for c in RAW_TRIP_SCHEMA.names), line.alias("line"), "reason")


@dataclass(frozen=True)
class Ingested:
    """The tables of one ingest."""

    spark: SparkSession
    path: str

    def _part(self, good: bool) -> DataFrame:
        kind = RAW_TRIP_SCHEMA.simpleString()[len("struct<") : -1].replace(":", " ") + ", line string, reason string"
        rows = self.spark.read.schema(kind).parquet(self.path)
        return rows.filter((F.col("reason") == GOOD) == F.lit(good))  # one folder each: the others are not opened

    def trips(self) -> DataFrame:
        return conform_trips(self._part(True).select(*TRIP_COLUMNS))

    def bad_rows(self) -> DataFrame:
        """(line, reason)"""
        return self._part(False).select("line", "reason")

    def report(self) -> DataFrame:
        """(reason, n_rows); all of them add up to the input."""
        kind = "reason string"
        return self.spark.read.schema(f"key string, {kind}").parquet(self.path).groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows"))


def ingest(spark: SparkSession, path: str, out: str, header: bool = True) -> Ingested:
    """Reads raw CSV once and writes good and bad rows under ``out``, by reason."""
    read_checked(spark, path, header).write.mode("errorifexists").partitionBy("reason").parquet(out)
    return Ingested(spark, out)
