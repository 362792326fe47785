"""The cleaning and feature plan on a stream.

Cleaning, distance, calendar fields and scoring are per-row projections and
filters, so the batch operators apply unchanged to a streaming DataFrame:
new trip files are cleaned and featurised incrementally, with progress kept
in a checkpoint under the shared folder (restartable after a failure).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.clean import clean_trips
from ..operators.features import feature_projection
from ..session import scratch_path, use_utc
from ..sources.fixtures import trips_from_events


def feature_stream(spark: SparkSession, source_dir: str, file_glob: str = "events.parquet") -> DataFrame:
    """Streaming DataFrame of cleaned, featurised trips from event files."""
    schema = spark.read.parquet(f"{source_dir.rstrip('/')}/{file_glob}").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", file_glob).parquet(source_dir)
    return feature_projection(clean_trips(trips_from_events(events)))


def score_stream(stream: DataFrame, model) -> DataFrame:
    """Apply a fitted PipelineModel to a streaming frame (stateless)."""
    return model.transform(stream)


def run_feature_stream(spark: SparkSession, source_dir: str, out: str | None = None) -> DataFrame:
    """Process everything available once (availableNow) into parquet and
    return the written table."""
    use_utc(spark)
    out = out or scratch_path(spark, "stream-features")
    q = (
        feature_stream(spark, source_dir)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", f"{out}-checkpoint")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return spark.read.parquet(out)
