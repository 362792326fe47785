"""Fares by event-time window on a stream of trip files.

Trips are delivered at least once and out of order. The stream drops repeated
deliveries and rows that come too late, and closes a window once the watermark
has passed it:

* the watermark trails the latest pickup time by ``delay``;
* ``dropDuplicatesWithinWatermark`` on the trip's key keeps a key only for as
  long as a repeat can still pass the watermark, so its state is bounded by the
  trips of one ``delay``, not by the history;
* a tumbling window holds a count and a sum; one partial row a task and
  window is shuffled, however many trips an hour has;
* append mode writes a window once, when it is final, and its state goes.

The keys of one ``delay`` may be many: on a large stream set
``spark.sql.streaming.stateStore.providerClass`` to Spark's RocksDB provider,
which keeps state on local disk and its changes in the checkpoint.

State and progress lie in the checkpoint of the shared folder, so a run that
ended (or failed) goes on where it was. Trips without a pickup time belong to
no window. Trips without a key cannot be told apart by it: they count as
repeats only if all their columns are equal.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import clean_trips
from ..schema import TRIP_SCHEMA
from ..session import scratch_path, use_utc

DELAY = "30 days"
# Fixed value of our own: most partitions of the stream's state. Every state task
# reports one number for each partition of its operator, so what the driver gets
# grows with the square of their count.
STATE_PARTITIONS = 64


def deduplicated(trips: DataFrame, delay: str = DELAY) -> DataFrame:
    """Each trip once, late ones dropped; a batch frame keeps the watermark as a mere mark."""
    own = F.coalesce(F.col("key").cast("string"), F.concat(F.lit("row:"), F.sha2(F.to_json(F.struct(*trips.columns)), 256)))
    timed = trips.filter(F.col("pickup_datetime").isNotNull()).withColumn("delivery_key", own)
    timed = timed.withWatermark("pickup_datetime", delay)
    return (timed.dropDuplicatesWithinWatermark(["delivery_key"]) if trips.isStreaming else timed.dropDuplicates(["delivery_key"])).drop("delivery_key")


def fares_by_window(trips: DataFrame, width: str = "1 hour", delay: str = DELAY) -> DataFrame:
    """(window_start, trip_count, total_fare, avg_fare) of each tumbling window."""
    by_window = deduplicated(trips, delay).groupBy(F.window("pickup_datetime", width).alias("w"))
    counted = by_window.agg(F.count(F.lit(1)).alias("trip_count"), F.sum("fare_amount").alias("total"), F.avg("fare_amount").alias("mean"))
    return counted.select(F.col("w.start").alias("window_start"), "trip_count", F.round("total", 2).alias("total_fare"), F.round("mean", 6).alias("avg_fare"))


@dataclass
class Run:
    """What one run of the stream did."""

    rows_in: int = 0
    late: int = 0
    repeated: int = 0
    batches: int = 0


@dataclass
class WindowStream:
    """The windows of trip files that arrive in ``landing``; each ``advance`` takes what is there and ends."""

    spark: SparkSession
    landing: str
    out: str
    width: str = "1 hour"
    delay: str = DELAY
    state_partitions: int = STATE_PARTITIONS
    runs: list[Run] = field(default_factory=list)

    def advance(self) -> Run:
        use_utc(self.spark)
        trips = clean_trips(self.spark.readStream.schema(TRIP_SCHEMA).parquet(self.landing))
        writer = (
            fares_by_window(trips, self.width, self.delay)
            .writeStream.format("parquet")
            .option("path", self.out)
            .option("checkpointLocation", f"{self.out}-checkpoint")
            .outputMode("append")
            .trigger(availableNow=True)
        )
        # a query takes the session's settings as it starts (its checkpoint keeps
        # the partitions of the state from the first run on)
        asked = self.spark.conf.get("spark.sql.shuffle.partitions")
        self.spark.conf.set("spark.sql.shuffle.partitions", min(int(asked), self.state_partitions))
        try:
            query = writer.start()
        finally:
            self.spark.conf.set("spark.sql.shuffle.partitions", asked)
        query.awaitTermination()
        run = Run()
        for progress in query.recentProgress:
            run.batches += 1
            run.rows_in += progress.numInputRows
            for state in progress.stateOperators:
                if state.operatorName == "dedupeWithinWatermark":
                    run.late += state.numRowsDroppedByWatermark
                    run.repeated += state.customMetrics.get("numDroppedDuplicateRows", 0)
        self.runs.append(run)
        return run

    def windows(self) -> DataFrame:
        """The windows that are final so far."""
        schema = "window_start timestamp, trip_count long, total_fare double, avg_fare double"
        return self.spark.read.schema(schema).parquet(self.out)


def deliveries(trips: DataFrame, days: int = 450) -> tuple[DataFrame, DataFrame]:
    """The trips as two deliveries, the first with pickups up to ``days`` after the earliest one.

    Of the first delivery's trips, those with key % 41 = 5 come only with the
    second one, and those with key % 50 = 7 come with both.
    """
    number = F.expr("try_cast(key as bigint)")
    early = F.coalesce(F.col("pickup_datetime") < trips.agg(F.min("pickup_datetime") + F.make_dt_interval(days=F.lit(days))).scalar(), F.lit(True))
    held_back = F.coalesce(number % 41 == 5, F.lit(False))
    again = F.coalesce(number % 50 == 7, F.lit(False))
    return trips.filter(early & ~held_back), trips.filter(~early | held_back | again)


def two_deliveries(spark: SparkSession, trips: DataFrame, width: str = "1 hour") -> WindowStream:
    """Both deliveries through the stream, which ends after the first one and starts again."""
    landing = scratch_path(spark, "landing")
    stream = WindowStream(spark, landing, scratch_path(spark, "fare-windows"), width)
    for delivery in deliveries(trips):
        delivery.write.mode("append").parquet(landing)
        stream.advance()
    return stream
