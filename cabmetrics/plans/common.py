"""Building blocks shared by the named plans: trips of a scale-factor
directory at each stage, and output normalisation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import clean_trips
from ..operators.features import feature_projection
from ..operators.split import train_test_split
from ..schema import CODE_PROFILE, CleaningProfile
from ..sources.fixtures import fixture_trips, fixture_yearly_trips
from ..sources.sinks import to_raw_text, write_trips
from ..session import content_stamp, path_exists, scratch_path, use_utc


_TABLES: dict = {}
# Fixed values of our own: minimum file count of a written trip table, and the
# rows a file holds at most on average (a fit of 50 trees reads up to 0.5 kB a train row in a pass).
MIN_TABLE_PARTITIONS = 8
ROWS_PER_PARTITION = 300_000


def table_partitions(rows: int) -> int:
    """Files of a written trip table: a function of its rows alone."""
    return max(MIN_TABLE_PARTITIONS, -(-rows // ROWS_PER_PARTITION))


def data_key(spark: SparkSession, sf_dir: str, *parts) -> tuple:
    """Key of what is kept for a directory: new files under its path give a new key."""
    base = sf_dir.rstrip("/")
    return (spark.sparkContext.applicationId, base, *(content_stamp(spark, f"{base}/{t}.parquet") for t in ("events", "orders")), *parts)


def trips_table(spark: SparkSession, sf_dir: str) -> str:
    """Write the derived trips once per session as parquet in the shared
    folder and return its path (the "load once, store columnar" stage).

    Downstream queries then scan a real trip table: cleaning predicates and
    column pruning reach the parquet reader instead of re-deriving every row
    from ``events`` inside each filter.
    """
    use_utc(spark)
    key = data_key(spark, sf_dir, "parquet")
    path = _TABLES.get(key)
    if path is None or not path_exists(spark, f"{path}/_SUCCESS"):
        path = scratch_path(spark, "trips")
        trips = fixture_trips(spark, sf_dir)
        # a source gives as many filled splits as it has row groups, however
        # large: few files, so few tasks of a fit, each with a share of the rows
        # that grows with the table. Spread the rows over files by their number
        # (the count reads parquet footers only). Not by the machine's cores:
        # the forest's bootstrap and the CV folds are seeded per partition, so
        # a layout that followed the cores would change models between machines.
        # Round-robin (not by key) so a hot key cannot make one file huge.
        trips = trips.repartition(table_partitions(trips.count()))
        trips.write.mode("overwrite").parquet(path)
        _TABLES[key] = path
    return path


def stable_layout(df: DataFrame, partitions: int, key: str = "key") -> DataFrame:
    """Opt-in: a training input whose partitioning depends on the keys alone.

    MLlib seeds the forest's bootstrap and the CV folds per partition, so the
    fitted forest follows the layout. Hash-partitioning into a fixed number of
    partitions, sorted by key, makes it the same on any machine. That is a
    full shuffle and sort of the training rows; fits read the written table's
    own layout unless this is asked for.
    """
    return df.repartition(partitions, key).sortWithinPartitions(key)


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw (uncleaned) trips of a scale-factor directory."""
    return spark.read.parquet(trips_table(spark, sf_dir))


def spread(spark: SparkSession, sf_dir: str, df: DataFrame) -> DataFrame:
    """Rows of the trip table for a fit: no task gets more than the rows of a file on average.

    A scan packs several small files into one task, on few cores or beyond
    128 MB a task; such rows are dealt anew, as many partitions as files.
    """
    rows = raw_trips(spark, sf_dir).count()
    if df.rdd.getNumPartitions() * ROWS_PER_PARTITION >= rows:
        return df
    return df.repartition(table_partitions(rows))


def clean(spark: SparkSession, sf_dir: str, profile: CleaningProfile = CODE_PROFILE) -> DataFrame:
    return clean_trips(raw_trips(spark, sf_dir), profile)


def features(spark: SparkSession, sf_dir: str, airport: bool = False, as_double: bool = False) -> DataFrame:
    return feature_projection(clean(spark, sf_dir), airport=airport, as_double=as_double)


def raw_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of uncleaned trips (nulls and outliers kept)."""
    return feature_projection(raw_trips(spark, sf_dir))


def split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return train_test_split(features(spark, sf_dir))


def yearly_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_utc(spark)
    t = fixture_yearly_trips(spark, sf_dir)
    return t.withColumn("year", F.year("pickup_datetime"))


def raw_csv(spark: SparkSession, sf_dir: str) -> str:
    """The raw trips written once per session as header CSV (the reference's input layout)."""
    key = data_key(spark, sf_dir, "csv")
    path = _TABLES.get(key)
    if path is None or not path_exists(spark, f"{path}/_SUCCESS"):
        path = write_trips(raw_trips(spark, sf_dir), scratch_path(spark, "trips-csv"), fmt="csv")
        _TABLES[key] = path
    return path


def clean_table(spark: SparkSession, sf_dir: str) -> str:
    """The cleaned trips written once per session as parquet (the processed file of the later stages)."""
    key = data_key(spark, sf_dir, "clean")
    path = _TABLES.get(key)
    if path is None or not path_exists(spark, f"{path}/_SUCCESS"):
        path = write_trips(clean(spark, sf_dir), scratch_path(spark, "trips-clean"))
        _TABLES[key] = path
    return path


def spoilt_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw trips as CSV lines (column ``value``), some with planted faults by their key (FIXTURES.md)."""
    trips = raw_text_trips(spark, sf_dir)
    number = F.expr("try_cast(key as bigint)")
    texts = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in trips.columns}
    texts["fare_amount"] = F.when(number % 211 == 3, F.lit("abc")).otherwise(texts["fare_amount"])
    texts["pickup_datetime"] = F.when(number % 229 == 11, F.lit("yesterday")).otherwise(texts["pickup_datetime"])
    texts["passenger_count"] = F.when(number % 233 == 13, F.lit("2.5x")).otherwise(texts["passenger_count"])
    whole = F.concat_ws(",", *texts.values())
    short = F.concat_ws(",", *list(texts.values())[:-1])
    line = F.when(number % 223 == 5, short).when(number % 227 == 7, F.concat(whole, F.lit(",extra"))).otherwise(whole)
    return trips.select(line.alias("value"))


def raw_text_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_raw_text(raw_trips(spark, sf_dir))


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (engines differ in the last bits of float math)."""
    return df.select(
        *[F.round(F.col(n), digits).alias(n) if t in ("double", "float") else F.col(n) for n, t in df.dtypes]
    )
