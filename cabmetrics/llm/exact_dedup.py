"""Exact dedup against a persistent digest index.

The index is a Parquet table bucketed and sorted by the SHA-256 digest of the
normalised text, one row per digest. A batch of documents is hashed, grouped
by digest (pre-aggregated before the shuffle), and its groups are
anti-joined with the index by a sort-merge join that reads the index without
a shuffle; what is new is appended in the index's own bucketing. The folder
outlives the session: ``open_index`` finds it again.

Every document then gets the row that stands for its digest: the indexed one
if the digest was known, else the largest id of the batch. Digests that hold
more than a thousandth of the rows are broadcast for that, the others joined
by a shuffle, so no task gets all rows of one.

A batch costs a read of the index, with a sort of each bucket once it has
several files; an append adds one file to each bucket, and ``compact`` makes
it one again. Two writers at once may both add a digest: the index is read
with one row for each, the largest id.

Defined cases: null text counts as empty; rows that repeat an id with the
same text are one document (each of them gets the same answer); a null id
never stands for a group unless all its ids are null; an empty batch appends
nothing. Columns besides id and text are not read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import looked_up, lower_ascii, written


def normalized(text: str | Column) -> Column:
    """The text that is compared: A-Z lower-cased, null as empty."""
    return lower_ascii(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def open_index(spark: SparkSession, path: str, buckets: int) -> str:
    """Table name of the digest index in folder ``path``, which is made if it is new.

    ``buckets`` holds for the life of the folder; choose it for the size the
    index will reach (one task sorts one bucket).
    """
    name = f"digest_index_{uuid.uuid4().hex[:12]}"
    spark.sql(
        f"CREATE TABLE {name} (digest BINARY, keep_id BIGINT) USING parquet "
        f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return name


def close_index(spark: SparkSession, index: str) -> None:
    """Forget the table's name; the folder stays."""
    spark.sql(f"DROP TABLE IF EXISTS {index}")


def indexed(spark: SparkSession, index: str) -> DataFrame:
    """(digest, keep_id), one row a digest; grouped within the index's buckets, without a shuffle."""
    return spark.table(index).groupBy("digest").agg(F.max("keep_id").alias("keep_id"))


def compact(spark: SparkSession, index: str, path: str, buckets: int) -> str:
    """The index written anew to folder ``path``, one sorted file a bucket; returns the new table's name."""
    fresh = open_index(spark, path, buckets)
    indexed(spark, index).repartition(buckets, "digest").sortWithinPartitions("digest").select("digest", "keep_id").write.insertInto(fresh)
    return fresh


def append_new(spark: SparkSession, index: str, groups: DataFrame, buckets: int) -> None:
    """Add the groups whose digest the index does not have."""
    known = spark.table(index).select("digest")
    fresh = groups.join(known.hint("merge"), "digest", "left_anti").select("digest", "keep_id")
    fresh.repartition(buckets, "digest").sortWithinPartitions("digest").write.insertInto(index)


def deduplicate(spark: SparkSession, docs: DataFrame, index: str, buckets: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, digest.

    ``group_size`` counts the batch; ``keep_id`` may be a row of an earlier one.
    """
    hashed = written(spark, docs.select(F.col(id_col).cast("long").alias("doc_id"), F.unhex(F.sha2(normalized(text_col), 256)).alias("digest")), "digests")
    groups = hashed.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    append_new(spark, index, groups, buckets)
    decided = groups.drop("keep_id").join(indexed(spark, index).hint("merge"), "digest").withColumn("held", F.col("group_size"))
    answered = looked_up(hashed, written(spark, decided, "decisions"), "digest", hashed.count())
    return answered.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest")
