"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import written


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def connected_components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, component): for each node of the edges (a, b) the smallest node it reaches.

    Alternating large-star and small-star steps (Kiveris et al., 2014), each
    two joins of the edges with one row per node; a node with very many edges
    is pre-aggregated and its join side split by adaptive execution. Every
    round is written to the shared folder; the number of rounds grows with the
    logarithm of the longest chain.
    """
    edges = written(spark, edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct(), "edges")
    seen = _fingerprint(edges)
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).filter("a != b").distinct()
        large = written(spark, large, "large_star")
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e"))
        edges = written(spark, small.select("e.a", "e.b").filter("a != b").distinct(), "small_star")
        now = _fingerprint(edges)
        if now == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(edges.select("b", "b").distinct())
        seen = now
