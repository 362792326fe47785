"""From raw documents to packed training sequences.

Each stage takes the documents that the one before kept; ``run`` writes every
stage's result under the shared folder and reads it back, so a lost executor
never costs more than the stage at hand.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabmetrics.llm.common import read_table, written
from cabmetrics.llm.decontaminate import contaminations
from cabmetrics.llm.exact_dedup import close_index, deduplicate, normalized, open_index
from cabmetrics.llm.language_id import identify, train
from cabmetrics.llm.near_dedup import near_duplicates
from cabmetrics.llm.packing import pack_documents
from cabmetrics.llm.queries import INDEX_BUCKETS, tokenizer_file
from cabmetrics.session import scratch_path


def digested(docs: DataFrame, text: Column | None = None) -> tuple[DataFrame, str]:
    """The documents with a digest of their (normalized) text, and the name of that column."""
    own = f"digest_{uuid.uuid4().hex}"  # a column, so that it is computed once a row
    return docs.withColumn(own, F.unhex(F.sha2(F.coalesce("text", F.lit("")) if text is None else text, 256))), own


def without(rows: DataFrame, own: str, dropped: DataFrame) -> DataFrame:
    """The rows whose id and digest ``own`` are not among ``dropped`` (dropped_id, dropped_digest); a null id equals a null id."""
    dropped = dropped.select("dropped_id", "dropped_digest").distinct()
    same = rows["doc_id"].cast("long").eqNullSafe(dropped["dropped_id"]) & (rows[own] == dropped["dropped_digest"])
    return rows.join(dropped, same, "left_anti").drop(own)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no learned language go; learned from the documents' own labels. Decided by id and text.

    Where no document has a label, nothing is learned and nothing can be told
    apart: all documents stay.
    """
    model = train(spark, docs)
    if not model.langs:
        return docs
    rows, own = digested(docs)
    found = identify(spark, rows, model, carried=(own,)).filter("rejected")
    return without(rows, own, found.withColumnsRenamed({"doc_id": "dropped_id", own: "dropped_digest"}))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays, the one with the largest id.

    Decided by id and text: rows that repeat an id with other texts are
    documents of their own; a row repeated whole is one document, and stays or
    goes as often as it comes.
    """
    index = open_index(spark, scratch_path(spark, "digest_index"), INDEX_BUCKETS)
    dropped = deduplicate(spark, docs, index, INDEX_BUCKETS).filter(~F.col("kept"))
    close_index(spark, index)  # the answers lie in written tables
    rows, own = digested(docs, normalized("text"))
    return without(rows, own, dropped.withColumnsRenamed({"doc_id": "dropped_id", "digest": "dropped_digest"}))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates stays, the one with the smallest id.

    Each id and text is a document of its own: they are numbered in the order
    of their ids (then digests; null ids last), and the number is the id that
    the components are formed with.
    """
    rows, own = digested(docs)
    number = f"number_{uuid.uuid4().hex}"
    keys = rows.select(F.col("doc_id").alias("of_id"), F.col(own).alias("of_digest")).distinct()
    # written as it is made: numbers rise over sorted ranges, but another run may cut the ranges elsewhere
    keys = written(spark, keys.orderBy(F.asc_nulls_last("of_id"), "of_digest").withColumn(number, F.monotonically_increasing_id()), "numbers")
    same = rows["doc_id"].eqNullSafe(keys["of_id"]) & (rows[own] == keys["of_digest"])
    rows = written(spark, rows.join(keys, same).select(*docs.columns, number), "numbered")
    dropped = near_duplicates(spark, rows, id_col=number).filter(~F.col("kept")).select(F.col("doc_id").alias(number))
    return rows.join(dropped, number, "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go. Decided by id and text."""
    rows, own = digested(docs)
    found = contaminations(spark, rows, read_table(spark, sf_dir, "benchmark"), carried=(own,))
    return without(rows, own, found.withColumnsRenamed({"doc_id": "dropped_id", own: "dropped_digest"}))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences with their token ids."""
    return pack_documents(docs, tokenizer_file())


STAGES = [("language", language), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("decontamination", decontamination), ("packing", packing)]

#: SQL has no tokenizer, language model or MinHash: tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(spark, stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
