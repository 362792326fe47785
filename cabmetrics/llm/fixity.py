"""WARC records and the Merkle audit of their replicas.

``warc_records`` lays pages out as WARC/1.0 response records in segments of
bounded size. A replica's records are hashed into one tree for each segment:
a leaf is a record's digest, the nodes above it cover ordered ranges of byte
offsets (``range_bytes``, then ``fanout`` times as much on each level up) and
hash their children with their places, up to a root over the whole segment.
``audit`` compares the roots of two replicas and goes down only where they
differ, so equal segments cost one row and a fault costs one path.

Ranges follow offsets, not record numbers: a record that is missing in one
replica changes its own path only. A replica is a copy of the archive's files,
so what it still has lies at the same offsets, and a lost record is a hole in
it. That is assumed: an archive laid out anew, without the lost record, has
other offsets from there to the segment's end, and all of them are reported.

Scale: segments are cut inside the scan tasks, without a shuffle. A level is
one pre-grouped aggregate of bounded groups (children of one range) and is
written; the descent joins the children of differing nodes only.

Defined cases: null html or url counts as empty, a null id is written as 0 in
the record's name; repeated pages are records of their own. Replicas may lack
records or segments or have more; an empty table has no segment. Other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import written

CRLF = "\r\n"


def record_text() -> F.Column:
    """One page (page_id, url, html) as a WARC response record."""
    html, url = F.coalesce("html", F.lit("")), F.coalesce("url", F.lit(""))
    name = F.lpad(F.hex(F.coalesce(F.col("page_id").cast("long"), F.lit(0))), 32, "0")
    uuid = F.concat_ws("-", *(F.substring(F.lower(name), start, n) for start, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))
    head = F.concat(
        F.lit(f"WARC/1.0{CRLF}WARC-Type: response{CRLF}WARC-Record-ID: <urn:uuid:"),
        uuid,
        F.lit(f">{CRLF}WARC-Target-URI: "),
        url,
        F.lit(f"{CRLF}WARC-Payload-Digest: sha256:"),
        F.sha2(html, 256),
        F.lit(f"{CRLF}Content-Type: text/html{CRLF}Content-Length: "),
        F.octet_length(html).cast("string"),
        F.lit(CRLF + CRLF),
    )
    return F.concat(head, html, F.lit(CRLF + CRLF))


def warc_records(pages: DataFrame, segment_bytes: int = 64 << 20) -> DataFrame:
    """(segment, offset, length, page_id, record): the pages as records of segments.

    A segment is a stretch of one scan task's pages; write the result before
    it is read more than once.
    """

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        segment, offset = TaskContext.get().partitionId() << 24, 0
        for batch in batches:
            length = pc.binary_length(batch.column("record")).to_numpy(zero_copy_only=False).astype(np.int64)
            segments, offsets = [], []
            for n in length.tolist():
                if offset and offset + n > segment_bytes:
                    segment, offset = segment + 1, 0
                segments.append(segment)
                offsets.append(offset)
                offset += n
            yield pa.RecordBatch.from_arrays(
                [pa.array(segments, pa.int64()), pa.array(offsets, pa.int64()), pa.array(length, pa.int64()), batch.column("page_id"), batch.column("record")],
                names=["segment", "offset", "length", "page_id", "record"],
            )

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), record_text().cast("binary").alias("record"))
    return rows.mapInArrow(tasks, "segment long, offset long, length long, page_id long, record binary")


def leaves(records: DataFrame) -> DataFrame:
    """Level 0: (segment, node, digest) with the record's offset as node."""
    return records.select("segment", F.col("offset").alias("node"), F.sha2("record", 256).alias("digest"))


def levels_for(segment_bytes: int, range_bytes: int, fanout: int) -> int:
    level, width = 1, range_bytes
    while width < segment_bytes:
        level, width = level + 1, width * fanout
    return level


def tree(spark: SparkSession, leaf: DataFrame, levels: int, range_bytes: int = 1 << 16, fanout: int = 16) -> list[DataFrame]:
    """The tree's levels (segment, node, digest) from the leaves to the roots, each written."""
    out = [written(spark, leaf, "merkle_0")]
    for level in range(1, levels + 1):
        parent = F.expr(f"node div {range_bytes if level == 1 else fanout}")
        child = F.concat_ws(":", F.col("node").cast("string"), "digest")
        up = out[-1].groupBy("segment", parent.alias("node")).agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("node", child.alias("child")))), lambda c: c["child"]), ","), 256).alias("digest"))
        out.append(written(spark, up, f"merkle_{level}"))
    return out


def audit(ours: list[DataFrame], theirs: list[DataFrame], range_bytes: int = 1 << 16, fanout: int = 16) -> DataFrame:
    """(segment, offset, fault) of the records that differ: corrupt, missing (in theirs) or extra."""
    suspects = None
    for level in range(len(ours) - 1, -1, -1):
        a, b = ours[level], theirs[level]
        if suspects is not None:
            parent = F.expr(f"node div {range_bytes if level == 0 else fanout}")
            a, b = (x.withColumn("parent", parent).join(suspects, ["segment", "parent"], "left_semi") for x in (a, b))
        a, b = a.select("segment", "node", F.col("digest").alias("a")), b.select("segment", "node", F.col("digest").alias("b"))
        differing = a.join(b, ["segment", "node"], "full_outer").filter("not (a <=> b)")
        if level:  # both sides of the next level ask for them: written once
            suspects = written(a.sparkSession, differing.select("segment", F.col("node").alias("parent")), "suspects")
    fault = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "extra").otherwise("corrupt")
    return differing.select("segment", F.col("node").alias("offset"), fault.alias("fault"))
