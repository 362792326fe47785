"""Merkle audit: exact places of faults, and the tree against hashlib."""

import hashlib

from pyspark.sql import functions as F

from cabmetrics.llm.common import written
from cabmetrics.llm.fixity import audit, leaves, levels_for, tree, warc_records
from cabmetrics.llm.queries import QUERIES

RANGE, FAN = 2000, 3


def archive(spark, rows, segment_bytes=20_000):
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, offset int").repartition(2, "page_id")
    return written(spark, warc_records(pages, segment_bytes), "records")


def trees(spark, *records):
    return [tree(spark, leaves(r), levels_for(20_000, RANGE, FAN), RANGE, FAN) for r in records]


ROWS = [(i, f"http://x/{i}", "é" * (i * 37 % 900)) for i in range(120)] + [(None, None, None), (7, "http://x/7", "again"), (500, "http://long", "z" * 50_000)]


def test_records_fill_segments_in_order(spark):
    records = archive(spark, ROWS).collect()
    assert len(records) == len(ROWS)
    by_segment = {}
    for r in records:
        assert len(r["record"]) == r["length"]
        head, _, body = bytes(r["record"]).partition(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.0\r\nWARC-Type: response\r\n")
        size = int(head.rsplit(b"Content-Length: ", 1)[1])
        assert body[size:] == b"\r\n\r\n" and hashlib.sha256(body[:size]).hexdigest().encode() in head
        by_segment.setdefault(r["segment"], []).append((r["offset"], r["length"]))
    for parts in by_segment.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 20_000 or len(parts) == 1


def test_tree_matches_hashlib(spark):
    records = archive(spark, ROWS)
    (ours,) = trees(spark, records)
    level = {(r["segment"], r["offset"]): hashlib.sha256(r["record"]).hexdigest() for r in records.collect()}
    for k, frame in enumerate(ours):
        assert {(r["segment"], r["node"]): r["digest"] for r in frame.collect()} == level
        up = {}
        for (segment, node), digest in sorted(level.items()):
            up.setdefault((segment, node // (RANGE if k == 0 else FAN)), []).append(f"{node}:{digest}")
        level = {key: hashlib.sha256(",".join(parts).encode()).hexdigest() for key, parts in up.items()}
    roots = ours[-2 if ours[-1].count() == 0 else -1]
    assert roots.filter("node = 0").count() == records.select("segment").distinct().count()


def test_faults_are_located(spark):
    records = archive(spark, ROWS)
    lost = (F.col("page_id") % 41 == 3).eqNullSafe(True)
    bad = (F.col("page_id") % 29 == 5).eqNullSafe(True)
    replica = records.filter(~lost).withColumn("record", F.when(bad, F.concat("record", F.lit(b" "))).otherwise(F.col("record")))
    added = records.limit(1).select((F.col("segment") + 77).alias("segment"), F.lit(0).cast("long").alias("offset"), "length", "page_id", "record")
    ours, theirs = trees(spark, records, replica.union(added))
    got = sorted(tuple(r) for r in audit(ours, theirs, RANGE, FAN).collect())
    want = [(r["segment"], r["offset"], "missing" if r["lost"] else "corrupt") for r in records.withColumns({"lost": lost, "bad": bad}).filter("lost or bad").collect()]
    want += [(r["segment"], 0, "extra") for r in added.collect()]
    assert got == sorted(want)
    assert audit(ours, ours, RANGE, FAN).count() == 0


def test_an_archive_laid_out_anew_differs_from_the_lost_record_on(spark):
    pages = spark.createDataFrame(ROWS[:40], "page_id long, url string, html string").coalesce(1)
    records, anew = (written(spark, warc_records(p, 1 << 20), "records") for p in (pages, pages.filter("page_id <> 9")))
    lost = next(r["offset"] for r in records.collect() if r["page_id"] == 9)
    ours, theirs = trees(spark, records, anew)
    found = {r["offset"]: r["fault"] for r in audit(ours, theirs, RANGE, FAN).collect()}
    offsets = {r["offset"] for r in records.collect()}
    assert offsets & found.keys() == {o for o in offsets if o >= lost} and not any(o < lost for o in found)


def test_empty_table(spark):
    records = archive(spark, [])
    ours, theirs = trees(spark, records, records)
    assert records.count() == 0 and audit(ours, theirs, RANGE, FAN).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op8_fixity"](spark, sf).toPandas()
    assert sorted(got["page_id"]) == [r["page_id"] for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id").orderBy("page_id").collect()]
    want = got["page_id"].map(lambda i: "missing" if i % 997 == 5 else "corrupt" if i % 499 == 7 else "intact")
    assert (got["status"] == want).all() and (got["status"] != "intact").any()
