"""Near-duplicate documents by circulant MinHash.

A document is the set of its distinct word shingles. One permutation sends
the hashed shingles to places on a circle, a second one gives the values of
the places; the k-th coordinate of the signature is the smallest value after
turning the values by k places. So two permutations make the whole
signature, and a shingle's contribution is one contiguous slice.

Documents of equal sets form a class, the document of smallest id stands for
it, and copies are never paired. Signatures are cut into bands; classes that
share a band's hash are candidates:

1. every class of a bucket is paired with the bucket's smallest one, each
   pair is confirmed on the full sets, and components are formed;
2. in buckets that still hold several components, each member is compared
   with all others inside a task, by exact intersections, and links between
   components are added.

After that no bucket has an unconfirmed pair of different components, so the
result is that of confirming all pairs in all buckets, without emitting them.
With ``bands=48, rows=6`` a pair of similarity 0.8 shares no bucket with
probability (1 - 0.8^6)^48 = 5e-7; higher similarities are safer still.

Scale: buckets are pre-aggregated before the shuffle; the joins back have one
row per bucket on one side, so adaptive execution splits a hot bucket. Pairs
are confirmed where the members of a centre meet its text; a centre with many
members is dealt out over salted copies. A bucket of many members is dealt to
blocks that meet two by two. Memory holds one centre's set, or two blocks.

Defined cases: words are split at ASCII white space after lower-casing A-Z. A
document of fewer words than a shingle is one shingle; one without words, or
null text, has none and is linked with nothing. Rows that share an id are one
node. A row without id gets its class's component and stays only if no row of
the class has an id. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WordHash, blocks, looked_up, mix64, raw_text, written
from .components import connected_components

CIRCLE = 1 << 20
POWERS = np.array([pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(64)], np.uint64)


def words_of(raw: bytes) -> list[bytes]:
    return raw.lower().split()


def shingle_hashes(hashed: np.ndarray, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of one document."""
    size = min(words, len(hashed))
    if not size:
        return hashed
    total = np.full(len(hashed) - size + 1, size, np.uint64)
    for k in range(size):
        total += hashed[k : len(hashed) - size + 1 + k] * POWERS[k : k + 1]
    return np.unique(mix64(total))


def shingle_set(words: list[bytes], size: int) -> set:
    """The shingles themselves."""
    if len(words) < size:
        return {tuple(words)} if words else set()
    return set(zip(*(words[k:] for k in range(size)), strict=False))


class Circulant:
    """Signatures from two permutations of a circle, cut into hashed bands."""

    def __init__(self, bands: int, rows: int, seed: int = 1):
        self.bands, self.rows = bands, rows
        rng = np.random.default_rng(seed)
        self.salt = rng.integers(1, 1 << 63, dtype=np.uint64)
        values = rng.permutation(CIRCLE).astype(np.uint32)
        size = bands * rows
        self.turned = np.lib.stride_tricks.sliding_window_view(np.concatenate([values, values[: size - 1]]), size)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        places = (mix64(shingles ^ self.salt) >> np.uint64(64 - 20)).astype(np.int64)
        out = np.full(self.bands * self.rows, 0xFFFFFFFF, np.uint32)
        for at in range(0, len(places), 2048):
            np.minimum(out, self.turned[places[at : at + 2048]].min(axis=0), out=out)
        return out

    def band_hashes(self, signatures: np.ndarray) -> np.ndarray:
        """A row of band hashes for each row of signatures."""
        parts = signatures.reshape(len(signatures), self.bands, self.rows).astype(np.uint64)
        total = (parts * POWERS[: self.rows]).sum(axis=2, dtype=np.uint64) + np.arange(self.bands, dtype=np.uint64) * POWERS[40]
        return mix64(total).view(np.int64)


def sketches(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, n_shingles, set_hash, bands) of each document (doc_id, text)."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_hash", pa.binary()), ("bands", pa.list_(pa.int64()))])
        circle, known = Circulant(bands, rows), WordHash()
        for block in blocks(batches, "text", 4 << 20):
            sets = [shingle_hashes(known.array(words_of(raw)), words) for raw in block.column("text").to_pylist()]
            full = np.array([len(s) > 0 for s in sets])
            values = circle.band_hashes(np.stack([circle.signature(s) for s in sets if len(s)])) if full.any() else np.zeros((0, bands), np.int64)
            offsets = np.concatenate([[0], np.cumsum(full * bands)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.reshape(-1))),
                ],
                schema=schema,
            )

    return docs.mapInArrow(tasks, "doc_id long, n_shingles long, set_hash binary, bands array<long>")


def confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int, members_per_task: int = 2000) -> DataFrame:
    """The pairs (centre, member) whose full shingle sets are similar enough.

    Members travel to their centre's text; a centre of many members is dealt
    out over as many copies as it needs.
    """
    copies = pairs.groupBy("centre").agg(F.ceil(F.count(F.lit(1)) / members_per_task).cast("int").alias("copies"))
    centres = (
        copies.join(texts.withColumnRenamed("doc_id", "centre"), "centre")
        .select("centre", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"), F.lit(None).cast("long").alias("member"), "text")
    )
    members = (
        pairs.join(copies, "centre")
        .select(F.col("member").alias("doc_id"), "centre", F.expr("int(pmod(xxhash64(member), copies))").alias("copy"))
        .join(texts, "doc_id")
        .select("centre", "copy", F.col("doc_id").alias("member"), "text")
    )

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, sets = None, []
        for block in blocks(batches, "text", 4 << 20):
            found = []
            for name, member, raw in zip(block.column("centre").to_pylist(), block.column("member").to_pylist(), block.column("text").to_pylist(), strict=True):
                if name != centre:
                    centre, sets = name, []
                own = shingle_set(words_of(raw), words)
                if member is None:
                    sets.append(own)
                    continue
                for other in sets:
                    shared = len(own & other)
                    if 100 * shared >= percent * (len(own) + len(other) - shared):
                        found.append((name, member))
                        break
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], names=["a", "b"])

    met = centres.union(members).repartition("centre", "copy").sortWithinPartitions("centre", "copy", F.col("member").asc_nulls_first())
    return met.select("centre", "member", "text").mapInArrow(tasks, "a long, b long").distinct()


def open_buckets(buckets: DataFrame, found: DataFrame) -> DataFrame:
    """(key, rep, size, component) of buckets that hold several components; of equal buckets one."""
    slots = buckets.select("key", "rep", "size").join(found.withColumnRenamed("node", "rep"), "rep", "left")
    slots = slots.select("key", "rep", "size", F.coalesce("component", "rep").alias("component"))
    by_key = slots.groupBy("key").agg(
        F.count(F.lit(1)).alias("held"),
        F.bit_xor(F.xxhash64("rep")).alias("x1"),
        F.bit_xor(F.xxhash64(F.lit(1), "rep")).alias("x2"),
        (F.min("component") != F.max("component")).alias("open"),
    )
    return slots.join(by_key.filter("open").groupBy("held", "x1", "x2").agg(F.min("key").alias("key")).select("key"), "key")


def linked_within_buckets(spark: SparkSession, slots: DataFrame, texts: DataFrame, words: int, percent: int, block_members: int = 2000, block_shingles: int = 1_000_000) -> DataFrame:
    """Links (a, b) that join the components of a bucket, found inside tasks without making pairs.

    A bucket beyond a block's size is dealt to blocks, and each two blocks
    meet in one group; so a group has a bounded number of shingles.
    """
    # spread over all tasks: a hot bucket's members are multiplied where they lie, not in one place
    slots = written(spark, slots.repartition(F.xxhash64("key", "rep")), "open_slots")
    blocks_of = F.ceil(F.greatest(F.count(F.lit(1)) / block_members, F.sum("size") / block_shingles)).cast("int").alias("blocks")
    sizes = written(spark, slots.groupBy("key").agg(F.count(F.lit(1)).alias("held"), blocks_of), "open_sizes")
    dealt = looked_up(slots, sizes, "key", slots.count()).withColumn("side", F.expr("int(pmod(xxhash64(rep), blocks))"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("key", F.least("side", "other").alias("p"), F.greatest("side", "other").alias("q"), "side", F.col("rep").alias("doc_id"), "component")
    met = dealt.join(texts, "doc_id").repartition("key", "p", "q").sortWithinPartitions("key", "p", "q", "side", "doc_id")

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, group = None, None
        for block in blocks(batches, "text", 4 << 20):
            heads = zip(*(block.column(n).to_pylist() for n in ("key", "p", "q")), strict=True)
            rows = zip(*(block.column(n).to_pylist() for n in ("side", "doc_id", "component", "text")), strict=True)
            for head, (side, doc, component, raw) in zip(heads, rows, strict=True):
                if head != current:
                    if group is not None and group.links:
                        yield group.batch()
                    current, group = head, Group(percent, head[1] != head[2])
                group.add(side, doc, component, shingle_set(words_of(raw), words))
        if group is not None and group.links:
            yield group.batch()

    return met.select("key", "p", "q", "side", "doc_id", "component", "text").mapInArrow(tasks, "a long, b long").distinct()


class Group:
    """Members of a bucket, or of two of its blocks, compared as they come.

    A new member's shingles are marked, and the marks are added up over the
    concatenated shingles of all earlier ones: exact intersections with all of
    them at once.
    """

    def __init__(self, percent: int, crosswise: bool):
        self.percent, self.crosswise = percent, crosswise
        self.names: dict = {}
        self.docs: list[int] = []
        self.sides: list[int] = []
        self.up: dict[int, int] = {}
        self.components: list[int] = []
        self.sizes = np.zeros(0, np.int64)
        self.held = np.zeros(1024, np.int32)
        self.used = 0
        self.links: list[tuple[int, int]] = []

    def top(self, component: int) -> int:
        while self.up.setdefault(component, component) != component:
            component = self.up[component]
        return component

    def add(self, side: int, doc: int, component: int, own: set) -> None:
        names = self.names
        ids = np.fromiter((names.setdefault(s, len(names)) for s in own), np.int32, len(own))
        if self.docs and not (self.crosswise and side == self.sides[0]):
            mark = np.zeros(len(names), np.int32)
            mark[ids] = 1
            starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])
            both = np.add.reduceat(mark[self.held[: self.used]], starts)
            near = np.flatnonzero(100 * both >= self.percent * (self.sizes + len(ids) - both))
            for i in near.tolist():
                mine, theirs = self.top(component), self.top(self.components[i])
                if mine != theirs and not (self.crosswise and self.sides[i] == side):
                    self.up[max(mine, theirs)] = min(mine, theirs)
                    self.links.append((doc, self.docs[i]))
        if self.crosswise and self.docs and side != self.sides[0]:
            return  # the second block is only compared with the first
        while self.used + len(ids) > len(self.held):
            self.held = np.concatenate([self.held, np.zeros(len(self.held), np.int32)])
        self.held[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        self.sizes = np.append(self.sizes, len(ids))
        self.docs.append(doc)
        self.sides.append(side)
        self.components.append(component)

    def batch(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in self.links], pa.int64()) for i in (0, 1)], names=["a", "b"])


def near_duplicates(
    spark: SparkSession,
    docs: DataFrame,
    words: int = 5,
    percent: int = 80,
    bands: int = 48,
    rows: int = 6,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked where 100 * |intersection| >= ``percent`` * |union|.
    """
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), raw_text(text_col).alias("text"))
    sketched = written(spark, sketches(named, words, bands, rows), "sketches")
    classes = sketched.filter("set_hash is not null").groupBy("set_hash").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("size"), F.first("bands").alias("bands"))
    slots = written(spark, classes.filter("rep is not null").select("rep", "size", F.explode("bands").alias("key")), "band_slots")
    shared = slots.groupBy("key").agg(F.count(F.lit(1)).alias("held"), F.min(F.struct("rep", "size")).alias("centre")).filter("held > 1")
    buckets = written(spark, slots.join(shared, "key").select("key", "held", "rep", "size", F.col("centre.rep").alias("centre"), F.col("centre.size").alias("centre_size")), "buckets")
    near_size = f"100 * least(size, {{0}}) >= {percent} * greatest(size, {{0}})"
    pairs = written(spark, buckets.filter("rep != centre").filter(near_size.format("centre_size")).select("centre", F.col("rep").alias("member")).distinct(), "pairs")
    texts = written(spark, named.join(buckets.select(F.col("rep").alias("doc_id")).distinct(), "doc_id"), "candidate_texts")
    links = written(spark, confirmed(pairs, texts, words, percent), "links")
    found = connected_components(spark, links)

    more = linked_within_buckets(spark, open_buckets(buckets.filter("held > 2"), found), texts, words, percent)
    found = connected_components(spark, found.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))

    of_class = classes.select("set_hash", "rep").join(found.withColumnRenamed("node", "rep"), "rep", "left")
    of_class = written(spark, of_class.select("set_hash", F.coalesce("component", "rep").alias("component")), "classes")
    out = sketched.select("doc_id", "n_shingles", "set_hash").join(of_class, "set_hash", "left")
    component = F.when(F.col("set_hash").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
