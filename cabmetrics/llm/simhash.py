"""Near-duplicate documents by SimHash, found with Golay-code fuzzy hashing.

A document's fingerprint has a bit for each of the 64 bits of a hash: one if
the bit is set in more than half of the hashes of its word shingles, repeats
included. Fingerprints that differ in at most ``DISTANCE`` = 3 bits are linked.

Method: a fingerprint is cut into three segments of 22, 21 and 21 bits, each
read as a word of the perfect binary Golay code [23, 12, 7]. Every word lies
within three bits of exactly one codeword. Of two words one bit apart, either
both decode to the same codeword, or both lie three bits from their own and
four from the other's. So a word's keys are the index of its codeword and, for
a word three bits off, the unordered pairs of that index with those of the
five codewords at distance four: words at most one bit apart share a key, and
a word has one or six keys.

At most three differing bits over three segments leave two cases:

* one segment is equal, and of the other two one differs in at most one bit:
  key of the equal segment's bits and a Golay key of the other (six orders);
* each segment differs in exactly one bit: Golay keys of the first two
  segments. There the parities of all three segments differ, so the key also
  holds how the parities differ among each other, and fingerprints meet only
  those of the other parity.

Every link therefore has a bucket in which both ends meet; candidates are
verified by counting differing bits, so the links are exact.

Components: only different fingerprints are compared. In a bucket the members
meet inside a task, as vectors, and those links are returned that join
separate components there; no pairs are emitted. A bucket of more than
``BLOCK`` members is dealt to blocks, and each two blocks meet in one group.

Scale: fingerprints are made in one pass, and copies collapse before any key
is made. The key space grows with none of the data: about 60 keys of 8 bytes
a fingerprint, 30 or more bits of selection each. Buckets with one member are
dropped by a count that is combined before its shuffle. Memory: one
document's words, or two blocks of 64-bit integers. The work of a bucket of
many different fingerprints is quadratic, spread over groups of bounded size.

Defined cases: words are split at ASCII white space after lower-casing A-Z. A
document of fewer words than a shingle is one shingle; one without words, or
null text, has fingerprint zero and is linked like any other. The component's
id is the smallest id of its rows; rows without an id are nodes all the same,
and a component of such rows only has no id. Rows that share an id but not a
text are different documents, which may lie in different components. An empty
table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blocks, looked_up, mix64, raw_text, written
from .components import connected_components

DISTANCE = 3
BLOCK = 8192
#: (first bit, bits) of the segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Generator polynomial of the Golay code (fixed value), x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011
HASH_SEED = 42


def fingerprint(raw: bytes, words: int) -> int:
    """Fingerprint of one text: a bit is one if set in over half of the shingles' hashes."""
    import xxhash

    found = raw.lower().split()
    if not found:
        return 0
    text = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    size = min(words, len(found))
    starts = [0, *(ends[: len(found) - size] + 1).tolist()]
    hashed = xxhash.xxh64_intdigest
    hashes = np.fromiter((hashed(text[a:b], HASH_SEED) for a, b in zip(starts, ends[size - 1 :].tolist(), strict=True)), np.uint64, len(starts))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].astype("<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, fingerprint) of each row of (doc_id, text)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            values = np.array([fingerprint(raw, words) for raw in block.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(values.view(np.int64))], names=["doc_id", "fingerprint"])

    return docs.mapInArrow(tasks, f"doc_id {kind}, fingerprint long")


class Golay:
    """Keys of 23-bit words such that words at most one bit apart share one."""

    def __init__(self):
        codewords = np.zeros(1, np.int64)
        for bit in range(12):  # all sums of the generator's shifts
            codewords = np.concatenate([codewords, codewords ^ (GENERATOR << bit)])
        index = np.arange(len(codewords), dtype=np.int64)
        self.nearest = np.full(1 << 23, -1, np.int16)
        self.off = np.zeros(1 << 23, np.int8)
        for size in range(4):
            for bits in itertools.combinations(range(23), size):
                word = codewords ^ sum(1 << b for b in bits)
                self.nearest[word], self.off[word] = index, size
        # a word three bits off lies four from c + (light codeword over its three error bits)
        self.codewords = codewords
        light = codewords[np.bitwise_count(codewords) == 7]
        errors = np.array([sum(1 << b for b in bits) for bits in itertools.combinations(range(23), 3)])
        self.others = np.stack([light[(light & error) == error] for error in errors])
        self.error_row = np.zeros(1 << 23, np.int16)
        self.error_row[errors] = np.arange(len(errors))

    def keys(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(keys, six a word; whether the word has them). A key has 24 bits."""
        nearest = self.nearest[words].astype(np.int64)
        codeword = self.codewords[nearest]
        row = self.error_row[words ^ codeword]
        others = self.nearest[codeword[:, None] ^ self.others[row]].astype(np.int64)
        low, high = np.minimum(nearest[:, None], others), np.maximum(nearest[:, None], others)
        keys = np.concatenate([(nearest * 4097)[:, None], low << 12 | high], axis=1)
        held = np.ones(keys.shape, bool)
        held[self.off[words] < 3, 1:] = False
        return keys, held


def bucket_keys(prints: np.ndarray, code: Golay) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, 64-bit key, side) of the buckets of each fingerprint; sides 0 and 1 of a key meet, side 2 meets itself."""
    parts = [(prints >> np.uint64(first) & np.uint64((1 << bits) - 1)).astype(np.int64) for first, bits in SEGMENTS]
    golay = [code.keys(p) for p in parts]
    parity = [np.bitwise_count(p).astype(np.int64) & 1 for p in parts]
    rows, keys, sides = [], [], []
    for equal, near in itertools.permutations(range(3), 2):
        near_keys, held = golay[near]
        row, column = np.nonzero(held)
        rows.append(row)
        keys.append(((equal * 3 + near) << 46) | (parts[equal][row] << 24) | near_keys[row, column])
        sides.append(np.full(len(row), 2, np.int8))
    (one, held_one), (two, held_two) = golay[0], golay[1]
    row, column = np.nonzero((held_one[:, :, None] & held_two[:, None, :]).reshape(len(prints), 36))
    rows.append(row)
    turned = (parity[0] ^ parity[1]) << 1 | (parity[0] ^ parity[2])
    keys.append((np.int64(1) << 60) | (turned[row] << 48) | (one[row, column // 6] << 24) | two[row, column % 6])
    sides.append(parity[0][row].astype(np.int8))
    return np.concatenate(rows), mix64(np.concatenate(keys).view(np.uint64)).view(np.int64), np.concatenate(sides)


def keyed(prints: DataFrame) -> DataFrame:
    """(key, side, fingerprint): the buckets of each fingerprint."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Golay()
        for batch in batches:
            values = batch.column("fingerprint").to_numpy().view(np.uint64)
            for at in range(0, len(values), 2048):
                part = values[at : at + 2048]
                row, key, side = bucket_keys(part, code)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(side), pa.array(part[row].view(np.int64))], names=["key", "side", "fingerprint"])

    return prints.select("fingerprint").mapInArrow(tasks, "key long, side byte, fingerprint long")


def links_within(values: np.ndarray, first: int, self_meeting: bool) -> list[tuple[int, int]]:
    """Links that join the members (fingerprints) of a group.

    Members before ``first`` meet those after, and one another if
    ``self_meeting``; a pair that other links join already is passed over.
    """
    component, found = np.arange(len(values)), []
    for i in range(len(values) if self_meeting else first):
        at = i + 1 if self_meeting else first
        near = at + np.flatnonzero(np.bitwise_count(values[at:] ^ values[i]) <= DISTANCE)
        for j in near[component[near] != component[i]].tolist():
            if component[j] != component[i]:
                found.append((int(values[i]), int(values[j])))
                component[component == component[j]] = component[i]
    return found


def bucket_links(spark: SparkSession, slots: DataFrame) -> DataFrame:
    """Links (a, b) that join each bucket's members, found inside tasks.

    Members of a bucket beyond ``BLOCK`` are dealt to blocks by their bits;
    each two blocks meet in a group (key, p, q).
    """
    block = BLOCK
    sizes = slots.groupBy("key").agg(F.count(F.lit(1)).alias("held"), F.min("side").alias("least"), F.max("side").alias("most"))
    shared = sizes.filter("held > 1 and (most = 2 or least < most)").select("key", F.ceil(F.col("held") / block).cast("int").alias("blocks"))
    dealt = slots.join(shared, "key")
    own = F.expr("int(pmod(xxhash64(fingerprint), blocks))")
    few = dealt.filter("blocks = 1").select("key", F.lit(0).alias("p"), F.lit(0).alias("q"), F.lit(0).alias("own"), "side", "fingerprint")
    # the members of a large bucket leave its task before they are multiplied
    many = written(spark, dealt.filter("blocks > 1").repartition("key", "fingerprint"), "large_buckets")
    many = many.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    many = many.select("key", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "own", "side", "fingerprint")

    def group_links(own: np.ndarray, side: np.ndarray, values: np.ndarray, crosswise: bool) -> list[tuple[int, int]]:
        here = own == own.min()
        if side[0] == 2:  # a key's sides are all 2, or all 0 and 1
            return links_within(np.concatenate([values[here], values[~here]]), int(here.sum()), False) if crosswise else links_within(values, 0, True)
        found = []
        for one in (0, 1) if crosswise else (0,):
            a = (side == one) & here if crosswise else side == 0
            b = (side != one) & ~here if crosswise else side == 1
            found += links_within(np.concatenate([values[a], values[b]]), int(a.sum()), False)
        return found

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in itertools.chain(batches, [None]):
            last = batch is None
            batch = rest if last else batch if rest is None else pa.concat_batches([rest, batch])
            rest = None
            if batch is None or not batch.num_rows:
                continue
            key, p, q, own, side, prints = (batch.column(c).to_numpy() for c in ("key", "p", "q", "own", "side", "fingerprint"))
            starts = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (p[1:] != p[:-1]) | (q[1:] != q[:-1])]))
            ends = np.concatenate([starts[1:], [len(key)]])
            if not last:
                rest = batch.slice(starts[-1])
                starts, ends = starts[:-1], ends[:-1]
            values, found = prints.view(np.uint64), []
            pairs = ends - starts == 2  # most buckets: compared all at once
            one, two = values[starts[pairs]], values[starts[pairs] + 1]
            near = (np.bitwise_count(one ^ two) <= DISTANCE) & ((side[starts[pairs]] == 2) | (side[starts[pairs]] != side[starts[pairs] + 1]))
            found += zip(one[near].tolist(), two[near].tolist(), strict=True)
            for a, b in zip(starts[~pairs].tolist(), ends[~pairs].tolist(), strict=True):
                if b - a > 1 and (p[a] == q[a] or own[a:b].min() != own[a:b].max()):
                    found += group_links(own[a:b], side[a:b], values[a:b], bool(p[a] != q[a]))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.array([f[i] for f in found], np.uint64).view(np.int64)) for i in (0, 1)], names=["a", "b"])

    met = few.union(many).repartition("key", "p", "q").sortWithinPartitions("key", "p", "q")
    return met.mapInArrow(tasks, "a long, b long").distinct()


def simhash_duplicates(spark: SparkSession, docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, fingerprint (long), component_id (smallest id that links reach)."""
    named = docs.select(F.col(id_col).alias("doc_id"), raw_text(text_col).alias("text"))
    made = written(spark, fingerprints(named, words), "fingerprints")
    classes = written(spark, made.groupBy("fingerprint").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("held")), "different")
    links = bucket_links(spark, written(spark, keyed(classes), "slots"))
    found = connected_components(spark, links)
    found = found.withColumnsRenamed({"node": "fingerprint", "component": "reached"})
    linked = written(spark, classes.join(found, "fingerprint", "left").withColumn("reached", F.coalesce("reached", "fingerprint")), "reached")
    ids = linked.groupBy("reached").agg(F.min("least").alias("component_id"))
    components = linked.select("fingerprint", "held", "reached").join(ids, "reached").drop("reached")
    return looked_up(made, written(spark, components, "components"), "fingerprint", made.count()).select("doc_id", "fingerprint", "component_id")
