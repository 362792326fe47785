"""Benchmark decontamination by the q-gram lemma.

Texts and benchmark items are compared in lower case with every run of other
characters than letters and digits as one blank, as UTF-8 bytes. An item of
more than ``window`` bytes is cut into windows of that size, no further apart
than the edits allowed in one, the last one at its end; a document is
contaminated if it holds a window with at most ``floor(error_rate * length)``
edits. So a copied stretch of ``window`` bytes is found at whatever offset of
the item it lies: the nearest window lacks half the edits of it at most, and
the other half may be edits of the copy.

A place with k edits shares at least ``length + 1 - q * (k + 1)`` q-grams
with the window, and they lie on at most k + 1 neighbouring diagonals. So the
shared q-grams are counted in diagonal bands that overlap by k, the bands
that reach the bound are kept, and each is verified by an alignment over the
band's diagonals. Windows too short for the lemma are taken whole: every
band that shares a q-gram is verified; those shorter than q must appear
exactly.

Scale: the benchmark is streamed to the driver in blocks of at most
``block_bytes``; each block's q-gram index is broadcast (its size is bounded
by the block: it holds each q-gram of an item once, with the range of the
windows around it) and meets all documents in one map. With several blocks each
one's matches are written before the next is built.

Defined cases: null or empty texts match nothing, nor does an empty benchmark
or an item without letters and digits; repeated items are all reported, a
repeated row gives its matches again (the result has them once per id). Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cabmetrics.session import scratch_path

from .common import batch_of, blocks, raw_text, received, sent

#: Every ASCII byte that is no letter or digit becomes a blank.
KEPT = bytes(b if chr(b).isalnum() or b >= 128 else 32 for b in range(256))
PAD = 4096


def comparable(raw: bytes) -> bytes:
    lowered = raw.lower() if raw.isascii() else raw.decode("utf-8", "replace").lower().encode("utf-8", "replace")
    return b" ".join(lowered.translate(KEPT).split())


def gram_hashes(text: np.ndarray, q: int) -> np.ndarray:
    """32-bit hash of the q bytes from each position on."""
    out = np.zeros(max(0, len(text) - q + 1), np.uint32)
    if not len(out):
        return out
    for k in range(q):
        out *= np.uint32(0x01000193)
        out += text[k : len(text) - q + 1 + k]
    out ^= out >> np.uint32(15)
    out *= np.uint32(0x2C1B3C6D)
    out ^= out >> np.uint32(13)
    return out


def windows_of(item: bytes, window: int, error_rate: float = 0.06) -> list[int]:
    """Starts of the windows of one item."""
    if len(item) <= window:
        return [0]
    steps = window // 2, max(1, int(error_rate * window))
    return sorted({start for step in steps for start in range(0, len(item) - window, step)} | {len(item) - window})


def expanded(firsts: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """The ranges of so many numbers from each first one on, one after the other."""
    return np.repeat(firsts.astype(np.int64), numbers) + np.arange(numbers.sum()) - np.repeat(np.cumsum(numbers) - numbers, numbers)


@dataclass
class Index:
    """q-grams of a block of benchmark windows."""

    q: int
    items: list[int]
    texts: list[bytes]
    edits: np.ndarray
    need: np.ndarray
    hashes: np.ndarray
    #: By hash: its first occurrence below (and their end).
    starts: np.ndarray
    #: By occurrence of a q-gram in an item: its place, the first window around it and their number.
    place: np.ndarray
    first: np.ndarray
    around: np.ndarray
    #: By window: its start in the item.
    begin: np.ndarray
    filter: np.ndarray

    @staticmethod
    def build(block: list[tuple[int, bytes]], q: int, window: int, error_rate: float) -> Index:
        items, texts, begin, grams, first, around = [], [], [], [], [], []
        for item, text in block:
            own = np.array(windows_of(text, window, error_rate))
            hashed = gram_hashes(np.frombuffer(text, np.uint8), q)
            at = np.arange(len(hashed))
            low = np.searchsorted(own, at + q - min(window, len(text)))
            grams.append(hashed)
            first.append(low + len(items))
            around.append(np.searchsorted(own, at, side="right") - low)
            for start in own.tolist():
                items.append(item)
                texts.append(text[start : start + window])
            begin.append(own)
        sizes = np.array([len(t) for t in texts])
        edits = np.floor(error_rate * sizes).astype(np.int64)
        need = np.maximum(1, sizes + 1 - q * (edits + 1))
        edits[sizes < q] = 0
        flat = np.concatenate(grams) if grams else np.zeros(0, np.uint32)
        order = np.argsort(flat, kind="stable")
        joined = lambda parts: np.concatenate(parts).astype(np.int32) if parts else np.zeros(0, np.int32)
        place = joined([np.arange(len(g)) for g in grams])[order]
        first, around, begin = joined(first)[order], joined(around)[order], joined(begin)
        hashes, starts = np.unique(flat[order], return_index=True)
        bits = min(27, max(16, int(64 * len(hashes)).bit_length()))
        seen = np.zeros(1 << bits, bool)
        seen[hashes >> np.uint32(32 - bits)] = True
        return Index(q, items, texts, edits, need, hashes, np.append(starts, len(flat)), place, first, around, begin, seen)

    def bands(self, text: np.ndarray) -> list[tuple[int, int]]:
        """(window, first diagonal) of the bands that share enough q-grams."""
        if len(text) < self.q or not len(self.hashes):
            return []
        hashed = gram_hashes(text, self.q)
        shift = np.uint32(32 - (len(self.filter).bit_length() - 1))
        at = np.flatnonzero(self.filter[hashed >> shift])
        gram = np.minimum(np.searchsorted(self.hashes, hashed[at]), len(self.hashes) - 1)
        true = self.hashes[gram] == hashed[at]
        at, gram = at[true], gram[true]
        number = self.starts[gram + 1] - self.starts[gram]
        through = np.concatenate([[0], np.cumsum(self.around, dtype=np.int64)])
        ends, keys, counts = np.cumsum(through[self.starts[gram + 1]] - through[self.starts[gram]]), [], []
        first = 0
        while first < len(at):  # about a million pairs at a time, however common a q-gram is
            last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + 1_000_000, side="right")))
            seen = expanded(self.starts[gram[first:last]], number[first:last])
            around = self.around[seen]
            owner = expanded(self.first[seen], around)
            place = np.repeat(self.place[seen], around) - self.begin[owner]
            diagonal = np.repeat(np.repeat(at[first:last], number[first:last]), around) - place + PAD
            width = self.widths[owner]
            band = diagonal >> width
            into = (diagonal - (band << width)) < self.edits[owner]
            key = np.concatenate([owner << 40 | band, (owner << 40 | (band - 1))[into]])
            key, count = np.unique(key, return_counts=True)
            keys.append(key)
            counts.append(count)
            first = last
        if not keys:
            return []
        key, back = np.unique(np.concatenate(keys), return_inverse=True)
        count = np.bincount(back, np.concatenate(counts))
        owner = key >> 40
        good = count >= self.need[owner]
        owner, band = owner[good], key[good] & ((1 << 40) - 1)
        return list(zip(owner.tolist(), ((band << self.widths[owner]) - PAD).tolist(), strict=True))

    @property
    def widths(self) -> np.ndarray:
        """By window: power of two of a band's diagonals, more than its edits."""
        return np.ceil(np.log2(self.edits + 2)).astype(np.int64)

    def aligned(self, text: np.ndarray, owners: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Fewest edits of each window near its first diagonal, and where the place ends; the windows have one size.

        Banded alignment of all the places at once: ``row[b]`` is the cost of
        the window's first i bytes against a stretch that ends on diagonal b.
        """
        k, wanted = int(self.edits[owners[0]]), np.frombuffer(b"".join(self.texts[o] for o in owners), np.uint8).reshape(len(owners), -1).T
        wide = (1 << int(self.widths[owners[0]])) + 3 * k + 1
        base = firsts - k + PAD
        steps = np.arange(wide)
        row = np.zeros((len(firsts), wide), np.int32)
        for i, bytes_ in enumerate(wanted):
            new = row + (text[base[:, None] + i + steps] != bytes_[:, None])
            new[:, :-1] = np.minimum(new[:, :-1], row[:, 1:] + 1)
            row = np.minimum.accumulate(new - steps, axis=1) + steps
        best = row.argmin(axis=1)
        return row[np.arange(len(firsts)), best], base + len(wanted) + best - PAD


def find(index: Index, texts: list[bytes]) -> list[tuple[int, int, int, int, int]]:
    """(text, item, edits, start, end) of the benchmark windows in comparable texts, each item's best once a text."""
    joined = b"\0" + b"\0".join(texts) + b"\0"
    starts = np.cumsum([1] + [len(t) + 1 for t in texts])
    padded = np.frombuffer(bytes(PAD) + joined + bytes(2 * PAD), np.uint8)
    found: dict[tuple[int, int], tuple[int, int, int]] = {}

    def note(owner: int, edits: int, start: int, end: int) -> None:
        text = int(np.searchsorted(starts, max(start, 1), side="right")) - 1
        if text >= len(texts):
            return
        key, value = (text, index.items[owner]), (edits, start - int(starts[text]), end - int(starts[text]))
        found[key] = min(found.get(key, value), value)

    by_size: dict[int, list[tuple[int, int]]] = {}
    for owner, first in index.bands(padded[PAD : PAD + len(joined)]):
        by_size.setdefault(len(index.texts[owner]), []).append((owner, first))
    for size, places in by_size.items():
        for at in range(0, len(places), 512):
            owners, firsts = np.array(places[at : at + 512]).T
            edits, ends = index.aligned(padded, owners, firsts)
            for owner, e, end in zip(owners.tolist(), edits.tolist(), ends.tolist(), strict=True):
                if e <= index.edits[owner]:
                    note(owner, e, end - size + e, end)
    for owner, text in enumerate(index.texts):
        if 0 < len(text) < index.q:
            at = joined.find(text)
            while at >= 0:
                note(owner, 0, at, at + len(text))
                at = joined.find(text, at + 1)
    return [(text, item, *value) for (text, item), value in sorted(found.items())]


def contaminations(
    spark: SparkSession,
    docs: DataFrame,
    benchmark: DataFrame,
    q: int = 10,
    window: int = 160,
    error_rate: float = 0.06,
    block_bytes: int = 4 << 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    carried: tuple[str, ...] = (),
) -> DataFrame:
    """(doc_id, item_id, edits, start, end) of each item's best place in a document, and the columns ``carried`` along.

    Places count bytes of the comparable text.
    """
    if window >= PAD // 2:
        raise ValueError(f"window must be less than {PAD // 2}")
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), raw_text(text_col).alias("text"), *carried)
    kinds = StructType([*StructType.fromDDL("doc_id long, item_id long, edits long, start long, end long"), *docs.select(*carried).schema])

    def against(index: Index) -> DataFrame:
        shared = sent(spark, index)

        def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = received(shared)
            names = ("doc_id", "item_id", "edits", "start", "end")
            schema = pa.schema([(n, pa.int64()) for n in names])
            for block in blocks(batches, "text", 2 << 20):
                ids = block.column("doc_id").to_pylist()
                found = find(index, [comparable(raw) for raw in block.column("text").to_pylist()])
                if found:
                    out = batch_of(schema, **dict(zip(names, zip(*((ids[f[0]], *f[1:]) for f in found), strict=True), strict=True)))
                    rows = pa.array([f[0] for f in found], pa.int64())
                    yield pa.RecordBatch.from_arrays([*out.columns, *(block.column(c).take(rows) for c in carried)], names=[*names, *carried])

        return named.mapInArrow(tasks, kinds)

    held, size, out = [], 0, None
    path = scratch_path(spark, "contaminations")
    for row in benchmark.select(F.col("item_id").cast("long"), raw_text("text").alias("text")).toLocalIterator():
        text = comparable(bytes(row["text"]))
        if not text:
            continue
        if held and size + len(text) > block_bytes:
            against(Index.build(held, q, window, error_rate)).write.mode("append").parquet(path)
            held, size, out = [], 0, path
        held.append((row["item_id"], text))
        size += len(text)
    if not held:
        return spark.createDataFrame([], kinds)
    last = against(Index.build(held, q, window, error_rate))
    if out is None:
        return last
    last.write.mode("append").parquet(path)
    return spark.read.schema(kinds).parquet(path)


def decontaminate(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, contaminated, matches (array of item_id, edits, start, end)."""
    id_col = options.get("id_col", "doc_id")
    found = contaminations(spark, docs, benchmark, **options)
    by_doc = found.groupBy("doc_id").agg(F.array_sort(F.collect_set(F.struct("item_id", "edits", "start", "end"))).alias("matches"))
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"))
    out = ids.join(by_doc.withColumnRenamed("doc_id", "found_id"), F.col("doc_id").eqNullSafe(F.col("found_id")), "left")
    return out.select("doc_id", F.col("matches").isNotNull().alias("contaminated"), F.coalesce("matches", F.array().cast("array<struct<item_id:long,edits:long,start:long,end:long>>")).alias("matches"))
