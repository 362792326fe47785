"""Removal of repeated passages by super-k-mer partitioning.

A window is ``window`` consecutive words of a document. Its minimiser is the
smallest hash among its runs of ``minimiser`` words; consecutive windows with
the same minimiser form a super-k-mer and travel as one packed string of
words to the minimiser's bucket. Equal windows have equal minimisers, so each
bucket sees all occurrences of its windows: it sorts them and marks every one
whose word sequence starts earlier elsewhere. A document then loses the words
that a marked window covers.

Scale:
- a scan task works on one block of text at a time. Equal super-k-mers of a
  block are collapsed before the shuffle: the first one travels, the others
  are marked at once. Buckets do the same as strings arrive, so a passage
  that a third of all documents share costs a bucket one string.
- buckets are dealt to groups whose number follows the bytes of the table
  (``group_bytes`` of text for each), and a block's super-k-mers for one group
  travel as one compressed row. Memory holds one block, or the distinct
  super-k-mers of one group.
- hashes only order the windows; neighbours in that order are compared word
  by word, so the marks are exact.

Defined cases: words are split at ASCII white space; null or blank texts and
documents shorter than a window lose nothing. The order of windows is
(id, start), a null id before all. Rows that repeat an id and a text are one
document and get the same answer; rows of one id with different texts are
told apart by the text's hash, and windows that start at the same place of
the same id don't mark each other. Other columns are not read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WordHash, blocks, mix64, raw_text

NO_ID = -(1 << 63)
RUN = 256  # windows of one packed string at most
MULTIPLIER = 0x9E3779B97F4A7C15


def rolling(x: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` consecutive values from each position on."""
    total, done, span, width = None, 0, x, 1
    while True:
        if size & width:
            if total is None:
                total = span
            else:
                n = len(x) - (done + width) + 1
                total = total[:n] * np.array([pow(MULTIPLIER, width, 1 << 64)], np.uint64) + span[done : done + n]
            done += width
        if done == size:
            return mix64(total)
        n = len(x) - 2 * width + 1
        span = span[:n] * np.array([pow(MULTIPLIER, width, 1 << 64)], np.uint64) + span[width : width + n]
        width *= 2


def sliding_minimum(x: np.ndarray, size: int) -> np.ndarray:
    low, width = x, 1
    while 2 * width <= size:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    rest = size - width
    return np.minimum(low[: len(low) - rest], low[rest:]) if rest else low


def super_kmers(hashed: np.ndarray, ends: np.ndarray, window: int, minimiser: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of windows and minimiser of each super-k-mer.

    ``hashed`` holds the words of documents in a row, which end at ``ends``;
    each document has a window at least.
    """
    low = sliding_minimum(rolling(hashed, minimiser), window - minimiser + 1)
    inside = np.ones(len(low), bool)
    for k in range(1, window):  # windows that would cross into the next document
        inside[(ends[:-1] - k)] = False
    first = inside.copy()
    first[1:] &= ~inside[:-1] | (low[1:] != low[:-1])
    starts = np.flatnonzero(first)
    after = np.append(starts[1:], len(low))
    blank = np.concatenate([[0], np.cumsum(~inside)])
    number = after - starts - (blank[after] - blank[starts])
    pieces = -(-number // RUN)
    base = np.repeat(starts, pieces) + RUN * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
    number = np.minimum(RUN, np.repeat(starts + number, pieces) - base)
    return base, number, low[base]


def pack(sent: list, marked: list) -> bytes:
    """One row of super-k-mers: (id, text hash, start, windows, string), and marked ones without string."""
    import zstandard

    heads = [x[:4] for x in sent] + [x[:4] for x in marked]
    body = struct.pack("<qq", len(sent), len(marked)) + np.array(heads, "<i8").reshape(-1, 4).T.tobytes() + b"\n".join(x[4] for x in sent)
    return zstandard.ZstdCompressor(level=3).compress(body)


def unpack(blob: bytes) -> tuple[list, list]:
    import zstandard

    body = zstandard.ZstdDecompressor().decompress(blob)
    n, m = struct.unpack_from("<qq", body)
    heads = np.frombuffer(body, "<i8", 4 * (n + m), 16).reshape(4, -1).T.tolist()
    strings = body[16 + 32 * (n + m) :].split(b"\n")
    return [(*h, s) for h, s in zip(heads[:n], strings, strict=False)], heads[n:]


class Firsts(dict):
    """The earliest of equal super-k-mers by string; the others are marked."""

    def __init__(self):
        super().__init__()
        self.marked: list = []
        self.beside: list = []  # at the same place of the same id, with another text

    def offer(self, item: tuple) -> None:
        held = self.get(item[4])
        if held is None:
            self[item[4]] = item
            return
        mine, theirs = (item[0], item[2]), (held[0], held[2])
        if mine == theirs:
            if item[1] != held[1]:
                self.beside.append(item)
        elif mine < theirs:
            self[item[4]] = item
            self.marked.append(held[:4])
        else:
            self.marked.append(item[:4])

    def items_in_order(self) -> list[tuple]:
        return sorted([*self.values(), *self.beside], key=lambda x: (x[0], x[2], x[1]))


class Numbering(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def repeated_windows(items: list[tuple], window: int) -> list[tuple[int, int, int, int]]:
    """(id, text hash, first word, words) of the stretches that marked windows cover; items in order of place."""
    number = np.array([x[3] for x in items], np.int64)
    names = Numbering()
    ids = np.concatenate([np.fromiter(map(names.__getitem__, b" ".join(x[4] for x in items[at : at + 5000]).split()), np.uint64) for at in range(0, len(items), 5000)])
    base = np.concatenate([[0], np.cumsum(number + window - 1)[:-1]])
    run = np.repeat(np.arange(len(items)), number)
    inner = np.arange(len(run)) - np.repeat(np.cumsum(number) - number, number)
    at = base[run] + inner
    keys = rolling(mix64(ids + np.uint64(1)), window)[at]
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    new = np.ones(len(ranked), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    first = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
    later = np.flatnonzero(~new)
    mark = np.zeros(len(run), bool)
    doc, start = np.array([x[0] for x in items], np.int64), np.array([x[2] for x in items], np.int64)
    place = start[run] + inner
    for part in np.array_split(later, len(later) // 100_000 + 1):
        mine, theirs = order[part], first[part]
        same = (ids[at[mine][:, None] + np.arange(window)] == ids[at[theirs][:, None] + np.arange(window)]).all(axis=1)
        mark[mine] = (doc[run[mine]] != doc[run[theirs]]) | (place[mine] != place[theirs])
        if not same.all():  # windows of equal hash that differ: tell them apart by their words
            for key in np.unique(keys[mine[~same]]).tolist():
                seen: dict[bytes, int] = {}
                for w in np.flatnonzero(keys == np.uint64(key)).tolist():
                    own = seen.setdefault(ids[at[w] : at[w] + window].tobytes(), w)
                    mark[w] = (doc[run[w]], place[w]) != (doc[run[own]], place[own])
    hits = np.flatnonzero(mark)
    if not len(hits):
        return []
    opens = np.ones(len(hits), bool)
    opens[1:] = (np.diff(hits) != 1) | (run[hits[1:]] != run[hits[:-1]])
    begin = hits[opens]
    end = hits[np.append(np.flatnonzero(opens)[1:] - 1, len(hits) - 1)]
    return [(items[r][0], items[r][1], p, n) for r, p, n in zip(run[begin].tolist(), place[begin].tolist(), (end - begin + window).tolist(), strict=True)]


def covered_words(named: DataFrame, groups: int, window: int, minimiser: int) -> DataFrame:
    """(key, text_hash, cut) of (key, text_hash, text): a cut is first word * 1024 + words."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHash()
        for block in blocks(batches, "text", 4 << 20):
            keys, hashes, raws = (block.column(n).to_pylist() for n in ("key", "text_hash", "text"))
            docs = [(i, words) for i in sorted(range(len(keys)), key=keys.__getitem__) if len(words := raws[i].split()) >= window]
            if not docs:
                continue
            words = [w for _, part in docs for w in part]
            ends = np.cumsum([len(part) for _, part in docs])
            base, number, low = super_kmers(known.array(words), ends, window, minimiser)
            sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
            offset = np.concatenate([[0], np.cumsum(sizes)])
            joined = b" ".join(words)
            del words
            doc = np.searchsorted(ends, base, side="right")
            row = np.array([i for i, _ in docs])[doc]
            place = base - np.concatenate([[0], ends])[doc]
            strings = [joined[a:b] for a, b in zip(offset[base].tolist(), (offset[base + number + window - 1] - 1).tolist(), strict=True)]
            firsts = Firsts()
            group_of = (mix64(low) % np.uint64(groups)).astype(np.int64)
            names = [(keys[i], hashes[i]) for i in range(len(keys))]
            for r, p, n, s in zip(row.tolist(), place.tolist(), number.tolist(), strings, strict=True):
                firsts.offer((*names[r], p, n, s))
            group_by_string = dict(zip(strings, group_of.tolist(), strict=True))
            by_group: dict[int, list] = {}
            for item in [*firsts.values(), *firsts.beside]:
                by_group.setdefault(group_by_string[item[4]], []).append(item)
            # marked ones need no bucket: they ride along with any row
            some = next(iter(by_group))
            rows = [(g, pack(items, firsts.marked if g == some else [])) for g, items in by_group.items()]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], names=["bucket", "packed"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, firsts = None, Firsts()
        names = ["key", "text_hash", "cut"]

        def closed() -> Iterator[pa.RecordBatch]:
            items = firsts.items_in_order()
            cuts = [(k, h, p, n + window - 1) for k, h, p, n in firsts.marked]
            if items:
                cuts += repeated_windows(items, window)
            for at in range(0, len(cuts), 50_000):
                key, text_hash, first, n = (np.array(x, np.int64) for x in zip(*cuts[at : at + 50_000], strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(text_hash), pa.array(first * 1024 + n)], names=names)

        for batch in batches:
            for i in range(batch.num_rows):
                bucket = batch.column(0)[i].as_py()
                if bucket != current:
                    yield from closed()
                    current, firsts = bucket, Firsts()
                items, marked = unpack(batch.column(1)[i].as_py())
                firsts.marked += marked
                for item in items:
                    firsts.offer(item)
        yield from closed()

    packed = named.mapInArrow(scan, "bucket long, packed binary")
    partitions = int(named.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = packed.repartitionById(partitions, F.expr(f"int(bucket % {partitions})"))  # groups are alike: deal them out evenly
    return dealt.sortWithinPartitions("bucket").mapInArrow(count, "key long, text_hash long, cut long")


def squeezed(named: DataFrame) -> DataFrame:
    """The texts compressed, for their way to the cuts."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        squeeze = zstandard.ZstdCompressor(level=3).compress
        for block in blocks(batches, "text", 4 << 20):
            small = pa.array(map(squeeze, block.column("text").to_pylist()), pa.binary())
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), block.column("key"), block.column("text_hash"), small], names=["doc_id", "key", "text_hash", "text"])

    return named.mapInArrow(tasks, "doc_id long, key long, text_hash long, text binary")


def remove_repeats(
    spark: SparkSession,
    docs: DataFrame,
    window: int = 20,
    minimiser: int = 4,
    group_bytes: int = 4 << 20,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_text (words joined by one blank)."""
    if not minimiser <= window <= 1023 - RUN:
        raise ValueError("window must lie between minimiser and 767")
    text = F.coalesce(F.col(text_col), F.lit(""))
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("key"), F.xxhash64(text).alias("text_hash"), raw_text(text_col).alias("text"))
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    groups = max(-(-total // group_bytes), 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = covered_words(named.drop("doc_id"), groups, window, minimiser).groupBy("key", "text_hash").agg(F.collect_list("cut").alias("cuts"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        full = zstandard.ZstdDecompressor().decompress
        schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string())])
        for block in blocks(batches, "text", 1 << 20):
            total, removed, kept = [], [], []
            for raw, cut in zip(block.column("text").to_pylist(), block.column("cuts"), strict=True):
                words = full(raw).split()
                total.append(len(words))
                if cut.is_valid:
                    places = cut.values.to_numpy(zero_copy_only=False)
                    change = np.zeros(len(words) + 1, np.int64)
                    np.add.at(change, places >> 10, 1)
                    np.add.at(change, (places >> 10) + (places & 1023), -1)
                    stay = np.cumsum(change[:-1]) == 0
                    words = [words[i] for i in np.flatnonzero(stay).tolist()]
                removed.append(total[-1] - len(words))
                kept.append(b" ".join(words).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], schema=schema)

    joined = squeezed(named).join(cuts, ["key", "text_hash"], "left").select("doc_id", "text", "cuts")
    return joined.mapInArrow(keep, "doc_id long, n_words long, n_removed long, kept_text string")
