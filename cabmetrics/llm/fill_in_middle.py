"""Fill-in-the-middle transformation: texts cut in three and reordered.

A text is a row of units (a run of ASCII letters, or any other single code
point). Two numbers drawn from the document's id choose after which units the
prefix and the middle end; the text is then written suffix-first or
prefix-first with markers, or left plain.

Method: the UTF-8 bytes of many texts, end to end, are a sequence over four
character classes: a byte within a code point, a letter within a run, a letter
that begins a run, the first byte of any other code point. A wavelet matrix
holds it as two bit planes with counted words. Ranks of the classes combine
into the number of units that begin before any place and the number of code
points there, and bisection on these ranks finds the places of both cuts, for
all texts of a block at once.

Scale: one pass without a shuffle. A text goes to the Python worker as bytes
and comes back with three numbers, block by block, so that Spark holds no
queue of the rows that wait for them; the result is put together by Spark's
own functions. Memory: an Arrow batch, and a block of ``BLOCK_BYTES`` of text,
or one longer text, a few times over. A lost executor costs the tasks at hand.

Defined cases: null text is empty; an empty text, one that holds a marker, and
the share ``plain_percent`` stay plain. A null id draws the numbers of the
empty id. Repeated rows are cut alike. An empty table gives no rows. Other
columns are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import blocks, raw_text

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
BLOCK_BYTES = 4 << 20
WITHIN, LETTER, RUN, OTHER = range(4)


def byte_classes() -> np.ndarray:
    """Class of each byte value; the first letter of a run is told apart later."""
    values = np.arange(256)
    table = np.where((values & 0xC0) == 0x80, WITHIN, OTHER).astype(np.uint8)
    for first, last in (b"AZ", b"az"):
        table[first : last + 1] = LETTER
    return table


class BitPlane:
    """Bits with the number of ones before each word."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, np.uint64)
        self.words.view(np.uint8)[: len(packed)] = packed
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def ones(self, place: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = place >> 6
        mask = (np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    """Rank queries over a sequence of symbols of ``bits`` bits."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.planes, self.zeros = [], []
        for bit in range(bits - 1, -1, -1):
            ones = (symbols >> bit & 1).astype(bool)
            self.planes.append(BitPlane(ones))
            self.zeros.append(len(symbols) - int(np.count_nonzero(ones)))
            if bit:
                symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def rank(self, symbol: int, place: np.ndarray) -> np.ndarray:
        """Occurrences of the symbol before each place."""
        first = np.zeros(1, np.int64)
        for depth, (plane, zeros) in enumerate(zip(self.planes, self.zeros, strict=True)):
            if symbol >> (len(self.planes) - 1 - depth) & 1:
                first, place = zeros + plane.ones(first), zeros + plane.ones(place)
            else:
                first, place = first - plane.ones(first), place - plane.ones(place)
        return place - first


class Units:
    """Units and code points of texts that lie end to end in ``data``, text i from ``starts[i]`` to ``ends[i]``."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        symbols = byte_classes()[data]
        follows = np.zeros(len(data) + 1, bool)
        follows[1:] = symbols == LETTER
        follows[starts] = False  # a text's first letter follows none
        symbols[(symbols == LETTER) & ~follows[:-1]] = RUN
        self.matrix, self.starts, self.ends = WaveletMatrix(symbols, 2), starts, ends

    def begun(self, place: np.ndarray) -> np.ndarray:
        """Units that begin before each place."""
        return self.matrix.rank(RUN, place) + self.matrix.rank(OTHER, place)

    def points(self, place: np.ndarray) -> np.ndarray:
        """Code points that begin before each place."""
        return place - self.matrix.rank(WITHIN, place)

    def counts(self) -> np.ndarray:
        return self.begun(self.ends) - self.begun(self.starts)

    def after(self, number: np.ndarray) -> np.ndarray:
        """Place in each text after its first ``number`` units: where the next one begins, or the text's end."""
        wanted = self.begun(self.starts) + number
        low, high = self.starts.copy(), self.ends.copy()  # the largest place with no more than ``wanted`` units begun
        while (low < high).any():
            middle = (low + high + 1) >> 1
            fits = self.begun(middle) <= wanted
            low, high = np.where(fits, middle, low), np.where(fits, high, middle - 1)
        return low


def cut(texts: pa.Array, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Units, prefix and middle code points of each text (binary, no nulls) for its two numbers."""
    size = np.int64 if pa.types.is_large_binary(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], size, len(texts) + 1, texts.offset * np.dtype(size).itemsize).astype(np.int64)
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held is not None else np.zeros(0, np.uint8)
    offsets -= offsets[0]
    units = Units(data, offsets[:-1], offsets[1:])
    counts = units.counts()
    one, two = first % (counts + 1), second % (counts + 1)
    begin, low, high = (units.points(p) for p in (units.starts, units.after(np.minimum(one, two)), units.after(np.maximum(one, two))))
    return counts, low - begin, high - low


CUTS = "struct<n:bigint,prefix:bigint,middle:bigint>"


def cuts(texts: pa.Array, first: pa.Array, second: pa.Array) -> pa.Array:
    """``cut`` for a batch of any size, block by block."""
    numbers = [x.to_numpy(zero_copy_only=False) for x in (first, second)]
    size = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4) if pa.types.is_binary(texts.type) else np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    found: list[list[np.ndarray]] = [[], [], []]
    start = 0
    while start < len(texts):
        stop = max(start + 1, int(np.searchsorted(size, int(size[start]) + BLOCK_BYTES, side="right")) - 1)
        for held, values in zip(found, cut(texts.slice(start, stop - start), *(x[start:stop] for x in numbers)), strict=True):
            held.append(values)
        start = stop
    return pa.StructArray.from_arrays([pa.array(np.concatenate(f) if f else np.zeros(0, np.int64), pa.int64()) for f in found], ["n", "prefix", "middle"])


def fill_in_middle(
    docs: DataFrame,
    seed: int = 1,
    plain_percent: int = 10,
    suffix_first_percent: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n (units), form (plain, psm or spm), prefix_chars, middle_chars, output.

    The cuts fall after h1 mod (n + 1) and h2 mod (n + 1) units, the form
    follows h3 and h4: 32-bit numbers from the SHA-256 of ``seed:id``.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"), 256)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"), digest.alias("digest"))

    def number(group: int) -> Column:
        return F.conv(F.substring("digest", 8 * group + 1, 8), 16, 10).cast("long")

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", BLOCK_BYTES):
            found = cuts(*(block.column(c) for c in ("text", "first", "second")))
            yield pa.RecordBatch.from_arrays([*(block.column(c) for c in ("doc_id", "text", "digest")), found], names=["doc_id", "text", "digest", "cut"])

    sent = rows.select("doc_id", raw_text("text").alias("text"), "digest", number(0).alias("first"), number(1).alias("second"))
    kinds = StructType([sent.schema["doc_id"], *StructType.fromDDL(f"text binary, digest string, cut {CUTS}")])
    rows = sent.mapInArrow(tasks, kinds).withColumn("text", F.col("text").cast("string"))
    marked = F.contains("text", F.lit(PREFIX)) | F.contains("text", F.lit(SUFFIX)) | F.contains("text", F.lit(MIDDLE))
    plain = (F.col("text") == "") | marked | (number(2) % 100 >= 100 - plain_percent)
    form = F.when(plain, "plain").when(number(3) % 100 < suffix_first_percent, "spm").otherwise("psm")
    low, middle = F.col("cut.prefix").cast("int"), F.col("cut.middle").cast("int")
    parts = {
        PREFIX: F.substring("text", F.lit(1), low),
        MIDDLE: F.substring("text", low + 1, middle),
        SUFFIX: F.substring("text", low + middle + 1, F.length("text")),
    }

    def joined(*order: str) -> Column:
        return F.concat(*(c for marker in order for c in (F.lit(marker), parts[marker])))

    output = F.when(F.col("form") == "plain", F.col("text")).when(F.col("form") == "psm", joined(PREFIX, SUFFIX, MIDDLE)).otherwise(joined(SUFFIX, PREFIX, MIDDLE))
    cut_only = F.col("form") != "plain"
    return rows.withColumn("form", form).select(
        "doc_id",
        F.col("cut.n").alias("n"),
        "form",
        F.when(cut_only, F.col("cut.prefix")).alias("prefix_chars"),
        F.when(cut_only, F.col("cut.middle")).alias("middle_chars"),
        output.alias("output"),
    )


def restored(output: Column, form: Column) -> Column:
    """The text that ``fill_in_middle`` made ``output`` from, by the markers alone."""

    def after(marker: str) -> Column:
        return F.substring(output, F.instr(output, marker) + len(marker), F.length(output))

    def between(marker: str, end: str) -> Column:
        begin = F.instr(output, marker) + len(marker)
        return F.substring(output, begin, F.instr(output, end) - begin)

    psm = F.concat(between(PREFIX, SUFFIX), after(MIDDLE), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), after(MIDDLE), between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
