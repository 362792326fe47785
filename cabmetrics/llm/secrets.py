"""Secret scan with password guess costs.

Base patterns find assignments (``assign``), access keys (``access``) and long
hex strings (``hex``). Besides, every value in a credential context (the
assignments of the base pattern and of further key words, bearer tokens,
user information of a URL) is priced by the guesses it takes: the cheapest
segmentation of the value into

- words of the corpus by rank, with capitals and look-alike digits,
- dates and years,
- repeats of a unit,
- walks over neighbouring keys, letters or digits,
- single characters by brute force,

found by dynamic programming, in bits. A value of ``threshold_bits`` or more
is a secret (``guess``); an ordinary word or "12345678" is not.

The ranks are those of the commonest alphabetic words of all documents.

Scale: one count of words (pre-aggregated in the tasks) and one map over the
documents; the broadcast dictionary holds ``dictionary_words`` words. The
costs of a value are the exact minimum over all segmentations, in time about
in proportion to its length.

Defined cases: null counts as empty and has no span; places count code
points, ends are exclusive; spans are sorted by start, then by kind as listed.
Repeated rows are scanned as often as they come; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blocks, raw_text, received, sent
from .word_counts import word_counts

KINDS = ("assign", "access", "hex", "guess")
KEYS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
# runs too short for a secret are dropped, so only long runs need to match
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
MORE_KEYS = ("pwd", "passphrase", "credential", "private_key", "privatekey", "access_key", "accesskey", "authorization", "bearer", "://")
MORE = re.compile(
    r"""(?ai)(?:(?:pwd|passphrase|credentials?|private_?key|access_?key|authorization)["']?[\x20]*[:=]\x20*["']?(?:bearer\x20+|basic\x20+)?([^\s"'<>,;]+)|\bbearer\x20+([A-Za-z0-9+/_.=~-]+)|://[^\s/:@]*:([^\s/@]+)@)"""
)

# Rows of a keyboard from left to right; each row starts right of the one above.
KEYBOARD = ("1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
# Characters commonly written for a letter.
LOOKALIKES = {"0": "o", "1": "l", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
LONGEST_WORD = 24


def _neighbours() -> dict[str, str]:
    out: dict[str, str] = {}
    for y, row in enumerate(KEYBOARD):
        for x, key in enumerate(row):
            near = [(y, x - 1), (y, x + 1), (y - 1, x), (y - 1, x + 1), (y + 1, x - 1), (y + 1, x)]
            out[key] = "".join(KEYBOARD[b][a] for b, a in near if 0 <= b < len(KEYBOARD) and 0 <= a < len(KEYBOARD[b]))
    return out


NEAR = _neighbours()
DATE = re.compile(r"(?a)(?:(\d{1,2})([-/._ ]?)(\d{1,2})\2(\d{4}|\d{2})|(\d{4})([-/._ ]?)(\d{1,2})\6(\d{1,2}))")
YEAR = re.compile(r"(?a)(?:19|20)\d\d")


class Words(dict):
    """Ranks of words; knows how words begin."""

    def __init__(self, ranks: dict[str, int]):
        super().__init__(ranks)
        self.starts = {w[:3] for w in ranks}


def _brute_bits(c: str) -> float:
    return math.log2(10 if c.isdigit() else 26 if c.isalpha() and c.isascii() else 33 if c.isascii() else 100)


def _case_bits(size: int, upper: int, first: bool) -> float:
    """Bits of the capitals among ``size`` characters, of which ``upper`` are capital, the ``first`` or not."""
    if not upper:
        return 0.0
    if upper == size or (upper == 1 and first):
        return 1.0
    share = upper / size
    return 1 - size * (share * math.log2(share) + (1 - share) * math.log2(1 - share))


def _dates(value: str, at: int) -> list[tuple[int, float]]:
    """(end, bits) of the date and the year that start here."""
    out = []
    m = DATE.match(value, at)
    if m:
        if m[1] is not None:
            a, b, year, mark = int(m[1]), int(m[3]), m[4], m[2]
        else:
            a, b, year, mark = int(m[8]), int(m[7]), m[5], m[6]
        if 1 <= min(a, b) <= 12 and 1 <= max(a, b) <= 31:
            y = int(year) if len(year) == 4 else 2000 + int(year) - (100 if int(year) > 50 else 0)
            if 1900 <= y <= 2099:
                out.append((m.end(), math.log2(365 * max(20, abs(y - 2020))) + 2 * bool(mark)))
    m = YEAR.match(value, at)
    if m:
        out.append((m.end(), math.log2(max(20, abs(int(m[0]) - 2020)))))
    return out


def lower_each(value: str) -> str:
    """Lower case, character by character: places stay the same."""
    return value.lower() if value.isascii() else "".join(c.lower() if len(c.lower()) == 1 else c for c in value)


def _walks(value: str) -> tuple[list[int], list[int], list[int]]:
    """(end of the longest walk from each place; turns and case changes counted up to each place).

    A walk from i to j has ``turns[j - 1] - turns[i + 1]`` turns and
    ``cases[j - 1] - cases[i]`` changes of case.
    """
    n, low = len(value), lower_each(value)
    steps: list[tuple | None] = [None] * n  # the step that leads to each place
    for i in range(1, n):
        a, b = low[i - 1], low[i]
        if b in NEAR.get(a, ""):
            steps[i] = ("k", NEAR[a].index(b))
        elif a.isalnum() and b.isalnum() and abs(ord(b) - ord(a)) == 1:
            steps[i] = ("s", ord(b) - ord(a))
    ends, turns, cases = list(range(1, n + 1)), [0] * n, [0] * n
    for i in range(n - 2, -1, -1):
        if steps[i + 1] is not None:
            ends[i] = ends[i + 1]
    for i in range(1, n):
        turns[i] = turns[i - 1] + (steps[i] is not None and steps[i] != steps[i - 1])
        cases[i] = cases[i - 1] + (value[i].isupper() != value[i - 1].isupper())
    return ends, turns, cases


def _runs(value: str) -> list[tuple[int, int, int]]:
    """(start, end, unit) of the longest stretches that repeat a unit at least twice.

    A unit that repeats a shorter one is left out: its repeats cost more. A
    run of a unit covers a place of every multiple of the unit, so only these
    places are looked at: the harmonic sum over all units.
    """
    codes = np.frombuffer(value.encode("utf-32-le", "surrogatepass"), "<u4")
    n, out = len(codes), []
    known_unit, until = np.zeros(n, np.int64), np.zeros(n, np.int64)  # of the run over the place that reaches furthest
    for unit in range(1, n // 2 + 1):
        places = np.arange(unit - 1, n - unit, unit)
        places = places[codes[places] == codes[places + unit]]
        if len(places):
            # where a run of a divisor holds one unit, it holds all of this unit's run
            known = known_unit[places]
            places = places[(known == 0) | (unit % np.maximum(known, 1) != 0) | (until[places] < places + unit)]
        done = -1
        for at in places.tolist():
            if at < done:
                continue
            start, end = at, at + 1
            while start > 0 and value[start - 1] == value[start - 1 + unit]:
                start -= 1
            while end + unit < n and value[end] == value[end + unit]:
                end += 1
            done = end
            if end - start >= unit and (not known_unit[start] or unit % known_unit[start] or until[start] < end + unit):
                out.append((start, end + unit, unit))
                new = start + np.flatnonzero(until[start : end + unit] < end + unit)
                known_unit[new], until[new] = unit, end + unit
    return sorted(out)


def _words_at(value: str, words: Words) -> list[list[tuple[int, float]]]:
    """For each place the (end, bits) of the words that start there."""
    n, low = len(value), lower_each(value)
    plain = "".join(LOOKALIKES.get(c, c) for c in low)
    odd, upper = [0], [0]
    for c, lowered in zip(value, low, strict=True):
        odd.append(odd[-1] + (lowered in LOOKALIKES))
        upper.append(upper[-1] + c.isupper())
    out: list[list[tuple[int, float]]] = [[] for _ in range(n)]
    for i in range(n - 2):
        if low[i : i + 3] not in words.starts and plain[i : i + 3] not in words.starts:
            continue
        for j in range(i + 3, min(n, i + LONGEST_WORD) + 1):
            ranks = [(words[w], bits) for w, bits in ((low[i:j], 0), (plain[i:j], odd[j] - odd[i])) if w in words]
            if ranks:
                cost = min(math.log2(rank + 1) + bits for rank, bits in ranks)
                out[i].append((j, cost + _case_bits(j - i, upper[j] - upper[i], value[i].isupper())))
    return out


def guess_bits(value: str, ranks: dict[str, int]) -> float:
    """Bits of the cheapest segmentation; each segment costs one bit besides its own, brute-forced characters none.

    Every end of a walk and every number of repeats is offered. A start whose
    offers another start of the same stretch makes for no more is passed over,
    so a long stretch costs time about in proportion to its length.
    """
    n = len(value)
    words = _words_at(value, ranks if isinstance(ranks, Words) else Words(ranks))
    ends, turns, cases = _walks(value)
    turn_bits, case_bits = 2.5 * np.array([*turns, 0.0]), np.array([*cases, 0.0])
    runs, active = _runs(value)[::-1], []
    brute = np.concatenate([[0.0], np.cumsum([_brute_bits(c) for c in value])]) if n else np.zeros(1)
    logs = np.log2(np.arange(1, n + 2))  # logs[k - 1] = log2(k)
    copies: dict[tuple[int, int], int] = {}  # of a word that stands more than once in a row
    for i in range(n - 1, -1, -1):
        for j, _ in words[i]:
            if value[i:j] == value[j : 2 * j - i]:
                copies[i, j] = 1 + copies.get((j, 2 * j - i), 1)
    best = np.full(n + 1, np.inf)
    best[0] = 0.0
    first: dict[tuple, int] = {}  # the last start of a stretch whose offers were made

    def offer_repeats(i: int, unit: int, times: int, fewest: int, bits: float, chain: tuple) -> None:
        leader = first.get(chain)
        if leader is not None and best[leader] + logs[fewest + (i - leader) // unit - 1] <= best[i] + logs[fewest - 1]:
            return
        first[chain] = i
        reached = best[i + fewest * unit : i + times * unit + 1 : unit]
        np.minimum(reached, best[i] + 1 + bits + logs[fewest - 1 : times], out=reached)

    for i in range(n):
        here = best[i] + 1
        best[i + 1] = min(best[i + 1], best[i] + brute[i + 1] - brute[i])
        for j, bits in words[i]:
            best[j] = min(best[j], here + bits)
            if (i, j) in copies:
                offer_repeats(i, j - i, copies[i, j], 2, bits, ("w", value[i:j], i + copies[i, j] * (j - i)))
        if value[i].isdigit():
            for end, bits in _dates(value, i):
                best[end] = min(best[end], here + bits)
        while runs and runs[-1][0] <= i:
            active.append(runs.pop())
        active = [r for r in active if r[1] - i >= 2 * r[2]]
        for start, end, unit in active:
            fewest = 3 if unit == 1 else 2
            if end - i >= fewest * unit:
                offer_repeats(i, unit, (end - i) // unit, fewest, float(brute[i + unit] - brute[i]), (start, unit, (i - start) % unit))
        end = ends[i]
        if end - i >= 3:
            begin = float(value[i].isupper())
            walk = best[i] - turn_bits[i + 1] - case_bits[i] + begin
            leader = first.get(("walk", end))
            if leader is not None and leader[1] + logs[i + 2 - leader[0]] <= walk + logs[2]:
                continue
            first["walk", end] = (i, walk)
            reached = best[i + 3 : end + 1]
            last = len(reached)
            top = reached.max()
            if top < math.inf:  # a walk only gets dearer: nothing to gain once it is past all that is known
                last = int(np.searchsorted(turn_bits[i + 2 : end], top - (walk + 1 + math.log2(47) + 2.5 + case_bits[i])))
            offers = walk + 1 + math.log2(47) + 2.5 + logs[2 : last + 2] + turn_bits[i + 2 : i + 2 + last] + case_bits[i + 2 : i + 2 + last]
            np.minimum(reached[:last], offers, out=reached[:last])
    return float(best[n])


def spans_of(raw: bytes, ranks: dict[str, int], threshold_bits: float) -> list[tuple[int, int, int, float | None]]:
    """(start, kind number, end, bits) of one text, in order."""
    low = raw.lower()
    keyed = any(k.encode() in low for k in KEYS)
    more = any(k.encode() in low for k in MORE_KEYS)
    access = b"AKIA" in raw
    hexed = b"h" * 24 in raw.translate(HEX_MAP)
    if not (keyed or more or access or hexed):
        return []
    text = raw.decode("utf-8", "replace")
    out: list = []
    values: set[tuple[int, int]] = set()
    if keyed:
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= 6:
                out.append((m.start(), 0, m.end(), None))
            values.add(m.span(2))
    if more:
        for m in MORE.finditer(text):
            values.add(m.span(m.lastindex))
    if access:
        out += [(m.start(), 1, m.end(), None) for m in ACCESS.finditer(text)]
    if hexed:
        out += [(m.start(), 2, m.end(), None) for m in HEX.finditer(text)]
    for start, end in values:
        bits = guess_bits(text[start:end], ranks)
        if bits >= threshold_bits:
            out.append((start, 3, end, bits))
    return sorted(out, key=lambda s: s[:3])


HEX_MAP = bytes(ord("h") if chr(b) in "0123456789abcdef" else 32 for b in range(256))


def word_ranks(docs: DataFrame, dictionary_words: int, text_col: str = "text") -> dict[str, int]:
    """Ranks of the commonest words of letters a-z, of all documents."""
    counts = word_counts(docs, text_col).select(F.col("word").cast("string").alias("word"), "n")
    letters = F.rtrim(F.col("word"), F.lit(".,;:!?"))
    stems = counts.select(letters.alias("word"), "n").filter(F.col("word").rlike("^[a-z]{3,24}$")).groupBy("word").agg(F.sum("n").alias("n"))
    top = stems.orderBy(F.desc("n"), "word").limit(dictionary_words).collect()
    return {row["word"]: i for i, row in enumerate(top, 1)}


def find_secrets(
    spark: SparkSession,
    docs: DataFrame,
    dictionary_words: int = 10_000,
    threshold_bits: float = 40.0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, spans (array of kind, start, end, bits)."""
    shared = sent(spark, Words(word_ranks(docs, dictionary_words, text_col)))
    kinds = "doc_id long, spans array<struct<kind:string,start:long,end:long,bits:double>>"

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = received(shared)
        item = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("bits", pa.float64())])
        for block in blocks(batches, "text", 4 << 20):
            found = [spans_of(raw, ranks, threshold_bits) for raw in block.column("text").to_pylist()]
            flat = [s for spans in found for s in spans]
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in found])]).astype(np.int32)
            values = pa.StructArray.from_arrays(
                [pa.array([KINDS[s[1]] for s in flat], pa.string()), pa.array([s[0] for s in flat], pa.int64()), pa.array([s[2] for s in flat], pa.int64()), pa.array([s[3] for s in flat], pa.float64())],
                fields=list(item),
            )
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets), values)], names=["doc_id", "spans"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), raw_text(text_col).alias("text")).mapInArrow(tasks, kinds)
