"""Cost-balanced sequence packing.

Documents are tokenised, closed with an end id and laid into training
sequences of at most ``max_tokens`` ids. The work of a sequence is estimated
as ``linear * n + quadratic * n^2`` summed over its pieces (attention stays
inside a document). In a packing group of about ``group_tokens`` ids the
pieces go, longest first, each to the sequence of lowest cost that still has
room for it; where none has, the cheapest sequence with any room takes as
many ids as fit and the rest goes on.

The sequences of a group are as many full ones as its ids fill, and the rest
of the ids in sequences of power-of-two lengths. So no sequence is padded.

Scale: one pass and no shuffle. A group is built inside a scan task, so a
task holds one group (and one document) at a time. The encoder's words last
as long as the Python worker, which serves many tasks; ids depend on the text
alone, so a fresh worker gives the same. ``sequence_id`` is
(scan partition, counter); a retried task makes the same groups again.

Defined cases: a null or empty text is one piece that holds the end id alone;
a null id is carried as null; repeated rows are packed as often as they come;
an empty table gives no piece. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import filterfalse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_of, blocks, kept, raw_text

SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


#: ASCII characters that the pre-tokenizer keeps in one run after a word's letters (an apostrophe may begin a contraction).
CLOSERS = ".,;:!?#$%&*"


class WordEncoder(dict):
    """Ids (little-endian unsigned 32-bit) of a word, remembered.

    The vocabulary lower-cases, and its pre-tokenizer never joins what white
    space separates, nor letters with what follows them. So a text's ids are
    its words' ids in a row, and a word's are those of its letters and of its
    closing run of punctuation. Holds about twice ``limit`` words: when the
    newer half is full it becomes the older one, whose words come back as they
    are met; those that are not met are forgotten.
    """

    def __init__(self, path: str, limit: int = 500_000):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task owns one core
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        self.older: dict[bytes, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def texts(self, raws: list[bytes]) -> list[bytes]:
        # special tokens ("<|...|>") are told by their case
        split = [(raw if b"<|" in raw else raw.lower()).split() for raw in raws]
        if len(self) > self.limit:
            self.older = dict(self)
            self.clear()
        words = set().union(*split).difference(self)
        if self.older:
            known = words & self.older.keys()
            self.update(zip(known, map(self.older.__getitem__, known), strict=True))
            words -= known
        self.learn(words)
        return [b"".join(map(self.__getitem__, part)) for part in split]

    def learn(self, words: set[bytes]) -> None:
        # ASCII words, the most of them, are told apart as bytes
        letters, rest, parts = dict.fromkeys(filter(bytes.isalpha, words)), {}, {}
        for word in filterfalse(bytes.isalpha, words):
            stem = word.rstrip(CLOSERS.encode())
            if not stem.isalpha():
                text = word.decode("utf-8", "replace")
                if text.isalpha():
                    letters[word] = None
                    continue
                if len(stem) == len(word) or not _latin(stem.decode("utf-8", "replace")):
                    rest[word] = text
                    continue
            end = word[len(stem) :]
            letters[stem], rest[end], parts[word] = None, end.decode(), (stem, end)
        new = [x for x in letters if x not in self]
        for at in range(0, len(new), 20_000):
            self.learn_letters(new[at : at + 20_000])
        others = [x for x in rest.items() if x[0] not in self]
        for at in range(0, len(others), 20_000):
            self.learn_each(others[at : at + 20_000])
        for word, (stem, end) in parts.items():
            self[word] = self[stem] + self[end]

    def learn_letters(self, some: list[bytes]) -> None:
        """Words of letters alone: one text of them all, cut after each id that closes a word."""
        ids = np.array(self.tokenizer.encode_batch_fast([b" ".join(some).decode("utf-8", "replace")], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self.closes[ids]) + 1
        if len(ends) != len(some) or (len(ids) and ends[-1] != len(ids)):
            self.learn_each([(word, word.decode("utf-8", "replace")) for word in some])
            return
        coded, cuts = ids.tobytes(), (4 * ends).tolist()
        self.update(zip(some, map(coded.__getitem__, map(slice, [0, *cuts], cuts)), strict=False))

    def learn_each(self, some: list[tuple[bytes, str]]) -> None:
        coded = self.tokenizer.encode_batch_fast([text for _, text in some], add_special_tokens=False)
        self.update((word, np.array(c.ids, "<u4").tobytes()) for (word, _), c in zip(some, coded, strict=True))


def _latin(stem: str) -> bool:
    """Letters that stay letters when lower-cased, of blocks that every Unicode version has alike."""
    return stem.isalpha() and max(stem) < "\u0250" and stem.lower().isalpha()


def capacities(total: int, max_tokens: int) -> np.ndarray:
    """Sequence lengths that ``total`` ids fill exactly."""
    full, rest = divmod(total, max_tokens)
    return np.array([max_tokens] * full + [1 << b for b in range(max_tokens.bit_length(), -1, -1) if rest >> b & 1], np.int64)


def plan_group(lengths: np.ndarray, max_tokens: int, linear: float, quadratic: float) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of one group."""
    room = capacities(int(lengths.sum()), max_tokens)
    size, cost = room.copy(), np.zeros(len(room))
    pieces, whole = [], 0
    for doc in np.flatnonzero(lengths >= max_tokens).tolist():  # a piece of full length is the dearest and fills a sequence
        for start in range(0, int(lengths[doc]) - max_tokens + 1, max_tokens):
            pieces.append((doc, start, max_tokens, whole, 0))
            whole += 1
    room, size, cost = room[whole:], size[whole:], cost[whole:]
    rest = lengths % max_tokens
    for doc in np.argsort(-rest, kind="stable").tolist():
        left, start = int(rest[doc]), int(lengths[doc] - rest[doc])
        while left:
            fit = room >= left
            at = int(np.argmin(np.where(fit if fit.any() else room > 0, cost, np.inf)))
            take = min(left, int(room[at]))
            pieces.append((doc, start, take, whole + at, int(size[at] - room[at])))
            room[at] -= take
            cost[at] += linear * take + quadratic * take * take
            start, left = start + take, left - take
    return pieces


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 2,
    max_tokens: int = 4096,
    linear: float = 1.0,
    quadratic: float = 1 / 6144,
    group_tokens: int = 1 << 22,
) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids.

    ``ids`` holds the piece's ids as little-endian unsigned 32-bit integers.
    ``linear`` and ``quadratic`` weigh a piece's length and its square.
    """

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = kept(f"WordEncoder:{tokenizer_path}", lambda: WordEncoder(tokenizer_path))
        end = np.array([end_id], "<u4").tobytes()
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())])
        next_id = TaskContext.get().partitionId() << 36
        names: list = []
        ids: list[bytes] = []

        def packed() -> Iterator[pa.RecordBatch]:
            nonlocal next_id
            lengths = np.array([len(x) // 4 for x in ids], np.int64)
            pieces = plan_group(lengths, max_tokens, linear, quadratic)
            for at in range(0, len(pieces), 20_000):
                doc, start, length, seq, offset = zip(*pieces[at : at + 20_000], strict=True)
                yield batch_of(
                    schema,
                    doc_id=[names[d] for d in doc],
                    start=start,
                    length=length,
                    doc_tokens=lengths[list(doc)],
                    sequence_id=np.array(seq) + next_id,
                    offset=offset,
                    ids=[ids[d][4 * s : 4 * (s + n)] for d, s, n in zip(doc, start, length, strict=True)],
                )
            next_id += max(p[3] for p in pieces) + 1

        held = 0
        for block in blocks(batches, "text", 2 << 20):
            coded = encoder.texts(block.column("text").to_pylist())
            for name, x in zip(block.column("doc_id").to_pylist(), coded, strict=True):
                names.append(name)
                ids.append(x + end)
                held += len(x) // 4 + 1
                if held >= group_tokens:
                    yield from packed()
                    names, ids, held = [], [], 0
        if ids:
            yield from packed()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), raw_text(text_col).alias("text")).mapInArrow(tasks, SCHEMA)
