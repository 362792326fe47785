"""Document scores by masked pseudo-likelihood.

Every word is predicted from the ``side`` words before and after it, without
itself, by a small window network: the sum of one embedding per place, tanh,
and a softmax in two steps (cluster, then member). A document's score is the
sum of the logarithms of these conditional probabilities.

The vocabulary comes from the counts of all words of all documents: the
``common`` most frequent ones have ids of their own, all others share
``shared`` hashed ids. Given the counts, ``score`` tells the words of one id
apart by their own: a word's share of what was counted there (and one more
occurrence, left to words that were not). The counts stay a Spark table of
all different words, however many; the words of the documents that are not
among the more frequent ones, which the tasks know, are joined with it. Without the counts the probability is spread evenly over the
different words of an id. As context, the words of one id are the same.

Training covers every position of every document, once a round, unless a
``stride`` above 1 is asked for: then a round takes one in ``stride``
positions (others each round). A task runs minibatch gradient steps from the
common parameters over what it reads; the tasks' parameters are averaged by
the positions they saw, in a tree of reductions on the executors. The
network's size is fixed.

Defined cases: words are lower-cased (A-Z) and split at ASCII white space.
Null or blank texts have no words: score 0, mean null. Without any word in
the table every score is 0. Places beyond the ends of a document are a
padding id. Repeated rows count and are scored as often as they come; other
columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blocks, raw_text, received, sent, words_of, written
from .word_counts import word_counts

CLUSTERS = 64
PARTS = ("inputs", "bias", "cluster", "cluster_bias", "member", "member_bias")


class Vocabulary(dict):
    """Id of a word: 1.. for common words, then the shared ids; 0 pads."""

    def __init__(self, words: list[bytes], shared: int, spread: np.ndarray):
        super().__init__((w, i) for i, w in enumerate(words, 1))
        self.common, self.shared = len(words), shared
        #: Log-probability of a word within its id.
        self.within = np.concatenate([np.zeros(len(words) + 1), -np.log(np.maximum(spread, 1))]).astype(np.float32)

    @property
    def size(self) -> int:
        return 1 + self.common + self.shared

    def __missing__(self, word: bytes) -> int:
        return 1 + self.common + zlib.crc32(word) % self.shared

    def ids(self, raw: bytes) -> np.ndarray:
        words = raw.lower().split()
        return np.fromiter(map(self.__getitem__, words), np.int32, len(words))


@dataclass
class Network:
    side: int
    inputs: np.ndarray  # place x id x hidden
    bias: np.ndarray
    cluster: np.ndarray  # hidden x cluster
    cluster_bias: np.ndarray
    member: np.ndarray  # cluster x hidden x member
    member_bias: np.ndarray

    @staticmethod
    def fresh(vocabulary: int, side: int, hidden: int, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        members = -(-vocabulary // CLUSTERS)
        small = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
        zero = lambda *shape: np.zeros(shape, np.float32)
        return Network(side, small(2 * side, vocabulary, hidden), zero(hidden), small(hidden, CLUSTERS), zero(CLUSTERS), small(CLUSTERS, hidden, members), zero(CLUSTERS, members))

    def parameters(self) -> np.ndarray:
        return np.concatenate([getattr(self, p).reshape(-1) for p in PARTS])

    def with_parameters(self, flat: np.ndarray) -> Network:
        out, at = {}, 0
        for p in PARTS:
            old = getattr(self, p)
            out[p] = flat[at : at + old.size].reshape(old.shape).astype(np.float32)
            at += old.size
        return Network(self.side, **out)

    def hidden_of(self, context: np.ndarray) -> np.ndarray:
        total = np.repeat(self.bias[None], len(context), axis=0)
        for place in range(context.shape[1]):
            total += self.inputs[place].take(context[:, place], axis=0)
        return np.tanh(total, out=total)

    def by_cluster(self, target: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
        """Rows in the order of the targets' clusters, and (cluster, start, end) in that order."""
        cluster = (target % CLUSTERS).astype(np.uint8)
        order = np.argsort(cluster, kind="stable")
        cuts = np.searchsorted(cluster[order], np.arange(CLUSTERS + 1)).tolist()
        return order, [(c, cuts[c], cuts[c + 1]) for c in range(CLUSTERS) if cuts[c] < cuts[c + 1]]

    def safe(self) -> bool:
        """Whether no logit, of whatever context, is so large that its exponential leaves the range of numbers."""
        most = max(np.abs(w).sum(axis=-2).max() + np.abs(b).max() for w, b in ((self.cluster, self.cluster_bias), (self.member, self.member_bias)))
        return bool(most < 80)  # hidden units lie in -1 to 1; sums of such exponentials stay below 1e38

    def with_bias(self) -> tuple[np.ndarray, np.ndarray]:
        """The layers' weights with the biases as a last input, which is 1."""
        return np.concatenate([self.cluster, self.cluster_bias[None]]), np.concatenate([self.member, self.member_bias[:, None]], axis=1)

    def log_probabilities(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        order, clusters = self.by_cluster(target)
        target = target[order]
        hidden = with_ones(self.hidden_of(context[order]))
        cluster, member = self.with_bias()
        safe, rows, place = self.safe(), np.arange(len(target)), target // CLUSTERS
        found = np.empty(len(target), np.float32)
        for at in range(0, len(target), 2048):  # logits that fit a core's cache
            end = min(at + 2048, len(target))
            found[at:end] = log_shares(hidden[at:end] @ cluster, rows[: end - at], target[at:end] % CLUSTERS, safe)
        for c, start, end in clusters:
            found[start:end] += log_shares(hidden[start:end] @ member[c], rows[: end - start], place[start:end], safe)
        out = np.empty_like(found)
        out[order] = found
        return out

    def gradients(self, context: np.ndarray, target: np.ndarray):
        """Sums over the batch, as (part, where, gradient) of the negated log-probabilities."""
        order, clusters = self.by_cluster(target)
        context, target = context[order], target[order]
        hidden = self.hidden_of(context)
        wide, size = with_ones(hidden), hidden.shape[1]
        cluster, member = self.with_bias()
        safe, rows, place = self.safe(), np.arange(len(target)), target // CLUSTERS
        turned = np.ascontiguousarray(self.member.transpose(0, 2, 1))
        # errors are the shares times ``total``; rows of the other factor are divided by it, as these are shorter
        error, total = errors(wide @ cluster, rows, target % CLUSTERS, safe)
        back = error @ self.cluster.T
        back /= total
        gradient = (wide / total).T @ error
        yield "cluster", ..., gradient[:size]
        yield "cluster_bias", ..., gradient[size]
        for c, start, end in clusters:
            part = wide[start:end]
            error, total = errors(part @ member[c], rows[: end - start], place[start:end], safe)
            gradient = (part / total).T @ error
            back[start:end] += (error @ turned[c]) / total
            yield "member", c, gradient[:size]
            yield "member_bias", c, gradient[size]
        back *= 1 - hidden * hidden
        yield "bias", ..., total_rows(back)
        back, units = back.astype(np.float64).reshape(-1), np.arange(size)
        for place, known in enumerate(self.inputs):
            at = context[:, place, None].astype(np.int64) * size + units
            yield "inputs", place, np.bincount(at.reshape(-1), back, known.size).astype(np.float32).reshape(known.shape)

    def step(self, context: np.ndarray, target: np.ndarray, rate: float) -> None:
        """One gradient step in place.

        What all positions share (the cluster layer and the biases) moves by
        the mean gradient times ``rate``. A word's input and a cluster's
        members see few of a large batch's positions: they move by the sum
        times ``rate`` / 1024 there, as far as in batches of 1024. Beyond
        1024 the gradients are less noisy, and steps grow with the fourth root.
        """
        rate *= max(1.0, len(target) / 1024) ** 0.25
        shared, own = (np.float32(rate / n) for n in (len(target), min(len(target), 1024)))
        for part, where, gradient in self.gradients(context, target):
            getattr(self, part)[where] -= (own if part in ("inputs", "member", "member_bias") else shared) * gradient


def total_rows(x: np.ndarray) -> np.ndarray:
    return np.ones(len(x), np.float32) @ x


def with_ones(hidden: np.ndarray) -> np.ndarray:
    out = np.ones((len(hidden), hidden.shape[1] + 1), np.float32)
    out[:, :-1] = hidden
    return out


def exponentials(logits: np.ndarray, safe: bool) -> np.ndarray:
    """In place, with the sum of each row as a column; rows that are not ``safe`` are divided by their largest one."""
    if not safe:
        logits -= logits.max(axis=1)[:, None]
    np.exp(logits, out=logits)
    return logits @ np.ones((logits.shape[1], 1), np.float32)


def log_shares(logits: np.ndarray, rows: np.ndarray, chosen: np.ndarray, safe: bool) -> np.ndarray:
    """Logarithm of the chosen entries' shares of the exponentials."""
    if not safe:
        logits -= logits.max(axis=1)[:, None]
    found = logits[rows, chosen]
    return found - np.log(exponentials(logits, True)[:, 0])


def errors(logits: np.ndarray, rows: np.ndarray, chosen: np.ndarray, safe: bool) -> tuple[np.ndarray, np.ndarray]:
    """In place: the shares of the exponentials, less 1 for the chosen ones, all times the sum; and the sums."""
    total = exponentials(logits, safe)
    logits[rows, chosen] -= total[:, 0]
    return logits, total


def contexts(ids: np.ndarray, side: int, at: np.ndarray) -> np.ndarray:
    """Ids around the positions ``at``, nearest places last to first and first to last; 0 beyond the ends."""
    padded = np.concatenate([np.zeros(side, np.int32), ids, np.zeros(side, np.int32)])
    places = [*range(side), *range(side + 1, 2 * side + 1)]
    return np.stack([padded[at + p] for p in places], axis=1)


def in_a_row(known: pa.Array, numbers: np.ndarray, vocabulary: Vocabulary, texts: pa.Array, side: int) -> tuple[np.ndarray, np.ndarray, pa.BinaryArray, np.ndarray]:
    """Numbers of documents' words one after the other, ``side`` paddings around each; their numbers of words; the words and whether each is ``known``.

    Known words have the ``numbers`` given, all others their shared ids.
    """
    words, n = words_of(texts)
    found = pc.index_in(words, value_set=known).fill_null(-1).to_numpy()
    held = found >= 0
    number = np.empty(len(words), np.int32)
    number[held] = numbers[found[held]]
    others = words.filter(pa.array(~held)).to_numpy(zero_copy_only=False)
    number[~held] = 1 + vocabulary.common + np.fromiter(map(zlib.crc32, others), np.uint32, len(others)) % vocabulary.shared
    row = np.zeros(side + len(words) + side * len(n), np.int32)
    row[side + np.arange(len(words)) + side * np.repeat(np.arange(len(n)), n)] = number
    return row, n, words, held


def around(row: np.ndarray, side: int, own: np.ndarray) -> np.ndarray:
    """Ids around the positions ``own`` of a row that is padded at its ends."""
    return np.stack([row[own + p] for p in range(-side, side + 1) if p], axis=1)


def counted(spark: SparkSession, docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n) of all words of all documents, as a written table."""
    return written(spark, word_counts(docs, text_col), "word_counts")


def within_shared(spark: SparkSession, counts: DataFrame, vocabulary: Vocabulary) -> tuple[DataFrame, list[float]]:
    """(word, n, log) of the words without an id of their own, and by shared id the logarithm of a word not counted."""
    slot = (F.crc32("word") % vocabulary.shared).alias("slot")
    known = spark.createDataFrame([(bytearray(w),) for w in vocabulary], "word binary")
    rare = counts.join(F.broadcast(known), "word", "left_anti").select("word", "n", slot)
    totals = rare.groupBy("slot").agg((F.sum("n") + 1).alias("total"))
    held = {r["slot"]: r["total"] for r in totals.collect()}
    rare = rare.join(F.broadcast(totals), "slot").select("word", "n", F.log(F.col("n") / F.col("total")).alias("log"))
    return rare, [-math.log(held.get(i, 1)) for i in range(vocabulary.shared)]


def build_vocabulary(spark: SparkSession, docs: DataFrame, common: int, shared: int, text_col: str = "text", counts: DataFrame | None = None) -> Vocabulary:
    """From the counts of all documents (``counts``, if made); the driver gets ``common`` words and ``shared`` numbers."""
    counts = counted(spark, docs, text_col) if counts is None else counts
    top = counts.orderBy(F.desc("n"), "word").limit(common)
    words = [bytes(r["word"]) for r in top.select("word").collect()]
    slots = counts.groupBy((F.crc32("word") % shared).alias("slot")).agg(F.count(F.lit(1)).alias("words")).collect()
    spread = np.zeros(shared, np.int64)
    for r in slots:
        spread[r["slot"]] = r["words"]
    for word in words:
        spread[zlib.crc32(word) % shared] -= 1
    return Vocabulary(words, shared, spread)


def train(
    spark: SparkSession,
    docs: DataFrame,
    vocabulary: Vocabulary,
    side: int = 2,
    hidden: int = 32,
    rounds: int = 1,
    stride: int = 1,
    batch: int = 8192,
    rate: float = 4.0,
    text_col: str = "text",
) -> Network:
    """Network trained on every position of all documents each round (one in ``stride``)."""
    network = Network.fresh(vocabulary.size, side, hidden)
    texts = docs.select(raw_text(text_col).alias("text"))
    for number in range(rounds):
        shared = sent(spark, (vocabulary, network))

        def tasks(batches: Iterator[pa.RecordBatch], shared=shared, phase=number * stride // max(rounds, 1)) -> Iterator[pa.RecordBatch]:
            vocabulary, network = received(shared)
            held, seen = [], 0
            known, numbers = pa.array(list(vocabulary), pa.binary()), np.arange(1, 1 + vocabulary.common, dtype=np.int32)
            # rows and weights are mixed over the batches that a block of text gives
            rng = np.random.default_rng(phase)

            def learn() -> int:
                context, target = (np.concatenate(x) for x in zip(*held, strict=True))
                order = rng.permutation(len(target))
                for at in range(0, len(target), batch):
                    own = order[at : at + batch]
                    network.step(context[own], target[own], rate)
                return len(target)

            for block in blocks(batches, "text", 2 << 20):
                row, n, _, _ = in_a_row(known, numbers, vocabulary, block.column("text"), network.side)
                place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                own = np.flatnonzero(row)[(place - np.repeat(n, n) - phase) % stride == 0]
                if len(own):
                    held.append((around(row, network.side, own), row[own]))
                if sum(len(t) for _, t in held) >= 16 * batch:
                    seen += learn()
                    held = []
            if held:
                seen += learn()
            if seen:
                weighted = np.append(network.parameters().astype(np.float64) * seen, seen).astype(np.float32)
                yield pa.RecordBatch.from_arrays([pa.array([weighted.tobytes()], pa.binary())], names=["weighted"])

        def add(a: bytes, b: bytes) -> bytes:
            return (np.frombuffer(a, np.float32) + np.frombuffer(b, np.float32)).tobytes()

        total = texts.mapInArrow(tasks, "weighted binary").rdd.map(lambda r: bytes(r[0])).treeAggregate(b"", lambda a, b: add(a, b) if a else b, lambda a, b: add(a, b) if a and b else a or b, depth=3)
        if not total:
            return network
        flat = np.frombuffer(total, np.float32)
        network = network.with_parameters(flat[:-1] / flat[-1])
    return network


def score(
    spark: SparkSession,
    docs: DataFrame,
    vocabulary: Vocabulary,
    network: Network,
    id_col: str = "doc_id",
    text_col: str = "text",
    segment: int = 1 << 15,
    counts: DataFrame | None = None,
    known: int = 1 << 16,
) -> DataFrame:
    """One row per document: doc_id, n_words, log_likelihood (sum), mean_log_likelihood.

    ``counts`` (word, n) gives the words of a shared id their own probabilities:
    the tasks know those of the ``known`` most frequent ones, all others are
    joined with the counts.
    """
    even, frequent = counts is None, []
    if not even:
        logs, unseen = within_shared(spark, counts, vocabulary)
        frequent = logs.orderBy(F.desc("n"), "word").limit(known).select("word", "log").collect()
    # numbers beyond the vocabulary's are those of the known words; their ids and logarithms
    places = [bytes(r["word"]) for r in frequent]
    ids = np.concatenate([np.arange(vocabulary.size), [vocabulary[w] for w in places]]).astype(np.int32)
    own_log = np.concatenate([np.zeros(vocabulary.size), [r["log"] for r in frequent]])
    shared = sent(spark, (vocabulary, network, places, ids, own_log))

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, network, places, ids, own_log = received(shared)
        side, known = network.side, pa.array([*vocabulary, *places], pa.binary())
        numbers = np.concatenate([np.arange(1, 1 + vocabulary.common), vocabulary.size + np.arange(len(places))]).astype(np.int32)
        for block in blocks(batches, "text", 2 << 20):
            # documents in a row, padded apart; a position is scored only if it holds a word
            place, n, split, held = in_a_row(known, numbers, vocabulary, block.column("text"), side)
            row, sums = ids[place], own_log[place]
            words = np.flatnonzero(row)
            for at in range(0, len(words), segment):
                own = words[at : at + segment]
                sums[own] += network.log_probabilities(around(row, side, own), row[own])
                if even:
                    sums[own] += vocabulary.within[row[own]]
            ends = np.cumsum(n + side)
            total = np.concatenate([[0.0], np.cumsum(sums)])
            columns = [block.column("doc_id"), pa.array(n), pa.array(total[ends] - total[ends - n])]
            if not even:
                cuts = np.concatenate([[0], np.cumsum(~held)])[np.concatenate([[0], np.cumsum(n)])]
                columns.append(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), split.filter(pa.array(~held))))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "log_likelihood", "rare"][: len(columns)])

    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), raw_text(text_col).alias("text"))
    kinds = "doc_id long, n_words long, log_likelihood double"
    mean = F.when(F.col("n_words") > 0, F.col("log_likelihood") / F.col("n_words")).alias("mean_log_likelihood")
    if even:
        return named.mapInArrow(tasks, kinds).select("*", mean)
    scored = named.mapInArrow(tasks, f"{kinds}, rare array<binary>").withColumn("row", F.monotonically_increasing_id())
    scored = written(spark, scored, "scored")
    words = scored.select("row", F.explode("rare").alias("word")).join(logs.select("word", "log"), "word", "left")
    log = F.coalesce("log", F.element_at(F.lit(unseen), (F.crc32("word") % vocabulary.shared + 1).cast("int")))
    within = words.groupBy("row").agg(F.sum(log).alias("within"))
    total = (F.col("log_likelihood") + F.coalesce("within", F.lit(0.0))).alias("log_likelihood")
    return scored.drop("rare").join(within, "row", "left").select("doc_id", "n_words", total).select("*", mean)
