"""Language identification with interpolated Kneser-Ney character models.

One model per language over ``order`` characters, trained on a bounded sample
of labelled documents: of each language the ``train_docs`` with the smallest
hash of their id and text, and the next ``calibration_docs`` to calibrate. The n-grams
of the sample are counted by Spark; the driver gets the distinct ones, whose
number the sample bounds, and derives the lower orders (continuation counts),
discounts and back-off weights.

The models lie in sorted arrays of 64-bit n-gram hashes with one row of
log-probabilities per n-gram and a column per language, broadcast to the
tasks. A task looks up every position of a whole text: an n-gram that no
language knows falls back to its context's weights and its shorter form. The
language of lowest cross-entropy per character wins.

Calibration, on documents outside the training sample:
- the score is the softmax of the negated cross-entropies times a factor that
  makes the score likeliest;
- a document is rejected when its cross-entropy exceeds what the sample has
  for its language and length: (entropy - median) * sqrt(length) / (1 +
  sqrt(length / 1000)) above ``slack`` times the sample's 99th percentile.
  Texts without a letter are rejected too.

Scale: prediction is one map over the documents; memory holds the model and
one segment of positions. Texts are not shuffled: the chosen documents' ids and
digests, whose number the sample bounds, are broadcast to the scan.

Defined cases: null text, or text without a letter: ``und``, score 0,
rejected. Without any labelled document every document is ``und``. Null
labels, null ids and null texts are never learned from. Rows repeated whole
count once in the sample, rows that share an id keep their own text and label
there; each row has its own prediction. Languages that tie: the first in order
of their names. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import batch_of, blocks, mix64, raw_text, received, sent, written

#: Powers of an odd number, modulo 2^64.
POWERS = [np.uint64(pow(0x9E3779B97F4A7C15, k, 1 << 64)) for k in range(16)]
SCHEMA = "doc_id long, lang_pred string, score double, rejected boolean, cross_entropy double, n_chars long"


def codes_of(text: str, order: int) -> np.ndarray:
    """Code points in lower case with blanks and digits unified, after order - 1 blanks."""
    codes = np.frombuffer((" " * (order - 1) + text.lower()).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    codes[codes <= 32] = 32
    codes[(codes >= 48) & (codes <= 57)] = 48
    return codes


def gram_hashes(codes: np.ndarray, order: int) -> list[np.ndarray]:
    """For k = 0..order the hash of the k characters that end at each position."""
    total = np.zeros(len(codes), np.uint64)
    out = [mix64(total)]
    for k in range(1, order + 1):
        shifted = np.zeros(len(codes), np.uint64)
        shifted[k - 1 :] = codes[: len(codes) - k + 1] + np.uint64(1)
        total = total + shifted * POWERS[k - 1]
        out.append(mix64(total + np.uint64(k)))
    return out


class HashTable:
    """Sorted 64-bit hashes with a directory over their leading bits."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.shift = np.uint64(64 - max(1, int(len(keys)).bit_length() + 1))
        starts = np.arange((1 << (64 - int(self.shift))) + 1, dtype=np.uint64)
        self.starts = np.searchsorted(keys >> self.shift, starts).astype(np.int32)
        self.depth = int(np.diff(self.starts).max(initial=0))

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Row of each hash, -1 if it is not there."""
        row = np.full(len(wanted), -1, np.int64)
        at = self.starts[(wanted >> self.shift).astype(np.int64)]
        last = len(self.keys) - 1
        for step in range(self.depth):
            here = np.minimum(at + step, last)
            row = np.where(self.keys[here] == wanted, here, row)
        return row


@dataclass
class Model:
    langs: list[str]
    order: int
    #: Log-probability of an unseen character, by language.
    floor: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))
    grams: list = field(default_factory=list)  # by k - 1: (HashTable, log-probabilities)
    contexts: list = field(default_factory=list)  # by k - 1: (HashTable, log back-off weights)
    factor: float = 1.0
    middle: np.ndarray = field(default_factory=lambda: np.zeros(0))
    limit: float = np.inf

    def log_probabilities(self, codes: np.ndarray) -> np.ndarray:
        """A row for each position after the leading blanks, a column for each language."""
        hashes = gram_hashes(codes, self.order)
        first = self.order - 1
        out = np.zeros((len(codes) - first, len(self.langs)), np.float32)
        todo = np.arange(len(out))
        for k in range(self.order, 0, -1):
            table, values = self.grams[k - 1]
            row = table.find(hashes[k][todo + first])
            hit = row >= 0
            if hit.all():
                out[todo] += values[row]
                return out
            out[todo[hit]] += values[row[hit]]
            todo = todo[~hit]
            if k > 1:
                table, weights = self.contexts[k - 1]
                row = table.find(hashes[k - 1][todo + first - 1])
                seen = row >= 0
                out[todo[seen]] += weights[row[seen]]
        out[todo] += self.floor
        return out

    def cross_entropies(self, texts: list[str], segment: int = 1 << 19) -> tuple[np.ndarray, np.ndarray]:
        """Per text and language the mean negated log-probability; the texts' lengths."""
        pad = self.order - 1
        coded = [codes_of(t, self.order) for t in texts]
        lengths = np.array([len(c) - pad for c in coded], np.int64)
        sums = np.zeros((len(texts), len(self.langs)))
        i = 0
        while i < len(texts):  # whole short texts together, a long one in overlapping segments
            j, held = i, 0
            while j < len(texts) and (j == i or held + lengths[j] <= segment):
                held += lengths[j]
                j += 1
            if j == i + 1:
                for at in range(0, int(lengths[i]), segment):
                    sums[i] += self.log_probabilities(coded[i][at : at + segment + pad]).sum(axis=0, dtype=np.float64)
            else:
                logs = self.log_probabilities(np.concatenate(coded[i:j]))
                ends = np.cumsum([len(c) for c in coded[i:j]])
                for n, end in enumerate(ends.tolist()):  # positions are counted after the first pad
                    sums[i + n] = logs[end - pad - lengths[i + n] : end - pad].sum(axis=0, dtype=np.float64)
            i = j
        return -sums / np.maximum(lengths, 1)[:, None], lengths

    def excess(self, entropy: np.ndarray, best: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        root = np.sqrt(lengths)
        return (entropy - self.middle[best]) * root / (1 + root / np.sqrt(1000))


def kneser_ney(counts: pd.DataFrame, order: int, alphabet: int = 1 << 16) -> Model:
    """Model from the counts (lang, gram, n) of all grams of ``order`` characters."""
    langs = sorted(counts["lang"].unique())
    model = Model(langs, order)
    if not langs:
        return model
    column = {lang: i for i, lang in enumerate(langs)}
    codes = np.frombuffer("".join(counts["gram"]).encode("utf-32-le", "surrogatepass"), "<u4").reshape(-1, order).astype(np.uint64)
    lang = counts["lang"].map(column).to_numpy()
    number = counts["n"].to_numpy(np.float64)
    levels = {}
    for k in range(order, 0, -1):
        if k < order:  # continuation counts: one for each distinct longer gram
            pairs = pd.DataFrame({"lang": lang, "gram": hashes_of(codes)})
            pairs["first"] = np.arange(len(pairs))
            kept = pairs.groupby(["lang", "gram"], sort=False)["first"].agg(["first", "size"])
            codes, lang, number = codes[kept["first"]], lang[kept["first"]], kept["size"].to_numpy(np.float64)
        levels[k] = (codes, lang, number)
        codes = codes[:, 1:]
    below = None
    for k in range(1, order + 1):
        codes, lang, number = levels[k]
        ones, twos = (number == 1).sum(), (number == 2).sum()
        discount = min(0.95, max(0.05, ones / max(1, ones + 2 * twos)))
        keys, first, gram = np.unique(hashes_of(codes), return_index=True, return_inverse=True)
        held, holds = np.unique(hashes_of(codes[:, :-1]), return_inverse=True)
        total, kinds = np.zeros((len(held), len(langs))), np.zeros((len(held), len(langs)))
        np.add.at(total, (holds, lang), number)
        np.add.at(kinds, (holds, lang), 1)
        weight = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
        exact = np.zeros((len(keys), len(langs)))
        exact[gram, lang] = (number - discount) / total[holds, lang]
        if below is None:
            shorter = 1 / alphabet
            model.floor = np.log(weight[0] / alphabet).astype(np.float32)
        else:
            table, values = below
            shorter = values[table.find(hashes_of(codes[first][:, 1:]))]
        values = exact + weight[holds[first]] * shorter
        below = (HashTable(keys), values)
        model.grams.append((below[0], np.log(values).astype(np.float32)))
        model.contexts.append((HashTable(held), np.log(weight).astype(np.float32)))
    return model


def hashes_of(grams: np.ndarray) -> np.ndarray:
    """Hash of each row of code points; the same as ``gram_hashes`` gives at the row's end."""
    total = np.zeros(len(grams), np.uint64)
    for k in range(grams.shape[1]):
        total = total + (grams[:, grams.shape[1] - 1 - k] + np.uint64(1)) * POWERS[k]
    return mix64(total + np.uint64(grams.shape[1]))


def labelled_sample(spark: SparkSession, docs: DataFrame, allowed: Column, train_docs: int, calibration_docs: int, max_languages: int = 1000) -> DataFrame:
    """(lang, text, train) of the bounded sample, written once.

    A document is its id, text and label: rows repeated whole are one, and rows
    that share an id keep their own text and label. Of a language's documents
    only those with a hash so small that four times the sample is expected go
    to the ranking, so no task ranks more than that.
    """
    size = train_docs + calibration_docs
    digests = F.xxhash64("text").alias("d1"), F.xxhash64(F.lit(1), "text").alias("d2")
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & allowed)
    labelled = labelled.select("doc_id", F.col("lang").alias("label"), *digests).distinct()
    labelled = written(spark, labelled, "labelled")
    held = written(spark, labelled.groupBy("label").agg(F.count(F.lit(1)).alias("held")), "languages")
    if held.count() > max_languages:  # a model has a column for each
        raise ValueError(f"more than {max_languages} languages")
    place = F.xxhash64("doc_id", "d1")
    share = place.cast("double") / 2.0**64 + 0.5
    few = labelled.join(F.broadcast(held), "label").filter(share * F.col("held") < 4.0 * size)
    by_hash = Window.partitionBy("label").orderBy(place, "doc_id", "d1", "d2")
    chosen = few.withColumn("rank", F.row_number().over(by_hash)).filter(F.col("rank") <= size).select("doc_id", "d1", "d2", "label", (F.col("rank") <= train_docs).alias("train"))
    texts = docs.filter(F.col("text").isNotNull()).select("doc_id", F.col("lang").alias("label"), "text", *digests)
    # at most ``size`` rows of four numbers for each of at most ``max_languages``
    met = texts.join(F.broadcast(chosen), ["doc_id", "label", "d1", "d2"]).dropDuplicates(["doc_id", "label", "d1", "d2"])
    return written(spark, met.select(F.col("label").alias("lang"), raw_text("text").alias("text"), "train"), "language_sample")


def count_grams(sample: DataFrame, order: int) -> DataFrame:
    """(lang, gram, n) over the training part of the sample."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("lang", pa.string()), ("gram", pa.string()), ("n", pa.int64())])
        for block in blocks(batches, "text", 2 << 20):
            langs = np.array(block.column("lang").to_pylist(), object)
            texts = block.column("text").to_pylist()
            for lang in dict.fromkeys(langs):
                codes = np.concatenate([codes_of(texts[i].decode("utf-8", "replace"), order) for i in np.flatnonzero(langs == lang)])
                inside = np.arange(order - 1, len(codes))
                if not len(inside):
                    continue
                _, first, n = np.unique(gram_hashes(codes, order)[order][inside], return_index=True, return_counts=True)
                grams = codes[inside[first][:, None] + np.arange(1 - order, 1)].astype("<u4").tobytes().decode("utf-32-le", "replace")
                yield batch_of(schema, lang=[lang] * len(n), gram=[grams[at : at + order] for at in range(0, len(grams), order)], n=n)

    grams = sample.filter("train").select("lang", "text").mapInArrow(tasks, "lang string, gram string, n long")
    return grams.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def train(
    spark: SparkSession,
    docs: DataFrame,
    allowed: Column | None = None,
    order: int = 4,
    train_docs: int = 800,
    calibration_docs: int = 200,
    slack: float = 3.0,
) -> Model:
    """Model from the labelled documents (doc_id, text, lang) that ``allowed`` admits.

    The sample is bounded by ``train_docs + calibration_docs`` documents a language.
    """
    sample = labelled_sample(spark, docs, F.lit(True) if allowed is None else allowed, train_docs, calibration_docs)
    model = kneser_ney(count_grams(sample, order).toPandas(), order)
    if not model.langs:
        return model
    held = measured(sample.filter(~F.col("train")).select("lang", "text"), model, spark).toPandas()
    if held.empty:
        held = measured(sample.select("lang", "text"), model, spark).toPandas()
    return calibrated(model, held, slack)


def measured(sample: DataFrame, model: Model, spark: SparkSession) -> DataFrame:
    """(lang, n_chars, entropies) of each sampled text."""
    shared = sent(spark, model)

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = received(shared)
        schema = pa.schema([("lang", pa.string()), ("n_chars", pa.int64()), ("entropies", pa.list_(pa.float64()))])
        for block in blocks(batches, "text", 2 << 20):
            entropies, lengths = model.cross_entropies([t.decode("utf-8", "replace") for t in block.column("text").to_pylist()])
            yield batch_of(schema, lang=block.column("lang").to_pylist(), n_chars=lengths, entropies=entropies.tolist())

    return sample.mapInArrow(tasks, "lang string, n_chars long, entropies array<double>")


def calibrated(model: Model, held: pd.DataFrame, slack: float) -> Model:
    """Sets the factor of the score and the limit of rejection."""
    held = held[held["n_chars"] > 0]
    if held.empty:
        model.middle = np.zeros(len(model.langs))
        return model
    entropies = np.array(held["entropies"].tolist())
    lengths, truth = held["n_chars"].to_numpy(), held["lang"].map({x: i for i, x in enumerate(model.langs)}).to_numpy()
    best = entropies.argmin(axis=1)

    def loss(factor: float) -> float:
        logits = -factor * (entropies - entropies.min(axis=1, keepdims=True))
        return float((np.log(np.exp(logits).sum(axis=1)) - logits[np.arange(len(truth)), truth]).mean())

    model.factor = min((0.5 * 2**i for i in range(9)), key=loss)
    lowest = entropies[np.arange(len(best)), best]
    overall = np.median(lowest)
    model.middle = np.array([np.median(lowest[best == i]) if (best == i).any() else overall for i in range(len(model.langs))])
    model.limit = slack * max(1.0, float(np.quantile(model.excess(lowest, best, lengths), 0.99)))
    return model


def identify(spark: SparkSession, docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", carried: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, lang_pred, score, rejected, cross_entropy, n_chars, and the columns ``carried`` along."""
    shared = sent(spark, model)
    further = docs.select(*carried).schema

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = received(shared)
        schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_()), ("cross_entropy", pa.float64()), ("n_chars", pa.int64())])
        for block in blocks(batches, "text", 2 << 20):
            texts = [t.decode("utf-8", "replace") for t in block.column("text").to_pylist()]
            lettered = np.array([next((True for c in t if c.isalpha()), False) for t in texts])
            if not model.langs:
                lettered[:] = False
            n = len(texts)
            langs, score, entropy = np.array(["und"] * n, object), np.zeros(n), np.full(n, np.nan)
            rejected, lengths = np.ones(n, bool), np.array([len(t) for t in texts], np.int64)
            if lettered.any():
                at = np.flatnonzero(lettered)
                entropies, scored = model.cross_entropies([texts[i] for i in at])
                best = entropies.argmin(axis=1)
                lowest = entropies[np.arange(len(at)), best]
                langs[at] = np.array(model.langs, object)[best]
                score[at] = 1 / np.exp(-model.factor * (entropies - lowest[:, None])).sum(axis=1)
                entropy[at] = lowest
                rejected[at] = model.excess(lowest, best, scored) > model.limit
            out = batch_of(schema, doc_id=block.column("doc_id"), lang_pred=langs, score=score, rejected=rejected, cross_entropy=entropy, n_chars=lengths)
            yield pa.RecordBatch.from_arrays([*out.columns, *(block.column(c) for c in carried)], names=[*schema.names, *carried])

    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), raw_text(text_col).alias("text"), *carried)
    return named.mapInArrow(tasks, StructType([*StructType.fromDDL(SCHEMA), *further]))
