"""Masked pseudo-likelihood: a distribution, right gradients, and prose above shuffled prose."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from cabmetrics.llm import pseudo_likelihood
from cabmetrics.llm.common import written
from cabmetrics.llm.pseudo_likelihood import Network, Vocabulary, build_vocabulary, contexts, counted, score, train


def test_probabilities_sum_to_one():
    network = Network.fresh(200, 2, 8)
    context = np.tile(np.array([[3, 5, 7, 9]]), (CLUSTERED := 64 * 4, 1))
    logs = network.log_probabilities(context, np.arange(CLUSTERED))
    assert np.exp(logs).sum() == pytest.approx(1, abs=1e-4)


def test_gradients_are_those_of_the_likelihood():
    network = Network.fresh(100, 1, 4)
    for p in ("inputs", "bias", "cluster", "cluster_bias", "member", "member_bias"):
        setattr(network, p, getattr(network, p).astype(np.float64))
    rng = np.random.default_rng(0)
    context, target = rng.integers(0, 100, (30, 2)), rng.integers(0, 100, 30)
    flat = network.parameters()
    loss = lambda x: -network.with_parameters(x).log_probabilities(context, target).sum(dtype=np.float64)
    total = network.with_parameters(np.zeros_like(flat))
    for part, where, gradient in network.gradients(context, target):
        getattr(total, part)[where] += gradient
    total = total.parameters()
    for direction in (total / np.linalg.norm(total), rng.normal(0, 1, len(flat)) / np.sqrt(len(flat))):
        slope = (loss(flat + 1e-2 * direction) - loss(flat - 1e-2 * direction)) / 2e-2
        assert slope == pytest.approx(total @ direction, rel=0.02, abs=0.02)


def test_a_step_moves_words_by_sums_and_shared_layers_by_means():
    rng = np.random.default_rng(1)
    context, target = rng.integers(0, 300, (3000, 4)), rng.integers(0, 300, 3000)
    start, moved = Network.fresh(300, 2, 8), Network.fresh(300, 2, 8)
    moved.step(context, target, 2.0)
    total = start.with_parameters(np.zeros_like(start.parameters()))
    for part, where, gradient in start.gradients(context, target):
        getattr(total, part)[where] += gradient
    for part, size in (("inputs", 1024), ("member", 1024), ("member_bias", 1024), ("cluster", 3000), ("cluster_bias", 3000), ("bias", 3000)):
        rate = 2.0 * (3000 / 1024) ** 0.25
        assert getattr(start, part) - getattr(moved, part) == pytest.approx(rate / size * getattr(total, part), abs=1e-4)


def test_held_out_likelihood_does_not_fall_with_large_batches(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").coalesce(2)
    held, seen = docs.filter("doc_id % 5 = 0"), docs.filter("doc_id % 5 <> 0")
    vocabulary = build_vocabulary(spark, seen, common=4095, shared=512)
    found = {}
    for name, options in (("small", {"batch": 1024, "rate": 4.0}), ("default", {})):
        scored = score(spark, held, vocabulary, train(spark, seen, vocabulary, **options))
        found[name] = scored.selectExpr("sum(log_likelihood) / sum(n_words)").first()[0]
    fresh = score(spark, held, vocabulary, Network.fresh(vocabulary.size, 2, 32)).selectExpr("sum(log_likelihood) / sum(n_words)").first()[0]
    assert found["default"] >= found["small"] > fresh + 0.5


def test_contexts_leave_the_word_out():
    got = contexts(np.array([1, 2, 3], np.int32), 2, np.arange(3))
    assert got.tolist() == [[0, 0, 2, 3], [0, 1, 3, 0], [1, 2, 0, 0]]


def test_scores_are_those_of_a_plain_loop(spark):
    docs = spark.createDataFrame([(1, "the cat sat"), (2, None), (3, " "), (4, "odd words here the cat"), (None, "the")], "doc_id long, text string")
    vocabulary = build_vocabulary(spark, docs, common=3, shared=5)
    network = Network.fresh(vocabulary.size, 2, 8)
    got = {r["doc_id"]: r for r in score(spark, docs, vocabulary, network, segment=2).collect()}
    for doc, text in [(1, "the cat sat"), (4, "odd words here the cat"), (None, "the")]:
        ids = vocabulary.ids(text.encode())
        logs = network.log_probabilities(contexts(ids, 2, np.arange(len(ids))), ids) + vocabulary.within[ids]
        assert got[doc]["log_likelihood"] == pytest.approx(float(logs.sum()), rel=1e-5)
        assert got[doc]["mean_log_likelihood"] == pytest.approx(float(logs.mean()), rel=1e-5)
    for doc in (2, 3):
        assert (got[doc]["n_words"], got[doc]["log_likelihood"], got[doc]["mean_log_likelihood"]) == (0, 0.0, None)


def test_vocabulary_counts_everything(spark):
    docs = spark.createDataFrame([("b a a",), ("A c d e f",), (None,)], "text string")
    vocabulary = build_vocabulary(spark, docs, common=2, shared=3)
    assert vocabulary[b"a"] == 1 and vocabulary[b"b"] == 2 and vocabulary[b"zz"] >= 3
    slots = [zlib.crc32(w) % 3 for w in (b"c", b"d", b"e", b"f")]
    assert np.exp(-vocabulary.within[3:]) == pytest.approx([max(1, slots.count(i)) for i in range(3)], rel=1e-5)


def test_prose_scores_above_shuffled_prose(spark):
    rng = random.Random(1)
    follows = {i: [rng.randrange(40) for _ in range(2)] for i in range(40)}
    rows = []
    for doc in range(400):
        at, words = rng.randrange(40), []
        for _ in range(60):
            words.append(f"w{at}")
            at = rng.choice(follows[at])
        rows.append((doc, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    vocabulary = build_vocabulary(spark, docs, common=60, shared=8)
    network = train(spark, docs, vocabulary, stride=4, batch=128, rounds=4, rate=2.0)
    held = []
    for doc, text in rows[:20]:
        words = text.split()
        held += [(doc, text), (1000 + doc, " ".join(rng.sample(words, len(words))))]
    got = {r["doc_id"]: r["mean_log_likelihood"] for r in score(spark, spark.createDataFrame(held, "doc_id long, text string"), vocabulary, network).collect()}
    assert all(got[d] > got[1000 + d] + 0.5 for d in range(20))


@pytest.mark.parametrize("n", range(1, 11))
def test_every_position_of_short_documents_is_learned(spark, n):
    words = [f"w{i}" for i in range(n)]
    docs = spark.createDataFrame([(i, " ".join(words)) for i in range(300)], "doc_id long, text string").coalesce(1)
    vocabulary = build_vocabulary(spark, docs, common=4095, shared=512)
    fresh, network = Network.fresh(vocabulary.size, 2, 32), train(spark, docs, vocabulary)
    ids = np.array([vocabulary[w.encode()] for w in words])
    bias = lambda x: x.member_bias[ids % 64, ids // 64] + x.cluster_bias[ids % 64]
    assert (bias(network) > bias(fresh) + 0.1).all()  # each word was a target
    mean = score(spark, docs.limit(1), vocabulary, network).first()["mean_log_likelihood"]
    untrained = score(spark, docs.limit(1), vocabulary, fresh).first()["mean_log_likelihood"]
    assert mean > untrained + 1


def test_words_of_a_shared_id_have_their_own_probabilities(spark):
    rows = [(1, "the odd the"), (2, "the rare the"), (2, "the rare the rare"), (None, "the rare"), (3, None), (4, "the a the a the a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    counts = counted(spark, docs)
    vocabulary = build_vocabulary(spark, docs, common=2, shared=1, counts=counts)
    assert sorted(vocabulary) == [b"rare", b"the"]
    vocabulary = build_vocabulary(spark, docs, common=1, shared=1, counts=counts)
    network = Network.fresh(vocabulary.size, 2, 8)
    own = {"odd": 1, "rare": 4, "a": 3, "new": 1}  # of 8 and one left for others
    new = spark.createDataFrame([*rows, (5, "the new the")], docs.schema)
    got = sorted(map(tuple, score(spark, new, vocabulary, network, counts=counts).collect()), key=repr)
    want = []
    for doc, text in [*rows, (5, "the new the")]:
        words = (text or "").split()
        ids = vocabulary.ids((text or "").encode())
        logs = network.log_probabilities(contexts(ids, 2, np.arange(len(ids))), ids) if words else np.zeros(0)
        total = float(logs.sum() + sum(np.log(own[w] / 9) for w in words if w != "the"))
        want.append((doc, len(words), total, total / len(words) if words else None))
    for g, w in zip(got, sorted(want, key=repr), strict=True):
        assert g[:2] == w[:2] and g[2:] == (pytest.approx(w[2], rel=1e-5), w[3] if w[3] is None else pytest.approx(w[3], rel=1e-5))


def test_only_words_that_the_tasks_do_not_know_are_joined(spark, monkeypatch):
    rows = [(1, "the odd the"), (2, "the rare the"), (2, "the rare the rare"), (None, "the rare odd"), (3, None), (4, "the a the a the a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    counts = counted(spark, docs)
    vocabulary = build_vocabulary(spark, docs, common=1, shared=2, counts=counts)
    network, new, joined = Network.fresh(vocabulary.size, 2, 8), spark.createDataFrame([*rows, (5, "the new the")], docs.schema), []

    def kept(spark, df, name):
        joined.append(sorted(bytes(w) for r in df.select("rare").collect() for w in r["rare"]))
        return written(spark, df, name)

    monkeypatch.setattr(pseudo_likelihood, "written", kept)
    found = [sorted(map(tuple, score(spark, new, vocabulary, network, counts=counts, **x).collect()), key=repr) for x in ({}, {"known": 1}, {"known": 0})]
    others = [b"a"] * 3 + [b"new", b"odd", b"odd"]
    assert joined == [[b"new"], others, others + [b"rare"] * 4]
    for other in found[1:]:
        for got, want in zip(other, found[0], strict=True):
            assert got[:2] == want[:2] and (got[2:] == want[2:] or got[2:] == pytest.approx(want[2:], rel=1e-9))


def test_large_weights_give_the_same_shares():
    rng = np.random.default_rng(2)
    context, target = rng.integers(0, 300, (500, 4)), rng.integers(0, 300, 500)
    network = Network.fresh(300, 2, 8)
    assert network.safe()
    logs, total = network.log_probabilities(context, target), network.gradients(context, target)
    # a number that all logits of a row share changes no probability
    network.cluster_bias += 500
    network.member_bias += 500
    assert not network.safe()
    assert network.log_probabilities(context, target) == pytest.approx(logs, abs=2e-3)
    for (part, _, gradient), (_, _, want) in zip(network.gradients(context, target), total, strict=True):
        assert np.isfinite(gradient).all() and gradient == pytest.approx(want, abs=0.05), part


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    vocabulary = build_vocabulary(spark, docs, common=10, shared=4)
    assert isinstance(vocabulary, Vocabulary)
    assert score(spark, docs, vocabulary, train(spark, docs, vocabulary)).count() == 0


def test_rows_of_words_are_those_of_a_plain_loop():
    vocabulary = Vocabulary([b"the", b"a"], 5, np.ones(5))
    texts = ["", " The\x0b a\x0ccat\r\n", "A", "\x1c the\x85 İA \xc4 the", "\t", "cat  CAT\x00 a "]
    raw = pa.array([b"x the", *(t.encode() for t in texts), b"the"], pa.binary()).slice(1, len(texts))
    numbers = np.array([1, 2, 8], np.int32)  # a known word beyond the vocabulary has a number of its own
    row, n, words, held = pseudo_likelihood.in_a_row(pa.array([b"the", b"a", b"cat"]), numbers, vocabulary, raw, 2)
    split = [t.encode().lower().split() for t in texts]
    flat = [w for s in split for w in s]
    assert (words.to_pylist(), n.tolist()) == (flat, [len(s) for s in split])
    assert held.tolist() == [w in (b"the", b"a", b"cat") for w in flat]
    want = [0, 0]
    for s in split:
        want += [8 if w == b"cat" else vocabulary[w] for w in s] + [0, 0]
    assert row.tolist() == want
