"""Language models: they are distributions, and held-out documents are told apart."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cabmetrics.llm.language_id import Model, codes_of, gram_hashes, hashes_of, identify, kneser_ney, labelled_sample, train
from cabmetrics.llm.queries import QUERIES


def counts_of(texts, order):
    rows = {}
    for lang, text in texts:
        codes = codes_of(text, order)
        for i in range(order - 1, len(codes)):
            key = (lang, "".join(map(chr, codes[i - order + 1 : i + 1].tolist())))
            rows[key] = rows.get(key, 0) + 1
    return pd.DataFrame([(*k, n) for k, n in rows.items()], columns=["lang", "gram", "n"])


TEXTS = [("a", "the cat sat on the mat with the other cat"), ("a", "that hat"), ("b", "le chat est sur le tapis avec un chat"), ("b", "là")]


def test_models_are_distributions():
    order, alphabet = 3, 60
    model = kneser_ney(counts_of(TEXTS, order), order, alphabet=alphabet)
    known = sorted({int(c) for _, t in TEXTS for c in codes_of(t, order)})
    for context in ("  ", "th", "he", "zz", "at", "qa"):
        total = np.zeros(2)
        for c in known:
            codes = np.array([*map(ord, context), c], np.uint64)
            total += np.exp(model.log_probabilities(codes)[0].astype(float))
        unseen = np.exp(model.log_probabilities(np.array([*map(ord, context), 0x4E00], np.uint64))[0].astype(float))
        assert total + (alphabet - len(known)) * unseen == pytest.approx([1, 1], abs=1e-5)


def plain_kneser_ney(counts, order, alphabet):
    """log P(character | the ones before) by dictionaries, one level after the other."""
    levels = {order: {(r.lang, r.gram): float(r.n) for r in counts.itertuples()}}
    for k in range(order - 1, 0, -1):
        levels[k] = {}
        for lang, gram in levels[k + 1]:
            levels[k][lang, gram[1:]] = levels[k].get((lang, gram[1:]), 0.0) + 1
    discounts = {}
    for k, level in levels.items():
        ones, twos = (sum(n == x for n in level.values()) for x in (1, 2))
        discounts[k] = min(0.95, max(0.05, ones / max(1, ones + 2 * twos)))

    def probability(lang, gram, k):
        if k == 0:
            return 1 / alphabet
        gram = gram[-k:]
        followers = {g[-1]: n for (x, g), n in levels[k].items() if x == lang and g[:-1] == gram[:-1]}
        total = sum(followers.values())
        if not total:
            return probability(lang, gram, k - 1)
        own = followers[gram[-1]] - discounts[k] if gram[-1] in followers else 0.0
        return own / total + discounts[k] * len(followers) / total * probability(lang, gram, k - 1)

    return probability


def test_equals_plain_kneser_ney():
    order, alphabet = 3, 80
    counts = counts_of(TEXTS, order)
    model, plain = kneser_ney(counts, order, alphabet=alphabet), plain_kneser_ney(counts, order, alphabet)
    for text in ("the cat", "un chat là", "zzz", "tha", "x the x", ""):
        codes = codes_of(text, order)
        got = model.log_probabilities(codes)
        for i in range(order - 1, len(codes)):
            gram = "".join(map(chr, codes[i - order + 1 : i + 1].tolist()))
            want = [np.log(plain(lang, gram, order)) for lang in model.langs]
            assert got[i - order + 1] == pytest.approx(want, abs=1e-4), (text, gram)


def test_the_sample_is_bounded_and_rightly_labelled(spark):
    rows = [(7, f"{lang} words {i}", lang) for i in range(300) for lang in ("en", "de")]  # one id, a text and label each
    rows += [(8, "en the same row", "en")] * 200 + [(9, "en de both", "en"), (9, "en de both", "de"), (None, "en no id", "en"), (10, None, "en"), (11, "en no label", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample = labelled_sample(spark, docs, F.lit(True), 30, 10).collect()
    assert {lang: sum(r["lang"] == lang for r in sample) for lang in ("en", "de")} == {"en": 40, "de": 40}
    assert sum(r["train"] for r in sample) == 60
    assert all(r["lang"] in r["text"].decode() for r in sample)
    assert len({(r["lang"], bytes(r["text"])) for r in sample}) == 80


def test_hashes_agree():
    codes = codes_of("Some text, 42", 4)
    rolled = gram_hashes(codes, 4)[4][3:]
    rows = np.stack([codes[i : i + 4] for i in range(len(codes) - 3)])
    assert (rolled == hashes_of(rows)).all()


def test_long_texts_are_cut_without_loss():
    model = kneser_ney(counts_of(TEXTS, 3), 3)
    texts = ["the chat " * 50, "x", "le mat " * 9]
    whole, _ = model.cross_entropies(texts)
    cut, _ = model.cross_entropies(texts, segment=17)
    assert whole == pytest.approx(cut)


def test_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op9_language"](spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    held = got[got["held_out"]]
    assert len(got) == 1000 and len(held) > 250
    assert (held["lang_pred"] == held["lang"]).mean() > 0.98
    assert got["rejected"].mean() < 0.01
    assert got["score"].between(0, 1).all()


def test_odd_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    extra = [(-1, None, "en"), (-2, "", "en"), (-3, "12 345 !?", None), (-4, "ξψωζη ∂ßqxzjv ŋʒʃ" * 40, None), (None, "the and of the", "en"), (-5, "A", "en")]
    table = docs.select("doc_id", "text", "lang").union(spark.createDataFrame(extra, "doc_id long, text string, lang string")).withColumn("score", F.lit("x"))
    model = train(spark, table)
    got = {r["doc_id"]: r for r in identify(spark, table, model).collect()}
    assert len(got) == docs.count() + len(extra)
    for i in (-1, -2, -3):
        assert (got[i]["lang_pred"], got[i]["score"], got[i]["rejected"]) == ("und", 0.0, True)
    assert got[-4]["rejected"] and not got[None]["rejected"] and not got[-5]["rejected"]
    nothing = train(spark, table.limit(0))
    assert isinstance(nothing, Model) and not nothing.langs
    assert {r["lang_pred"] for r in identify(spark, table, nothing).collect()} == {"und"}
    assert identify(spark, table.limit(0), model).count() == 0
