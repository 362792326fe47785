"""Repeated passages against a dictionary of all windows."""

import random

import numpy as np
import pytest

from cabmetrics.llm.substring_dedup import Firsts, pack, remove_repeats, repeated_windows, sliding_minimum, unpack


def brute(rows, size):
    texts = [(doc, (text or "").encode().split()) for doc, text in rows]
    first = {}
    for doc, words in texts:
        place = -1 if doc is None else doc
        for p in range(len(words) - size + 1):
            key = tuple(words[p : p + size])
            first[key] = min(first.get(key, (place, p)), (place, p))
    out = []
    for doc, words in texts:
        place, gone = -1 if doc is None else doc, [False] * len(words)
        for p in range(len(words) - size + 1):
            if first[tuple(words[p : p + size])] < (place, p):
                gone[p : p + size] = [True] * size
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g).decode()
        out.append((doc, len(words), sum(gone), kept))
    return sorted(out, key=repr)


def found(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, key long, cuts string").repartition(5)
    return sorted((tuple(r) for r in remove_repeats(spark, df, **options).collect()), key=repr)


def test_documents(spark, sf_small):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()]
    assert found(spark, rows) == brute(rows, 20)


@pytest.mark.parametrize("size", [5, 8])
def test_made_up_repeats(spark, size):
    rng = random.Random(size)
    names = ["a", "b", "c", "dé"]
    passage = " ".join(rng.choice(names) for _ in range(40))
    rows = [(i, " ".join(rng.choice(names) for _ in range(rng.randrange(30))) + " " + (passage if i % 3 else "") + " tail") for i in range(60)]
    rows += [(100, "z " * 1500), (101, "z " * 700), (102, None), (103, ""), (104, " \n\t"), (None, passage), (5, rows[5][1])]
    assert found(spark, rows, window=size, minimiser=3) == brute(rows, size)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_equal_hashes_are_told_apart(monkeypatch):
    import cabmetrics.llm.substring_dedup as m

    monkeypatch.setattr(m, "rolling", lambda x, size: np.zeros(len(x) - size + 1, np.uint64))
    items = [(1, 0, 0, 3, b"a b c d"), (2, 0, 0, 3, b"x b c d")]
    assert repeated_windows(items, 2) == [(2, 0, 1, 3)]


def test_strings_travel_whole():
    firsts = Firsts()
    for item in [(5, 1, 0, 2, b"a b c"), (3, 1, 7, 2, b"a b c"), (9, 1, 0, 2, b"a b c"), (4, 1, 0, 1, b"q r")]:
        firsts.offer(item)
    assert firsts.items_in_order() == [(3, 1, 7, 2, b"a b c"), (4, 1, 0, 1, b"q r")]
    assert unpack(pack(firsts.items_in_order(), firsts.marked)) == (firsts.items_in_order(), [[5, 1, 0, 2], [9, 1, 0, 2]])


@pytest.mark.parametrize("size", range(1, 20))
def test_sliding_minimum(size):
    x = np.random.default_rng(size).integers(0, 100, 60)
    assert sliding_minimum(x, size).tolist() == [x[i : i + size].min() for i in range(61 - size)]
