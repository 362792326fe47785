"""Near duplicates against all pairs."""

import random

import pytest

from cabmetrics.llm.components import connected_components
from cabmetrics.llm.near_dedup import linked_within_buckets, near_duplicates, shingle_set


def brute(rows, size, percent=80):
    sets = {}
    for doc, text in rows:
        sets.setdefault(doc, shingle_set((text or "").encode().lower().split(), size))
    up = {d: d for d in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = top(a), top(b)
                    up[max(x, y)] = min(x, y)
    return sorted((d, len(sets[d]), top(d), top(d) == d) for d in ids)


def found(spark, table, **options):
    df = spark.createDataFrame([(*r, 1, b"x") for r in table], "doc_id long, text string, rep long, key binary")
    return sorted((tuple(r) for r in near_duplicates(spark, df, **options).collect()), key=repr)


@pytest.mark.parametrize("size", [2, 5])
def test_documents(spark, sf_small, size):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()]
    assert found(spark, rows, words=size) == sorted(brute(rows, size), key=repr)


def test_families_chains_and_odd_texts(spark):
    rng = random.Random(5)
    names = [f"w{i}" for i in range(400)]
    rows, doc = [], 0
    for _ in range(4):  # families whose members drift away from each other: links through others only
        words = [rng.choice(names) for _ in range(120)]
        for _ in range(25):
            words = list(words)
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(names)
            rows.append((doc, " ".join(words)))
            doc += 1
    rows += [(doc, None), (doc + 1, ""), (doc + 2, "One"), (doc + 3, "one"), (doc + 4, "one two"), (doc + 5, " \t\n")]
    rng.shuffle(rows)
    assert found(spark, rows, words=2) == sorted(brute(rows, 2), key=repr)


def test_second_pass_finds_links_that_no_centre_has(spark):
    # one band of one row: everything that shares one place meets in a few buckets
    rng = random.Random(2)
    base = [f"c{i}" for i in range(40)]
    rows = []
    for family in range(6):
        own = [f"f{family}x{i}" for i in range(40)]
        for copy in range(3):
            rows.append((3 * family + copy, " ".join(base[:10] + own + [f"m{rng.random()}"])))
    got = found(spark, rows, words=1, bands=200, rows=1)
    assert got == sorted(brute(rows, 1), key=repr)


@pytest.mark.parametrize("members", [2, 7, 2000])
def test_buckets_in_blocks(spark, members):
    rng = random.Random(members)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for doc in range(30):
        words = list(base)
        for _ in range(rng.randrange(2, 9)):
            words[rng.randrange(60)] = f"x{rng.randrange(40)}"
        rows.append((doc, " ".join(words)))
    texts = spark.createDataFrame([(d, t.encode()) for d, t in rows], "doc_id long, text binary")
    slots = spark.createDataFrame([(k, d, 60, d) for k in (1, 2) for d, _ in rows[10 * (k - 1) :]], "key long, rep long, size long, component long")
    links = linked_within_buckets(spark, slots, texts, 1, 80, block_members=members)
    found = {r["node"]: r["component"] for r in connected_components(spark, links).collect()}
    assert [(d, found.get(d, d)) for d, _ in rows] == [(d, top) for d, _, top, _ in brute(rows, 1)]


def test_null_ids_repeats_and_empty_table(spark):
    text = "a b c d e f g h"
    got = found(spark, [(None, text), (4, text), (4, text), (None, "x y z"), (None, None)], words=2)
    assert got == sorted([(None, 7, 4, False), (4, 7, 4, True), (4, 7, 4, True), (None, 2, None, True), (None, 0, None, True)], key=repr)
    assert found(spark, []) == []


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 90), (90, 100), (7, 7)], "a long, b long")
    got = {tuple(r) for r in connected_components(spark, edges).collect()}
    assert got == {(i, 0) for i in range(61)} | {(100, 90), (90, 90)}
