"""Decontamination against a full alignment of every window."""

import random

import numpy as np
import pytest

from cabmetrics.llm.decontaminate import comparable, contaminations, decontaminate, windows_of


def nearest(window, text):
    """Fewest edits of the window anywhere in the text."""
    row = np.zeros(len(text) + 1, int)
    steps = np.arange(len(text) + 1)
    codes = np.frombuffer(text, np.uint8)
    for i, byte in enumerate(window, 1):
        new = np.minimum(row + 1, np.append(i, row[:-1] + (codes != byte)))
        row = np.minimum.accumulate(new - steps) + steps
    return int(row.min())


def brute(docs, items, size=160, rate=0.06, q=10):
    out = {}
    for doc, text in docs:
        text = comparable((text or "").encode())
        for item, x in items:
            x = comparable((x or "").encode())
            for start in windows_of(x, size) if x else []:
                window = x[start : start + size]
                k = int(rate * len(window)) if len(window) >= q else 0
                if text and nearest(window, text) <= k:
                    out.setdefault(doc, set()).add(item)
    return out


def found(spark, docs, items, **options):
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, item_id long").repartition(3)
    b = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, doc_id long")
    out = {}
    for r in contaminations(spark, d, b, **options).collect():
        out.setdefault(r["doc_id"], set()).add(r["item_id"])
    return out


def edited(rng, text, edits):
    text = list(text)
    for _ in range(edits):
        at = rng.randrange(len(text))
        kind = rng.randrange(3)
        if kind == 0:
            text[at] = rng.choice("qzxj")
        elif kind == 1:
            text.insert(at, rng.choice("qzxj"))
        else:
            del text[at]
    return "".join(text)


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("etaoinshr") for _ in range(rng.randrange(1, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    items = [(i, prose(rng.randrange(12, 70))) for i in range(12)] + [(20, "Tiny"), (21, ""), (22, None), (23, "?!"), (24, prose(4)), (5, "again " + prose(20))]
    docs = [(i, prose(rng.randrange(5, 150))) for i in range(20)]
    for i, (_, text) in enumerate(items[:12] * 4):
        edits = [0, 2, int(0.06 * len(text)), int(0.09 * len(text))][i // 12]
        docs.append((100 + i, prose(rng.randrange(40)) + " " + edited(rng, text, edits) + " " + prose(30)))
    docs += [(200, items[3][1].upper()), (201, items[0][1][: len(items[0][1]) // 3]), (202, None), (203, ""), (204, "a tiny, thing"), (205, items[1][1] * 2)]
    return docs, items


@pytest.mark.parametrize("block", [4 << 20, 200])
def test_planted_passages(spark, planted, block):
    docs, items = planted
    assert found(spark, docs, items, block_bytes=block) == brute(docs, items)


@pytest.mark.parametrize("size", [220, 384])
def test_stretches_at_every_offset(spark, size):
    rng = random.Random(size)
    prose = lambda n: " ".join("".join(rng.choice("etaoinshr") for _ in range(rng.randrange(1, 7))) for _ in range(n))
    item = prose(150)[:size]
    docs = [(at, prose(20) + " " + item[at : at + 160] + " " + prose(20)) for at in range(size - 160 + 1)]
    docs += [(1000 + at, prose(20) + " " + edited(rng, item[at : at + 160], 3) + " " + prose(20)) for at in range(0, size - 160, 7)]
    docs += [(2000 + at, prose(20) + " " + item[at : at + 110] + " " + prose(20)) for at in range(0, size - 110, 7)]
    assert set(found(spark, docs, [(1, item)])) == {d for d, _ in docs if d < 2000}


def test_documents(spark, sf_small):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").limit(60).collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").select("item_id", "text").limit(15).collect()]
    docs.append((-1, "before " + items[2][1].replace(" ", "\n").upper() + " after"))
    assert found(spark, docs, items) == brute(docs, items)


def test_each_document_once(spark):
    docs = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog today"), (1, "other"), (None, None), (3, "")], "doc_id long, text string")
    items = spark.createDataFrame([(9, "The quick brown fox, jumps over the lazy dog!")], "item_id long, text string")
    got = sorted(((r["doc_id"], r["contaminated"], [tuple(m) for m in r["matches"]]) for r in decontaminate(spark, docs, items).collect()), key=repr)
    hit = [(9, 0, 0, 43)]
    assert got == sorted([(1, True, hit), (1, True, hit), (None, False, []), (3, False, [])], key=repr)
    assert decontaminate(spark, docs, items.limit(0)).filter("contaminated").count() == 0
    assert decontaminate(spark, docs.limit(0), items).count() == 0
