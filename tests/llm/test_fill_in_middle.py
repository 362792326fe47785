import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from cabmetrics.llm import fill_in_middle as fim
from cabmetrics.llm.queries import op13_fill_in_middle
from cabmetrics.llm.fill_in_middle import Units, WaveletMatrix, cuts, fill_in_middle, restored

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.DOTALL)


def plain_answer(doc_id, text, seed=1, plain=10, spm=20):
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 100 - plain:
        return doc_id, n, "plain", None, None, text
    if h[3] % 100 < spm:
        return doc_id, n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return doc_id, n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def odd_texts(number, seed=3):
    rng = random.Random(seed)
    letters = ["a", "Z", "bc", " ", "\n", "\r\n", "é", "ß", "漢", "😀", "é", "_", "0", "<", "<S", ">", "@", "[", "`", "{", "\x00", " "]
    return ["".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 2, 5, 40, 400]))) for _ in range(number)]


def test_ranks_are_counts():
    rng = np.random.default_rng(5)
    for size in (0, 1, 63, 64, 65, 1000):
        symbols = rng.integers(0, 4, size).astype(np.uint8)
        matrix, places = WaveletMatrix(symbols, 2), np.arange(size + 1)
        for symbol in range(4):
            assert matrix.rank(symbol, places).tolist() == [int((symbols[:p] == symbol).sum()) for p in places]


def test_places_after_units():
    texts = [t.encode() for t in odd_texts(60)]
    ends = np.cumsum([len(t) for t in texts])
    starts = ends - [len(t) for t in texts]
    units = Units(np.frombuffer(b"".join(texts), np.uint8), starts, ends)
    found = [[m.group().encode() for m in UNIT.finditer(t.decode())] for t in texts]
    assert units.counts().tolist() == [len(f) for f in found]
    for k in (0, 1, 3, 17):
        number = np.minimum(units.counts(), k)
        assert (units.after(number) - starts).tolist() == [sum(map(len, f[:k])) for f in found]


def test_blocks_cut_like_one(monkeypatch):
    texts = pa.array([t.encode() for t in odd_texts(200, seed=9)], pa.binary())
    numbers = pa.array(range(100, 300)), pa.array(range(7000, 9000, 10))
    whole = cuts(texts, *numbers).to_pylist()
    monkeypatch.setattr(fim, "BLOCK_BYTES", 300)
    assert cuts(texts, *numbers).to_pylist() == whole
    assert cuts(texts.slice(50, 20), *(n.slice(50, 20) for n in numbers)).to_pylist() == whole[50:70]


def test_equals_plain_cutting_and_restores(spark):
    texts = odd_texts(300) + [None, "", "<M>", "a <P> b", "x" * 300_000, "x y" * 100_000, "é" * 50_000, "one", "same", "same"]
    rows = [(i, t, f"n{i}", "form", 1) for i, t in enumerate(texts)] + [(None, "no id here", "a", "b", 2), (7, "a repeated id", "a", "b", 3), (7, "a repeated id", "a", "b", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n string, form string, cut int")
    found = fill_in_middle(docs).withColumn("back", restored(F.col("output"), F.col("form"))).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[-1])
    assert sorted((tuple(r)[:6] for r in found), key=key) == sorted((plain_answer(r[0], r[1]) for r in rows), key=key)
    texts_of = {(r[0], r[1] or "") for r in rows}
    assert {(r["doc_id"], r["back"]) for r in found} == texts_of
    assert {r["form"] for r in found} == {"plain", "psm", "spm"}


def test_other_shares_and_ids(spark):
    rows = [(f"id-{i}", t) for i, t in enumerate(odd_texts(80, seed=4))]
    docs = spark.createDataFrame(rows, "name string, body string")
    found = fill_in_middle(docs, seed=8, plain_percent=0, suffix_first_percent=50, id_col="name", text_col="body").collect()
    assert sorted(map(tuple, found)) == sorted(plain_answer(*r, seed=8, plain=0, spm=50) for r in rows)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert fill_in_middle(docs).collect() == []


def test_query_returns_every_document(spark, sf_small):
    found = op13_fill_in_middle(spark, sf_small).collect()
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    assert len(found) == len(docs)
    for r in found:
        want = plain_answer(r["doc_id"], docs[r["doc_id"]])
        assert tuple(r)[:5] == want[:5]
        assert r["output_sha256"] == hashlib.sha256(want[5].encode()).hexdigest()
        assert r["restored_sha256"] == hashlib.sha256(docs[r["doc_id"]].encode()).hexdigest()


def test_no_queue_of_whole_texts_waits_for_the_cuts(spark):
    docs = spark.createDataFrame([(1, "ab cd")], "doc_id long, text string")
    plan = fill_in_middle(docs)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "EvalPython" not in plan
