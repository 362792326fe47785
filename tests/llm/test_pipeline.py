"""The pipeline's stages against brute force, each on what the one before kept."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from cabmetrics.llm.common import written
from cabmetrics.llm.decontaminate import comparable
from cabmetrics.llm.near_dedup import shingle_set
from cabmetrics.llm.queries import QUERIES, tokenizer_file

CLASHING = ["kept", "component_id", "digest", "rejected", "keep_id", "rep", "key", "ids"]


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    """The smallest documents with odd rows and clashing columns, and their folder."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source")
    leak = spark.read.parquet(f"{sf}/benchmark.parquet").orderBy("item_id").first()["text"]
    prose = docs.filter("lang = 'en' and length(text) > 800").orderBy("doc_id").first()["text"]
    odd = [
        (9001, None, None, None),
        (9002, "", "en", "x"),
        (9003, "42 - 17", None, "x"),
        (9004, prose[:300] + " " + leak.upper() + " " + prose[300:600], "en", None),
        (9005, prose.upper(), "en", "copy"),
        (9006, prose + " end", None, "near copy"),
        (9007, "the and of to in " * 9000, "en", "long"),
        (None, "the and of the in", "en", "no id"),
    ]
    whole = docs.union(spark.createDataFrame(odd, docs.schema)).union(docs.filter("doc_id = 5"))
    return whole.withColumns({c: F.lit(c) for c in CLASHING}), sf


def rows_of(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)


def near_survivors(rows):
    sets = {d: shingle_set((t or "").encode().lower().split(), 5) for d, t in rows if d is not None}
    up = {d: d for d in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = top(a), top(b)
                up[max(x, y)] = min(x, y)
    return [(d, t) for d, t in rows if d is None or top(d) == d]


def test_stages(spark, table):
    docs, sf = table
    stages = dict(pipeline.STAGES)
    assert list(stages) == ["language", "exact_dedup", "near_dedup", "decontamination", "packing"]
    kept = {"": docs}
    for name, stage in list(stages.items())[:-1]:
        out = written(spark, stage(spark, list(kept.values())[-1], sf), "stage")
        assert out.columns == docs.columns
        kept[name] = out
    rows = {name: rows_of(df) for name, df in kept.items()}

    gone = {d for d, _ in rows[""]} - {d for d, _ in rows["language"]}
    assert {9001, 9002, 9003} <= gone and len(gone) <= 3 + 2  # only texts without a language, or nearly

    best = {}
    for d, t in rows["language"]:
        key = "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
        best[key] = max(best.get(key, -1), -1 if d is None else d)
    want = [(d, t) for d, t in rows["language"] if d is None or best["".join(c.lower() if "A" <= c <= "Z" else c for c in t)] == d]
    assert rows["exact_dedup"] == want

    assert rows["near_dedup"] == near_survivors(rows["exact_dedup"])

    items = [comparable(r["text"].encode()) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    leaked = {d for d, t in rows["near_dedup"] if any(x in comparable(t.encode()) for x in items)}
    assert 9004 in leaked and rows["decontamination"] == [(d, t) for d, t in rows["near_dedup"] if d not in leaked]

    pieces = stages["packing"](spark, kept["decontamination"], sf).collect()
    plain = Tokenizer.from_file(tokenizer_file())
    left = rows["decontamination"]
    assert {p["doc_id"] for p in pieces} == {d for d, _ in left}
    for d, t in left:
        if left.count((d, t)) > 1:  # a repeated row is packed as often
            continue
        own = sorted((p for p in pieces if p["doc_id"] == d), key=lambda p: p["start"])
        assert [i for p in own for i in np.frombuffer(p["ids"], "<u4").tolist()] == [*plain.encode(t, add_special_tokens=False).ids, 2]


def test_exact_dedup_decides_by_id_and_text(spark):
    rows = [(1, "one text"), (5, "ONE text"), (1, "a text of its own"), (7, "one more"), (7, "one more"), (3, "One More")]
    rows += [(None, "one text"), (None, "no id"), (9, None), (8, "")]
    docs = spark.createDataFrame([(d, t, 1, 2) for d, t in rows], "doc_id long, text string, dropped_id int, dropped_digest int")
    out = dict(pipeline.STAGES)["exact_dedup"](spark, docs, "")
    assert out.columns == docs.columns
    assert rows_of(out) == sorted([(5, "ONE text"), (1, "a text of its own"), (7, "one more"), (7, "one more"), (None, "no id"), (9, None)], key=repr)


@pytest.fixture(scope="module")
def prose(spark):
    """Two unlike English texts, and a benchmark item."""
    sf = "/root/testdata/sf0.001"
    texts = spark.read.parquet(f"{sf}/documents.parquet").filter("lang = 'en' and length(text) > 800").orderBy("doc_id").limit(2).collect()
    return [r["text"] for r in texts], spark.read.parquet(f"{sf}/benchmark.parquet").orderBy("item_id").first()["text"], sf


def test_language_decides_by_id_and_text(spark, prose):
    (one, two), _, sf = prose
    learned = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    odd = [(9001, "42 - 17", None), (9001, one + " x", None), (None, "42 - 17", None), (None, two + " x", None), (9002, None, None), (9002, two + " y", None)]
    out = dict(pipeline.STAGES)["language"](spark, learned.union(spark.createDataFrame(odd, learned.schema)), sf)
    got = [r for r in rows_of(out) if r[0] is None or r[0] > 9000]
    assert got == sorted([(9001, one + " x"), (None, two + " x"), (9002, two + " y")], key=repr)


def test_near_dedup_decides_by_id_and_text(spark, prose):
    (one, two), _, sf = prose
    rows = [(1, one), (7, one + " end"), (7, two), (None, one + " more"), (None, "no copy of anything at all"), (8, two + " end"), (8, two + " end"), (9, None)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, number int")
    out = dict(pipeline.STAGES)["near_dedup"](spark, docs, sf)
    assert out.columns == docs.columns
    assert rows_of(out) == sorted([(1, one), (7, two), (None, "no copy of anything at all"), (9, None)], key=repr)


def test_decontamination_decides_by_id_and_text(spark, prose):
    (one, two), leak, sf = prose
    rows = [(1, one + " " + leak), (1, one), (None, two + " " + leak), (None, two), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = dict(pipeline.STAGES)["decontamination"](spark, docs, sf)
    assert rows_of(out) == sorted([(1, one), (None, two), (2, None)], key=repr)


def test_run_equals_the_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in pipeline.STAGES:
        docs = written(spark, stage(spark, docs, sf), "stage")
    pick = ["doc_id", "start", "length", "ids"]
    key = lambda r: (r["doc_id"], r["start"])
    assert [r["ids"] for r in sorted(pipeline.run(spark, sf).select(*pick).collect(), key=key)] and sum(
        r["length"] for r in pipeline.run(spark, sf).select("length").collect()
    ) == sum(r["length"] for r in docs.select("length").collect())


def test_empty_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in pipeline.STAGES:
        docs = written(spark, stage(spark, docs, sf), "stage")
        assert docs.count() == 0


def test_registered():
    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in QUERIES) for i in range(1, 11))
    assert set(QUERIES) <= set(names)


@pytest.mark.parametrize("name", ["op4_chat_format", "op6_exact_dedup"])
def test_sql_twins(spark, name):
    import duckdb

    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    df = QUERIES[name](spark, sf)
    want = con.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in want.description]
    assert sorted(cols) == sorted(df.columns)
    assert sorted(tuple(r) for r in df.select(*cols).collect()) == sorted(want.fetchall())


def test_without_labels_the_language_stage_keeps_everything(spark, table):
    docs, sf = table
    some = docs.filter("doc_id < 20 or doc_id is null").withColumn("lang", F.lit(None).cast("string"))
    assert rows_of(pipeline.language(spark, some, sf)) == rows_of(some)
    nothing = docs.limit(0)
    assert pipeline.language(spark, nothing, sf).columns == docs.columns and pipeline.language(spark, nothing, sf).count() == 0
