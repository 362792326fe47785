import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from cabmetrics.llm import merkle_manifest as mm
from cabmetrics.llm.merkle_manifest import field_digest, folded, hex_text, manifest, siblings_digest
from cabmetrics.llm.queries import op11_merkle_manifest

KIND = "doc_id long, source string, lang string, n_chars long, text string, tree string, place int, payload string, path int"


def h(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def leaf_of(row, more=0):
    doc_id, source, lang, n_chars, text = row[:5]
    if n_chars is not None:
        n_chars += more
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def plain_tree(leaves):
    """Root, and the (side, sibling) steps of each leaf, by lists."""
    steps = [[] for _ in leaves]
    members, row = [[i] for i in range(len(leaves))], list(leaves)
    while len(row) > 1:
        nodes, groups = [], []
        for k in range(0, len(row), 2):
            pair = row[k : k + 2]
            for side, group in enumerate(members[k : k + 2]):
                for i in group:
                    steps[i].append((side, pair[1 - side] if len(pair) == 2 else None))
            nodes.append(h(*pair))
            groups.append(sum(members[k : k + 2], []))
        row, members = nodes, groups
    return row[0] if row else None, steps


def climb(leaf, steps):
    for side, sibling in steps:
        leaf = h(leaf) if sibling is None else h(sibling, leaf) if side else h(leaf, sibling)
    return leaf


def plain_answers(rows):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    of_lang, subroots = [], []
    for lang in langs:
        own = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        subroot, steps = plain_tree([leaf_of(r) for r in own])
        of_lang.append((own, steps))
        subroots.append(subroot)
    root, over = plain_tree(subroots)
    out = []
    for (own, steps), subroot, upper in zip(of_lang, subroots, over, strict=True):
        for row, path in zip(own, steps, strict=True):
            path = path + upper
            more = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            reached = climb(leaf_of(row, more), path)
            out.append((row[0], leaf_of(row), subroot, root, h(*(s for _, s in path if s)), reached, reached == root))
    return sorted(out, key=repr)


def answers(spark, rows):
    docs = spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], KIND)
    more = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0) & F.col("n_chars").isNotNull()
    now = F.when(more, field_digest(docs["doc_id"], docs["source"], docs["lang"], docs["n_chars"] + 1, docs["text"]))
    found = manifest(spark, docs, carried={"now": now}).withColumn("reached", folded(F.coalesce("now", "leaf"), F.col("path")))
    root = hex_text(F.col("root"))
    found = found.select("doc_id", hex_text(F.col("leaf")), hex_text(F.col("subroot")), root, siblings_digest(F.col("path")), "reached", F.col("reached") == root)
    return sorted((tuple(r) for r in found.collect()), key=repr)


def rows_of(number, seed=1, langs=("en", "de", None, "é", "zz")):
    rng = random.Random(seed)
    rows = [(i, rng.choice([None, "web", "bücher"]), rng.choice(langs) if i % 3 else "en", rng.choice([None, 5, 70]), rng.choice([None, "", "Text ü 漢", "y" * 5000])) for i in range(number)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("number", [1, 3, 40])
def test_equals_lists(spark, number):
    rows = rows_of(number, seed=number)
    assert answers(spark, rows) == plain_answers(rows)


def test_a_single_group(spark):
    rows = [(i, None, "en", 1, f"t{i}") for i in range(5)]
    assert answers(spark, rows) == plain_answers(rows)


def test_many_small_blocks_and_joins_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(mm, "BLOCK_BITS", 2)
    monkeypatch.setattr(mm, "FEW_NODES", 3)
    rows = rows_of(150, seed=7) + [(1000 + i, "s", f"lang{i:02}", 1, "one") for i in range(9)]
    assert answers(spark, rows) == plain_answers(rows)


def test_null_and_repeated_ids_and_rows(spark):
    rows = rows_of(20, seed=5) + [(None, None, None, None, None), (None, "a", "en", 1, "b"), (3, "a", "en", 1, "b"), (3, "a", "en", 1, "b"), (3, "a", "de", 1, "b")]
    assert answers(spark, rows) == plain_answers(rows)


def test_many_equal_rows_are_cut_into_parts(spark):
    rows = [(7, "s", "en", 3, "same")] * 3000 + rows_of(50, seed=6)
    assert answers(spark, rows) == plain_answers(rows)


def test_empty_table(spark):
    assert answers(spark, []) == []


def test_other_group_and_order(spark):
    docs = spark.createDataFrame([("b", 1, "x"), ("a", 1, "y"), ("c", 2, "z")], "name string, shard int, body string")
    found = manifest(spark, docs, fields=("name", "body"), group="shard", order="name").select("name", hex_text(F.col("root")), folded(F.col("leaf"), F.col("path"))).collect()
    leaf = {n: h(f"1:{n}", f"1:{b}") for n, b in (("a", "y"), ("b", "x"), ("c", "z"))}
    root = h(h(leaf["a"], leaf["b"]), leaf["c"])
    assert sorted(tuple(r) for r in found) == [(n, root, root) for n in "abc"]


def test_query_over_the_table(spark, sf_small):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    found = sorted((tuple(r) for r in op11_merkle_manifest(spark, sf_small).collect()), key=repr)
    assert found == plain_answers(rows)
    assert {r[6] for r in found} == {True, False}
