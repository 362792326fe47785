import random

import numpy as np
import pytest
import xxhash

from cabmetrics.llm import simhash
from cabmetrics.llm.queries import op12_simhash
from cabmetrics.llm.simhash import Golay, bucket_keys, fingerprint, links_within, simhash_duplicates

KIND = "doc_id long, text string, fingerprint string, held int, key string"


def plain_print(text, words=3):
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    shingles = [b" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """Smallest reachable fingerprint of each, by all pairs."""
    values = np.array(sorted(set(prints)), np.uint64)
    up = list(range(len(values)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(values)):
        for j in (i + 1 + np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= 3)).tolist():
            a, b = top(i), top(j)
            up[max(a, b)] = min(a, b)
    return {int(v): int(values[top(i)]) for i, v in enumerate(values)}


def plain_answers(rows):
    prints = [plain_print(t) for _, t in rows]
    reached = plain_components(prints)
    least = {}
    for (i, _), f in zip(rows, prints, strict=True):
        if i is not None:
            least[reached[f]] = min(i, least.get(reached[f], i))
    return sorted(((i, f, least.get(reached[f])) for (i, _), f in zip(rows, prints, strict=True)), key=repr)


def answers(spark, rows):
    docs = spark.createDataFrame([(*r, "a", 1, "b") for r in rows], KIND)
    return sorted(((r["doc_id"], r["fingerprint"] & (2**64 - 1), r["component_id"]) for r in simhash_duplicates(spark, docs).collect()), key=repr)


@pytest.fixture(scope="module")
def code():
    return Golay()


def test_the_code_is_perfect(code):
    assert code.nearest.min() == 0 and len(np.unique(code.codewords)) == 4096
    assert np.bincount(np.bitwise_count(code.codewords), minlength=24)[[0, 7, 8, 11, 12, 15, 16, 23]].tolist() == [1, 253, 506, 1288, 1288, 506, 253, 1]
    words = np.random.default_rng(1).integers(0, 1 << 23, 2000)
    away = np.bitwise_count(code.codewords[code.nearest[words]] ^ words)
    assert (away == code.off[words]).all() and away.max() <= 3


def test_words_one_bit_apart_share_a_key(code):
    words = np.random.default_rng(2).integers(0, 1 << 23, 500)
    keys, held = code.keys(words)
    for bit in range(23):
        near_keys, near_held = code.keys(words ^ (1 << bit))
        for i in range(len(words)):
            assert set(keys[i][held[i]]) & set(near_keys[i][near_held[i]])


def test_every_near_pair_has_a_bucket(code):
    rng = random.Random(3)
    values = np.array([rng.getrandbits(64) for _ in range(3000)], np.uint64)
    others = values.copy()
    for i in range(len(values)):
        for bit in rng.sample(range(64), rng.randint(0, 3)):
            others[i] ^= np.uint64(1 << bit)

    def buckets(prints):
        met = [{} for _ in prints]
        for row, key, side in zip(*(x.tolist() for x in bucket_keys(prints, code)), strict=True):
            met[row][key] = side
        return met

    for a, b in zip(buckets(values), buckets(others), strict=True):
        assert any(a[k] == b[k] == 2 or a[k] + b[k] == 1 for k in a.keys() & b.keys())


def test_fingerprints_of_odd_texts():
    texts = ["", " \t\n", "one", "One TWO", "a b c", "a b c a b c a b c", "É é ß", "x\x0by\x0cz", "\x1fa \x85b", "w " * 70_000, "tail" * 50_000]
    assert [fingerprint(t.encode(), 3) for t in texts] == [plain_print(t) for t in texts]


def test_links_join_what_all_pairs_join():
    rng = random.Random(4)
    centre = [rng.getrandbits(64) for _ in range(5)]
    values = np.unique(np.array([c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for c in centre for _ in range(60)], np.uint64))
    assert len(values) > 200
    links = links_within(values, 0, True)
    want = plain_components(values.tolist())
    assert len(links) == len(values) - len(set(want.values()))
    assert all(want[a] == want[b] for a, b in links)


def varied(number, seed=5):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows = []
    while len(rows) < number:
        text = [rng.choice(words) for _ in range(rng.choice([40, 120, 300]))]
        for _ in range(rng.choice([1, 1, 4, 12])):
            own = list(text)
            for _ in range(rng.choice([0, 1, 1, 2])):
                own[rng.randrange(len(own))] = rng.choice(words)
            rows.append((len(rows), " ".join(own)))
    return rows


def test_equals_all_pairs(spark):
    rows = varied(400)
    rows += [(1000, None), (999, ""), (1001, "  "), (None, rows[3][1]), (None, "alone without an id"), (2, rows[2][1]), (2, rows[2][1]), (2, "another text"), (1002, "two words"), (1003, "z " * 30_000)]
    assert answers(spark, rows) == plain_answers(rows)


def test_large_buckets_are_dealt_to_blocks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 3)
    rows = varied(120, seed=6)
    assert answers(spark, rows) == plain_answers(rows)


def test_empty_table(spark):
    assert answers(spark, []) == []


def test_query_over_the_table(spark, sf_small):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    found = sorted(((r["doc_id"], int(r["fingerprint"], 16), r["component_id"]) for r in op12_simhash(spark, sf_small).collect()), key=repr)
    assert found == plain_answers(rows)
    assert all(len(r["fingerprint"]) == 16 for r in op12_simhash(spark, sf_small).take(3))
