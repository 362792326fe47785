"""Packing against whole-text tokenising: every id in exactly one place, no padding."""

import numpy as np
import pytest
from tokenizers import Tokenizer

from cabmetrics.llm.packing import WordEncoder, capacities, pack_documents, plan_group
from cabmetrics.llm.queries import tokenizer_file

ODD = [
    None,
    "",
    "   \n\t ",
    "It's it's don't., can't, \"foo\"., a.,b e.g., é́a ΣΑΣ x y <|endoftext|>. a<|startoftext|>b ..,,",
    "<|ENDOFTEXT|> A <|endoftext|> B.",
    "漢字, 日本。 ½. ²., 1., 12.,",
    "x" * 20_000,
    "word " * 9_000,
]


def expected(texts):
    plain = Tokenizer.from_file(tokenizer_file())
    return [[*e.ids, 2] for e in plain.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def check(pieces, ids):
    for doc, want in enumerate(ids):
        own = sorted((p for p in pieces if p["doc_id"] == doc), key=lambda p: p["start"])
        assert [i for p in own for i in np.frombuffer(p["ids"], "<u4").tolist()] == want
        assert [p["start"] for p in own] == [0, *np.cumsum([p["length"] for p in own])[:-1]]
        assert {p["doc_tokens"] for p in own} == {len(want)}
    sequences = {}
    for p in pieces:
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096 and at & (at - 1) == 0  # full, or a power of two


def test_every_id_once(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    rows = docs.select("text").limit(60).collect()
    texts = [r["text"] for r in rows] + ODD
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, ids string, offset int")
    check([r.asDict() for r in pack_documents(df, tokenizer_file()).collect()], expected(texts))


def test_small_groups_and_repeated_rows(spark):
    df = spark.createDataFrame([(0, "one two three " * 700)] * 3 + [(None, "lost")], "doc_id long, text string").coalesce(1)
    pieces = pack_documents(df, tokenizer_file(), group_tokens=1000).collect()
    assert sum(p["length"] for p in pieces if p["doc_id"] == 0) == 3 * 2101
    assert [p["length"] for p in pieces if p["doc_id"] is None] == [2]
    assert pack_documents(df.limit(0), tokenizer_file()).count() == 0


def plain_plan(lengths, max_tokens, linear, quadratic):
    """The placement rule as a loop over lists."""
    room = capacities(sum(lengths), max_tokens).tolist()
    size, cost, pieces = list(room), [0.0] * len(room), []
    waiting = []
    for doc, n in enumerate(lengths):
        waiting += [(max_tokens, doc, start) for start in range(0, n - n % max_tokens, max_tokens)]
        waiting += [(n % max_tokens, doc, n - n % max_tokens)] if n % max_tokens else []
    for left, doc, start in sorted(waiting, key=lambda w: (-w[0], w[1], w[2])):
        while left:
            fits = [k for k in range(len(room)) if room[k] >= left] or [k for k in range(len(room)) if room[k]]
            at = min(fits, key=lambda k: (cost[k], k))
            take = min(left, room[at])
            pieces.append((doc, start, take, at, size[at] - room[at]))
            room[at] -= take
            cost[at] += linear * take + quadratic * take * take
            start, left = start + take, left - take
    return pieces


def test_plan_follows_the_cost():
    rng = np.random.default_rng(7)
    for number in (1, 2, 9, 60):
        lengths = np.concatenate([rng.integers(1, 300, number), rng.integers(1, 9000, number), [1, 4096, 8192, 4097]])
        pieces = plan_group(lengths, 4096, 1.0, 1 / 6144)
        assert pieces == plain_plan(lengths.tolist(), 4096, 1.0, 1 / 6144)
        assert sum(p[2] for p in pieces) == lengths.sum()


def test_words_with_closing_runs():
    rng = np.random.default_rng(11)
    letters, ends = list("abzAZéßñÖİŉſΣ漢ǅ") + ["ci\u0301", "\u0301", "ﬁ", "'s", "'", "<|", "|>", "-", "9"], list(".,;:!?#$%&*") + ["'", "(", "\u0338", "。"]
    encoder = WordEncoder(tokenizer_file(), limit=200)
    texts = [" ".join("".join(rng.choice(letters, rng.integers(0, 5))) + "".join(rng.choice(ends, rng.integers(0, 4))) for _ in range(12)) for _ in range(1500)]
    for at in range(0, len(texts), 100):
        some = texts[at : at + 100]
        got = encoder.texts([t.encode() for t in some])
        assert [[*np.frombuffer(x, "<u4").tolist(), 2] for x in got] == expected(some)


@pytest.mark.parametrize("text", [t for t in ODD if t])
def test_encoder_forgets(text):
    encoder = WordEncoder(tokenizer_file(), limit=1)
    for _ in range(2):
        assert np.frombuffer(encoder.texts([text.encode()])[0], "<u4").tolist() == expected([text])[0][:-1]


def test_ascii_words_are_told_apart_without_decoding_them(monkeypatch):
    from cabmetrics.llm import packing

    seen = []
    monkeypatch.setattr(packing, "_latin", lambda stem, latin=packing._latin: seen.append(stem) or latin(stem))
    text = b"plain closed. closed! \xc3\xa9t\xc3\xa9 \xc3\xa9t\xc3\xa9, it's don't. 3rd, ... \xce\xb1\xce\xb2. bad\xff bad\xff, \xff."
    encoder = packing.WordEncoder(tokenizer_file())
    coded = np.frombuffer(encoder.texts([text])[0], "<u4").tolist()
    assert coded == encoder.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids
    assert seen and not {"plain", "closed"} & set(seen)
