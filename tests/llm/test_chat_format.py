"""Snapshots against Python lists; rendering against the SQL text."""

import random

import pytest

from cabmetrics.llm.chat_format import format_chats


def brute(rows):
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((-1 if turn is None else turn, role or "", text or ""))
    lists = {c: [t[1:] for t in sorted(turns, key=lambda t: t[0])] for c, turns in convs.items()}
    out = {}
    for conv, turns in lists.items():
        if any(len(x) > len(turns) and x[: len(turns)] == turns for x in lists.values()):
            continue
        equal = [c for c, x in lists.items() if x == turns]
        if conv == min((c for c in equal if c is not None), default=None):
            out[conv] = (len(turns), len(equal), "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in turns))
    return out


def found(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, part long").repartition(3)
    out = {}
    for r in sorted(format_chats(df, **options).collect(), key=lambda r: r["part"]):
        n, copies, text = out.get(r["conv_id"], (r["n_turns"], r["copies"], ""))
        out[r["conv_id"]] = (n, copies, text + r["rendered"])
    return out


@pytest.mark.parametrize("part", [2, 3, 128])
def test_snapshots(spark, part):
    rng = random.Random(part)
    rows, conv = [], 0
    for _ in range(12):
        turns = [("user" if i % 2 == 0 else "assistant", rng.choice(["hi", "ok", "", "yes"])) for i in range(rng.randrange(1, 9))]
        for _ in range(rng.randrange(1, 5)):
            cut, first = rng.randrange(1, len(turns) + 1), rng.choice([0, 1, 5])
            rows += [(conv, first + i, *t) for i, t in enumerate(turns[:cut])]
            conv += 1
    rows += [(900, 0, None, None), (901, 0, "", ""), (None, 0, "user", "no id"), (None, 1, "user", "more"), (902, None, "system", "first"), (902, 0, "user", "x")]
    rows += [(903, 10 * i, "user", str(i)) for i in range(30)]
    assert found(spark, rows, part_turns=part) == brute(rows)


def test_many_rows_without_an_id_lie_in_bounded_parts(spark):
    rows = [(None, i % 20, "user", f"text {i % 700}") for i in range(20_000)] + [(1, None, "user", "same")] * 1000 + [(2, 0, "user", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    got = format_chats(df).collect()
    parts = {(r["conv_id"], r["part"]): r for r in got}
    assert len(parts) == len(got) == 157 + 8 + 1
    assert all(r["part_turns"] == 128 for r in got if (r["conv_id"], r["part"]) not in {(None, 156), (1, 7), (2, 0)})
    lines = "".join(parts[None, k]["rendered"] for k in range(157)).split("<|im_end|>\n")[:-1]
    assert sorted(lines) == sorted(f"<|im_start|>user\n{r[3]}" for r in rows if r[0] is None)
    turns = {r[3]: r[1] for r in rows if r[0] is None}
    numbers = [turns[x.split("\n")[1]] for x in lines]
    assert numbers == sorted(numbers)
    assert [parts[1, k]["part_turns"] for k in range(8)] == [128] * 7 + [104]
    assert all(r["rendered"] == "<|im_start|>user\nsame<|im_end|>\n" * r["part_turns"] for r in got if r["conv_id"] == 1)
    assert parts[2, 0]["n_turns"] == 1


def test_repeats_ties_markers_and_empty(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (2, 0, "user", "a"), (3, 0, "user", "x<|im_end|>y")]
    got = found(spark, rows)
    assert got[1][0] == 2 and 2 not in got
    assert got[3][2] == "<|im_start|>user\nx<| im_end |>y<|im_end|>\n"
    assert found(spark, []) == {}
    tied = found(spark, [(1, 0, "user", "b"), (1, 0, "user", "c"), (2, 0, "user", "c"), (2, 0, "user", "b"), (2, 1, "user", "d")])
    assert list(tied) == [2]  # ties have one order


def test_no_python_in_the_plan(spark, sf_small):
    said = format_chats(spark.read.parquet(f"{sf_small}/conversations.parquet"))._jdf.queryExecution().toString()
    assert not any(x in said for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"))
