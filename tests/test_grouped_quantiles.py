import math
import random

import pytest
from pyspark.sql import functions as F

from cabmetrics.operators import grouped_quantiles as GQ


def exact(values, p):
    h = (len(values) - 1) * p
    lo = math.floor(h)
    hi = min(lo + 1, len(values) - 1)
    return values[lo] + (h - lo) * (values[hi] - values[lo])


def rows_of(sizes, seed=1):
    rng = random.Random(seed)
    draw = {"flat": lambda: rng.uniform(-5, 5), "tied": lambda: float(rng.randint(0, 3)), "long": lambda: math.exp(rng.gauss(0, 3))}
    return [(g, k, draw[k]()) for g, n in sizes.items() for k in draw for _ in range(n)]


@pytest.mark.parametrize("few", [10_000, 0])
def test_quantiles_of_every_group(spark, monkeypatch, few):
    monkeypatch.setattr(GQ, "FEW_GROUPS", few)
    rows = rows_of({"a": 5000, "b": 1, "c": 2, "d": 400, None: 37})
    rows += [("e", "none", None), ("a", "flat", None), ("a", "flat", float("nan")), ("f", "ends", float("inf")), ("f", "ends", -1.0)]
    df = spark.createDataFrame(rows, "g string, k string, x double")
    probs = (0.0, 0.25, 0.5, 0.999, 1.0)
    found = {(r["g"], r["k"]): r for r in GQ.grouped_quantiles(df, ["g", "k"], "x", probs, digits=None).collect()}
    groups = {}
    for g, k, x in rows:
        groups.setdefault((g, k), [])
        if x is not None and not math.isnan(x):
            groups[g, k].append(x)
    assert found.keys() == groups.keys()
    for key, values in groups.items():
        values.sort()
        assert found[key]["n"] == len(values)
        got = [found[key][GQ.quantile_name(p)] for p in probs]
        if not values:
            assert got == [None] * len(probs)
        elif key != ("f", "ends"):
            assert got == pytest.approx([exact(values, p) for p in probs], rel=1e-12, abs=1e-12)
        else:
            assert got[0] == -1.0 and got[-1] == math.inf


def test_a_bracket_that_misses_is_widened(spark, monkeypatch):
    rows = [("a", float(i)) for i in range(3000)] + [("b", float(i % 7)) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, x double")
    # a very small sketch and no margin: many brackets miss their rank
    monkeypatch.setattr(GQ.math, "ceil", lambda v: 0)
    found = GQ.order_statistics(df, ["g"], "x", {"v": F.floor(F.col("n") * 0.37)}, k=8).collect()
    assert {r["g"]: r["v"] for r in found} == {"a": 1110.0, "b": float(sorted(i % 7 for i in range(500))[185])}


def test_ranks_outside_a_group_and_empty_tables(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0)], "g string, x double")
    found = GQ.order_statistics(df, ["g"], "x", {"first": F.lit(0), "beyond": F.col("n"), "before": F.lit(-1)}).collect()
    assert [tuple(r) for r in found] == [("a", 2, 1.0, None, None)]
    assert GQ.order_statistics(df.limit(0), ["g"], "x", {"first": F.lit(0)}).collect() == []


def test_conformal_widths_and_their_coverage(spark):
    rng = random.Random(8)
    noise = {"near": 1.0, "far": 6.0}
    made = [(i, band, 20 + rng.gauss(0, noise[band]), 20.0, i % 2) for i in range(6000) for band in noise] + [(-1, "rare", 3.0, 2.0, 0), (-2, "rare", 9.0, 2.0, 1), (-3, "unseen", 9.0, 2.0, 1)]
    df = spark.createDataFrame(made, "id long, band string, label double, prediction double, side int")
    widths = GQ.conformal_widths(df.filter("side = 0"), ["band"], coverage=0.9)
    got = {r["band"]: r for r in widths.collect()}
    for band in noise:
        errors = sorted(abs(y - p) for _, b, y, p, side in made if b == band and side == 0)
        assert got[band]["half_width"] == errors[math.ceil((len(errors) + 1) * 0.9) - 1]
    assert got["rare"]["half_width"] is None  # one row cannot give a 90 % interval
    report = {r["band"]: r for r in GQ.interval_report(df.filter("side = 1"), widths, ["band"]).collect()}
    assert all(0.88 < report[b]["coverage"] < 0.92 for b in noise)
    assert (report["rare"]["n_calibration"], report["rare"]["n_covered"], report["unseen"]["n_calibration"]) == (1, 0, 0)
    ends = GQ.with_intervals(df.filter("id = 1 and band = 'far'"), widths, ["band"]).first()
    assert ends["high"] == 20 + got["far"]["half_width"] and ends["low"] == max(0.0, 20 - got["far"]["half_width"])
