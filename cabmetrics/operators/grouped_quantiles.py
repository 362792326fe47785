"""Exact order statistics of every group at once, and intervals made from them.

Spark's exact ``percentile`` keeps all distinct values of a group in one
buffer. Here all groups are narrowed together, without a job per group:

1. one grouped aggregate takes each group's count and a sketch, which gives
   two values around every wanted rank; these brackets are a small table, one
   row a group;
2. the rows meet their group's brackets; one aggregate with map-side counts
   says how many values lie below each bracket, another one counts the equal
   values inside it (about one in 180 of the rows for each rank);
3. the values of a bracket in order, with a running count, give the value that
   covers the rank.

A hot group costs nothing extra in 1 and 2, and in 3 one task sorts only its
bracket's different values. The sketch's bound is checked: a rank that its
bracket does not hold is looked for again in the whole range of its group.
Interpolation is the linear rule of pandas, ``quantile_cont`` and ``percentile``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import nan_to_null

#: Steps of the fractions at which a sketch is read.
GRID = 2000
#: Groups up to this number are sent to every task as brackets (a few hundred bytes each).
FEW_GROUPS = 10_000


def _small(table: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(table) if rows <= FEW_GROUPS else table


def _same_group(left: Sequence[str], right: Sequence[str]) -> Column:
    cond = F.lit(True)
    for a, b in zip(left, right, strict=True):
        cond = cond & F.col(a).eqNullSafe(F.col(b))
    return cond


def order_statistics(df: DataFrame, groups: Sequence[str], value: str, ranks: dict[str, Column], k: int = 4096) -> DataFrame:
    """(groups, n, one column per name): the values at the 0-based ``ranks`` of each group.

    A rank is an expression of ``n``, the group's number of values that are
    not null or NaN; a rank outside 0 .. n-1, or null, gives null. A group
    without values has n = 0; null groups are groups.
    """
    names, keys = list(ranks), [f"g{i}" for i in range(len(groups))]
    rows = df.select(*(F.col(g).alias(k) for g, k in zip(groups, keys, strict=True)), nan_to_null(F.col(value).cast("double")).alias("x"))
    counted = rows.groupBy(*keys).agg(F.count("x").alias("n"), F.kll_sketch_agg_double("x", F.lit(k)).alias("sketch"), F.min("x").alias("least"), F.max("x").alias("most"))
    # the sketch is read at fixed fractions only: a rank's bracket is the steps around it, and the sketch's error (about half of ``margin``)
    margin = math.ceil(4 / k**0.9 * GRID)
    grid = F.kll_sketch_get_quantile_double("sketch", F.array(*(F.lit(i / GRID) for i in range(GRID + 1))))
    counted = counted.select(*keys, "n", F.when(F.col("n") > 0, grid).alias("grid"), "least", "most", *(ranks[r].cast("long").alias(f"rank{i}") for i, r in enumerate(names)))

    def bracket(i: int) -> list[Column]:
        at = F.col(f"rank{i}") / F.greatest(F.col("n") - 1, F.lit(1)) * GRID
        low, high = F.floor(at).cast("int") - margin + 1, F.ceil(at).cast("int") + margin + 1  # 1-based
        a = F.when(low < 1, F.col("least")).otherwise(F.try_element_at("grid", F.greatest(low, F.lit(1))))
        b = F.when(high > GRID + 1, F.col("most")).otherwise(F.try_element_at("grid", F.least(high, F.lit(GRID + 1))))
        wanted = F.col(f"rank{i}").between(0, F.col("n") - 1)
        return [F.when(wanted, a).alias(f"a{i}"), F.when(wanted, b).alias(f"b{i}")]

    return _resolved(rows, counted.select("*", *(c for i in range(len(names)) for c in bracket(i))), keys, names, groups)


def _resolved(rows: DataFrame, brackets: DataFrame, keys: list[str], names: list[str], groups: Sequence[str]) -> DataFrame:
    many = range(len(names))
    brackets = brackets.select(*keys, "n", "least", "most", *(f"{c}{i}" for i in many for c in ("rank", "a", "b"))).persist()
    found = brackets.count()
    of = [f"of_{k}" for k in keys]
    sent = _small(brackets.select(*(F.col(k).alias(o) for k, o in zip(keys, of, strict=True)), *(f"{c}{i}" for i in many for c in ("a", "b"))), found)
    met = rows.filter("x is not null").join(sent, _same_group(keys, of))
    below = met.groupBy(*keys).agg(*(F.count_if(F.col("x") < F.col(f"a{i}")).alias(f"below{i}") for i in many), *(F.count_if(F.col("x") <= F.col(f"b{i}")).alias(f"upto{i}") for i in many))
    inside = met.select(*keys, "x", F.explode(F.filter(F.array(*(F.when(F.col("x").between(F.col(f"a{i}"), F.col(f"b{i}")), F.lit(i)) for i in many)), lambda i: i.isNotNull())).alias("i"))
    inside = inside.groupBy(*keys, "i", "x").agg(F.count(F.lit(1)).alias("held"))
    running = Window.partitionBy(*keys, "i").orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = inside.withColumn("upto", F.sum("held").over(running))
    left = [f"l_{k}" for k in keys]
    asked = brackets.join(below.select(*(F.col(k).alias(o) for k, o in zip(keys, left, strict=True)), *(f"{c}{i}" for i in many for c in ("below", "upto"))), _same_group(keys, left), "left")
    # a bracket that misses its rank (beyond the sketch's bound) is replaced by the group's whole range
    holds = [(F.col(f"below{i}") <= F.col(f"rank{i}")) & (F.col(f"rank{i}") < F.col(f"upto{i}")) for i in many]
    wrong = asked.filter(~F.coalesce(_all([F.col(f"a{i}").isNull() | holds[i] for i in many]), F.lit(True)))
    if wrong.limit(1).count():
        ends = [(f"rank{i}", F.when(holds[i], F.col(f"a{i}")).when(F.col(f"a{i}").isNotNull(), F.col("least")).alias(f"a{i}"), F.when(holds[i], F.col(f"b{i}")).when(F.col(f"b{i}").isNotNull(), F.col("most")).alias(f"b{i}")) for i in many]
        wide = asked.select(*keys, "n", "least", "most", *(c for end in ends for c in end))
        return _resolved(rows, wide, keys, names, groups)
    places = F.array(*(F.struct(F.lit(i).alias("j"), (F.col(f"rank{i}") - F.col(f"below{i}")).alias("place")) for i in many))
    asked = asked.select(*(F.col(k).alias(o) for k, o in zip(keys, of, strict=True)), F.inline(places))
    hit = inside.join(_small(asked, found), _same_group(keys, of) & (F.col("i") == F.col("j")) & (F.col("upto") > F.col("place")) & (F.col("upto") - F.col("held") <= F.col("place")))
    picked = hit.groupBy(*keys).agg(*(F.max(F.when(F.col("i") == i, F.col("x"))).alias(f"v{i}") for i in many))
    out = brackets.select(*keys, "n").join(picked.select(*(F.col(k).alias(o) for k, o in zip(keys, left, strict=True)), *(f"v{i}" for i in many)), _same_group(keys, left), "left")
    return out.select(*(F.col(k).alias(g) for g, k in zip(groups, keys, strict=True)), "n", *(F.col(f"v{i}").alias(name) for i, name in enumerate(names)))


def _all(conditions: list[Column]) -> Column:
    whole = conditions[0]
    for c in conditions[1:]:
        whole = whole & c
    return whole


def grouped_quantiles(df: DataFrame, groups: Sequence[str], value: str, probs: Sequence[float], digits: int | None = 6) -> DataFrame:
    """(groups, n, p<percent> ...): exact quantiles of each group, null for a group without values."""
    at = {p: (F.col("n") - 1) * F.lit(float(p)) for p in probs}
    ranks = {f"{side}{k}": c for k, p in enumerate(probs) for side, c in (("lo", F.floor(at[p])), ("hi", F.least(F.floor(at[p]) + 1, F.col("n") - 1)))}
    found = order_statistics(df, groups, value, ranks)

    def between(k: int, p: float) -> Column:
        lo, hi, share = F.col(f"lo{k}"), F.col(f"hi{k}"), at[p] - F.floor(at[p])
        v = F.when((lo == hi) | (share == 0), lo).otherwise(lo + share * (hi - lo))
        return (F.round(v, digits) if digits is not None else v).alias(quantile_name(p))

    return found.select(*groups, "n", *(between(k, p) for k, p in enumerate(probs)))


def quantile_name(p: float) -> str:
    return f"p{p * 100:g}".replace(".", "_")


def conformal_widths(calibration: DataFrame, groups: Sequence[str], label: str = "label", prediction: str = "prediction", coverage: float = 0.9) -> DataFrame:
    """(groups, n, half_width): split-conformal half widths of prediction intervals per group.

    The half width is the ceil((n + 1) * coverage)-th smallest absolute error
    of the group's ``n`` calibration rows, an order statistic without
    interpolation, which a new row's error does not exceed with probability
    ``coverage`` at least. A group with too few rows for that has none (null).
    """
    errors = calibration.select(*groups, F.abs(F.col(label) - F.col(prediction)).alias("size"))
    rank = F.ceil((F.col("n") + 1) * F.lit(float(coverage)) - F.lit(1e-9)) - 1
    return order_statistics(errors, groups, "size", {"half_width": rank})


def with_intervals(preds: DataFrame, widths: DataFrame, groups: Sequence[str], prediction: str = "prediction", least: float = 0.0) -> DataFrame:
    """Predictions with ``low`` and ``high`` of their group's interval (null where the group has none); no fare is below ``least``."""
    of = [f"of_{g}" for g in groups]
    named = widths.select(*(F.col(g).alias(o) for g, o in zip(groups, of, strict=True)), "half_width")
    met = preds.join(named, _same_group(groups, of), "left")
    low = F.greatest(F.lit(least), F.col(prediction) - F.col("half_width"))
    return met.withColumn("low", F.when(F.col("half_width").isNotNull(), low)).withColumn("high", F.col(prediction) + F.col("half_width")).drop("half_width", *of)


def interval_report(preds: DataFrame, widths: DataFrame, groups: Sequence[str], label: str = "label", prediction: str = "prediction", digits: int = 6) -> DataFrame:
    """Per group: calibration rows, half width, held-out rows, those inside the interval, and their share."""
    inside = F.col(label).between(F.col("low"), F.col("high"))
    held = with_intervals(preds, widths, groups, prediction).groupBy(*groups).agg(F.count(F.lit(1)).alias("n_test"), F.count_if(inside).alias("n_covered"))
    of = [f"of_{g}" for g in groups]
    named = widths.select(*(F.col(g).alias(o) for g, o in zip(groups, of, strict=True)), F.col("n").alias("n_calibration"), F.round("half_width", digits).alias("half_width"))
    out = held.join(named, _same_group(groups, of), "left")
    return out.select(*groups, F.coalesce("n_calibration", F.lit(0)).alias("n_calibration"), "half_width", "n_test", "n_covered", F.round(F.col("n_covered") / F.col("n_test"), digits).alias("coverage"))
