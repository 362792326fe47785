"""Exact quantiles with bounded memory.

Spark's exact ``percentile`` keeps every distinct value of a group in one
aggregation buffer; over a whole table that buffer (and the final merge task)
grows with the data. This operator finds the same order statistics by
narrowing an open interval around each wanted rank:

1. a sketch (``percentile_approx``, one aggregate) gives two values close to
   the rank on either side;
2. conditional counts (one aggregate) say exactly how many values lie below
   and at each of the two. The rank is then one of them, or lies strictly
   between, before or after them, and the interval shrinks accordingly;
3. an interval of at most ``limit`` values is read as one sorted list.

Every pass removes the two values from the interval, so it ends; as the
sketch errs by about 1/10,000, two rounds narrow 10^8 values to the list.
Every size takes the same path. Only comparisons are made with the bounds,
so infinite values are values like others. Rows are never multiplied,
shuffled or kept. Interpolation follows the linear rule of pandas, DuckDB
``quantile_cont`` and Spark ``percentile``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import nan_to_null


def _ranks(n: int, p: float) -> tuple[int, int, float]:
    h = (n - 1) * p
    lo = math.floor(h)
    return lo, min(lo + 1, n - 1), h - lo


def _between(a: float, b: float, frac: float) -> float:
    return a if a == b or not frac else a + frac * (b - a)


def _inside(col: str, t: dict) -> Column:
    """The column's value where it lies in the target's open interval, else null."""
    c = F.col(col)
    cond = c.isNotNull()
    if t["lo"] is not None:
        cond = cond & (c > F.lit(t["lo"]))
    if t["hi"] is not None:
        cond = cond & (c < F.lit(t["hi"]))
    return F.when(cond, c)


def opening_sketch(col: Column, probs: Sequence[float], accuracy: int = 10_000) -> Column:
    """Aggregate of two values around each of ``probs``, for the ``sketches`` of ``exact_quantiles``.

    A caller that aggregates the column anyway puts it into that pass.
    """
    margin = 3 / accuracy
    return F.percentile_approx(col, [f for p in probs for f in (max(0.0, p - margin), min(1.0, p + margin))], accuracy)


def exact_quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    limit: int = 256,
    accuracy: int = 10_000,
    max_passes: int = 200,
    stats: dict | None = None,
    sketches: dict | None = None,
) -> dict[str, list[float | None]]:
    """``{column: [quantile for p in probs]}``; null/NaN ignored, None for an empty column.

    ``stats`` (``{column: (count, min, max)}`` of the non-null, non-NaN
    values) lets a caller that already aggregated the column skip the count,
    and ``sketches`` (the ``opening_sketch`` of each column) the first sketch.
    """
    cols = list(cols)
    base = df.select(*[nan_to_null(F.col(c).cast("double")).alias(f"x{i}") for i, c in enumerate(cols)])
    if stats is None:
        counted = [c for i in range(len(cols)) for c in (F.count(f"x{i}").alias(f"n{i}"), opening_sketch(F.col(f"x{i}"), probs, accuracy).alias(f"s{i}"))]
        row = base.agg(*counted).first()
        counts, opening = [row[f"n{i}"] for i in range(len(cols))], [row[f"s{i}"] for i in range(len(cols))]
    else:
        counts = [stats[c][0] for c in cols]
        opening = [sketches[c] for c in cols] if sketches is not None else None

    # by (column, 0-based rank): the open interval that holds the answer (None:
    # unbounded), how many values lie before it and in it, the answer
    targets: dict[tuple[int, int], dict] = {}
    for i, n in enumerate(counts):
        for k, p in enumerate(probs if n else ()):
            for r in _ranks(n, p)[:2]:
                targets.setdefault((i, r), {"lo": None, "hi": None, "before": 0, "inside": n, "value": None, "bracket": 2 * k})

    for _ in range(max_passes):
        wide = [(k, t) for k, t in targets.items() if t["value"] is None and t["inside"] > limit]
        if not wide:
            break
        by_interval: dict[tuple, list] = {}
        for (i, r), t in wide:
            by_interval.setdefault((i, t["lo"], t["hi"]), []).append((r, t))
        asked = []
        if opening is not None:  # the first brackets are there already
            asked = [(i, r, t, *opening[i][t["bracket"] : t["bracket"] + 2]) for (i, r), t in wide]
            opening = None
        else:
            sketched = []
            for s, ((i, _, _), members) in enumerate(by_interval.items()):
                margin = max(2 / accuracy, 1.5 / members[0][1]["inside"])
                fractions, leader = [], None
                members.sort(key=lambda m: m[0])
                for r, t in members:
                    if leader is None or r > leader + 1:  # the two ranks of one quantile share a bracket
                        leader, at = r, (r - t["before"] + 0.5) / t["inside"]
                        fractions += [max(0.0, at - margin), min(1.0, at + margin)]
                    t["bracket"] = len(fractions) - 2
                sketched.append(F.percentile_approx(_inside(f"x{i}", members[0][1]), fractions, accuracy).alias(f"s{s}"))
            found = base.agg(*sketched).first()
            for s, ((i, _, _), members) in enumerate(by_interval.items()):
                for r, t in members:
                    asked.append((i, r, t, *found[f"s{s}"][t["bracket"] : t["bracket"] + 2]))
        edges = {(i, v) for i, _, _, a, b in asked for v in (a, b)}
        names = {edge: e for e, edge in enumerate(sorted(edges))}
        row = base.agg(
            *[
                c
                for (i, v), e in names.items()
                for c in (F.count_if(F.col(f"x{i}") < F.lit(v)).alias(f"b{e}"), F.count_if(F.col(f"x{i}") <= F.lit(v)).alias(f"u{e}"))
            ]
        ).first()
        for i, r, t, a, b in asked:
            below_a, upto_a = row[f"b{names[i, a]}"], row[f"u{names[i, a]}"]
            below_b, upto_b = row[f"b{names[i, b]}"], row[f"u{names[i, b]}"]
            if below_a <= r < upto_a:
                t["value"] = a
            elif below_b <= r < upto_b:
                t["value"] = b
            elif r < below_a:
                t.update(hi=a, inside=below_a - t["before"])
            elif r < below_b:
                t.update(lo=a, hi=b, before=upto_a, inside=below_b - upto_a)
            else:
                t.update(lo=b, inside=t["before"] + t["inside"] - upto_b, before=upto_b)
    else:
        raise RuntimeError("exact_quantiles did not converge")

    rest: dict[tuple, list] = {}
    for (i, r), t in targets.items():
        if t["value"] is None:
            rest.setdefault((i, t["lo"], t["hi"]), []).append((r, t))
    if rest:
        lists = [F.sort_array(F.collect_list(_inside(f"x{i}", members[0][1]))).alias(f"l{s}") for s, ((i, _, _), members) in enumerate(rest.items())]
        row = base.agg(*lists).first()
        for s, members in enumerate(rest.values()):
            for r, t in members:
                t["value"] = row[f"l{s}"][r - t["before"]]

    out: dict[str, list[float | None]] = {}
    for i, c in enumerate(cols):
        out[c] = []
        for p in probs:
            if not counts[i]:
                out[c].append(None)
                continue
            lo, hi, frac = _ranks(counts[i], p)
            out[c].append(_between(targets[i, lo]["value"], targets[i, hi]["value"], frac))
    return out


def approx_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], accuracy: int = 10_000) -> dict:
    """Sketch-based quantiles (``percentile_approx``): one pass, fixed memory."""
    row = df.agg(
        *[F.percentile_approx(nan_to_null(F.col(c).cast("double")), list(probs), accuracy).alias(c) for c in cols]
    ).first()
    return {c: list(row[c]) if row[c] is not None else [None] * len(probs) for c in cols}


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], method: str = "exact", **kw) -> dict:
    if method == "exact":
        return exact_quantiles(df, cols, probs, **kw)
    if method == "approx":
        kw.pop("stats", None)
        kw.pop("sketches", None)
        return approx_quantiles(df, cols, probs, **kw)
    raise ValueError(f"unknown method {method!r}")
