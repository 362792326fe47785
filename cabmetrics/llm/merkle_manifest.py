"""Merkle dataset manifest with a proof for every row.

A row's leaf is the SHA-256 of its fields. The leaves of a group (a language)
in the order of their ids form a binary tree; the groups' roots, in the order
of the groups, form one more tree, whose root stands for the dataset. A proof
lists the siblings on the way from the leaf through its group's root to the
dataset's root, so that one row is checked without the others.

Method, pointer jumping: each node holds a segment, the siblings on the way
towards an ancestor, and a pointer to that ancestor. A self-join appends the
ancestor's own segment and takes over its pointer, which doubles the distance;
after as many joins as the height has binary digits, every leaf points to the
root and holds its whole proof. A round needs only the nodes of levels that
are multiples of its distance, so the nodes above the leaves shrink fast. The
children of a group's root begin with the proof of that root in the upper
tree appended, so no join meets all rows of a group at one key.

Scale: leaves are numbered by one range sort and the row counts of its parts.
``2 ** BLOCK_BITS`` consecutive nodes meet in a task, which hashes that many
levels; the tree is done after a few such shuffles of shrinking size. A jump
of distance d joins leaves to nodes that stand for 2**d leaves each: while
there are many such nodes a key has few rows, and once there are at most ``FEW_NODES``
they are broadcast (that many segments, a few MB). So no key, group or
broadcast grows with the largest group. Every table that is used twice is
written to the shared folder.

Defined cases: null fields hash as ``-``; a null group is the first group, a
null id comes first in it. Rows of one id come in the order of their leaves;
rows repeated whole are leaves of their own, with the proofs of their places. A
group of one leaf has that leaf as its root. An empty table gives no rows. Text
of any length is hashed by the scan and goes no further. Other columns are not
read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
BLOCK_BITS = 10
FEW_NODES = 10_000
#: What a sibling's entry begins with: none at this level, on the left, on the right.
ALONE, LEFT, RIGHT = b"\x00", b"\x01", b"\x02"


def field_digest(*values: Column) -> Column:
    """SHA-256 (32 bytes) of the values, each ``-`` if null, else its UTF-8 byte count, a colon and itself."""
    texts = [v.cast("string") for v in values]
    return F.unhex(F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts)), 256))


def hex_text(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def height(total: Column) -> Column:
    """Levels above the leaves of a tree of ``total`` leaves."""
    return F.when(total <= 1, 0).otherwise(F.length(F.bin(total - 1)))


def ordered_spans(spark: SparkSession, rows: DataFrame, group: str, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """(the rows in order, with their part of it; a row per group and part: what ``placed`` needs).

    Nulls come first. Rows that tie are told apart by where they lie in the
    written table, so that many equal rows are still cut into parts.
    """
    kept = written(spark, rows.withColumn("spread", F.monotonically_increasing_id()), "unordered")
    by = [F.asc_nulls_first(c) for c in (group, *order, "spread")]
    # written as it is made: marks rise over sorted ranges, but another run may cut the ranges elsewhere
    ordered = written(spark, kept.orderBy(*by).drop("spread").withColumn("mark", F.monotonically_increasing_id()), "ordered")
    ordered = ordered.withColumn("part", F.shiftright("mark", 33))
    spans = ordered.groupBy(group, "part").agg(F.count(F.lit(1)).alias("held"), F.min("mark").alias("first"))
    earlier = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before, total = F.coalesce(F.sum("held").over(earlier), F.lit(0)), F.sum("held").over(Window.partitionBy(group))
    return ordered, written(spark, spans.select(F.col(group).alias("of_group"), F.col("part").alias("of_part"), "first", before.alias("before"), total.alias("total")), "spans")


def placed(ordered: DataFrame, group: str, spans: DataFrame) -> DataFrame:
    """The rows with their place in their group, from 0, and the other columns of their span (total, ...)."""
    same = (F.col("part") == F.col("of_part")) & F.col(group).eqNullSafe(F.col("of_group"))
    rows = ordered.join(spans, same).withColumn("place", F.col("before") + F.col("mark") - F.col("first"))
    return rows.drop("of_group", "of_part", "part", "mark", "first", "before")


def tree_levels(rows: pa.RecordBatch, starts: np.ndarray, base: int, bits: int, schema: pa.Schema) -> pa.RecordBatch:
    """The nodes over blocks of consecutive nodes of level ``base`` (block i from row ``starts[i]``).

    Nodes below the blocks' tops have an entry: their sibling; tops have their digest.
    """
    trees, totals, places, digests = (rows.column(c).to_pylist() for c in ("tree", "total", "place", "digest"))
    out: list[tuple] = []
    ends = [*starts[1:].tolist(), rows.num_rows]
    for start, end in zip(starts.tolist(), ends, strict=True):
        tree, total, first, level, row = trees[start], totals[start], places[start], base, digests[start:end]
        while True:
            count = (total + (1 << level) - 1) >> level
            of_row = range(start, end) if level == 0 else [None] * len(row)
            if count == 1 or level == base + bits:
                out.append((tree, total, level, first, row[0], None, of_row[0]))
                break
            above = []
            for k in range(0, len(row) - 1, 2):
                left, right = row[k], row[k + 1]
                out.append((tree, total, level, first + k, None, RIGHT + right, of_row[k]))
                out.append((tree, total, level, first + k + 1, None, LEFT + left, of_row[k + 1]))
                above.append(hashlib.sha256((left.hex() + right.hex()).encode()).digest())
            if len(row) % 2:
                out.append((tree, total, level, first + len(row) - 1, None, ALONE, of_row[-1]))
                above.append(hashlib.sha256(row[-1].hex().encode()).digest())
            first, level, row = first >> 1, level + 1, above
    columns = [pa.array(c, f.type) for c, f in zip(list(zip(*out, strict=True))[:6], schema, strict=False)]
    payload = rows.column("payload").take(pa.array([o[6] for o in out], pa.int64()))
    return pa.RecordBatch.from_arrays([*columns, payload], names=schema.names)


NODES = "tree long, total long, level int, place long, digest binary, entry binary"


def tree_nodes(spark: SparkSession, leaves: DataFrame, largest: int) -> tuple[DataFrame, DataFrame]:
    """(nodes below the root with their entries, roots) of the trees over (tree, total, place, digest, payload)."""
    payload = leaves.schema["payload"].dataType
    schema = StructType.fromDDL(NODES).add("payload", payload)
    names = pa.schema([("tree", pa.int64()), ("total", pa.int64()), ("level", pa.int32()), ("place", pa.int64()), ("digest", pa.binary()), ("entry", pa.binary()), ("payload", pa.null())])
    bits = BLOCK_BITS

    def hashing(base: int):
        def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rest = None
            for batch in batches:
                if rest is not None:
                    batch = pa.concat_batches([rest, batch])
                if not batch.num_rows:
                    continue
                heads = np.stack([batch.column("tree").to_numpy(), batch.column("place").to_numpy() >> bits])
                starts = np.flatnonzero(np.concatenate([[True], (heads[:, 1:] != heads[:, :-1]).any(axis=0)]))
                if len(starts) > 1:
                    yield tree_levels(batch.slice(0, starts[-1]), starts[:-1], base, bits, names)
                rest = batch.slice(starts[-1])
            if rest is not None:
                yield tree_levels(rest, np.zeros(1, np.int64), base, bits, names)

        return tasks

    done, tops, base = [], [], 0
    while True:
        met = leaves.select("tree", "total", "place", "digest", "payload").repartition("tree", F.shiftright("place", bits)).sortWithinPartitions("tree", "place")
        made = written(spark, met.mapInArrow(hashing(base), schema), "nodes")
        done.append(made.filter("entry is not null"))
        base += bits
        # a block's top is a root once its tree's height is reached
        tops.append(made.filter(F.col("entry").isNull() & (F.col("level") == height(F.col("total")))))
        if max(largest - 1, 0) >> base == 0:
            break
        leaves = made.filter(F.col("entry").isNull() & (F.col("level") < height(F.col("total"))))
    return _all(done), _all(tops)


def _all(tables: list[DataFrame]) -> DataFrame:
    whole = tables[0]
    for table in tables[1:]:
        whole = whole.unionByName(table)
    return whole


def proofs(spark: SparkSession, leaves: DataFrame, largest: int, upper=None) -> DataFrame:
    """(tree, payload, subroot, root, path) for each leaf of (tree, total, place, digest, payload).

    ``upper`` maps the roots (tree, digest) to rows (tree, subroot, root, path)
    of the tree above; without it the root of each tree is the root.
    """
    nodes, tops = tree_nodes(spark, leaves, largest)
    none = F.array().cast("array<binary>")
    above = tops.select("tree", F.col("digest").alias("subroot"), F.col("digest").alias("root"), none.alias("path")) if upper is None else upper(tops.select("tree", "digest"))
    above = written(spark, above.select("tree", "subroot", "root", F.col("path").alias("beyond")), "above")
    nodes = nodes.withColumn("height", height(F.col("total"))).withColumn("path", F.array("entry"))
    columns = ["tree", "height", "level", "place", "path", "subroot", "root", "payload"]
    highest = nodes.filter("level = height - 1").join(above, "tree").withColumn("path", F.concat("path", "beyond"))
    highest = written(spark, highest.select(*columns), "highest")  # two nodes a tree at most
    lower = nodes.filter("level < height - 1").withColumns({"subroot": F.lit(None).cast("binary"), "root": F.lit(None).cast("binary")}).select(*columns)
    inner = written(spark, lower.union(highest).filter("level > 0").drop("payload"), "pointers")
    found = lower.union(highest).filter("level = 0")
    distance, levels = 1, max(largest - 1, 0).bit_length()
    while distance < levels:
        target = inner.filter(F.col("level") % (2 * distance) == distance)
        found = jumped(found, target.filter(F.col("level") == distance), distance)
        inner = jumped(inner.filter(F.col("level") % (2 * distance) == 0), target, distance)
        distance *= 2
        if distance < levels:
            inner = written(spark, inner, "pointers")
    alone = tops.filter("level = 0").join(above, "tree").select("tree", "payload", "subroot", "root", F.col("beyond").alias("path"))
    return found.select("tree", "payload", "subroot", "root", "path").union(alone)


def jumped(rows: DataFrame, target: DataFrame, distance: int) -> DataFrame:
    """Nodes with the segment and pointer of their ancestor ``distance`` above taken over; nodes that point to the root have none and stay."""
    target = target.select(*(F.col(c).alias(f"to_{c}") for c in ("tree", "level", "place", "path", "subroot", "root")))
    if target.limit(FEW_NODES + 1).count() <= FEW_NODES:
        target = F.broadcast(target)
    same = (F.col("tree") == F.col("to_tree")) & (F.col("level") + distance == F.col("to_level")) & (F.shiftright("place", distance) == F.col("to_place"))
    longer = F.when(F.col("to_path").isNull(), F.col("path")).otherwise(F.concat("path", "to_path"))
    taken = {"path": longer, "subroot": F.coalesce("to_subroot", "subroot"), "root": F.coalesce("to_root", "root")}
    return rows.join(target, same, "left").withColumns(taken).select(*rows.columns)


def folded(leaf: Column, path: Column) -> Column:
    """The root (lowercase hex) that a leaf and the entries of its path lead to."""

    def step(reached: Column, entry: Column) -> Column:
        side, sibling = F.substring(entry, 1, 1), hex_text(F.substring(entry, 2, 32))
        return F.sha2(F.when(side == F.lit(LEFT), F.concat(sibling, reached)).when(side == F.lit(RIGHT), F.concat(reached, sibling)).otherwise(reached), 256)

    return F.aggregate(path, hex_text(leaf), step)


def siblings_digest(path: Column) -> Column:
    """SHA-256 (lowercase hex) of the siblings' hex texts from the leaf to the root."""
    met = F.filter(path, lambda e: F.octet_length(e) > 1)
    return F.sha2(F.array_join(F.transform(met, lambda e: hex_text(F.substring(e, 2, 32))), ""), 256)


def manifest(
    spark: SparkSession,
    docs: DataFrame,
    fields: tuple[str, ...] = FIELDS,
    group: str = "lang",
    order: str = "doc_id",
    carried: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: the columns ``order``, leaf, subroot, root (32 bytes each), path and those of ``carried``.

    ``path`` holds an entry for each level, the sibling's side and digest; see
    ``folded``. ``carried`` are small columns computed from the row, to be kept beside it.
    """
    extra = {f"carried_{name}": value for name, value in (carried or {}).items()}
    leaves = docs.select(F.col(group).alias("in_group"), F.col(order).alias("item"), field_digest(*(docs[f] for f in fields)).alias("digest"), *(v.alias(n) for n, v in extra.items()))
    ordered, spans = ordered_spans(spark, leaves, "in_group", ["item", "digest"])
    groups = spans.groupBy("of_group").agg(F.max("total").alias("largest")).withColumn("one", F.lit(1))
    ranked, all_groups = ordered_spans(spark, groups.withColumnRenamed("of_group", "ranked_group"), "one", ["ranked_group"])
    ranked = written(spark, placed(ranked, "one", all_groups).select("ranked_group", F.col("place").alias("tree"), "largest"), "groups")
    size = ranked.agg(F.max("largest").alias("largest"), F.count(F.lit(1)).alias("n_groups")).first()
    spans = spans.join(ranked.drop("largest"), F.col("of_group").eqNullSafe(F.col("ranked_group"))).drop("ranked_group")
    payload = F.struct("item", F.col("digest").alias("leaf"), *extra)
    leaves = placed(ordered, "in_group", spans).select("tree", "total", "place", "digest", payload.alias("payload"))

    def of_groups(roots: DataFrame) -> DataFrame:
        top = roots.select(F.lit(0).cast("long").alias("tree"), F.lit(size["n_groups"]).cast("long").alias("total"), F.col("tree").alias("place"), "digest", F.struct("tree", "digest").alias("payload"))
        found = proofs(spark, top, size["n_groups"])
        return found.select("payload.tree", F.col("payload.digest").alias("subroot"), "root", "path")

    found = proofs(spark, leaves, size["largest"] or 0, of_groups)
    named = [F.col(f"payload.{n}").alias(n.removeprefix("carried_")) for n in extra]
    return found.select(F.col("payload.item").alias(order), F.col("payload.leaf").alias("leaf"), "subroot", "root", "path", *named)
