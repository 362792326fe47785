"""Chat formatting of logged conversations, after collapsing snapshots.

A log may hold a conversation several times, each time with some more turns.
Every turn gets the hash of the conversation up to it (two 64-bit hashes that
roll from turn to turn), so a whole conversation is recognised as the
beginning of a longer one by equality of its last hash and its length with a
turn of the other. An anti-join keeps the maximal conversations; of equal
ones the smallest id stays. The kept ones are rendered in ChatML.

DataFrame functions only.

Scale: the place of every turn in its conversation comes from one sort of the
table by conversation, number and hashes, in ranges: a conversation that holds
a third of all rows lies in many of them. Then turns are handled in parts of
``part_turns`` places, so no group is larger than that, whatever the turn
numbers are; what parts pass on to each other is one row each, in blocks. Equal
rows travel as one with their number. Only hashes are shuffled until the kept
conversations are known. Prefixes that many conversations share are reduced
before the shuffle. A conversation is rendered in its parts, to be read in
order; a part is one string, so its turns must fit one value (2 GB).

Defined cases: turns are ordered by number, then by hashes of role and text;
a null number comes first. Null role or text counts as empty. Rows without a
conversation id are one conversation. Repeated rows are turns of their own.
Chat markers inside a text are broken up by blanks. An empty table gives no
row. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

NO_TURN = -(1 << 62)
#: Parts whose hashes are added up together.
BLOCK_PARTS = 4096
TURN = ("conv_id", "turn", "h1", "h2")


def _turns(conversations: DataFrame) -> DataFrame:
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    return conversations.select(
        "conv_id",
        F.coalesce(F.col("turn").cast("long"), F.lit(NO_TURN)).alias("turn"),
        F.xxhash64(F.lit(1), role, text).alias("h1"),
        F.xxhash64(F.lit(2), text, role).alias("h2"),
        role.alias("role"),
        text.alias("text"),
    )


def _ordered(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(the different turns in order, with their range; before and total of each conversation and range)."""
    spark = conversations.sparkSession
    different = _turns(conversations).groupBy(*TURN).agg(F.count(F.lit(1)).alias("n"))
    # written as it is made: marks rise over sorted ranges, but another run may cut the ranges elsewhere
    marked = different.orderBy(*(F.asc_nulls_first(c) for c in TURN)).withColumn("mark", F.monotonically_increasing_id())
    ordered = written(spark, marked, "turns_in_order").withColumn("range", F.shiftright("mark", 33))
    spans = ordered.groupBy(F.col("conv_id").alias("s_conv"), F.col("range").alias("s_range")).agg(F.sum("n").alias("held"))
    of_conv = Window.partitionBy("s_conv")
    earlier = of_conv.orderBy("s_range").rowsBetween(Window.unboundedPreceding, -1)
    before, total = F.coalesce(F.sum("held").over(earlier), F.lit(0)), F.sum("held").over(of_conv)
    return ordered, written(spark, spans.select("s_conv", "s_range", before.alias("before"), total.alias("total")), "spans")


def _pieces(ordered: DataFrame, spans: DataFrame, part_turns: int) -> DataFrame:
    """The turns of the conversations in ``spans`` by part, with the first place (from 0) and the number of equal rows there."""
    earlier = Window.partitionBy("conv_id", "range").orderBy("mark").rowsBetween(Window.unboundedPreceding, -1)
    counted = ordered.withColumn("within", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    met = counted.join(spans, counted.conv_id.eqNullSafe(spans.s_conv) & (F.col("range") == F.col("s_range")))
    met = met.withColumn("start", F.col("before") + F.col("within")).withColumn("end", F.col("start") + F.col("n"))
    parts = met.withColumn("part", F.explode(F.expr(f"sequence(start div {part_turns}, (end - 1) div {part_turns})")))
    first, last = F.greatest("start", F.col("part") * part_turns), F.least("end", (F.col("part") + 1) * part_turns)
    kept = [c for c in spans.columns if c not in ("s_conv", "s_range", "before")]
    return parts.select(*TURN, "part", first.alias("first"), (last - first).alias("number"), *kept)


def _sums_before(sums: DataFrame) -> DataFrame:
    """(conv_id, part, x1, x2) of each part, with the sums of its conversation's earlier parts."""
    sums = sums.withColumn("block", F.expr(f"part div {BLOCK_PARTS}"))
    blocks = sums.groupBy(F.col("conv_id").alias("b_conv"), F.col("block").alias("b_block")).agg(F.bit_xor("x1").alias("b1"), F.bit_xor("x2").alias("b2"))
    over_blocks = Window.partitionBy("b_conv").orderBy("b_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("b_conv", "b_block", *(F.coalesce(F.bit_xor(b).over(over_blocks), F.lit(0)).alias(b) for b in ("b1", "b2")))
    in_block = Window.partitionBy("conv_id", "block").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    inner = sums.select("conv_id", "part", "block", *(F.coalesce(F.bit_xor(x).over(in_block), F.lit(0)).alias(x) for x in ("x1", "x2")))
    met = inner.join(blocks, inner.conv_id.eqNullSafe(blocks.b_conv) & (F.col("block") == F.col("b_block")))
    return met.select(F.col("conv_id").alias("s_conv"), F.col("part").alias("s_part"), F.col("x1").bitwiseXOR(F.col("b1")).alias("x1"), F.col("x2").bitwiseXOR(F.col("b2")).alias("x2"))


def _maximal(ordered: DataFrame, spans: DataFrame, part_turns: int) -> DataFrame:
    places = _pieces(ordered, spans, part_turns).withColumn("place", F.explode(F.expr("sequence(first + 1, first + number)")))
    mixed = places.select("conv_id", "part", "place", (F.col("place") == F.col("total")).alias("closes"), F.xxhash64("place", "h1", "h2").alias("m1"), F.xxhash64("h2", "h1", "place").alias("m2"))
    sums = _sums_before(mixed.groupBy("conv_id", "part").agg(F.bit_xor("m1").alias("x1"), F.bit_xor("m2").alias("x2")))
    running = Window.partitionBy("conv_id", "part").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    rolled = mixed.select("conv_id", "part", "place", "closes", F.bit_xor("m1").over(running).alias("r1"), F.bit_xor("m2").over(running).alias("r2"))
    rolled = rolled.join(sums, rolled.conv_id.eqNullSafe(sums.s_conv) & (rolled.part == sums.s_part)).select(
        "conv_id", "place", "closes", F.col("r1").bitwiseXOR(F.col("x1")).alias("p1"), F.col("r2").bitwiseXOR(F.col("x2")).alias("p2")
    )
    whole = rolled.filter("closes").groupBy("place", "p1", "p2").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("copies"))
    begun = rolled.filter(~F.col("closes")).select("place", "p1", "p2").distinct()
    return whole.join(begun, ["place", "p1", "p2"], "left_anti").select("conv_id", F.col("place").alias("n_turns"), "copies")


def maximal_conversations(conversations: DataFrame, part_turns: int = 128) -> DataFrame:
    """(conv_id, n_turns, copies) of the conversations that no longer one begins with."""
    return _maximal(*_ordered(conversations), part_turns)


def format_chats(conversations: DataFrame, part_turns: int = 128) -> DataFrame:
    """One row per part of a kept conversation: conv_id, part, part_turns, n_turns, copies, rendered.

    ``part`` counts from 0; every part but the last has ``part_turns`` turns.
    """
    ordered, spans = _ordered(conversations)
    kept = written(conversations.sparkSession, _maximal(ordered, spans, part_turns).withColumnRenamed("conv_id", "k_conv"), "kept_conversations")
    pieces = _pieces(ordered, spans.drop("total").join(kept, spans.s_conv.eqNullSafe(kept.k_conv)).drop("k_conv"), part_turns)
    clean = F.replace(F.replace(F.col("text"), F.lit("<|im_start|>"), F.lit("<| im_start |>")), F.lit("<|im_end|>"), F.lit("<| im_end |>"))
    line = F.concat(F.lit("<|im_start|>"), "role", F.lit("\n"), clean, F.lit("<|im_end|>\n"))
    lines = _turns(conversations).groupBy(*(F.col(c).alias(f"l_{c}") for c in TURN)).agg(F.first(line).alias("line"))
    same = pieces.conv_id.eqNullSafe(lines.l_conv_id)
    for c in TURN[1:]:
        same = same & (pieces[c] == lines[f"l_{c}"])
    rows = pieces.join(lines, same).select("conv_id", "part", "number", "n_turns", "copies", F.struct("first", F.expr("repeat(line, cast(number as int))").alias("line")).alias("l"))
    found = rows.groupBy("conv_id", "part").agg(F.sum("number").alias("part_turns"), F.first("n_turns").alias("n_turns"), F.first("copies").alias("copies"), F.array_sort(F.collect_list("l")).alias("lines"))
    return found.select("conv_id", "part", "part_turns", "n_turns", "copies", F.array_join(F.col("lines.line"), "").alias("rendered"))
