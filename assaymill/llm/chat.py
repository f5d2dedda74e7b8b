"""Chat formatting after collapsing cumulative snapshots.

A logged conversation that another one continues is a prefix of it. Rolling hashes over the
turns tell: the hash of the first ``k`` turns is the sum of one 128-bit hash per
(place, role, text), so a prefix's hash is a running sum. Equal conversations keep the smallest
id; then those whose whole hash is a proper prefix of another's go by anti-join. What stays is
rendered between role marks.

A conversation's turns are dealt by blocks of ``BLOCK`` turns: places and sums run inside a block
and continue from the totals of the blocks before, so no task needs a whole conversation.
Rendered text comes in parts of one block each; usual conversations have the part 0 only.

Turns are ordered by ``turn`` (NULL first), role and text; a repeated row counts once. NULL
roles read as ``user``, NULL texts as empty. Rows with a NULL ``conv_id`` are one conversation.
Marks inside texts are broken up by blanks, so that a text can't open a turn.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assaymill.session import materialize

BLOCK = 256
#: The role marks.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _placed(conversations: DataFrame) -> DataFrame:
    """Turns with their place, the two running hash sums and the number of turns."""
    turns = conversations.select(
        F.col("conv_id").alias("c"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit("user")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).distinct()
    block = F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(1 << 62)))
    turns = turns.withColumn("block", block)
    inside = Window.partitionBy("c", "block").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    turns = turns.withColumn("n", F.row_number().over(inside).cast("bigint"))
    totals = turns.groupBy("c", "block").agg(F.count("*").alias("size"))
    before = Window.partitionBy("c").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        F.col("c").alias("tc"), F.col("block").alias("tb"),
        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"),
        F.sum("size").over(Window.partitionBy("c")).alias("n_turns"),
    )
    turns = turns.join(totals, F.col("c").eqNullSafe(F.col("tc")) & (F.col("block") == F.col("tb")))
    place = F.col("offset") + F.col("n")
    # Sums of 32-bit hashes in 64 bits can't overflow; four of them are as good as 128 bits.
    parts = [F.xxhash64(F.lit(s), place, "role", "text") for s in (1, 2)]
    halves = [h.bitwiseAND(0xFFFFFFFF) for h in parts] + [F.shiftrightunsigned(h, 32) for h in parts]
    turns = turns.select("c", "block", "turn", "role", "text", "n_turns", place.alias("place"), *[h.alias(f"h{i}") for i, h in enumerate(halves)])
    return materialize(turns, "chat-turns")


def maximal(conversations: DataFrame) -> DataFrame:
    """The turns of conversations that no other one equals (but for a larger id) or continues."""
    turns = _placed(conversations)
    names = ["h0", "h1", "h2", "h3"]
    key = ["place", *names]
    inside = Window.partitionBy("c", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    local = turns.select("c", "block", "place", "n_turns", *[F.sum(h).over(inside).alias(h) for h in names])
    sums = turns.groupBy("c", "block").agg(*[F.sum(h).alias(h) for h in names])
    before = Window.partitionBy("c").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        F.col("c").alias("sc"), F.col("block").alias("sb"),
        *[F.coalesce(F.sum(h).over(before), F.lit(0)).alias(f"s{h}") for h in names],
    )
    running = local.join(sums, F.col("c").eqNullSafe(F.col("sc")) & (F.col("block") == F.col("sb"))).select(
        "c", "place", "n_turns", *[(F.col(h) + F.col(f"s{h}")).alias(h) for h in names]
    )
    running = materialize(running, "chat-prefixes")
    # Equal conversations and common prefixes are one row before anything is joined.
    whole = running.where("place = n_turns").groupBy(*key).agg(
        F.min("c").alias("keep"), F.count_if(F.col("c").isNull()).alias("unnamed")
    )
    prefixes = running.where("place < n_turns").select(*key).distinct()
    kept = whole.join(prefixes, key, "left_anti").select("keep", F.lit(True).alias("kept"))
    return turns.join(kept, F.col("c").eqNullSafe(F.col("keep"))).drop("keep", "kept")


def _rendered(turn_text):
    for mark in (OPEN, CLOSE):
        turn_text = F.replace(turn_text, F.lit(mark), F.lit(mark.replace("|", " | ")))
    return turn_text


def render(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``part``, ``n_turns`` and ``rendered`` text of each maximal conversation."""
    turns = maximal(conversations)
    part = F.floor((F.col("place") - 1) / BLOCK)
    line = F.concat(F.lit(OPEN), _rendered(F.col("role")), F.lit("\n"), _rendered(F.col("text")), F.lit(CLOSE + "\n"))
    lines = turns.select("c", part.alias("part"), "n_turns", F.struct("place", line.alias("line")).alias("x"))
    grouped = lines.groupBy("c", "part", "n_turns").agg(F.array_sort(F.collect_list("x")).alias("xs"))
    return grouped.select(
        F.col("c").alias("conv_id"), "part", "n_turns", F.array_join(F.col("xs.line"), "").alias("rendered")
    )
