"""Chat formatting after cumulative-snapshot collapse, in DataFrame operations only.

Logs often hold a conversation several times, each time with some more turns. The turns of a
conversation are hashed with their places, and the running combination of these hashes names every
prefix. A conversation whose whole is a proper prefix of another is dropped by an anti-join on that
name; of equal conversations the smallest id stays. What is left is rendered.

A long conversation is worked on in blocks of up to ``BLOCK`` turns, so no task needs all of it: all turns
are sorted in ranges, whatever their numbers, and cut by their place in the sort. Places and hashes are combined within
blocks, over the blocks of a part and over parts, and the text comes in segments.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabularium.llm.common import join_sized, stage

BLOCK = 256
#: Characters of a text by which the ranges of the sort are drawn.
RANGE_CHARS = 256
#: ``monotonically_increasing_id`` holds the partition above this many bits.
_PART = 33


def _turn_hash(salt: int) -> Column:
    return F.xxhash64(F.lit(salt), "place", F.coalesce("role", F.lit("")), F.col("role").isNull(), F.coalesce("text", F.lit("")), F.col("text").isNull())


def _earlier(blocks: DataFrame, names: list[str], fold: Callable[[str], Column], combine: Callable[[Column, Column], Column]) -> DataFrame:
    """``blocks`` (``conv_id, part, block`` and numbers) with each number folded over the earlier blocks of its conversation.

    First over the parts of a conversation, of which there are no more than tasks of the sort, then over the
    blocks within a part, so that no task needs all blocks of a huge conversation.
    """
    over = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("conv_id", "part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    parts = blocks.groupBy("conv_id", "part").agg(*[fold(c).alias(c) for c in names])
    parts = parts.select("conv_id", "part", *[F.coalesce(fold(c).over(over), zero).alias(f"parts_{c}") for c in names])
    within = blocks.select("*", *[F.coalesce(fold(c).over(inside), zero).alias(f"blocks_{c}") for c in names])
    return within.join(parts, ["conv_id", "part"]).select(
        *[c for c in blocks.columns if c not in names], *[combine(F.col(f"parts_{c}"), F.col(f"blocks_{c}")).alias(c) for c in names]
    )


def turns(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """``conv_id, turn, role, text, place, a, b, n``: distinct turns in order, with the hashes of the prefix that ends there.

    Turns are in order of ``turn`` (null first), then role and text; exactly repeated rows count once.
    ``place`` counts from 0, ``n`` is the number of turns of the conversation. Rows without a conversation id are left out.
    Rows are sorted in ranges of all four columns, so a conversation with null, equal or sparse turns is cut like
    any other; only turns that are alike up to the first ``RANGE_CHARS`` characters of the text are never parted.
    """
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    rows = rows.where("conv_id is not null").distinct()
    order = [F.asc("conv_id"), F.asc_nulls_first("turn"), F.asc_nulls_first("role")]
    # Samples for the bounds of the ranges reach the driver, so they hold starts of texts; the sort compares whole texts.
    ranged = rows.repartitionByRange(*order, F.asc_nulls_first(F.substring("text", 1, RANGE_CHARS)))
    ranged = ranged.sortWithinPartitions(*order, F.asc_nulls_first("text"))
    # The number holds the partition of the sort in its upper bits and the place there in its lower ones.
    ranged = stage(ranged.withColumn("at", F.monotonically_increasing_id()), "turns")
    cut = ranged.withColumn("part", F.shiftright("at", _PART)).withColumn("block", F.expr(f"at div {block}"))
    keys = ["conv_id", "part", "block"]

    blocks = stage(cut.groupBy(*keys).agg(F.count("*").alias("size"), F.min("at").alias("lowest")), "blocks")
    lengths = stage(blocks.groupBy("conv_id").agg(F.sum("size").alias("n"), F.count("*").alias("blocks")), "lengths")
    before = _earlier(blocks, ["size"], F.sum, lambda x, y: x + y)
    before = join_sized(stage(before, "before"), lengths, "conv_id", "blocks", blocks.count())
    placed = cut.join(before, keys).withColumn("place", F.col("size") + F.col("at") - F.col("lowest")).drop("size", "lowest", "at")

    # Hashes of a turn at its place, combined within blocks; a block is the smallest group from here on.
    running = Window.partitionBy(*keys).orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hashed = placed.select("*", _turn_hash(1).alias("ha"), _turn_hash(2).alias("hb"))
    inner = stage(hashed.select("*", F.bit_xor("ha").over(running).alias("ia"), F.bit_xor("hb").over(running).alias("ib")), "hashed")
    sums = inner.groupBy(*keys).agg(F.bit_xor("ha").alias("a"), F.bit_xor("hb").alias("b"))
    sums = _earlier(sums, ["a", "b"], F.bit_xor, lambda x, y: x.bitwiseXOR(y))
    joined = inner.join(sums, keys)
    return joined.select("conv_id", "turn", "role", "text", "place", "n", F.col("ia").bitwiseXOR(F.col("a")).alias("a"), F.col("ib").bitwiseXOR(F.col("b")).alias("b"))


def maximal(turned: DataFrame) -> DataFrame:
    """``conv_id`` of the conversations that are no proper prefix of another; of equal ones the smallest id."""
    last = turned.where("place = n - 1").groupBy("n", "a", "b").agg(F.min("conv_id").alias("conv_id"))
    inner = turned.where("place < n - 1").select((F.col("place") + 1).alias("n"), "a", "b").distinct()
    return last.join(inner, ["n", "a", "b"], "left_anti").select("conv_id")


def render(turned: DataFrame, segment: int = BLOCK) -> DataFrame:
    """``conv_id, segment, n_turns, text``: conversations as text, in segments of up to ``segment`` turns.

    A turn is ``<|role|>``, a line break, its text and another line break; a null role is ``unknown``, a null text empty.
    """
    shown = F.concat(F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"), F.coalesce("text", F.lit("")), F.lit("\n"))
    parts = turned.select("conv_id", F.floor(F.col("place") / F.lit(segment)).cast("long").alias("segment"), F.struct("place", shown.alias("shown")).alias("part"))
    lists = parts.groupBy("conv_id", "segment").agg(F.sort_array(F.collect_list("part")).alias("parts"))
    return lists.select("conv_id", "segment", F.size("parts").cast("long").alias("n_turns"), F.array_join(F.transform("parts", lambda p: p["shown"]), "").alias("text"))


def format_conversations(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """Collapse snapshots and render what remains. An empty table gives an empty one."""
    turned = stage(turns(conversations, block), "prefixes")
    kept = stage(maximal(turned), "maximal")
    return render(turned.join(kept, "conv_id", "left_semi"), block)
