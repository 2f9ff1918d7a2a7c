"""Preference formatting, on DataFrame functions only.

A pair is a chosen and a rejected conversation.  Their longest common prefix of
turns (same turn number, role and text) is rendered once, as the prompt; what
follows on either side is rendered as that side's completion.  The result has
one row per rendered turn, in the order (pair, part, turn): a whole
conversation never has to fit a task, and training text is ``rendered`` of a
part, joined in that order.  ``trained`` is the loss mask: only assistant turns
of a completion are learnt, prompts and user turns are masked.

A completion whose prefix covers the whole conversation is empty and has no
row.  Pairs with equal conversations are prompt only.

Result for odd input: rows with a null pair or turn number belong to no
conversation and give no row; a null role or text is an empty one; exactly
repeated turns count once; several different turns under one number keep the
order (role, text) and agree only if all of them do; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casetrace.llm.common import require

ASSISTANT = "assistant"


def turns(conversations: DataFrame, pair: str) -> DataFrame:
    """Distinct turns ``pair_id, turn, nth, role, text`` of one side."""
    require(conversations, [pair, "turn", "role", "text"])
    one = conversations.where(F.col(pair).isNotNull() & F.col("turn").isNotNull()).select(
        F.col(pair).alias("pair_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text")).distinct()
    return one.withColumn("nth", F.row_number().over(
        Window.partitionBy("pair_id", "turn").orderBy("role", "text")))


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("\n"))


def format_pairs(chosen: DataFrame, rejected: DataFrame, pair: str) -> DataFrame:
    """``pair_id, part`` (prompt, chosen or rejected), ``turn, nth, role,
    rendered, trained, prompt_turns`` of every pair in either table."""
    a, b = turns(chosen, pair), turns(rejected, pair)
    place = ["pair_id", "turn", "nth"]
    both = (a.select(*place, F.struct("role", "text").alias("chosen"))
            .join(b.select(*place, F.struct("role", "text").alias("rejected")), place, "outer"))
    # the first place where the sides differ; null where they never do
    differ = ~F.col("chosen").eqNullSafe(F.col("rejected"))
    split = both.groupBy("pair_id").agg(F.min(F.when(differ, F.col("turn"))).alias("split"))
    cut = both.join(split, "pair_id").withColumn(
        "common", F.col("split").isNull() | (F.col("turn") < F.col("split")))
    sides = F.when(F.col("common"), F.array(F.struct(F.lit("prompt").alias("part"),
                                                     F.col("chosen").alias("t")))).otherwise(
        F.filter(F.array(F.struct(F.lit("chosen").alias("part"), F.col("chosen").alias("t")),
                         F.struct(F.lit("rejected").alias("part"), F.col("rejected").alias("t"))),
                 lambda s: s["t"].isNotNull()))
    counts = cut.groupBy("pair_id").agg(
        F.count_if("common").cast("long").alias("prompt_turns"))
    return (cut.select(*place, F.explode(sides).alias("s")).join(counts, "pair_id")
            .select("pair_id", "s.part", "turn", F.col("nth").cast("int").alias("nth"),
                    F.col("s.t.role").alias("role"),
                    render(F.col("s.t.role"), F.col("s.t.text")).alias("rendered"),
                    ((F.col("s.part") != "prompt") & (F.col("s.t.role") == ASSISTANT))
                    .alias("trained"), "prompt_turns"))


def swap_last_reply(conversations: DataFrame, key: str = "conv_id") -> DataFrame:
    """A rejected side for a table without one: every conversation up to its
    last assistant turn, then the last assistant turn of its neighbour (the id
    with the lowest bit flipped) in that place.  Without a reply of its own it
    stays whole; without a neighbour's reply it ends before its last reply."""
    known = conversations.where(F.col(key).isNotNull() & F.col("turn").isNotNull())
    last = (known.where(F.col("role") == ASSISTANT).groupBy(key)
            .agg(F.max("turn").alias("__last")))
    replies = (known.join(last, key).where((F.col("role") == ASSISTANT)
                                           & (F.col("turn") == F.col("__last")))
               .groupBy(key, "__last").agg(F.min("text").alias("__reply")))
    neighbour = replies.select(F.col(key).bitwiseXOR(1).alias(key), "__reply")
    before = known.join(last, key, "left").where("__last is null or turn < __last")
    swapped = last.join(neighbour, key).select(
        key, F.col("__last").alias("turn"), F.lit(ASSISTANT).alias("role"),
        F.col("__reply").alias("text"))
    return before.select(key, "turn", "role", "text").unionByName(swapped)
