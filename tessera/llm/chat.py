"""Preference formatting of paired conversations, with DataFrame functions only.

A pair is a chosen and a rejected conversation. Their longest common prefix of turns (same role, same text) is
rendered once as the prompt; what follows in each is its completion, with the character ranges of assistant
text as the loss mask. Turns are numbered and measured by windows inside a conversation, then laid together;
pairs join by id, so work is spread over all conversations however often a turn or a conversation is repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def paired_by_id(conversations: DataFrame) -> DataFrame:
    """(pair_id, chosen_id, rejected_id): conversation 2i is preferred to 2i + 1, where both exist."""
    ids = conversations.select(F.col("conv_id").cast("long").alias("c")).where("c is not null").distinct()
    by = ids.groupBy(F.floor(F.col("c") / 2).alias("pair_id")).agg(F.min("c").alias("chosen_id"), F.max("c").alias("rejected_id"))
    return by.where("chosen_id <> rejected_id")


def laid(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns array<struct<turn, role, text, shown, start, body>>): each conversation's turns in order.

    shown is the rendered turn, start its first character in the rendering of the whole, body where its text
    starts. Of rows that share conversation and turn the one with the least (role, text) counts; null roles and
    texts render as empty.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    one = conversations.where("conv_id is not null and turn is not null").groupBy(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"))
    rows = one.agg(F.min(F.struct(role.alias("role"), text.alias("text"))).alias("x")).select("conv_id", "turn", "x.role", "x.text")
    shown = rows.withColumn("shown", F.concat(F.lit("<|"), "role", F.lit("|>\n"), "text", F.lit("\n")))
    upto = W.partitionBy("conv_id").orderBy("turn").rowsBetween(W.unboundedPreceding, 0)
    start = F.sum(F.length("shown").cast("long")).over(upto) - F.length("shown")
    put = shown.withColumn("start", start).withColumn("body", F.col("start") + F.length("role") + 5)
    return put.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text", "shown", "start", "body"))).alias("turns"))


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: t["shown"]), "")


def _mask(turns: Column) -> Column:
    """Character ranges of assistant text in the rendered turns, as 'from-to' parted by commas."""
    base = F.coalesce(F.element_at(F.transform(turns, lambda t: t["start"]), 1), F.lit(0))
    own = F.filter(turns, lambda t: t["role"] == "assistant")
    return F.array_join(F.transform(own, lambda t: F.concat((t["body"] - base).cast("string"), F.lit("-"), (t["body"] - base + F.length(t["text"])).cast("string"))), ",")


def preferences(conversations: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row per pair whose conversations both exist: prompt, completions and their masks.

    pairs: (pair_id, chosen_id, rejected_id). A conversation that is a prefix of the other leaves an empty
    completion; without a common first turn the prompt is empty. Empty tables give no rows.
    """
    whole = laid(conversations)
    chosen = whole.select(F.col("conv_id").alias("chosen_id"), F.col("turns").alias("c"))
    rejected = whole.select(F.col("conv_id").alias("rejected_id"), F.col("turns").alias("r"))
    both = pairs.join(chosen, "chosen_id").join(rejected, "rejected_id")
    equal = F.zip_with("c", "r", lambda a, b: F.coalesce((a["role"] == b["role"]) & (a["text"] == b["text"]), F.lit(False)))
    split = F.array_position(equal, False).cast("int")
    same = F.when(split == 0, F.size("c")).otherwise(split - 1)
    cut = both.withColumn("n", same)
    rest = lambda c: F.slice(c, F.col("n") + 1, F.greatest(F.size(c) - F.col("n"), F.lit(0)))
    return cut.select(
        "pair_id", "chosen_id", "rejected_id", F.col("n").cast("long").alias("prompt_turns"), _render(F.slice("c", F.lit(1), F.col("n"))).alias("prompt"),
        _render(rest("c")).alias("chosen"), _mask(rest("c")).alias("chosen_mask"), _render(rest("r")).alias("rejected"), _mask(rest("r")).alias("rejected_mask"),
    )
