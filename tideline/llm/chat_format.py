"""Preference formatting, in DataFrame functions only: a shared prompt and two masked completions for each pair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "<|", "|>"
END = "<|end|>\n"


def render(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), F.coalesce(turn["role"], F.lit("")), F.lit(f"{CLOSE}\n"), F.coalesce(turn["text"], F.lit("")), F.lit(f"\n{END}"))


def conversations_of(turns: DataFrame, name: str, trained_role: str) -> DataFrame:
    """pair_id and the conversation as an array by turn, ties by role and text; a null turn is first. Of each turn: role,
    text, where its rendering ends, counted from the conversation's front, and where what is trained on begins (else null).
    """
    rows = turns.where("pair_id is not null").select("pair_id", "turn", "role", "text")
    size = F.char_length(render(F.struct("role", "text")))
    rows = rows.withColumn("_end", F.sum(size).over(Window.partitionBy("pair_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0)))
    begin = F.when(F.col("role") == trained_role, F.col("_end") - F.char_length(F.coalesce("text", F.lit(""))) - len(f"\n{END}"))
    rows = rows.groupBy("pair_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text", F.col("_end").alias("end"), begin.alias("begin")))).alias("all"))
    return rows.select("pair_id", F.transform("all", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias(name), F.transform("all", lambda x: F.struct(x["begin"].alias("start"), x["end"].alias("end"))).alias(f"{name}_ends"))


def format_preferences(chosen: DataFrame, rejected: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """pair_id, prefix_turns, prompt, chosen, rejected, chosen_mask, rejected_mask for each pair_id on both sides.

    Both inputs have pair_id, turn, role, text. prompt renders the longest prefix of turns with the same role and text on
    both sides, once. A completion renders what follows; its mask is an array of (start, end) in code points of what is
    trained on: the text and end mark of each turn of `trained_role`, not the marks before it. Null roles and texts are
    rendered empty and equal each other. A side that is all prefix has an empty completion and mask. Rows without a
    pair_id, and pairs with one side only, are left out; other columns don't matter. The work grows with the turns of a
    conversation, which is one row: it must fit a task.
    """
    both = conversations_of(chosen, "c", trained_role).join(conversations_of(rejected, "r", trained_role), "pair_id")
    differs = F.array_position(F.zip_with("c", "r", lambda x, y: x.eqNullSafe(y)), False)
    shorter = F.least(F.size("c"), F.size("r"))
    both = both.withColumn("prefix_turns", F.when(differs > 0, F.least(differs - 1, shorter)).otherwise(shorter).cast("int"))

    def completion(side: str) -> tuple[Column, Column]:
        rest = F.slice(F.col(side), F.col("prefix_turns") + 1, F.size(side))
        ends = F.slice(F.col(f"{side}_ends"), F.col("prefix_turns") + 1, F.size(side))
        prompt_end = F.coalesce(F.get(F.col(f"{side}_ends"), F.col("prefix_turns") - 1)["end"], F.lit(0))
        mask = F.transform(F.filter(ends, lambda x: x["start"].isNotNull()), lambda x: F.struct((x["start"] - prompt_end).cast("int").alias("start"), (x["end"] - prompt_end).cast("int").alias("end")))
        return F.array_join(F.transform(rest, render), ""), mask

    (good, good_mask), (bad, bad_mask) = completion("c"), completion("r")
    prompt = F.array_join(F.transform(F.slice(F.col("c"), F.lit(1), F.col("prefix_turns")), render), "")
    return both.select("pair_id", "prefix_turns", prompt.alias("prompt"), good.alias("chosen"), bad.alias("rejected"), good_mask.alias("chosen_mask"), bad_mask.alias("rejected_mask"))
