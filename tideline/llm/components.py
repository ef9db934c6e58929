"""Connected components of an edge list by contraction; every step is a join or an aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.shared import forget, stored


def components(edges: DataFrame) -> DataFrame:
    """node, component: the smallest node that each node of `edges` (a long, b long) reaches.

    Each round maps every node to the least of itself and its neighbours, follows that map to its end, and renames both
    ends of the edges. The map's end is found by joining it with itself, which doubles the steps that it takes, so a chain
    of any length, in the order of its ids, is one round of as many joins as its length has binary digits. What a round
    leaves are nodes smaller than all their neighbours: under half of those of a chain in any order, and of a star none
    but its least after two rounds. The smallest node keeps its name. Nulls are dropped; loops and repeated edges do no
    harm; without edges the result is empty.
    """
    edges = stored(edges.where("a is not null and b is not null").select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")), "edges")
    maps: list[DataFrame] = []
    while True:
        n = edges.count()
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = _followed(stored(both.groupBy("a").agg(F.least("a", F.min("b")).alias("to")).withColumnRenamed("a", "node"), "least", 2 * n), 2 * n)
        maps.append(least)
        onto = least.select(F.col("node").alias("a"), F.col("to").alias("to_a"))
        to = least.select(F.col("node").alias("b"), F.col("to").alias("to_b"))
        left = edges.join(onto, "a").join(to, "b").where("to_a != to_b").select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b"))
        left = stored(left.distinct() if len(maps) > 1 else left, "edges", n)
        forget(edges)
        edges = left
        if edges.isEmpty():
            break
    #: From the last map, which is the smallest, to the first: each step is one join, written before the next.
    out = maps.pop().withColumnRenamed("to", "component")
    while maps:
        step = maps.pop()
        ends = out.withColumnRenamed("node", "to")
        folded = stored(step.join(ends, "to", "left").select("node", F.coalesce("component", "to").alias("component")), "components")
        forget(step)
        forget(out)
        out = folded
    return out


def _followed(steps: DataFrame, rows: int) -> DataFrame:
    """steps (node, to) with each `to` replaced by where it leads in the end; every `to` is a node, and a root its own."""
    while True:
        moving = steps.where("node != to")
        further = steps.select(F.col("node").alias("to"), F.col("to").alias("end")).where("to != end")
        if moving.join(further, "to", "left_semi").isEmpty():
            return steps
        twice = stored(steps.join(further, "to", "left").select("node", F.coalesce("end", "to").alias("to")), "least", rows)
        forget(steps)
        steps = twice
