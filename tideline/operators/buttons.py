"""What recorded button planes prove, command by command: states, boundaries held against the command before, reasons."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.functions.bits import decode

C = F.col


def button_proofs(commands: DataFrame, keys: list[str], order: str, planes: list[str], parent: Column, bound: Column, steps: dict[str, tuple[int, int]], masks: dict[str, int]) -> DataFrame:
    """commands with `codes` (each button's state code), `compared`, `contradicted`, `reason_codes` and `status`.

    A plane that is absent is 0 if its parent is there. With no parent, or an unknown one, there are no codes, and the
    reason is missing_button_parent or button_parent_unknown; a command whose source is not `bound`, or not known to be,
    has the reason source_not_bound, and keeps its codes. A command follows the one before it in its keys if each clock of
    `steps` has gone on by a step within its bounds; then, if both have codes, their buttons are `compared`, and those that
    were held at the end of the one and not at the start of the other, or the other way, are `contradicted`. A command
    without reasons is verified unless all its buttons are contradicted; any other is unknown. Masks are single bits.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    there = F.coalesce(parent, F.lit(False))
    p1, p2, p3 = (F.when(there, F.coalesce(C(p), F.lit(0)).cast("long")) for p in planes)
    rows = commands.withColumns({"_p1": p1, "_p2": p2, "_p3": p3, "_parent": parent, "_bound": F.coalesce(bound, F.lit(False))})
    follows = reduce(lambda a, b: a & b, ((C(c) - F.lag(c).over(w)).between(lo, hi) for c, (lo, hi) in steps.items()))
    rows = rows.withColumn("_before", F.when(follows, F.lag("_p1").over(w)))
    apart = C("_before").bitwiseXOR(C("_p1")).bitwiseXOR(C("_p2"))
    every = F.create_map(*(x for n, m in masks.items() for x in (F.lit(n), decode(C("_p1"), C("_p2"), C("_p3"), m)["code"])))
    reasons = F.array_compact(
        F.array(
            F.when(C("_parent").isNull(), F.lit("button_parent_unknown")).when(~C("_parent"), F.lit("missing_button_parent")),
            F.when(~C("_bound"), F.lit("source_not_bound")),
        )
    )
    rows = rows.withColumns(
        {
            "codes": F.when(C("_p1").isNotNull(), every),
            "compared": F.when(apart.isNotNull(), len(masks)).otherwise(0),
            "contradicted": F.array_compact(F.array(*(F.when(apart.bitwiseAND(F.lit(m)) != 0, F.lit(n)) for n, m in masks.items()))),
            "reason_codes": reasons,
        }
    )
    fine = (F.size("reason_codes") == 0) & (F.size("contradicted") < len(masks))
    return rows.withColumn("status", F.when(fine, "verified").otherwise("unknown")).drop("_p1", "_p2", "_p3", "_parent", "_bound", "_before")


def proof_summary(proofs: DataFrame, keys: list[str]) -> DataFrame:
    """Of each key: verified and unknown commands, those without a parent, comparisons of buttons and contradicted ones."""
    return proofs.groupBy(*keys).agg(
        F.count_if(C("status") == "verified").alias("verified"),
        F.count_if(C("status") == "unknown").alias("unknown"),
        F.count_if(F.array_contains("reason_codes", "missing_button_parent")).alias("missing_parents"),
        F.sum("compared").alias("comparisons"),
        F.sum(F.size("contradicted")).alias("mismatches"),
    )


def state_counts(proofs: DataFrame, keys: list[str]) -> DataFrame:
    """How often each button of a key was in each state; `verified` counts the commands that prove it, uncontradicted."""
    rows = proofs.select(*keys, "status", "contradicted", F.explode("codes").alias("button", "code"))
    proven = (C("status") == "verified") & ~F.array_contains("contradicted", C("button"))
    return rows.groupBy(*keys, "button", "code").agg(F.count("*").alias("n"), F.count_if(proven).alias("verified"))
