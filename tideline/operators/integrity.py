"""The checks of an extraction as a whole: errors, which refuse it, apart from warnings, each counted by player or table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.operators import scans
from tideline.operators.windows import repeated_within

ERROR, WARNING = "error", "warning"
C = F.col


def _issues(counts: DataFrame, scope: Column, rules: dict[str, tuple[str, Column]]) -> DataFrame:
    """scope, code, severity, n of each rule that counts something."""
    each = F.array(*(F.struct(F.lit(code).alias("code"), F.lit(severity).alias("severity"), n.cast("long").alias("n")) for code, (severity, n) in rules.items()))
    return counts.select(scope.cast("string").alias("scope"), F.explode(each).alias("x")).select("scope", "x.*").where("n > 0")


def command_issues(commands: DataFrame, recent: int = 4096) -> DataFrame:
    """By slot: gaps and reversals of numbers and ticks, commands repeated within `recent`, numbers out of range, and view
    angles and buttons that are missing: in some commands a warning, in all of them an error."""
    w = Window.partitionBy("slot").orderBy("row_id")
    rows = repeated_within(commands, "slot", ["tick", "number"], "row_id", recent)
    rows = rows.withColumns({"_number": F.lag("number").over(w), "_tick": F.lag("tick").over(w)})
    odd = ~C("pitch").between(-90, 90) | ~C("yaw").between(-180, 180) | ~C("p1").between(0, 255)
    n = rows.groupBy("slot").agg(
        F.count("*").alias("n"),
        F.count_if(C("number") > C("_number") + 1).alias("gaps"),
        F.count_if(C("number") <= C("_number")).alias("reversals"),
        F.count_if(C("tick") < C("_tick")).alias("ticks_back"),
        F.count_if("duplicate").alias("repeated"),
        F.count_if(odd).alias("odd"),
        F.count_if(C("yaw").isNull()).alias("no_view"),
        F.count_if(C("present").isNull()).alias("no_buttons"),
    )
    all_, some = (lambda c: F.when(C(c) == C("n"), C(c)).otherwise(0)), (lambda c: F.when(C(c) < C("n"), C(c)).otherwise(0))
    rules = {
        "number_gaps": (WARNING, C("gaps")),
        "number_reversals": (WARNING, C("reversals")),
        "tick_reversals": (WARNING, C("ticks_back")),
        "repeated_commands": (WARNING, C("repeated")),
        "numbers_out_of_range": (ERROR, C("odd")),
        "all_view_angles_missing": (ERROR, all_("no_view")),
        "some_view_angles_missing": (WARNING, some("no_view")),
        "all_buttons_missing": (ERROR, all_("no_buttons")),
        "some_buttons_missing": (WARNING, some("no_buttons")),
    }
    return _issues(n, F.concat(F.lit("slot:"), C("slot").cast("string")), rules)


def order_issues(commands: DataFrame) -> DataFrame:
    """Rows whose id isn't one more than the id before it, of the whole table, which is one key."""
    rows = scans.previous(scans.ranged(commands.select("row_id"), [], ["row_id"]), [], ["row_id"], ["row_id"])
    broken = rows.agg(F.count_if(C("previous_row") & (C("row_id") != C("previous_row_id") + 1)).alias("n"))
    return _issues(broken, F.lit("commands"), {"command_row_order": (ERROR, C("n"))})


def state_issues(states: DataFrame) -> DataFrame:
    """By slot: changes of the identity behind it."""
    w = Window.partitionBy("slot").orderBy("tick")
    n = states.withColumn("_user", F.lag("user_id").over(w)).groupBy("slot").agg(F.count_if(C("_user") != C("user_id")).alias("n"))
    return _issues(n, F.concat(F.lit("slot:"), C("slot").cast("string")), {"identity_changes": (WARNING, C("n"))})


def round_issues(rounds: DataFrame) -> DataFrame:
    """Rounds that are there twice, end before they start or thaw before they start; and no rounds at all."""
    per = rounds.groupBy("round_id").agg((F.count("*") - 1).alias("again"), F.count_if((C("end") < C("start")) | (C("freeze_end") < C("start"))).alias("backwards"), F.count_if(C("end").isNull()).alias("unended"))
    n = per.agg(F.count("*").alias("rounds"), F.coalesce(F.sum("again"), F.lit(0)).alias("again"), F.coalesce(F.sum("backwards"), F.lit(0)).alias("backwards"), F.coalesce(F.sum("unended"), F.lit(0)).alias("unended"))
    rules = {"no_rounds": (ERROR, (C("rounds") == 0).cast("int")), "repeated_rounds": (ERROR, C("again")), "rounds_backwards": (ERROR, C("backwards")), "rounds_without_end": (WARNING, C("unended"))}
    return _issues(n, F.lit("rounds"), rules)


def count_issues(commands: DataFrame, states: DataFrame, stated: dict[str, int]) -> DataFrame:
    """What a manifest states (commands, states, eligible, rejected) against what is there, by how much they differ."""
    n = commands.agg(F.count("*").alias("c")).crossJoin(states.agg(F.count("*").alias("s")))
    rules = {
        "command_count_mismatch": (ERROR, F.abs(C("c") - stated["commands"])),
        "state_count_mismatch": (ERROR, F.abs(C("s") - stated["states"])),
        "unaccounted_payloads": (ERROR, F.abs(F.lit(stated["eligible"]) - C("c") - stated["rejected"])),
        "no_commands": (ERROR, (C("c") == 0).cast("int")),
        "no_states": (ERROR, (C("s") == 0).cast("int")),
    }
    return _issues(n, F.lit("manifest"), rules)


def integrity(commands: DataFrame, states: DataFrame, rounds: DataFrame, stated: dict[str, int]) -> DataFrame:
    """scope, code, severity, n of every check that found something; without errors an extraction passes."""
    parts = [command_issues(commands), order_issues(commands), state_issues(states), round_issues(rounds), count_issues(commands, states, stated)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def passes(issues: DataFrame) -> bool:
    return issues.where(C("severity") == ERROR).isEmpty()
