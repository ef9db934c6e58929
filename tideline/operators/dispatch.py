"""Dispatches of planned actions against their plan: clocks, lateness, holds of controls, and a report of each run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.operators.aggregates import nearest_rank

C = F.col


def dispatches(plan: DataFrame, log: DataFrame, run: list[str], derived: Column) -> DataFrame:
    """log with `matched`, `consistent`, `lateness`, `call` and `issues`.

    plan has run, id (unique in a run), command and at; log has run, n (its order), id, command, at, elapsed, wall_before
    and wall_after. A dispatch is matched if it is the first of its id in its run and the plan has the id with the same
    command and at; it is consistent if elapsed is known, not negative and equals `derived`, what another clock of the log
    says. lateness is elapsed - at where both hold, call is wall_after - wall_before where that is known and not negative.
    issues, in this order: invalid_elapsed, elapsed_regressed (below the last valid one before), clocks_disagree,
    invalid_wall, wall_regressed (begun before the end of the last valid call before), not_as_planned, early.
    """
    w = Window.partitionBy(*run).orderBy("n")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    due = plan.select(*run, "id", C("command").alias("_command"), C("at").alias("_at"), F.lit(True).alias("_planned"))
    rows = log.withColumn("_first", F.row_number().over(Window.partitionBy(*run, "id").orderBy("n")) == 1).join(due, [*run, "id"], "left")
    sound = F.coalesce(C("elapsed") >= 0, F.lit(False))
    fine = F.coalesce(C("wall_after") >= C("wall_before"), F.lit(False))
    rows = rows.withColumns({"_elapsed": F.when(sound, C("elapsed")), "_end": F.when(fine, C("wall_after"))})
    rows = rows.withColumns(
        {
            "matched": F.coalesce(C("_planned") & C("_first") & C("command").eqNullSafe(C("_command")) & C("at").eqNullSafe(C("_at")), F.lit(False)),
            "consistent": F.coalesce(C("_elapsed") == derived, F.lit(False)),
            "_last": F.last("_elapsed", ignorenulls=True).over(before),
            "_wall": F.last("_end", ignorenulls=True).over(before),
            "call": F.when(C("_end").isNotNull(), C("wall_after") - C("wall_before")),
        }
    ).withColumn("lateness", F.when(C("matched") & C("consistent"), C("elapsed") - C("at")))
    rules = {
        "invalid_elapsed": C("_elapsed").isNull(),
        "elapsed_regressed": C("_elapsed") < C("_last"),
        "clocks_disagree": ~C("consistent"),
        "invalid_wall": C("_end").isNull(),
        "wall_regressed": C("_end").isNotNull() & (C("wall_before") < C("_wall")),
        "not_as_planned": ~C("matched"),
        "early": C("lateness") < 0,
    }
    rows = rows.withColumn("issues", F.array_compact(F.array(*(F.when(c, F.lit(k)) for k, c in rules.items()))))
    return rows.select(*log.columns, "matched", "consistent", "lateness", "call", "issues")


def holds(events: DataFrame, run: list[str], control: str, pressed: str, at: str) -> DataFrame:
    """events (pressed or released, in the order n) with `status`, `press` and `hold`.

    A press is `held` if a release follows before the run ends, else not_released; while a control is held, another is a
    duplicate_press. A release is `paired` with the press that began the hold (`press` is its n, `hold` the difference of
    their `at`), or without_press. Rows that don't say which of both they are, are left out.
    """
    w = Window.partitionBy(*run, control).orderBy("n")
    rows = events.where(C(pressed).isNotNull()).withColumn("_was", F.coalesce(F.lag(pressed).over(w), F.lit(False)))
    begun = F.when(C(pressed) & ~C("_was"), F.struct("n", C(at).alias("at")))
    later = F.max(~C(pressed)).over(w.rowsBetween(1, Window.unboundedFollowing))
    rows = rows.withColumns({"_begun": F.last(begun, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)), "_later": F.coalesce(later, F.lit(False))})
    status = F.when(C(pressed) & C("_was"), "duplicate_press").when(C(pressed), F.when(C("_later"), "held").otherwise("not_released")).when(C("_was"), "paired").otherwise("without_press")
    rows = rows.withColumn("status", status)
    paired = C("status") == "paired"
    return rows.select(*events.columns, "status", F.when(paired, C("_begun.n")).alias("press"), F.when(paired, C(at) - C("_begun.at")).alias("hold"))


def dispatch_report(plan: DataFrame, judged: DataFrame, run: list[str]) -> DataFrame:
    """Of each run: planned, dispatched, matched and missing actions, dispatches with issues, whether both are in the same
    order (the plan's by at, then id), and least, median, 95 % (nearest rank) and largest lateness, and the longest call."""
    planned = plan.select(*run, "id", F.row_number().over(Window.partitionBy(*run).orderBy("at", "id")).alias("place"))
    logged = judged.select(*run, C("id").alias("_id"), F.row_number().over(Window.partitionBy(*run).orderBy("n")).alias("place"))
    order = planned.join(logged, [*run, "place"], "full_outer").groupBy(*run).agg(F.count("id").alias("planned"), F.min(C("id").eqNullSafe(C("_id"))).alias("in_order"))
    gone = plan.join(judged.select(*run, "id").distinct(), [*run, "id"], "left_anti").groupBy(*run).agg(F.count("*").alias("missing"))
    stats = judged.groupBy(*run).agg(
        F.count("*").alias("dispatched"),
        F.count_if("matched").alias("matched"),
        F.count_if(F.size("issues") > 0).alias("with_issues"),
        F.min("lateness").alias("least"),
        F.median("lateness").alias("middle"),
        nearest_rank("lateness", 0.95).alias("high"),
        F.max("lateness").alias("most"),
        F.max("call").alias("longest_call"),
    )
    out = order.join(stats, run, "left").join(gone, run, "left")
    return out.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("dispatched", "matched", "with_issues", "missing")})
