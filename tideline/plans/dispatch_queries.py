"""Dispatches of every slot's planned actions, the holds of its controls and a report of each slot."""

from pyspark.sql import functions as F

from tideline.operators import dispatch
from tideline.plans.registry import query
from tideline.plans.views import CMD, commands

C = F.col

RUNS = """
plan AS (SELECT slot, row_id AS id, kind AS command, tick + k % 3 AS due FROM cmd),
ledger AS (SELECT slot, row_id AS id, (sec, row_id) AS n, CASE WHEN present IS NULL THEN 'click' ELSE kind END AS command, tick + k % 3 + CAST(cents % 50 = 0 AS INT) AS due, CASE WHEN yaw IS NOT NULL THEN client_tick END AS elapsed,
  CASE WHEN dx IS NULL THEN tick ELSE client_tick END AS derived, sec AS wall_before, sec + k - 3 AS wall_after, alive FROM cmd WHERE alive),
j0 AS (SELECT l.*, p.id IS NOT NULL AND l.command = p.command AND l.due = p.due AS matched, coalesce(elapsed >= 0 AND elapsed = derived, false) AS consistent, CASE WHEN elapsed >= 0 THEN elapsed END AS e,
  CASE WHEN wall_after >= wall_before THEN wall_after END AS w FROM ledger l LEFT JOIN plan p ON p.slot = l.slot AND p.id = l.id),
j1 AS (SELECT *, last_value(e IGNORE NULLS) OVER o AS le, last_value(w IGNORE NULLS) OVER o AS lw, CASE WHEN matched AND consistent THEN elapsed - due END AS lateness, CASE WHEN w IS NOT NULL THEN wall_after - wall_before END AS call
  FROM j0 WINDOW o AS (PARTITION BY slot ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
judged AS (SELECT *, concat_ws(',', CASE WHEN e IS NULL THEN 'invalid_elapsed' END, CASE WHEN e < le THEN 'elapsed_regressed' END, CASE WHEN NOT consistent THEN 'clocks_disagree' END, CASE WHEN w IS NULL THEN 'invalid_wall' END,
  CASE WHEN w IS NOT NULL AND wall_before < lw THEN 'wall_regressed' END, CASE WHEN NOT matched THEN 'not_as_planned' END, CASE WHEN lateness < 0 THEN 'early' END) AS issues FROM j1)"""


def plan_and_log(spark, d):
    """Every command is planned; those that are no errors were dispatched, some as another command or for another tick."""
    c = commands(spark, d)
    at = C("tick") + C("k") % 3
    log = c.where("alive").select(
        "slot",
        C("row_id").alias("id"),
        F.struct("sec", "row_id").alias("n"),
        F.when(C("present").isNull(), "click").otherwise(C("kind")).alias("command"),
        (at + (C("cents") % 50 == 0).cast("int")).alias("at"),
        F.when(C("yaw").isNotNull(), C("client_tick")).alias("elapsed"),
        F.when(C("dx").isNull(), C("tick")).otherwise(C("client_tick")).alias("derived"),
        C("sec").alias("wall_before"),
        (C("sec") + C("k") - 3).alias("wall_after"),
    )
    return c.select("slot", C("row_id").alias("id"), C("kind").alias("command"), at.alias("at")), log


@query("SELECT id, matched, consistent, lateness, call, issues FROM judged", CMD, RUNS)
def dom_48_dispatches(spark, d):
    """Each dispatch against its plan and its clocks."""
    out = dispatch.dispatches(*plan_and_log(spark, d), ["slot"], C("derived"))
    return out.select("id", "matched", "consistent", "lateness", "call", F.array_join("issues", ",").alias("issues"))


@query(
    """SELECT slot, planned, in_order, coalesce(dispatched, 0) AS dispatched, coalesce(matched, 0) AS matched, coalesce(with_issues, 0) AS with_issues, least, middle, high, most, longest_call, coalesce(missing, 0) AS missing FROM (
      SELECT slot, count(id) AS planned, bool_and(id IS NOT DISTINCT FROM lid) AS in_order FROM (SELECT slot, id, row_number() OVER (PARTITION BY slot ORDER BY due, id) AS place FROM plan) FULL JOIN (SELECT slot, id AS lid, row_number() OVER (PARTITION BY slot ORDER BY n) AS place FROM judged) USING (slot, place) GROUP BY slot)
      LEFT JOIN (SELECT slot, count(*) AS dispatched, count(*) FILTER (matched) AS matched, count(*) FILTER (issues <> '') AS with_issues, min(lateness) AS least, median(lateness) AS middle, quantile_disc(lateness, 0.95) AS high, max(lateness) AS most, max(call) AS longest_call FROM judged GROUP BY slot) USING (slot)
      LEFT JOIN (SELECT slot, count(*) AS missing FROM plan WHERE id NOT IN (SELECT id FROM judged) GROUP BY slot) USING (slot)""",
    CMD,
    RUNS,
)
def dom_48_report(spark, d):
    """Planned, dispatched, matched and missing actions of each slot, and their lateness."""
    plan, log = plan_and_log(spark, d)
    return dispatch.dispatch_report(plan, dispatch.dispatches(plan, log, ["slot"], C("derived")), ["slot"]).withColumn("high", C("high").cast("long"))


@query(
    """SELECT row_id, CASE WHEN down AND was THEN 'duplicate_press' WHEN down AND later THEN 'held' WHEN down THEN 'not_released' WHEN was THEN 'paired' ELSE 'without_press' END AS status, CASE WHEN NOT down AND was THEN b.row_id END AS press, CASE WHEN NOT down AND was THEN tick - b.tick END AS hold FROM (
      SELECT *, last_value(CASE WHEN down AND NOT was THEN {'row_id': row_id, 'tick': tick} END IGNORE NULLS) OVER (PARTITION BY slot, control ORDER BY sec, row_id ROWS UNBOUNDED PRECEDING) AS b FROM (
        SELECT row_id, slot, control, sec, tick, down, coalesce(lag(down) OVER w, false) AS was, coalesce(bool_or(NOT down) OVER (PARTITION BY slot, control ORDER BY sec, row_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), false) AS later
          FROM (SELECT *, p2 & 3 AS control, kind = 'view' AS down FROM cmd WHERE kind IN ('view', 'click')) WINDOW w AS (PARTITION BY slot, control ORDER BY sec, row_id)))""",
    CMD,
)
def dom_48_holds(spark, d):
    """Views press one of four controls of their slot and clicks release it: which belong together, and for how long."""
    rows = commands(spark, d).select("slot", "tick", F.struct("sec", "row_id").alias("n"), C("p2").bitwiseAND(F.lit(3)).alias("control"), F.when(C("kind") == "view", True).when(C("kind") == "click", False).alias("down"))
    return dispatch.holds(rows, ["slot"], "control", "down", "tick").select(C("n.row_id").alias("row_id"), "status", C("press.row_id").alias("press"), "hold")
