"""Candidate windows over all recordings with the hints of their commands, and what button planes prove of each command."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.operators import buttons, discovery
from tideline.plans.registry import query
from tideline.plans.views import STATE, commands, states

C = F.col
ACTIONS = ["reload", "crouch", "jump", "movement_start", "movement_stop", "sustained_attack"]

WINDOWS = """
v AS (SELECT slot, round_id, tick, moving, health, alive AND paused IS DISTINCT FROM true AS ok FROM st),
c0 AS (SELECT *, lag(ok) OVER w AS pok, lag(tick) OVER w AS pt, lag(round_id) OVER w AS pr FROM v WINDOW w AS (PARTITION BY slot ORDER BY tick)),
c1 AS (SELECT *, sum(CASE WHEN pok AND tick - pt <= 240 AND pr = round_id THEN 0 ELSE 1 END) OVER (PARTITION BY slot ORDER BY tick) AS run FROM c0),
c2 AS (SELECT *, (row_number() OVER (PARTITION BY slot, run ORDER BY tick) - 1) // 3 AS chunk FROM c1 WHERE ok),
c3 AS (SELECT *, lag(moving) OVER w AS bm, lag(health) OVER w AS bh FROM c2 WINDOW w AS (PARTITION BY slot, run, chunk ORDER BY tick)),
win AS (SELECT slot, round_id, min(tick) AS start, max(tick) + 1 AS "end", count(*) FILTER (NOT bm AND moving) AS starts, count(*) FILTER (bm AND NOT moving) AS stops, count(*) FILTER (health < bh) AS decreases
  FROM c3 GROUP BY slot, round_id, run, chunk HAVING count(*) = 3)"""

HINTS = """
m0 AS (SELECT w.slot, w.start, w."end", c.tick, c.row_id, present IS NOT NULL AS known, c.tick >= w.start + 20 AS inside, (p1 & 4) <> 0 AS held, (p1 & 4) <> 0 AND (p2 & 4) = 0 AND (p3 & 4) = 0 AS steady,
  ((p1 | p2 | p3) & 16) <> 0 AS reload, ((p1 | p2 | p3) & 32) <> 0 AS crouch, ((p1 | p2 | p3) & 64) <> 0 AS jump, p1 & 3 AS at_end, xor(p1, p2) & 3 AS at_start FROM win w JOIN cmd c ON c.slot = w.slot AND c.tick >= w.start AND c.tick < w."end"),
m1 AS (SELECT *, tick - lag(tick) OVER w AS gap, coalesce(known AND lag(known) OVER w AND tick - lag(tick) OVER w <= 60, false) AS follows, lag(at_end) OVER w AS before_end, coalesce(lag(held) OVER w, false) AS before_held
  FROM m0 WINDOW w AS (PARTITION BY slot, start ORDER BY tick, row_id)),
m2 AS (SELECT *, sum(CASE WHEN known AND steady AND follows AND before_held THEN 0 ELSE 1 END) OVER (PARTITION BY slot, start ORDER BY tick, row_id) AS hold FROM m1),
m3 AS (SELECT *, row_number() OVER w - 1 + CAST(first_value(known AND steady) OVER w AS INT) AS length FROM m2 WINDOW w AS (PARTITION BY slot, start, hold ORDER BY tick, row_id)),
h0 AS (SELECT slot, start, "end", count(*) AS commands, count(*) FILTER (known) AS known, count(*) FILTER (known AND NOT follows) AS boundary_gaps, count(*) FILTER (known AND inside AND reload) AS reload, count(*) FILTER (known AND inside AND crouch) AS crouch,
  count(*) FILTER (known AND inside AND jump) AS jump, count(*) FILTER (known AND follows AND inside AND before_end = at_start AND before_end = 0 AND at_end <> 0) AS movement_start,
  count(*) FILTER (known AND follows AND inside AND before_end = at_start AND before_end <> 0 AND at_end = 0) AS movement_stop, coalesce(max(length) FILTER (inside AND known), 0) AS attack_run,
  greatest(coalesce(max(gap), 0), min(tick) - start, "end" - max(tick)) AS max_gap FROM m3 GROUP BY slot, start, "end"),
hints AS (SELECT w.*, coalesce(commands, 0) AS commands, coalesce(known, 0) AS known, coalesce(commands - known, 0) AS unknown, coalesce(boundary_gaps, 0) AS boundary_gaps, coalesce(reload, 0) AS reload, coalesce(crouch, 0) AS crouch, coalesce(jump, 0) AS jump,
  coalesce(movement_start, 0) AS movement_start, coalesce(movement_stop, 0) AS movement_stop, coalesce(attack_run, 0) AS attack_run, coalesce(attack_run, 0) >= 2 AS sustained_attack, max_gap, coalesce(max_gap <= 120, false) AS covered
  FROM win w LEFT JOIN h0 USING (slot, start))"""


def candidates(spark, d) -> DataFrame:
    """Windows of three sound states of one slot and round, four hours apart at most, with the hints of their commands."""
    found = discovery.state_windows(
        states(spark, d),
        ["slot"],
        "tick",
        C("alive") & ~C("paused").eqNullSafe(True),
        ["round_id"],
        3,
        240,
        {"starts": lambda before: ~before("moving") & C("moving"), "stops": lambda before: before("moving") & ~C("moving"), "decreases": lambda before: C("health") < before("health")},
    )
    rows = commands(spark, d).select("slot", "tick", "row_id", "p1", "p2", "p3", "present")
    near = lambda before: C("tick") - before("tick") <= 60
    return discovery.action_hints(found, rows, ["slot"], "tick", ["tick", "row_id"], ["p1", "p2", "p3"], C("present").isNotNull(), near, {"reload": 16, "crouch": 32, "jump": 64}, [1, 2], 4, 20, 120, 2)


@query("SELECT * FROM hints", STATE, WINDOWS, HINTS)
def dom_39_discovery(spark, d):
    """Every candidate window with its states' evidence, its commands' hints and whether commands cover it."""
    return candidates(spark, d)


REPORT = ", ".join(f"count(*) FILTER (CAST({a} AS BIGINT) > 0) AS n_{a}, count(*) FILTER (CAST({a} AS BIGINT) > 0 AND covered) AS eligible_{a}" for a in ACTIONS)


@query(f"SELECT round_id, count(*) AS candidates, count(*) FILTER (covered) AS eligible, CAST(sum(known) AS BIGINT) AS known, CAST(sum(unknown) AS BIGINT) AS unknown, {REPORT} FROM hints GROUP BY round_id", STATE, WINDOWS, HINTS)
def dom_39_coverage(spark, d):
    """How many candidates of each round there are, are covered, and hint at each action."""
    return discovery.coverage_report(candidates(spark, d), ["round_id"], ACTIONS)


MASKS = {"attack": 1, "jump": 2, "crouch": 4, "forward": 8}

PROOFS = f"""
q0 AS (SELECT slot, round_id, row_id, tick, present, kind, CASE WHEN present THEN p1 END AS q1, CASE WHEN present THEN p2 END AS q2, CASE WHEN present THEN CASE WHEN k % 7 <> 0 THEN p3 ELSE 0 END END AS q3 FROM cmd),
q AS (SELECT *, CASE WHEN tick - lag(tick) OVER w BETWEEN 0 AND 720 THEN xor(lag(q1) OVER w, xor(q1, q2)) & 15 END AS apart FROM q0 WINDOW w AS (PARTITION BY slot, round_id ORDER BY row_id)),
proof AS (SELECT *, CASE WHEN apart IS NULL THEN 0 ELSE 4 END AS compared, concat_ws(',', {', '.join(f"CASE WHEN (apart & {m}) <> 0 THEN '{n}' END" for n, m in MASKS.items())}) AS contradicted,
  concat_ws(',', CASE WHEN present IS NULL THEN 'button_parent_unknown' WHEN NOT present THEN 'missing_button_parent' END, CASE WHEN kind = 'error' THEN 'source_not_bound' END) AS reasons FROM q),
judged AS (SELECT *, CASE WHEN reasons = '' AND coalesce(apart, 0) <> 15 THEN 'verified' ELSE 'unknown' END AS status FROM proof)"""


def button_proofs(spark, d) -> DataFrame:
    """Commands with four buttons; one plane is sometimes absent, and errors are bound to no source."""
    rows = commands(spark, d).select("slot", "round_id", "row_id", "tick", "present", "kind", "p1", "p2", F.when(C("k") % 7 != 0, C("p3")).alias("p3"))
    return buttons.button_proofs(rows, ["slot", "round_id"], "row_id", ["p1", "p2", "p3"], C("present"), C("kind") != "error", {"tick": (0, 720)}, MASKS)


@query("SELECT row_id, status, reasons, contradicted, compared FROM judged", STATE, PROOFS)
def dom_37_proofs(spark, d):
    """What each command proves of its buttons, and why not more."""
    return button_proofs(spark, d).select("row_id", "status", F.array_join("reason_codes", ",").alias("reasons"), F.array_join("contradicted", ",").alias("contradicted"), "compared")


@query("SELECT slot, count(*) FILTER (status = 'verified') AS verified, count(*) FILTER (status = 'unknown') AS unknown, count(*) FILTER (NOT present) AS missing_parents, CAST(sum(compared) AS BIGINT) AS comparisons, CAST(sum(bit_count(coalesce(apart, 0))) AS BIGINT) AS mismatches FROM judged GROUP BY slot", STATE, PROOFS)
def dom_37_summary(spark, d):
    """Proven and unknown commands of each slot, and how its buttons' boundaries agree."""
    return buttons.proof_summary(button_proofs(spark, d), ["slot"])


STATES = " UNION ALL ".join(
    f"SELECT slot, '{n}' AS button, CAST((q1 & {m}) <> 0 AS INT) + 2 * CAST((q2 & {m}) <> 0 AS INT) + 4 * CAST((q3 & {m}) <> 0 AS INT) AS code, status = 'verified' AND (coalesce(apart, 0) & {m}) = 0 AS fine FROM judged WHERE present"
    for n, m in MASKS.items()
)


@query(f"SELECT slot, button, code, count(*) AS n, count(*) FILTER (fine) AS verified FROM ({STATES}) GROUP BY slot, button, code", STATE, PROOFS)
def dom_37_state_counts(spark, d):
    """How often each button of a slot was in each of its eight states."""
    return buttons.state_counts(button_proofs(spark, d), ["slot"])
