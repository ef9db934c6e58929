"""Queries of calibrations and audits: control windows, pixels, commands, turns, insertions, compiled counts."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tideline.functions import reasons
from tideline.functions.angles import interpolate_degrees, wrap_degrees
from tideline.operators import labels, responses, windows
from tideline.plans.label_queries import JOINED
from tideline.plans.registry import query
from tideline.plans.views import CMD, STATE, WRAP, commands, states

C = F.col

AUDIT = """
, co AS (SELECT c.*, s.paused, s.alive AS state_alive FROM cmd c JOIN st s USING (slot, tick)),
win AS (SELECT *, lead(user_id) OVER w AS user_1, lead(tick, 4) OVER w AS tick_4, lead(row_id, 2) OVER w AS r2, lead(row_id, 3) OVER w AS r3, lead(row_id, 4) OVER w AS r4,
  coalesce(lead(dx, 2) OVER w, 0) + coalesce(lead(dx, 3) OVER w, 0) + coalesce(lead(dx, 4) OVER w, 0) AS moved,
  bool_and(state_alive) OVER f AS all_alive, count(paused) OVER f = count(*) OVER f AS known, bool_or(paused) OVER f AS any_paused
  FROM co WINDOW w AS (PARTITION BY slot ORDER BY row_id), f AS (PARTITION BY slot ORDER BY row_id ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)),
au AS (SELECT row_id, moved, """ + JOINED.format(
    r="CASE WHEN user_1 <> user_id THEN 'source_normalization_predecessor_disagrees' END, CASE WHEN k % 17 = 0 THEN 'source_first_target_disagrees' END, CASE WHEN client_tick + 4 > tick + 4 + k % 3 THEN 'control_window_exceeds_verified_source_horizon' END, CASE WHEN r2 % 13 = 0 OR r3 % 13 = 0 OR r4 % 13 = 0 THEN 'contributing_live_source_envelope_unavailable_or_ambiguous' END, CASE WHEN r4 IS NULL THEN 'complete_control_window_unavailable' END, CASE WHEN tick_4 - tick > 20000 THEN 'control_state_window_out_of_supported_range' END, CASE WHEN NOT all_alive THEN 'alive_not_true' END, CASE WHEN NOT known THEN 'pause_unknown' END, CASE WHEN any_paused THEN 'pause_active' END"
) + " AS reasons FROM win WHERE kind = 'view')"


@query("SELECT row_id, reasons = '' AS eligible, reasons, CASE WHEN reasons = '' THEN moved END AS delta FROM au", STATE + AUDIT)
def dom_32_control_audit(spark, d):
    """The control window of each observation (the second to the fourth command after it), with every reason against it:
    of its source, its horizon, its envelopes, and the player's state over the whole window. A window with a reason has
    no delta."""
    s = states(spark, d).select("slot", "tick", "paused", C("alive").alias("state_alive"))
    w = Window.partitionBy("slot").orderBy("row_id")
    f = w.rowsBetween(0, 4)
    rows = commands(spark, d).join(s, ["slot", "tick"])
    rows = rows.withColumns({"user_1": F.lead("user_id").over(w), "tick_4": F.lead("tick", 4).over(w), **{f"r{k}": F.lead("row_id", k).over(w) for k in (2, 3, 4)}})
    moved = sum((F.coalesce(F.lead("dx", k).over(w), F.lit(0)) for k in (2, 3, 4)), F.lit(0))
    rows = rows.withColumns({"moved": moved, "all_alive": F.min("state_alive").over(f), "known": F.count("paused").over(f) == F.count("*").over(f), "any_paused": F.max("paused").over(f)}).where("kind = 'view'")
    why = labels.sorted_reasons(
        [
            (C("user_1") != C("user_id"), reasons.SOURCE_NORMALIZATION_PREDECESSOR_DISAGREES),
            (C("k") % 17 == 0, reasons.SOURCE_FIRST_TARGET_DISAGREES),
            (C("client_tick") + 4 > C("tick") + 4 + C("k") % 3, reasons.CONTROL_WINDOW_EXCEEDS_VERIFIED_SOURCE_HORIZON),
            (F.exists(F.array("r2", "r3", "r4"), lambda r: r % 13 == 0), reasons.CONTRIBUTING_LIVE_SOURCE_ENVELOPE_UNAVAILABLE_OR_AMBIGUOUS),
            (C("r4").isNull(), reasons.COMPLETE_CONTROL_WINDOW_UNAVAILABLE),
            (C("tick_4") - C("tick") > 20000, reasons.CONTROL_STATE_WINDOW_OUT_OF_SUPPORTED_RANGE),
            (~C("all_alive"), reasons.ALIVE_NOT_TRUE),
            (~C("known"), reasons.PAUSE_UNKNOWN),
            (C("any_paused"), reasons.PAUSE_ACTIVE),
        ]
    )
    cell = labels.masked(C("moved"), why)
    return rows.select("row_id", cell.alias("c"), why.alias("r")).select("row_id", C("c.valid").alias("eligible"), F.array_join("r", ",").alias("reasons"), C("c.value").alias("delta"))


@query(
    "SELECT slot, count(*) AS frames, count(*) FILTER (n IS NULL) AS missing, count(*) FILTER (n > 1) AS ambiguous, count(*) FILTER (n = 1 AND NOT sized) AS other_size, count(*) FILTER (n = 1 AND sized AND seen = x) AS matched, count(*) FILTER (n = 1 AND sized AND seen <> x) AS other_pixels, count(*) FILTER (paused = false) AS stable, count(DISTINCT x) AS images, count(*) FILTER (x = before) AS repeats FROM (SELECT s.slot, s.x, s.paused, r.n, r.sized, r.seen, lag(x) OVER (PARTITION BY s.slot ORDER BY s.tick) AS before FROM st s LEFT JOIN (SELECT slot, tick, count(*) AS n, bool_and(k % 7 <> 0) AS sized, CAST(sum(cents) AS BIGINT) AS seen FROM cmd WHERE kind IN ('view', 'click') GROUP BY 1, 2) r ON r.slot = s.slot AND r.tick = s.tick) GROUP BY slot",
    STATE,
)
def dom_52_pixel_audit(spark, d):
    """The frames of each player against what was read back: exactly one readback each, of one size and equal pixels; how
    many were stable, how many images differ and how many repeat the one before."""
    read = commands(spark, d).where("kind in ('view', 'click')").groupBy("slot", "tick").agg(F.count("*").alias("n"), F.min(C("k") % 7 != 0).alias("sized"), F.sum("cents").alias("seen"))
    rows = states(spark, d).withColumn("before", F.lag("x").over(Window.partitionBy("slot").orderBy("tick"))).join(read, ["slot", "tick"], "left")
    one = (C("n") == 1) & C("sized")
    return rows.groupBy("slot").agg(
        F.count("*").alias("frames"),
        F.count_if(C("n").isNull()).alias("missing"),
        F.count_if(C("n") > 1).alias("ambiguous"),
        F.count_if((C("n") == 1) & ~C("sized")).alias("other_size"),
        F.count_if(one & (C("seen") == C("x"))).alias("matched"),
        F.count_if(one & (C("seen") != C("x"))).alias("other_pixels"),
        F.count_if(~C("paused")).alias("stable"),
        F.count_distinct("x").alias("images"),
        F.count_if(C("x") == C("before")).alias("repeats"),
    )


SUMMARY = f"""
, dup AS (SELECT slot, count(*) AS repeated FROM (SELECT slot, user_id, number FROM cmd GROUP BY 1, 2, 3 HAVING count(*) > 1) GROUP BY slot),
chg AS (SELECT slot, count(*) AS transitions FROM (SELECT slot, kind, yaw, lag(kind) OVER w AS pk, lag(yaw) OVER w AS py FROM cmd WINDOW w AS (PARTITION BY slot, user_id, round_id ORDER BY row_id)) WHERE pk <> kind OR abs({WRAP.format(d="yaw - py")}) > 0.10005 GROUP BY slot),
near AS (SELECT p.slot, count(*) AS neighbours FROM cmd p JOIN cmd q ON q.slot = p.slot AND q.user_id = p.user_id AND q.number BETWEEN p.number - 2 AND p.number + 8 WHERE p.kind = 'purchase' GROUP BY p.slot)"""


@query(
    "SELECT slot, commands, eligible, lowest, highest, coalesce(repeated, 0) AS repeated, coalesce(transitions, 0) AS transitions, coalesce(neighbours, 0) AS neighbours, "
    + JOINED.format(r="CASE WHEN commands <> eligible THEN 'incomplete_command_reconstruction' END, CASE WHEN repeated > 0 THEN 'ambiguous_command_number_identity' END, CASE WHEN unread > 0 THEN 'canonical_command_projection_requires_review' END")
    + " AS issues FROM (SELECT slot, count(*) FILTER (yaw IS NOT NULL) AS commands, count(*) AS eligible, min(number) AS lowest, max(number) AS highest, count(*) FILTER (dx IS NULL AND present IS NULL) AS unread FROM cmd GROUP BY slot) LEFT JOIN dup USING (slot) LEFT JOIN chg USING (slot) LEFT JOIN near USING (slot)",
    CMD + SUMMARY,
)
def dom_54_command_summary(spark, d):
    """Of each player: how many of the payloads became commands, the range of their numbers, numbers that stand twice,
    changes from one command to the next, the commands around each dispatch, and what has to be looked at."""
    from tideline.operators.joins import band_join

    c = commands(spark, d)
    rows = c.groupBy("slot").agg(F.count("yaw").alias("commands"), F.count("*").alias("eligible"), F.min("number").alias("lowest"), F.max("number").alias("highest"), F.count_if(C("dx").isNull() & C("present").isNull()).alias("unread"))
    twice = c.groupBy("slot", "user_id", "number").count().where("count > 1").groupBy("slot").agg(F.count("*").alias("repeated"))
    w = Window.partitionBy("slot", "user_id", "round_id").orderBy("row_id")
    moves = c.select("slot", (F.lag("kind").over(w) != C("kind")).alias("a"), (F.abs(wrap_degrees(C("yaw") - F.lag("yaw").over(w))) > 0.10005).alias("b")).where("a or b").groupBy("slot").agg(F.count("*").alias("transitions"))
    near = band_join(c.where("kind = 'purchase'").select("slot", "user_id", "number"), c.select("slot", "user_id", C("number").alias("m")), ("slot", "user_id"), "number", "m", 2, 8)
    near = near.where("m is not null").groupBy("slot").agg(F.count("*").alias("neighbours"))
    for more in (twice, moves, near):
        rows = rows.join(more, "slot", "left")
    rows = rows.fillna(0, ["repeated", "transitions", "neighbours"])
    issues = labels.sorted_reasons([(C("commands") != C("eligible"), reasons.INCOMPLETE_COMMAND_RECONSTRUCTION), (C("repeated") > 0, reasons.AMBIGUOUS_COMMAND_NUMBER_IDENTITY), (C("unread") > 0, reasons.CANONICAL_COMMAND_PROJECTION_REQUIRES_REVIEW)])
    return rows.withColumn("issues", F.array_join(issues, ",")).drop("unread")


TURNS = f"""
, nx AS (SELECT slot, tick, yaw, lead(yaw) OVER w AS yaw2, lead(tick) OVER w - tick AS step FROM st WINDOW w AS (PARTITION BY slot ORDER BY tick)),
tu AS (SELECT c.slot, o.o AS "offset", CASE WHEN n.tick IS NULL THEN 'missing_state' WHEN n.yaw IS NULL OR n.yaw2 IS NULL OR n.step > 240 THEN 'missing_bracket' END AS skip,
  abs({WRAP.format(d="c.yaw - (n.yaw + (" + WRAP.format(d="n.yaw2 - n.yaw") + ") * (c.cents % 10) / 10.0)")}) AS error
  FROM cmd c CROSS JOIN (VALUES (0), (1)) o(o) LEFT JOIN nx n ON n.slot = c.slot AND n.tick = c.tick + o.o WHERE c.yaw IS NOT NULL)"""


@query("SELECT slot, CAST(\"offset\" AS BIGINT) AS \"offset\", count(*) FILTER (skip IS NULL) AS tested, count(*) FILTER (skip = 'missing_state') AS missing_state, count(*) FILTER (skip = 'missing_bracket') AS missing_bracket, count(*) FILTER (skip IS NULL AND error <= 5.00005) AS matches, round(max(error) FILTER (skip IS NULL), 6) AS worst FROM tu GROUP BY 1, 2", STATE + TURNS)
def dom_55_turns(spark, d):
    """A fixed candidate (the view lies between the states of one tick later) beside its control (of the same tick): each
    command's angle against the angle between two adjacent states, or why there is none."""
    w = Window.partitionBy("slot").orderBy("tick")
    near = states(spark, d).select("slot", "tick", C("yaw").alias("a"), F.lead("yaw").over(w).alias("b"), (F.lead("tick").over(w) - C("tick")).alias("step"), F.lit(True).alias("met"))
    asked = commands(spark, d).where("yaw is not null").select("slot", "yaw", "cents", F.col("tick").alias("own"), F.explode(F.array(F.lit(0).cast("long"), F.lit(1).cast("long"))).alias("offset"))
    rows = asked.withColumn("tick", C("own") + C("offset")).join(near, ["slot", "tick"], "left")
    skip = F.when(C("met").isNull(), "missing_state").when(C("a").isNull() | C("b").isNull() | (C("step") > 240), "missing_bracket")
    error = F.abs(wrap_degrees(C("yaw") - interpolate_degrees(C("a"), C("b"), (C("cents") % 10) / 10.0)))
    rows = rows.select("slot", "offset", skip.alias("skip"), error.alias("error"))
    fine = C("skip").isNull()
    return rows.groupBy("slot", "offset").agg(
        F.count_if(fine).alias("tested"), F.count_if(C("skip") == "missing_state").alias("missing_state"), F.count_if(C("skip") == "missing_bracket").alias("missing_bracket"), F.count_if(fine & (C("error") <= 5.00005)).alias("matches"), F.round(F.max(F.when(fine, C("error"))), 6).alias("worst")
    )


INSERT = """
, ba AS (SELECT slot, tick, count(*) AS n, count(*) FILTER (k % 11 <> 0) AS inserted, min(client_tick) - min(k) % 3 AS elapsed, min(sec) AS before, max(sec) + min(k) AS after, coalesce(bool_and(present), true) AS guarded FROM cmd WHERE kind = 'purchase' GROUP BY 1, 2),
fq AS (SELECT slot, tick, count(*) AS seen FROM cmd GROUP BY 1, 2),
ins AS (SELECT b.*, f.seen, lag(after) OVER w AS last_after, lag(elapsed) OVER w AS last_elapsed FROM ba b LEFT JOIN fq f ON f.slot = b.slot AND f.tick = b.elapsed WINDOW w AS (PARTITION BY b.slot ORDER BY b.tick))"""
INSERT_RULES = "CASE WHEN elapsed < greatest(tick, last_elapsed) THEN 'early_scheduling_observation' END, CASE WHEN coalesce(seen, 0) <> 1 THEN 'missing_or_ambiguous_native_frame' END, CASE WHEN inserted <> n THEN 'insertion_count_disagrees' END, CASE WHEN before < last_after THEN 'insertion_clock_reversed' END, CASE WHEN NOT guarded THEN 'guard_failed' END"


@query("SELECT slot, tick, n, " + JOINED.format(r=INSERT_RULES) + " AS reasons FROM ins", CMD + INSERT)
def dom_56_insertions(spark, d):
    """Each batch of inserted events: observed in exactly one native frame, not before its time nor before the last one,
    all events inserted, clocks after those of the batch before, and guards that held."""
    c = commands(spark, d)
    batch = c.where("kind = 'purchase'").groupBy("slot", "tick").agg(F.count("*").alias("n"), F.count_if(C("k") % 11 != 0).alias("inserted"), (F.min("client_tick") - F.min("k") % 3).alias("elapsed"), F.min("sec").alias("before"), (F.max("sec") + F.min("k")).alias("after"), F.coalesce(F.min("present"), F.lit(True)).alias("guarded"))
    w = Window.partitionBy("slot").orderBy("tick")
    batch = batch.withColumns({"last_after": F.lag("after").over(w), "last_elapsed": F.lag("elapsed").over(w)})
    seen = c.groupBy("slot", C("tick").alias("elapsed")).agg(F.count("*").alias("seen"))
    rules = [
        (C("elapsed") < F.greatest("tick", "last_elapsed"), reasons.EARLY_SCHEDULING_OBSERVATION),
        (F.coalesce("seen", F.lit(0)) != 1, reasons.MISSING_OR_AMBIGUOUS_NATIVE_FRAME),
        (C("inserted") != C("n"), reasons.INSERTION_COUNT_DISAGREES),
        (C("before") < C("last_after"), reasons.INSERTION_CLOCK_REVERSED),
        (~C("guarded"), "guard_failed"),
    ]
    return batch.join(seen, ["slot", "elapsed"], "left").select("slot", "tick", "n", F.array_join(labels.sorted_reasons(rules), ",").alias("reasons"))


@query(
    "SELECT slot, round_id, count(*) AS decisions, count(*) FILTER (emitted <> 0) AS events, CAST(sum(abs(emitted)) AS BIGINT) AS counts, count(*) FILTER (emitted <> emitted + CASE WHEN row_id % 101 = 0 THEN 1 ELSE 0 END) AS disagree, round(arg_max(total - whole, row_id), 6) + 0.0 AS carried FROM (SELECT *, whole - coalesce(lag(whole) OVER (PARTITION BY slot, round_id ORDER BY row_id), 0) AS emitted FROM (SELECT slot, round_id, row_id, total, CAST(round(total) AS BIGINT) AS whole FROM (SELECT slot, round_id, row_id, sum(coalesce(dx, 0)) OVER (PARTITION BY slot, round_id ORDER BY row_id)::DOUBLE * 10 / 22 AS total FROM cmd))) GROUP BY slot, round_id",
    CMD,
)
def dom_62_compilation(spark, d):
    """The counts of each round's decisions computed anew, with what is carried from one to the next, against those that
    were recorded."""
    rows = responses.compiled_counts(commands(spark, d).withColumn("want", F.coalesce("dx", F.lit(0))), ["slot", "round_id"], "row_id", C("want") * 10 / 22.0)
    recorded = C("emitted") + F.when(C("row_id") % 101 == 0, 1).otherwise(0)
    out = rows.groupBy("slot", "round_id").agg(F.count("*").alias("decisions"), F.count_if(C("emitted") != 0).alias("events"), F.sum(F.abs("emitted")).alias("counts"), F.count_if(C("emitted") != recorded).alias("disagree"), F.max_by("residual", "row_id").alias("carried"))
    return out.withColumn("carried", F.round("carried", 6) + 0.0)


#: The controls by the kind of the command that asks for them.
EFFECTS = """
, ob AS (SELECT slot, round_id, greatest(max(x) - first(x ORDER BY tick), first(x ORDER BY tick) - min(x)) AS moved, max(health) AS speed, first(health ORDER BY tick) AS clip, min(health) AS low, max(health) AS high, count(DISTINCT user_id) AS holders,
  first(moving ORDER BY tick) AS ground, bool_and(moving) AS grounded, max(yaw) AS up, count(yaw) = count(*) AS yaw_known, max(CAST(paused AS INT)) > first(CAST(paused AS INT) ORDER BY tick) AS ducked, count(paused) = count(*) AS duck_known FROM st GROUP BY 1, 2),
ask AS (SELECT slot, round_id, kind, count(*) FILTER (dx > 0) AS matching FROM cmd GROUP BY 1, 2, 3)"""


@query(
    "SELECT slot, round_id, kind, CASE WHEN NOT known THEN 'unknown' WHEN seen THEN 'observed_response_evidence' ELSE 'missing_observed_response' END AS status, CASE WHEN NOT known THEN why END AS reason FROM (SELECT slot, round_id, kind, CASE kind WHEN 'view' THEN true WHEN 'click' THEN holders = 1 WHEN 'purchase' THEN holders = 1 WHEN 'signup' THEN yaw_known ELSE duck_known END AS known, CASE kind WHEN 'view' THEN matching > 0 AND moved > 0.25 AND speed > 1 WHEN 'click' THEN low < clip WHEN 'purchase' THEN high > clip WHEN 'signup' THEN ground AND NOT grounded AND up > 1 ELSE ducked END AS seen, CASE WHEN kind IN ('click', 'purchase') THEN 'ammo_or_weapon_identity_unavailable_or_changed' WHEN kind = 'signup' THEN 'jump_state_unavailable' ELSE 'duck_state_unavailable' END AS why FROM ask JOIN ob USING (slot, round_id))",
    STATE + EFFECTS,
)
def dom_60_effects(spark, d):
    """Whether what each control should do was seen in the states of the round, by the control's own rule: moving, shooting,
    reloading, jumping, ducking; unknown where a state that the rule needs isn't."""
    first = lambda c: F.min_by(C(c), C("tick"))
    duck = C("paused").cast("int")
    seen = states(spark, d).groupBy("slot", "round_id").agg(
        F.greatest(F.max("x") - first("x"), first("x") - F.min("x")).alias("moved"), F.max("health").alias("speed"), first("health").alias("clip"), F.min("health").alias("low"), F.max("health").alias("high"), F.count_distinct("user_id").alias("holders"),
        first("moving").alias("ground"), F.min("moving").alias("grounded"), F.max("yaw").alias("up"), (F.count("yaw") == F.count("*")).alias("yaw_known"), (F.max(duck) > F.min_by(duck, C("tick"))).alias("ducked"), (F.count("paused") == F.count("*")).alias("duck_known"),
    )
    asked = commands(spark, d).groupBy("slot", "round_id", "kind").agg(F.count_if(C("dx") > 0).alias("matching"))
    held = reasons.AMMO_OR_WEAPON_IDENTITY_UNAVAILABLE_OR_CHANGED
    one = C("holders") == 1
    rules = {
        "view": responses.effect(F.lit(True), (C("matching") > 0) & (C("moved") > 0.25) & (C("speed") > 1), reasons.MOVEMENT_STATE_UNAVAILABLE),
        "click": responses.effect(one, C("low") < C("clip"), held),
        "purchase": responses.effect(one, C("high") > C("clip"), held),
        "signup": responses.effect(C("yaw_known"), C("ground") & ~C("grounded") & (C("up") > 1), reasons.JUMP_STATE_UNAVAILABLE),
    }
    out = responses.effect(C("duck_known"), C("ducked"), reasons.DUCK_STATE_UNAVAILABLE)
    for kind, rule in rules.items():
        out = F.when(C("kind") == kind, rule).otherwise(out)
    return asked.join(seen, ["slot", "round_id"]).select("slot", "round_id", "kind", out.alias("e")).select("slot", "round_id", "kind", "e.status", "e.reason")


@query(
    "SELECT user_id, round_id, n, missing, round(t0 - p0, 6) + 0.0 AS residual_yaw, round(t1 - p1, 6) + 0.0 AS residual_pitch, missing = 0 AND c0 = i0 AND abs(t0 - p0) <= 0.01 + 0.02 * abs(p0) AND abs(t1 - p1) <= 0.01 + 0.02 * abs(p1) AS agrees FROM (SELECT *, c0 * 0.022::DOUBLE + c1 * -0.001::DOUBLE AS p0, c0 * 0.0005::DOUBLE + c1 * 0.022::DOUBLE AS p1 FROM (SELECT user_id, round_id, count(*) AS n, count(*) FILTER (dx IS NULL) AS missing, coalesce(sum(dx), 0)::DOUBLE AS c0, sum(dy)::DOUBLE AS c1, sum(k - 50)::DOUBLE AS i0, coalesce(sum(dx * 0.022::DOUBLE - dy * 0.001::DOUBLE + CASE WHEN row_id % 50 = 0 THEN 0.5 ELSE 0.0 END), 0) AS t0, coalesce(sum(dy * 0.022::DOUBLE + dx * 0.0005::DOUBLE), 0) AS t1 FROM (SELECT *, k % 7 - 3 AS dy FROM cmd) GROUP BY 1, 2))",
    CMD,
)
def dom_63_gain_agreement(spark, d):
    """The labelled turns of each case against the measured gain applied to the counts that it was given."""
    rows = commands(spark, d).withColumns({"dy": C("k") % 7 - 3, "plan_x": C("k") - 50})
    rows = rows.withColumns({"yaw": C("dx") * 0.022 - C("dy") * 0.001 + F.when(C("row_id") % 50 == 0, 0.5).otherwise(0.0), "pitch": C("dy") * 0.022 + C("dx") * 0.0005, "plan_y": C("dy")})
    out = responses.gain_agreement(rows, ["user_id", "round_id"], ["yaw", "pitch"], ["dx", "dy"], ["plan_x", "plan_y"], [[0.022, -0.001], [0.0005, 0.022]], 0.01, 0.02)
    return out.withColumns({c: F.round(c, 6) + 0.0 for c in ("residual_yaw", "residual_pitch")})


MASKS = (1, 2, 4, 8, 16, 32, 64, 128)


@query(
    "SELECT kind, hypothesis, tested, matches, tested_again, matches_again, CASE WHEN tested = 0 THEN 'untested' WHEN matches < tested THEN 'rejected' WHEN tested_again = 0 THEN 'unconfirmed' WHEN matches_again < tested_again THEN 'contradicted' ELSE 'confirmed' END AS status FROM (SELECT kind, 'mask_' || m AS hypothesis, count(*) FILTER (row_id % 2 = 0) AS tested, count(*) FILTER (row_id % 2 = 0 AND ok) AS matches, count(*) FILTER (row_id % 2 = 1) AS tested_again, count(*) FILTER (row_id % 2 = 1 AND ok) AS matches_again FROM (SELECT kind, row_id, m, ((p1 & m) <> 0) = pressed AS ok FROM (SELECT *, CASE WHEN kind = 'error' AND row_id % 2 = 1 AND k % 10 = 1 THEN (cents // 4) % 2 = 0 ELSE (cents // 4) % 2 = 1 END AS pressed FROM cmd WHERE dx IS NOT NULL) CROSS JOIN (VALUES (1), (2), (4), (8), (16), (32), (64), (128)) v(m)) WHERE ok IS NOT NULL GROUP BY 1, 2)",
    CMD,
)
def dom_53_confirmed_hypotheses(spark, d):
    """Which bit of a plane is the button of each control: each hypothesis is frozen on half of the rows and confirmed, or
    contradicted, by the others."""
    c = commands(spark, d).where("dx is not null")
    down = F.floor(C("cents") / 4) % 2 == 1
    pressed = F.when((C("kind") == "error") & (C("row_id") % 2 == 1) & (C("k") % 10 == 1), ~down).otherwise(down)
    rows = c.withColumn("pressed", pressed)
    return responses.confirmed(rows, ["kind"], C("row_id") % 2 == 0, {f"mask_{m}": (C("p1").bitwiseAND(F.lit(m)) != 0) == C("pressed") for m in MASKS})


PLAN = """
, cut AS (SELECT *, CASE WHEN lag(alive) OVER w AND tick - lag(tick) OVER w <= 240 AND lag(round_id) OVER w = round_id THEN 0 ELSE 1 END AS c FROM st WINDOW w AS (PARTITION BY slot ORDER BY tick)),
wi AS (SELECT slot, round_id, min(tick) AS s, max(tick) + 1 AS e FROM (SELECT *, sum(c) OVER (PARTITION BY slot ORDER BY tick) AS g FROM cut) WHERE alive GROUP BY slot, round_id, g),
cl AS (SELECT slot, round_id, even // 320 + CASE WHEN even % 320 >= 32 THEN 1 ELSE 0 END AS n_clips, CASE WHEN even % 320 >= 32 THEN even ELSE even - even % 320 END AS planned, CASE WHEN even % 320 >= 32 THEN 0 ELSE even % 320 END AS short, e - s - even AS odd FROM (SELECT *, (e - s) // 2 * 2 AS even FROM wi)),
pl AS (SELECT slot, round_id, CAST(sum(n_clips) AS BIGINT) AS n_clips, CAST(sum(planned) AS BIGINT) AS planned, CAST(sum(short) AS BIGINT) AS short, CAST(sum(odd) AS BIGINT) AS odd FROM cl GROUP BY slot, round_id),
pr AS (SELECT *, CAST(ceil(planned::DOUBLE / 64 * 230000000 + n_clips * 50000000) AS BIGINT) AS projected_bytes, planned::DOUBLE / 64 * 25 + n_clips * 30 AS projected_seconds FROM pl)"""


@query("SELECT *, CASE WHEN n_clips = 0 THEN 'no_clip' WHEN n_clips > 3 THEN 'too_many_clips' WHEN projected_bytes > 2500000000 THEN 'storage_exceeds_budget' WHEN projected_seconds > 300 THEN 'time_exceeds_budget' ELSE 'planned' END AS verdict FROM pr", STATE + PLAN)
def dom_41_budgeted_rounds(spark, d):
    """Each player's alive windows of a round cut into whole clips, every tick planned or left out for a reason, with the storage and
    time that they are projected to need against the budgets."""
    alive = windows.gap_islands(states(spark, d), ["slot"], "tick", C("alive"), ["round_id"], 240)
    clips = responses.whole_clips(alive, 320, 32)
    return responses.within_budget(clips, ["slot", "round_id"], 3, 64, 230e6, 50e6, 25.0, 30.0, 2.5e9, 300.0)


@query(
    "SELECT slot, tick, images, CASE WHEN reasons = '' THEN target END AS target, reasons FROM (SELECT slot, tick, images, target, "
    + JOINED.format(r="CASE WHEN n < 8 THEN 'insufficient_history_frames' END, CASE WHEN tick - oldest > 1000 THEN 'history_not_contiguous' END, CASE WHEN target IS NULL THEN 'target_unavailable' END, CASE WHEN cs > 1 THEN 'ambiguous_command_support' END, CASE WHEN NOT alive THEN 'alive_not_true' END, CASE WHEN paused IS NULL THEN 'pause_unknown' END, CASE WHEN paused THEN 'pause_active' END")
    + " AS reasons FROM (SELECT s.*, cs, array_to_string(list(x) OVER w, ',') AS images, lead(x) OVER (PARTITION BY slot ORDER BY tick) - x AS target, count(*) OVER w AS n, first_value(tick) OVER w AS oldest FROM st s JOIN (SELECT slot, tick, count(*) AS cs FROM cmd GROUP BY 1, 2) USING (slot, tick) WINDOW w AS (PARTITION BY slot ORDER BY tick ROWS BETWEEN 7 PRECEDING AND CURRENT ROW)))",
    STATE,
)
def dom_33_samples(spark, d):
    """A sample for each state: the last eight images, and the target masked by every reason against it: of the history,
    of the target, of the commands that support it and of the player's state."""
    w = Window.partitionBy("slot").orderBy("tick")
    support = commands(spark, d).groupBy("slot", "tick").agg(F.count("*").alias("support"))
    rows = windows.history(states(spark, d), ["slot"], "tick", "x", 8).withColumns({"oldest": F.first("tick").over(w.rowsBetween(-7, 0)), "target": F.lead("x").over(w) - C("x")}).join(support, ["slot", "tick"])
    rules = [(C("tick") - C("oldest") > 1000, reasons.HISTORY_NOT_CONTIGUOUS), (C("target").isNull(), reasons.TARGET_UNAVAILABLE), (C("support") > 1, reasons.AMBIGUOUS_COMMAND_SUPPORT), (~C("alive"), reasons.ALIVE_NOT_TRUE), (C("paused").isNull(), reasons.PAUSE_UNKNOWN), (C("paused"), reasons.PAUSE_ACTIVE)]
    why = F.array_sort(F.array_union("reason_codes", labels.sorted_reasons(rules)))
    cell = labels.masked(C("target"), why)
    return rows.select("slot", "tick", F.array_join("history", ",").alias("images"), cell.alias("c"), F.array_join(why, ",").alias("reasons")).select("slot", "tick", "images", C("c.value").alias("target"), "reasons")


@query(
    "SELECT user_id, n, falls, gap, n_offsets, CASE WHEN falls > 0 THEN 'clock_not_monotone' WHEN gap > 20000 THEN 'gap_over_limit' WHEN n_offsets > 1 AND residual > 3 THEN 'offset_not_constant' END AS reason, CASE WHEN falls = 0 AND coalesce(gap, 0) <= 20000 AND (n_offsets = 1 OR residual <= 3) THEN mid END AS \"offset\", residual FROM (SELECT user_id, n, falls, gap, n_offsets, mid, greatest(hi - mid, mid - lo) AS residual FROM (SELECT user_id, count(*) AS n, count(*) FILTER (tick < p) AS falls, max(tick - p) AS gap, count(DISTINCT o) AS n_offsets, median(o) AS mid, min(o) AS lo, max(o) AS hi FROM (SELECT user_id, tick, client_tick - tick AS o, lag(tick) OVER (PARTITION BY user_id ORDER BY sec, row_id) AS p FROM cmd) GROUP BY user_id))",
    CMD,
)
def dom_5_clock_calibration(spark, d):
    """The offset between two clocks of each player, where the clock never falls, has no gap over the limit, and one offset
    fits all commands; else the first of these that isn't so."""
    from tideline.operators.aggregates import offset_fit

    rows = commands(spark, d).withColumns({"o": C("client_tick") - C("tick"), "p": F.lag("tick").over(Window.partitionBy("user_id").orderBy("sec", "row_id"))})
    clock = rows.groupBy("user_id").agg(F.count("*").alias("n"), F.count_if(C("tick") < C("p")).alias("falls"), F.max(C("tick") - C("p")).alias("gap"))
    fit = offset_fit(rows, ["user_id"], "o", 3.0)
    reason = F.when(C("falls") > 0, "clock_not_monotone").when(C("gap") > 20000, "gap_over_limit").when(C("offset").isNull(), "offset_not_constant")
    return clock.join(fit, "user_id").withColumn("reason", reason).select("user_id", "n", "falls", "gap", "n_offsets", "reason", F.when(C("reason").isNull(), C("offset")).alias("offset"), "residual")
