"""Transitions, islands, chunks, history, running work."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tideline.operators import scans, windows
from tideline.plans.registry import query
from tideline.plans.views import CMD, FRAMES, ROUNDS, STATE, WRAP, commands, frames, rounds, states
from tideline.plans.views import PLAYER_FRAMES, player_frames

C = F.col

TRANSITION = f"""
, tr0 AS (SELECT *, lag(row_id) OVER w AS pr, lag(round_id) OVER w AS p_round, lag(user_id) OVER w AS p_user, lag(alive) OVER w AS p_alive, lag(yaw) OVER w AS p_yaw,
  lag(pitch) OVER w AS p_pitch, lag(tick) OVER w AS p_tick, lag(number) OVER w AS p_number, lag(client_tick) OVER w AS p_client FROM cmd WINDOW w AS (PARTITION BY slot ORDER BY row_id)),
tr AS (SELECT *, CASE WHEN pr IS NULL THEN 'first_command' WHEN p_round IS DISTINCT FROM round_id THEN 'changed_round_id' WHEN NOT p_alive OR NOT alive THEN 'not_alive'
  WHEN p_yaw IS NULL OR yaw IS NULL THEN 'missing_viewangles' WHEN tick - p_tick < 0 OR tick - p_tick > 16 THEN 'demo_tick_discontinuity'
  WHEN number <> p_number + 1 THEN 'command_number_discontinuity' WHEN client_tick < p_client THEN 'client_tick_reset' END AS reset_reason,
  {WRAP.format(d="yaw - p_yaw")} AS dy, pitch - p_pitch AS dp FROM tr0)"""


@query("SELECT row_id, reset_reason, CASE WHEN reset_reason IS NULL THEN dy END AS delta_yaw, CASE WHEN reset_reason IS NULL THEN dp END AS delta_pitch, CASE WHEN reset_reason IS NULL THEN pr END AS previous_row_id FROM tr", CMD + TRANSITION)
def win_1_transitions(spark, d):
    return windows.transitions(commands(spark, d), same=("round_id",)).select("row_id", "reset_reason", "delta_yaw", "delta_pitch", "previous_row_id")


@query("SELECT slot, coalesce(reset_reason, 'valid') AS reason, count(*) AS n FROM tr GROUP BY 1, 2", CMD + TRANSITION)
def win_2_normalisation_report(spark, d):
    t = windows.transitions(commands(spark, d), same=("round_id",))
    return t.groupBy("slot", F.coalesce("reset_reason", F.lit("valid")).alias("reason")).agg(F.count("*").alias("n"))


@query("SELECT slot, count(*) FILTER (tick - p_tick > 16) AS gaps, count(*) FILTER (number < p_number) AS reversals, max(tick - p_tick) AS max_gap, count(*) FILTER (yaw <> p_yaw) AS turns FROM tr0 WHERE p_round = round_id GROUP BY slot", CMD + TRANSITION)
def win_3_continuity(spark, d):
    w = Window.partitionBy("slot").orderBy("row_id")
    rows = commands(spark, d).withColumns({f"p_{c}": F.lag(c).over(w) for c in ("tick", "number", "yaw", "round_id")}).where("p_round_id = round_id")
    step = C("tick") - C("p_tick")
    return rows.groupBy("slot").agg(F.count_if(step > 16).alias("gaps"), F.count_if(C("number") < C("p_number")).alias("reversals"), F.max(step).alias("max_gap"), F.count_if(C("yaw") != C("p_yaw")).alias("turns"))


@query("SELECT row_id, coalesce(rn - lag(rn) OVER (PARTITION BY slot, user_id, kind ORDER BY rn) <= 64, false) AS duplicate FROM (SELECT *, row_number() OVER (PARTITION BY slot ORDER BY row_id) AS rn FROM cmd)", CMD)
def win_4_bounded_duplicates(spark, d):
    return windows.repeated_within(commands(spark, d), "slot", ["user_id", "kind"], "row_id", 64).select("row_id", "duplicate")


@query("SELECT slot, round_id, min(tick) AS start, max(tick) + 1 AS \"end\", count(*) AS n FROM (SELECT *, sum(s) OVER (PARTITION BY slot ORDER BY tick) AS island FROM (SELECT *, CASE WHEN lag(tick) OVER w IS NULL OR NOT lag(alive) OVER w OR tick - lag(tick) OVER w > 90 OR lag(round_id) OVER w <> round_id THEN 1 ELSE 0 END AS s FROM st WINDOW w AS (PARTITION BY slot ORDER BY tick))) WHERE alive GROUP BY slot, round_id, island", STATE)
def win_5_alive_windows(spark, d):
    return windows.gap_islands(states(spark, d), ["slot"], "tick", C("alive"), ["round_id"], 90).select("slot", "round_id", "start", "end", "n")


@query("SELECT slot, tick, chunk FROM (SELECT *, count(*) OVER (PARTITION BY slot, island, chunk) AS n FROM (SELECT *, (row_number() OVER (PARTITION BY slot, island ORDER BY tick) - 1) // 2 AS chunk FROM (SELECT *, tick - row_number() OVER (PARTITION BY slot ORDER BY tick) AS island FROM st))) WHERE n = 2", STATE)
def win_6_chunks(spark, d):
    return windows.chunks(states(spark, d), ["slot"], "tick", 2).select("slot", "tick", C("chunk").cast("long").alias("chunk"))


@query("SELECT slot, max(n) AS longest, count(*) FILTER (n >= 3) AS sustained FROM (SELECT slot, g, count(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY slot ORDER BY row_id) - row_number() OVER (PARTITION BY slot, alive ORDER BY row_id) AS g FROM cmd) WHERE alive GROUP BY slot, g) GROUP BY slot", CMD)
def win_7_held_runs(spark, d):
    w = Window.partitionBy("slot").orderBy("row_id")
    runs = windows.islands(commands(spark, d).withColumn("cut", C("alive") != F.lag("alive").over(w)), ["slot"], ["row_id"], C("cut"))
    n = runs.where("alive").groupBy("slot", "island").agg(F.count("*").alias("n"))
    return n.groupBy("slot").agg(F.max("n").alias("longest"), F.count_if(C("n") >= 3).alias("sustained"))


@query("SELECT slot, moving, min(tick) AS start, max(tick) + 1 AS \"end\" FROM (SELECT *, sum(s) OVER (PARTITION BY slot ORDER BY tick) AS island FROM (SELECT *, CASE WHEN lag(tick) OVER w = tick - 1 AND lag(moving) OVER w = moving THEN 0 ELSE 1 END AS s FROM st WINDOW w AS (PARTITION BY slot ORDER BY tick))) GROUP BY slot, moving, island", STATE)
def win_9_run_length_segments(spark, d):
    return windows.run_length_segments(states(spark, d), ["slot"], "tick", ["moving"]).select("slot", "moving", "start", "end")


@query("SELECT tick, count(DISTINCT (slot, cents)) > 1 AS ambiguous, count(*) AS n FROM cmd GROUP BY tick", CMD)
def win_10_ambiguous_ticks(spark, d):
    return commands(spark, d).groupBy("tick").agg((F.countDistinct("slot", "cents") > 1).alias("ambiguous"), F.count("*").alias("n"))


@query("SELECT row_id, count(*) OVER (PARTITION BY tick, slot, kind) <> 1 AS ambiguous FROM cmd", CMD)
def win_11_duplicate_shots(spark, d):
    return commands(spark, d).select("row_id", (F.count("*").over(Window.partitionBy("tick", "slot", "kind")) != 1).alias("ambiguous"))


@query("SELECT slot, tick, array_to_string(list(x) OVER (PARTITION BY slot ORDER BY tick ROWS BETWEEN 7 PRECEDING AND CURRENT ROW), ',') AS history, array_to_string(list(x) OVER (PARTITION BY slot ORDER BY tick ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING), ',') AS future, concat_ws(',', CASE WHEN row_number() OVER (PARTITION BY slot ORDER BY tick) < 8 THEN 'insufficient_history_frames' END, CASE WHEN row_number() OVER (PARTITION BY slot ORDER BY tick DESC) < 3 THEN 'insufficient_future_intervals' END) AS reasons FROM st", STATE)
def win_12_history_windows(spark, d):
    h = windows.history(states(spark, d), ["slot"], "tick", "x", 8, 3)
    return h.select("slot", "tick", F.array_join("history", ",").alias("history"), F.array_join("future", ",").alias("future"), F.array_join("reason_codes", ",").alias("reasons"))


@query("SELECT row_id, max(client_tick) OVER (PARTITION BY slot ORDER BY row_id) AS ceiling, sum(CASE WHEN kind <> 'view' THEN 1 ELSE 0 END)  OVER (PARTITION BY slot ORDER BY row_id) AS other FROM cmd".replace("sum(CASE", "CAST(sum(CASE").replace("ORDER BY row_id) AS other", "ORDER BY row_id) AS BIGINT) AS other"), CMD)
def win_14_running_ceiling(spark, d):
    rows = scans.ranged(commands(spark, d).select("row_id", "slot", "client_tick", "kind"), ["slot"], ["row_id"])
    return scans.scan(rows, ["slot"], ["row_id"], ceiling=scans.running_max(C("client_tick")), other=scans.running_count(C("kind") != "view")).select("row_id", "ceiling", "other")


@query("SELECT slot, tick, string_agg(DISTINCT kind, ',' ORDER BY kind) AS kinds FROM (SELECT a.slot, a.tick, b.kind FROM (SELECT slot, tick FROM st) a JOIN (SELECT slot, kind, min(tick) AS t FROM cmd GROUP BY 1, 2) b ON b.slot = a.slot AND b.t <= a.tick) GROUP BY slot, tick", STATE)
def win_16_prefix_reasons(spark, d):
    #: A kind has been seen once its least tick so far is known: a running minimum for each kind instead of a growing set.
    names = ["click", "error", "purchase", "signup", "view"]
    per_tick = commands(spark, d).groupBy("slot", "tick").agg(*(F.max(F.when(C("kind") == k, k)).alias(k) for k in names))
    w = Window.partitionBy("slot").orderBy("tick").rowsBetween(Window.unboundedPreceding, 0)
    return per_tick.select("slot", "tick", F.concat_ws(",", *(F.max(k).over(w) for k in names)).alias("kinds"))


@query("SELECT slot, skip, count(*) AS n, CAST(coalesce(sum(step), 0) AS BIGINT) AS total FROM (SELECT slot, CASE WHEN p IS NULL THEN 'first' WHEN pr <> round_id THEN 'epoch' WHEN client_tick < p THEN 'backwards' ELSE 'measured' END AS skip, client_tick - p AS step FROM (SELECT *, lag(client_tick) OVER w AS p, lag(round_id) OVER w AS pr FROM cmd WINDOW w AS (PARTITION BY slot ORDER BY row_id))) GROUP BY slot, skip", CMD)
def win_17_adjacent_intervals(spark, d):
    w = Window.partitionBy("slot").orderBy("row_id")
    rows = commands(spark, d).withColumns({"p": F.lag("client_tick").over(w), "pr": F.lag("round_id").over(w)})
    skip = F.when(C("p").isNull(), "first").when(C("pr") != C("round_id"), "epoch").when(C("client_tick") < C("p"), "backwards").otherwise("measured")
    return rows.groupBy("slot", skip.alias("skip")).agg(F.count("*").alias("n"), F.coalesce(F.sum(C("client_tick") - C("p")), F.lit(0)).alias("total"))


@query("SELECT slot, count(*) FILTER (client_tick < p) AS violations FROM (SELECT slot, client_tick, lag(client_tick) OVER (PARTITION BY slot ORDER BY row_id) AS p FROM cmd) GROUP BY slot", CMD)
def win_18_clock_monotonic(spark, d):
    from tideline.operators.audits import not_rising

    return not_rising(commands(spark, d), ["slot"], "row_id", "client_tick", strict=False)


@query("SELECT frame_index, start <> coalesce(lag(\"end\") OVER (ORDER BY frame_index), start) AS broken FROM fr", CMD, FRAMES)
def win_19_frame_contiguity(spark, d):
    f = frames(spark, d)
    before = f.select((C("frame_index") + 1).alias("frame_index"), C("end").alias("p"))
    return f.join(before, "frame_index", "left").select("frame_index", (C("start") != F.coalesce("p", "start")).alias("broken"))


@query("SELECT slot, tick, concat_ws(',', CASE WHEN pa IS DISTINCT FROM alive THEN 'alive:' || pa || '>' || alive END, CASE WHEN pm IS DISTINCT FROM moving THEN 'moving:' || pm || '>' || moving END) AS changed FROM (SELECT *, lag(alive) OVER w AS pa, lag(moving) OVER w AS pm, row_number() OVER w AS rn FROM st WINDOW w AS (PARTITION BY slot ORDER BY tick)) WHERE rn > 1 AND (pa IS DISTINCT FROM alive OR pm IS DISTINCT FROM moving)", STATE)
def win_20_state_changes(spark, d):
    out = windows.changes(states(spark, d), ["slot"], "tick", ["alive", "moving"])
    said = F.transform("changed", lambda x: F.concat(x["name"], F.lit(":"), x["before"], F.lit(">"), x["after"]))
    return out.select("slot", "tick", F.array_join(said, ",").alias("changed"))


@query("SELECT slot, user_id, row_id, next_tick - tick AS held FROM (SELECT *, lead(tick) OVER w AS next_tick, lead(kind) OVER w AS next_kind FROM cmd WHERE kind IN ('click', 'purchase') WINDOW w AS (PARTITION BY user_id ORDER BY row_id)) WHERE kind = 'click' AND next_kind = 'purchase'", CMD)
def win_22_press_release(spark, d):
    w = Window.partitionBy("user_id").orderBy("row_id")
    rows = commands(spark, d).where("kind IN ('click', 'purchase')").withColumns({"next_tick": F.lead("tick").over(w), "next_kind": F.lead("kind").over(w)})
    return rows.where("kind = 'click' AND next_kind = 'purchase'").select("slot", "user_id", "row_id", (C("next_tick") - C("tick")).alias("held"))


@query("SELECT user_id, kind, max(row_id) AS row_id FROM cmd GROUP BY user_id, kind", CMD)
def win_23_latest_wins(spark, d):
    return windows.latest(commands(spark, d), ["user_id", "kind"], [F.desc("row_id")]).select("user_id", "kind", "row_id")


@query("SELECT slot, frame_index, CAST(coalesce(sum(n) OVER (PARTITION BY slot ORDER BY frame_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS first, CAST(sum(n) OVER (PARTITION BY slot ORDER BY frame_index) AS BIGINT) AS last FROM (SELECT slot, frame_index, count(row_id) AS n FROM pf LEFT JOIN (SELECT slot, row_id, tick // 32 AS frame_index FROM cmd) USING (slot, frame_index) GROUP BY slot, frame_index)", CMD, PLAYER_FRAMES)
def win_24_frame_cursor(spark, d):
    from tideline.operators.joins import interval_join

    f = player_frames(spark, d)
    n = interval_join(commands(spark, d), f, "tick", keys=("slot",), width=32).groupBy("slot", "frame_index").agg(F.count("*").alias("n"))
    f = f.join(n, ["slot", "frame_index"], "left").select("slot", "frame_index", F.coalesce("n", F.lit(0)).alias("n"))
    w = Window.partitionBy("slot").orderBy("frame_index").rowsBetween(Window.unboundedPreceding, 0)
    return f.withColumn("last", F.sum("n").over(w)).select("slot", "frame_index", (C("last") - C("n")).alias("first"), "last")


@query("SELECT row_id, CAST(count(*) OVER (PARTITION BY slot ORDER BY sec RANGE BETWEEN 3599 PRECEDING AND CURRENT ROW) AS BIGINT) AS n FROM cmd", CMD)
def win_28_rolling_rate(spark, d):
    return commands(spark, d).select("row_id", F.count("*").over(Window.partitionBy("slot").orderBy("sec").rangeBetween(-3599, 0)).alias("n"))


@query("SELECT row_id, CAST(t - coalesce(lag(t) OVER (PARTITION BY slot ORDER BY row_id), 0) AS BIGINT) AS emitted FROM (SELECT row_id, slot, floor(sum(cents * 0.125) OVER (PARTITION BY slot ORDER BY row_id) + 0.5) AS t FROM cmd)", CMD)
def win_29_carried_rounding(spark, d):
    rows = commands(spark, d).withColumn("v", C("cents") * 0.125)
    return windows.carried_rounding(rows, ["slot"], "row_id", "v").select("row_id", "emitted")


@query("SELECT slot, tick, x, x1, x2 FROM (SELECT *, row_number() OVER w AS rn, lead(x, 1) OVER w AS x1, lead(x, 2) OVER w AS x2 FROM st WINDOW w AS (PARTITION BY slot ORDER BY tick)) WHERE rn % 2 = 1 AND x2 IS NOT NULL", STATE)
def win_30_target_pairs(spark, d):
    w = Window.partitionBy("slot").orderBy("tick")
    rows = states(spark, d).withColumns({"rn": F.row_number().over(w), "x1": F.lead("x", 1).over(w), "x2": F.lead("x", 2).over(w)})
    return rows.where("rn % 2 = 1 AND x2 IS NOT NULL").select("slot", "tick", "x", "x1", "x2")


@query("SELECT slot, min(a) AS start, max(b) AS \"end\", count(*) AS n FROM (SELECT *, sum(s) OVER (PARTITION BY slot ORDER BY a, b) AS g FROM (SELECT *, CASE WHEN a <= max(b) OVER (PARTITION BY slot ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 30 THEN 0 ELSE 1 END AS s FROM (SELECT slot, tick AS a, tick + 1 + k % 20 AS b FROM cmd))) GROUP BY slot, g", CMD)
def win_32_merged_runs(spark, d):
    rows = commands(spark, d).select("slot", C("tick").alias("start"), (C("tick") + 1 + C("k") % 20).alias("end"))
    return windows.running_segments(rows, ["slot"], "start", "end", slack=30)


@query("SELECT slot, tick, row_id FROM (SELECT *, row_number() OVER (PARTITION BY slot, tick ORDER BY row_id) AS rn FROM cmd) WHERE rn > 1", CMD)
def win_33_later_duplicates(spark, d):
    rows = commands(spark, d).withColumn("rn", F.row_number().over(Window.partitionBy("slot", "tick").orderBy("row_id")))
    return rows.where("rn > 1").select("slot", "tick", "row_id")


@query("SELECT user_id, kind, min(row_id) AS first, count(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY row_id) - row_number() OVER (PARTITION BY user_id, kind ORDER BY row_id) AS g FROM cmd) GROUP BY user_id, kind, g", CMD)
def win_34_batches_of_equal_key(spark, d):
    w = Window.partitionBy("user_id").orderBy("row_id")
    runs = windows.islands(commands(spark, d).withColumn("cut", C("kind") != F.lag("kind").over(w)), ["user_id"], ["row_id"], C("cut"))
    return runs.groupBy("user_id", "kind", "island").agg(F.min("row_id").alias("first"), F.count("*").alias("n")).drop("island")


@query("SELECT r.round_id, r.slot, r.n, r.offsets = 1 AS constant FROM (SELECT round_id, slot, count(*) AS n, count(DISTINCT number - row_id) AS offsets FROM cmd GROUP BY 1, 2) r", CMD)
def win_36_constant_clock(spark, d):
    return commands(spark, d).groupBy("round_id", "slot").agg(F.count("*").alias("n"), (F.countDistinct(C("number") - C("row_id")) == 1).alias("constant"))


@query("SELECT round_id, n, phase FROM (SELECT r.round_id, count(row_id) AS n, CASE WHEN r.\"end\" IS NULL THEN 'unknown' WHEN count(row_id) FILTER (tick >= freeze_end AND tick < r.\"end\") = 0 THEN 'unknown' WHEN count(row_id) FILTER (tick >= freeze_end AND tick < r.\"end\" AND NOT alive) > count(row_id) FILTER (tick >= freeze_end AND tick < r.\"end\") * 0.22 THEN 'setup' ELSE 'competitive' END AS phase FROM rd r LEFT JOIN cmd c ON c.round_id = r.round_id GROUP BY r.round_id, r.\"end\", freeze_end)", CMD, ROUNDS)
def dom_1_round_phases(spark, d):
    c = commands(spark, d).join(rounds(spark, d), "round_id", "right")
    inside = (C("tick") >= C("freeze_end")) & (C("tick") < C("end"))
    g = c.groupBy("round_id", "end").agg(F.count("row_id").alias("n"), F.count_if(inside).alias("inside"), F.count_if(inside & ~C("alive")).alias("bad"))
    phase = F.when(C("end").isNull() | (C("inside") == 0), "unknown").when(C("bad") > C("inside") * 0.22, "setup").otherwise("competitive")
    return g.select("round_id", "n", phase.alias("phase"))
