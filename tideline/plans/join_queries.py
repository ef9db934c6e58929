"""Interval, as-of, band and uniqueness joins."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tideline.operators import joins
from tideline.plans.registry import query
from tideline.plans.views import CMD, FRAMES, ROUNDS, STATE, commands, frames, neighbours, rounds, states
from tideline.plans.views import PLAYER_FRAMES, player_frames

C = F.col


@query("SELECT row_id, frame_index FROM cmd JOIN fr ON tick >= start AND tick < \"end\"", CMD, FRAMES)
def join_1_point_in_interval(spark, d):
    return joins.interval_join(commands(spark, d), frames(spark, d), "tick", width=32).select("row_id", "frame_index")


@query("SELECT row_id, frame_index FROM cmd JOIN fr ON client_tick > start AND client_tick <= \"end\"", CMD, FRAMES)
def join_2_future_interval(spark, d):
    return joins.interval_join(commands(spark, d), frames(spark, d), "client_tick", closed="right", width=32).select("row_id", "frame_index")


@query("SELECT slot, frame_index, count(row_id) AS n, coalesce(string_agg(CAST(row_id AS VARCHAR), ',' ORDER BY row_id), '') AS ids FROM pf LEFT JOIN (SELECT slot, row_id, tick // 32 AS frame_index FROM cmd) USING (slot, frame_index) GROUP BY slot, frame_index", CMD, PLAYER_FRAMES)
def dom_4_aligned_frames(spark, d):
    f = player_frames(spark, d)
    met = joins.interval_join(commands(spark, d), f, "tick", keys=("slot",), width=32)
    ids = met.groupBy("slot", "frame_index").agg(F.array_sort(F.collect_list("row_id")).alias("ids"))
    out = f.join(ids, ["slot", "frame_index"], "left")
    return out.select("slot", "frame_index", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n"), F.coalesce(F.array_join("ids", ","), F.lit("")).alias("ids"))


@query("SELECT a.row_id, a.tick, b.cents FROM cmd a JOIN cmd b USING (row_id) WHERE a.alive", CMD)
def join_3_exact_key(spark, d):
    c = commands(spark, d)
    return c.where("alive").select("row_id", "tick").join(c.select("row_id", "cents"), "row_id")


@query("SELECT c.row_id, r.round_id, c.tick - r.start AS since FROM cmd c JOIN rd r ON c.round_id = r.round_id AND c.tick >= r.start AND c.tick < r.\"end\"", CMD, ROUNDS)
def join_4_window_containment(spark, d):
    r = rounds(spark, d).where("end is not null")
    met = joins.interval_join(commands(spark, d).select("row_id", "round_id", "tick"), r.select("round_id", "start", "end"), "tick", keys=("round_id",), width=1440)
    return met.select("row_id", "round_id", (C("tick") - C("start")).alias("since"))


@query("SELECT slot, tick, freeze_end, \"end\" AS round_end FROM st LEFT JOIN rd USING (round_id)", STATE, ROUNDS)
def join_5_dimension_lookup(spark, d):
    return states(spark, d).join(rounds(spark, d), "round_id", "left").select("slot", "tick", "freeze_end", C("end").alias("round_end"))


@query("SELECT c.row_id, a.x AS x_before, b.x AS x_after FROM cmd c LEFT JOIN st a ON a.slot = c.slot AND a.tick = c.tick - c.k % 2 LEFT JOIN st b ON b.slot = c.slot AND b.tick = c.tick - c.k % 2 + CASE WHEN c.k % 3 = 0 THEN 0 ELSE 1 END", STATE)
def join_6_bracket(spark, d):
    at = C("tick") - C("k") % 2 + F.when(C("k") % 3 == 0, 0.0).otherwise(0.5)
    c = commands(spark, d).select("row_id", "slot", at.alias("at"))
    return joins.bracket_join(c, states(spark, d), "at", ("slot",), "tick", ("x",)).select("row_id", "x_before", "x_after")


@query("SELECT row_id FROM cmd WHERE EXISTS (SELECT 1 FROM rd WHERE tick >= start AND tick < freeze_end)", CMD, ROUNDS)
def join_7_in_window(spark, d):
    from tideline.operators.filters import in_any_window

    return in_any_window(commands(spark, d), rounds(spark, d).select("start", C("freeze_end").alias("end")), "tick").select("row_id")


@query("SELECT c.row_id, s.x, CASE WHEN s.n IS NULL THEN 'missing' WHEN s.n > 1 THEN 'ambiguous' ELSE 'matched' END AS status FROM cmd c LEFT JOIN (SELECT slot, tick % 9973 AS m, count(*) AS n, CASE WHEN count(*) = 1 THEN min(x) END AS x FROM st GROUP BY 1, 2) s ON s.slot = c.slot AND s.m = c.client_tick % 9973", STATE)
def join_9_unique_match(spark, d):
    right = states(spark, d).select("slot", (C("tick") % 9973).alias("m"), "x")
    left = commands(spark, d).select("row_id", "slot", (C("client_tick") % 9973).alias("m"))
    return joins.unique_join(left, right, ["slot", "m"], ["x"]).select("row_id", "x", "status")


@query("SELECT a.row_id, bool_or(b.present) AS pressed, count(b.row_id) AS n FROM cmd a LEFT JOIN cmd b ON b.slot = a.slot AND b.tick BETWEEN a.tick - 4 AND a.tick AND b.kind = 'click' WHERE a.kind = 'purchase' GROUP BY a.row_id", CMD)
def join_12_lookback(spark, d):
    c = commands(spark, d)
    a = c.where("kind = 'purchase'").select("row_id", "slot", "tick")
    b = c.where("kind = 'click'").select("slot", C("tick").alias("t"), "present")
    met = joins.band_join(a, b, ("slot",), "tick", "t", 4, 0).groupBy("row_id").agg(F.max("present").alias("pressed"), F.count("*").alias("n"))
    return a.select("row_id").join(met, "row_id", "left").select("row_id", "pressed", F.coalesce("n", F.lit(0)).alias("n"))


@query(
    "SELECT slot, tick, CASE WHEN a.n IS NULL THEN 'right_only' WHEN b.n IS NULL THEN 'left_only' WHEN a.n > 1 OR b.n > 1 THEN 'ambiguous' ELSE 'matched' END AS status, CASE WHEN a.n = 1 AND b.n = 1 THEN a.v END AS left_cents, CASE WHEN a.n = 1 AND b.n = 1 THEN b.v END AS right_cents FROM (SELECT slot, tick, count(*) AS n, min(cents) AS v FROM cmd WHERE slot % 10 < 9 GROUP BY 1, 2) a FULL JOIN (SELECT slot - 1 AS slot, tick, count(*) AS n, min(cents) AS v FROM cmd WHERE slot % 10 > 0 GROUP BY 1, 2) b USING (slot, tick)",
    CMD,
)
def join_15_unique_tick(spark, d):
    """Commands of each slot with those of the next slot of its recording at the same tick, if both are the only ones."""
    left, right = neighbours(commands(spark, d))
    return joins.paired_once(left, right, ["slot", "tick"], "cents")


@query("SELECT a.row_id, count(*) AS n, min(b.row_id) AS first FROM cmd a JOIN cmd b ON b.slot = a.slot AND b.cents BETWEEN a.cents - 3 AND a.cents + 3 AND b.kind = 'view' WHERE a.kind = 'error' GROUP BY a.row_id", CMD)
def join_16_tolerance(spark, d):
    c = commands(spark, d)
    b = c.where("kind = 'view'").select("slot", C("cents").alias("at"), C("row_id").alias("other"))
    a = c.where("kind = 'error'").select("row_id", "slot", "cents")
    return joins.band_join(a, b, ("slot",), "cents", "at", 3, 3).groupBy("row_id").agg(F.count("*").alias("n"), F.min("other").alias("first"))


@query("SELECT a.row_id, max(b.tick) AS before, min(c.tick) AS after FROM (SELECT * FROM cmd WHERE kind = 'purchase') a LEFT JOIN (SELECT slot, tick FROM cmd WHERE kind = 'view') b ON b.slot = a.slot AND b.tick < a.tick LEFT JOIN (SELECT slot, tick FROM cmd WHERE kind = 'view') c ON c.slot = a.slot AND c.tick > a.tick AND c.tick < a.tick + 500 WHERE b.tick > a.tick - 500 OR b.tick IS NULL GROUP BY a.row_id".replace("LEFT JOIN (SELECT slot, tick FROM cmd WHERE kind = 'view') b ON b.slot = a.slot AND b.tick < a.tick LEFT JOIN", "ASOF LEFT JOIN (SELECT DISTINCT slot, tick FROM cmd WHERE kind = 'view') b ON b.slot = a.slot AND b.tick < a.tick ASOF LEFT JOIN").replace("AND c.tick > a.tick AND c.tick < a.tick + 500 WHERE b.tick > a.tick - 500 OR b.tick IS NULL", "AND c.tick > a.tick"), CMD)
def join_17_bracketing(spark, d):
    c = commands(spark, d)
    a = c.where("kind = 'purchase'").select("row_id", "slot", "tick")
    v = c.where("kind = 'view'").select("slot", C("tick").alias("t")).distinct()
    back = joins.asof_join(a, v, "tick", "t", ("slot",), (), strict=True).withColumnRenamed("asof_t", "before")
    ahead = joins.asof_join(a.withColumn("minus", -C("tick")), v.withColumn("m", -C("t")), "minus", "m", ("slot",), ("t",), strict=True)
    return back.join(ahead.select("row_id", C("asof_t").alias("after")), "row_id").select("row_id", "before", "after")


@query("SELECT a.row_id, string_agg(CAST(b.row_id AS VARCHAR), ',' ORDER BY b.row_id) AS near FROM cmd a JOIN cmd b ON b.number BETWEEN a.number - 2 AND a.number + 8 WHERE a.kind = 'signup' GROUP BY a.row_id", CMD)
def join_18_neighbourhood(spark, d):
    c = commands(spark, d)
    a = c.where("kind = 'signup'").select("row_id", "number")
    met = joins.band_join(a, c.select(C("number").alias("m"), C("row_id").alias("other")), (), "number", "m", 2, 8)
    return met.groupBy("row_id").agg(F.array_join(F.array_sort(F.collect_list("other")), ",").alias("near"))


@query("SELECT a.row_id, count(*) AS n FROM cmd a JOIN cmd b ON a.slot = b.slot AND a.row_id <> b.row_id AND b.tick BETWEEN a.tick - 10 AND a.tick + 10 WHERE a.kind = 'purchase' GROUP BY a.row_id", CMD)
def join_19_proximity(spark, d):
    c = commands(spark, d)
    a = c.where("kind = 'purchase'").select("row_id", "slot", "tick")
    b = c.select("slot", C("tick").alias("t"), C("row_id").alias("other"))
    return joins.band_join(a, b, ("slot",), "tick", "t", 10, 10).where("other != row_id").groupBy("row_id").agg(F.count("*").alias("n"))


@query("SELECT a.slot, a.tick, b2.x AS x_2, b3.x AS x_3, b4.x AS x_4 FROM st a LEFT JOIN st b2 ON b2.slot = a.slot AND b2.tick = a.tick + 2 LEFT JOIN st b3 ON b3.slot = a.slot AND b3.tick = a.tick + 3 LEFT JOIN st b4 ON b4.slot = a.slot AND b4.tick = a.tick + 4", STATE)
def join_21_three_offsets(spark, d):
    s = states(spark, d)
    return joins.offset_join(s.select("slot", "tick"), s, "slot", "tick", (2, 3, 4), "x")


@query("SELECT a.row_id, coalesce(b.m, c.m) AS found, CASE WHEN b.m IS NOT NULL THEN 'exact' WHEN c.m IS NOT NULL THEN 'fallback' ELSE 'none' END AS mode FROM cmd a LEFT JOIN (SELECT cents, tick, min(row_id) AS m FROM cmd WHERE kind = 'view' GROUP BY 1, 2) b USING (cents, tick) LEFT JOIN (SELECT cents, min(row_id) AS m FROM cmd WHERE kind = 'click' GROUP BY 1) c USING (cents)", CMD)
def join_22_fallback_hash(spark, d):
    c = commands(spark, d)
    exact = c.where("kind = 'view'").groupBy("cents", "tick").agg(F.min("row_id").alias("m1"))
    loose = c.where("kind = 'click'").groupBy("cents").agg(F.min("row_id").alias("m2"))
    out = c.join(exact, ["cents", "tick"], "left").join(loose, "cents", "left")
    mode = F.when(C("m1").isNotNull(), "exact").when(C("m2").isNotNull(), "fallback").otherwise("none")
    return out.select("row_id", F.coalesce("m1", "m2").alias("found"), mode.alias("mode"))


@query("SELECT slot, frame_index, c.t AS last_tick, c.r AS last_row FROM pf ASOF LEFT JOIN (SELECT slot AS s, tick AS t, max(row_id) AS r FROM cmd GROUP BY slot, tick) c ON pf.slot = c.s AND pf.\"end\" >= c.t", CMD, PLAYER_FRAMES)
def join_23_prefix_lookup(spark, d):
    c = commands(spark, d).groupBy("slot", C("tick").alias("t")).agg(F.max("row_id").alias("r"))
    out = joins.asof_join(player_frames(spark, d), c, "end", "t", ("slot",), ("r",))
    return out.select("slot", "frame_index", C("asof_t").alias("last_tick"), C("asof_r").alias("last_row"))


@query("SELECT slot, tick, CASE WHEN a.x IS NULL THEN 'missing_left' WHEN b.x IS NULL THEN 'missing_right' ELSE 'changed' END AS status FROM (SELECT * FROM st WHERE slot % 10 < 9) a FULL JOIN (SELECT * REPLACE (slot - 1 AS slot) FROM st WHERE slot % 10 > 0) b USING (slot, tick) WHERE a.x IS NULL OR b.x IS NULL OR a.x <> b.x OR a.health <> b.health", STATE)
def join_26_table_comparison(spark, d):
    """States of each slot against those of the next slot of its recording."""
    left, right = neighbours(states(spark, d))
    return joins.compare_tables(left, right, ["slot", "tick"], ["x", "health"])


@query("SELECT c.row_id, s.o_orderpriority AS series FROM cmd c JOIN orders s ON s.o_orderkey = c.row_id", CMD)
def join_27_series(spark, d):
    series = spark.read.parquet(f"{d}/orders.parquet").select(C("o_orderkey").alias("row_id"), C("o_orderpriority").alias("series"))
    return commands(spark, d).select("row_id").join(series, "row_id")


@query("SELECT user_id, 'missing' AS kind FROM (SELECT DISTINCT user_id FROM cmd WHERE kind = 'view' EXCEPT SELECT user_id FROM cmd WHERE kind = 'signup') UNION ALL SELECT user_id, 'added' FROM (SELECT DISTINCT user_id FROM cmd WHERE kind = 'signup' EXCEPT SELECT user_id FROM cmd WHERE kind = 'view')", CMD)
def join_31_coverage(spark, d):
    c = commands(spark, d)
    return joins.not_covered(c.where("kind = 'view'"), c.where("kind = 'signup'"), "user_id")


@query("SELECT a.row_id, count(b.row_id) FILTER (b.tick <= a.tick - 4) AS before, count(b.row_id) FILTER (b.tick >= a.tick + 16) AS after FROM (SELECT * FROM cmd WHERE kind = 'purchase') a LEFT JOIN cmd b ON b.slot = a.slot AND (b.tick BETWEEN a.tick - 16 AND a.tick - 4 OR b.tick BETWEEN a.tick + 16 AND a.tick + 28) GROUP BY a.row_id", CMD)
def join_32_relative_windows(spark, d):
    c = commands(spark, d)
    a = c.where("kind = 'purchase'").select("row_id", "slot", "tick")
    b = c.select("slot", C("tick").alias("t"))
    step = C("t") - C("tick")
    met = joins.band_join(a, b, ("slot",), "tick", "t", 16, 28).groupBy("row_id").agg(F.count_if(step <= -4).alias("before"), F.count_if(step >= 16).alias("after"))
    return a.select("row_id").join(met, "row_id", "left").select("row_id", F.coalesce("before", F.lit(0)).alias("before"), F.coalesce("after", F.lit(0)).alias("after"))


@query("SELECT c.row_id, a.x AS x, a.tick AS state_tick FROM cmd c ASOF LEFT JOIN st a ON a.slot = c.slot AND a.tick <= c.tick - c.k", STATE)
def join_29_latest_before(spark, d):
    c = commands(spark, d).select("row_id", "slot", (C("tick") - C("k")).alias("at"))
    return joins.asof_join(c, states(spark, d), "at", "tick", ("slot",), ("x",)).select("row_id", C("asof_x").alias("x"), C("asof_tick").alias("state_tick"))


@query("SELECT slot, tick, x, lo, alpha * (x2 - x) + x AS at FROM (SELECT slot, tick, x, tick AS lo, 0.25 AS alpha, lead(x) OVER w AS x2, lead(tick) OVER w AS t2 FROM st WINDOW w AS (PARTITION BY slot ORDER BY tick)) WHERE t2 = tick + 1", STATE)
def win_26_interpolated(spark, d):
    from tideline.functions.angles import interpolate

    w = Window.partitionBy("slot").orderBy("tick")
    s = states(spark, d).withColumns({"x2": F.lead("x").over(w), "t2": F.lead("tick").over(w)}).where("t2 = tick + 1")
    return s.select("slot", "tick", "x", C("tick").alias("lo"), interpolate(C("x").cast("double"), C("x2").cast("double"), F.lit(0.25)).alias("at"))
