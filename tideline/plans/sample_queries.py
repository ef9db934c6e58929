"""Composite queries: targets, labels, reasons, acceptance, training assembly, and the rest of the inventory."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tideline.operators import joins, samples, selection, windows
from tideline.plans.registry import query
from tideline.plans.views import CMD, ROUNDS, STATE, WRAP, commands, neighbours, rounds, states
from tideline.plans.views import PLAYER_FRAMES, player_frames

C = F.col

TARGET = """
, cc AS (SELECT slot, row_id, tick AS t FROM cmd),
ff AS (SELECT slot, frame_index, "end" AS upper, "end" + 32 AS cutoff, max(frame_index) OVER () AS last FROM pf),
tg AS (SELECT f.slot, f.frame_index, upper, cutoff, last, min(row_id) FILTER (t - 1 > upper AND t <= cutoff) AS target, count(row_id) FILTER (t - 1 > upper AND t <= cutoff) AS n, count(row_id) FILTER (t - 1 <= upper AND upper <= t) AS overlapping
  FROM ff f LEFT JOIN cc ON cc.slot = f.slot AND t >= upper - 1 AND t <= cutoff GROUP BY f.slot, f.frame_index, upper, cutoff, last)"""


@query(
    "SELECT tg.slot, frame_index, upper, cutoff, target, t AS target_tick, t - 1 - upper AS gap, greatest(n - 1, 0) AS remaining, overlapping, concat_ws(',', CASE WHEN frame_index + 1 < 8 THEN 'insufficient_history_frames' END, CASE WHEN frame_index + 1 > last THEN 'insufficient_future_intervals' END, CASE WHEN target IS NULL THEN 'no_future_command' END, CASE WHEN t <> upper + 2 THEN 'first_future_command_coverage_gap' END) AS reasons FROM tg LEFT JOIN cc ON cc.row_id = target",
    CMD,
    PLAYER_FRAMES + TARGET,
)
def dom_19_causal_targets(spark, d):
    out = samples.causal_targets(player_frames(spark, d), commands(spark, d), "tick", 8, 2, 32, keys=("slot",))
    return out.withColumn("reasons", F.array_join("reason_codes", ",")).drop("reason_codes")


TRIPLE = """
, tri AS (SELECT *, lead(yaw, 1) OVER w AS y1, lead(yaw, 2) OVER w AS y2, lead(pitch, 1) OVER w AS q1, lead(pitch, 2) OVER w AS q2, lead(p1, 1) OVER w AS h1, lead(p1, 2) OVER w AS h2, lead(p2, 1) OVER w AS c1, lead(p2, 2) OVER w AS c2, lead(p3, 1) OVER w AS r1, lead(p3, 2) OVER w AS r2, lead(row_id, 2) OVER w AS third FROM cmd WINDOW w AS (PARTITION BY slot ORDER BY row_id))"""


def triples(spark, d):
    w = Window.partitionBy("slot").orderBy("row_id")
    names = {"yaw": "y", "pitch": "q", "p1": "h", "p2": "c", "p3": "r"}
    rows = commands(spark, d).withColumns({f"{n}{k}": F.lead(c, k).over(w) for c, n in names.items() for k in (1, 2)} | {"third": F.lead("row_id", 2).over(w)})
    return rows.where("third IS NOT NULL")


@query(f"SELECT row_id, CASE WHEN yaw IS NOT NULL AND y1 IS NOT NULL AND y2 IS NOT NULL AND abs({WRAP.format(d='y1 - yaw')}) <> 180 AND abs({WRAP.format(d='y2 - y1')}) <> 180 THEN round(({WRAP.format(d='y1 - yaw')}) + ({WRAP.format(d='y2 - y1')}), 9) + 0.0 END AS yaw_turn, CASE WHEN yaw IS NOT NULL AND y1 IS NOT NULL AND y2 IS NOT NULL THEN q2 - pitch END AS pitch_turn, yaw IS NOT NULL AND y1 IS NOT NULL AND y2 IS NOT NULL AS pitch_valid FROM tri WHERE third IS NOT NULL", CMD + TRIPLE)
def dom_27_aim_labels(spark, d):
    yaw, pitch = samples.aim_label([C("yaw"), C("y1"), C("y2")], [C("pitch"), C("q1"), C("q2")])
    return triples(spark, d).select("row_id", (F.round(yaw["value"], 9) + 0.0).alias("yaw_turn"), pitch["value"].alias("pitch_turn"), pitch["valid"].alias("pitch_valid"))


@query(
    "SELECT row_id, CASE WHEN ok THEN c END AS held_end, CASE WHEN ok THEN x <> y END AS net_changed, CASE WHEN ok THEN x <> y AND c END AS net_pressed, CASE WHEN ok THEN x <> y AND NOT c END AS net_released, CASE WHEN ok THEN r OR s END AS rapid, CASE WHEN ok THEN x OR y OR r OR s END AS activity FROM (SELECT *, (a <> b) = x AND (b <> c) = y AS ok FROM (SELECT row_id, (p1 & 4) <> 0 AS a, (h1 & 4) <> 0 AS b, (h2 & 4) <> 0 AS c, (c1 & 4) <> 0 AS x, (c2 & 4) <> 0 AS y, (r1 & 4) <> 0 AS r, (r2 & 4) <> 0 AS s FROM tri WHERE third IS NOT NULL))",
    CMD + TRIPLE,
)
def dom_29_button_labels(spark, d):
    label = samples.button_label([C("p1"), C("h1"), C("h2")], [C("p2"), C("c1"), C("c2")], [C("p3"), C("r1"), C("r2")], 4)
    return triples(spark, d).select("row_id", label.alias("x")).select("row_id", "x.*")


@query("SELECT row_id, array_to_string(list_sort(list_distinct(flatten(list(CASE WHEN s.slot IS NULL THEN ['missing_player_state'] ELSE list_filter([CASE WHEN NOT s.alive THEN 'not_alive' END, CASE WHEN s.paused THEN 'paused_active' END, CASE WHEN s.paused IS NULL THEN 'paused_unknown' END], lambda x: x IS NOT NULL) END)))), ',') AS reasons FROM (SELECT row_id, slot, unnest(range(tick - 1, tick + 2)) AS t FROM cmd WHERE kind = 'purchase') c LEFT JOIN st s ON s.slot = c.slot AND s.tick = c.t GROUP BY row_id", STATE)
def dom_16_state_reasons(spark, d):
    c = commands(spark, d).where("kind = 'purchase'").select("row_id", "slot", (C("tick") - 1).alias("first"), (C("tick") + 1).alias("last"))
    s = states(spark, d).select("slot", "tick", "alive", "paused", F.lit(True).alias("_has"))
    out = samples.range_reasons(c, s, "row_id", "first", "last", {"not_alive": ~C("alive"), "paused_active": C("paused"), "paused_unknown": C("paused").isNull()})
    return out.select("row_id", F.array_join("reason_codes", ",").alias("reasons"))


@query("SELECT row_id, concat_ws(',', CASE WHEN yaw IS NULL THEN 'missing_viewangles' END, CASE WHEN NOT alive THEN 'not_alive' END, CASE WHEN dx IS NULL AND coalesce(present, false) THEN 'defaulted_mouse' END, CASE WHEN tick - lag(tick) OVER (PARTITION BY slot ORDER BY row_id) > 16 THEN 'tick_gap' END) AS reasons FROM cmd", CMD)
def dom_14_quality_reasons(spark, d):
    gap = C("tick") - F.lag("tick").over(Window.partitionBy("slot").orderBy("row_id"))
    rules = F.array_compact(F.array(F.when(C("yaw").isNull(), F.lit("missing_viewangles")), F.when(~C("alive"), F.lit("not_alive")), F.when(C("dx").isNull() & F.coalesce("present", F.lit(False)), F.lit("defaulted_mouse")), F.when(gap > 16, F.lit("tick_gap"))))
    return commands(spark, d).withColumn("r", rules).select("row_id", F.array_join("r", ",").alias("reasons"))


@query("SELECT accepted, count(*) AS n, count(DISTINCT user_id) AS users FROM (SELECT user_id, alive AND yaw IS NOT NULL AND coalesce(present, false) AND row_number() OVER (PARTITION BY slot ORDER BY row_id) >= 8 AS accepted FROM cmd) GROUP BY accepted", CMD)
def dom_17_acceptance(spark, d):
    n = F.row_number().over(Window.partitionBy("slot").orderBy("row_id"))
    ok = C("alive") & C("yaw").isNotNull() & F.coalesce("present", F.lit(False)) & (C("n") >= 8)
    return commands(spark, d).withColumn("n", n).groupBy(ok.alias("accepted")).agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("users"))


@query("SELECT row_id, CASE WHEN yaw IS NULL THEN 'unknown' WHEN NOT alive THEN 'rejected' WHEN present IS NULL THEN 'unknown' WHEN present THEN 'verified' ELSE 'rejected' END AS status, CASE WHEN yaw IS NULL THEN 'no_view' WHEN NOT alive THEN 'dead' WHEN present IS NULL THEN 'no_evidence' WHEN present THEN 'ok' ELSE 'other_view' END AS reason FROM cmd", CMD)
def dom_13_rule_cascade(spark, d):
    rule = F.when(C("yaw").isNull(), F.struct(F.lit("unknown").alias("status"), F.lit("no_view").alias("reason")))
    for when, status, reason in ((~C("alive"), "rejected", "dead"), (C("present").isNull(), "unknown", "no_evidence"), (C("present"), "verified", "ok")):
        rule = rule.when(when, F.struct(F.lit(status).alias("status"), F.lit(reason).alias("reason")))
    return commands(spark, d).select("row_id", rule.otherwise(F.struct(F.lit("rejected").alias("status"), F.lit("other_view").alias("reason"))).alias("x")).select("row_id", "x.*")


@query("SELECT slot, tick, round_id, array_to_string(v, ',') AS vals, array_to_string(m, ',') AS mask FROM (SELECT slot, tick, round_id, [coalesce(CAST(paused AS INT), 0), coalesce(CAST(yaw > 0 AS INT), 0)] AS v, [paused IS NOT NULL, yaw IS NOT NULL] AS m FROM st)", STATE)
def dom_65_masked_targets(spark, d):
    v, m = samples.masked_array([C("paused").cast("int"), (C("yaw") > 0).cast("int")])
    text = lambda c, kind: F.array_join(F.transform(c, lambda x: x.cast(kind).cast("string")), ",")
    return states(spark, d).select("slot", "tick", "round_id", text(v, "int").alias("vals"), text(m, "boolean").alias("mask"))


@query("SELECT split, count(*) AS n, count(DISTINCT user_id) AS series FROM (SELECT user_id, CASE WHEN b < 8000 THEN 'train' WHEN b < 9000 THEN 'validation' ELSE 'test' END AS split FROM (SELECT user_id, list_reduce(list_prepend(0::BIGINT, list_transform(range(0, 16), lambda i: ('0x' || substr(sha256('train-1:' || user_id), i * 4 + 1, 4))::BIGINT)), lambda a, x: (a * 65536 + x) % 10000) AS b FROM (SELECT DISTINCT user_id, tick FROM cmd))) GROUP BY split", CMD)
def dom_67_training_assembly(spark, d):
    out = samples.assemble(commands(spark, d), ["user_id", "tick"], ["row_id"], "user_id", "train-1")
    return out.groupBy("split").agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("series"))


@query("SELECT round_id, slot, count(*) AS n, CAST(sum(CASE WHEN p2 & 1 > 0 THEN 1 ELSE 0 END) AS BIGINT) AS attacks FROM cmd WHERE alive GROUP BY 1, 2 HAVING count(*) >= 4".replace("p2 & 1 > 0", "(p2 & 1) > 0"), CMD)
def dom_39_candidates(spark, d):
    from tideline.functions.bits import any_bit

    return commands(spark, d).where("alive").groupBy("round_id", "slot").agg(F.count("*").alias("n"), F.count_if(any_bit(C("p2"), 1)).alias("attacks")).where("n >= 4")


@query("SELECT slot, ns // 20000000 AS cell, count(DISTINCT ns) > 1 AS collides, count(*) AS n FROM (SELECT slot, (sec * 64 + cents % 64) * 15625000 AS ns FROM cmd) GROUP BY 1, 2", CMD)
def dom_72_control_grid(spark, d):
    """Controls at 64ths of a second on a grid of 20 ms: which cells get more than one."""
    ns = commands(spark, d).select("slot", ((C("sec") * 64 + C("cents") % 64) * 15_625_000).alias("ns"))
    return ns.groupBy("slot", F.expr("ns div 20000000").alias("cell")).agg((F.countDistinct("ns") > 1).alias("collides"), F.count("*").alias("n"))


@query("SELECT c.row_id, s.start AS segment_start FROM cmd c LEFT JOIN (SELECT round_id, start, freeze_end FROM rd) s ON s.round_id = c.round_id AND c.tick >= s.start AND c.tick < s.freeze_end", CMD, ROUNDS)
def join_8_segment_lookup(spark, d):
    r = rounds(spark, d).select("round_id", "start", C("freeze_end").alias("end"))
    return joins.interval_join(commands(spark, d), r, "tick", keys=("round_id",), how="left").select("row_id", C("start").alias("segment_start"))


@query("SELECT c.row_id, CASE WHEN e.n IS NULL THEN 'missing' WHEN e.n > 1 THEN 'ambiguous' ELSE 'matched' END AS status, CASE WHEN e.n = 1 THEN e.k END AS k FROM cmd c LEFT JOIN (SELECT user_id, round_id, slot, kind, p1, count(*) AS n, min(k) AS k FROM cmd WHERE kind IN ('view', 'click') GROUP BY 1, 2, 3, 4, 5) e USING (user_id, round_id, slot, kind, p1)", CMD)
def join_10_five_keys(spark, d):
    c = commands(spark, d)
    keys = ["user_id", "round_id", "slot", "kind", "p1"]
    return joins.unique_join(c.drop("k"), c.where("kind IN ('view', 'click')").select(*keys, "k"), keys, ["k"]).select("row_id", "status", "k")


@query("SELECT kind, clock, count(*) AS n FROM (SELECT 'tick' AS kind, tick AS clock FROM cmd UNION ALL SELECT 'client', client_tick FROM cmd UNION ALL SELECT 'number', number FROM cmd) GROUP BY 1, 2", CMD)
def join_11_clock_index(spark, d):
    c = commands(spark, d)
    keyed = [c.select(F.lit(k).alias("kind"), C(x).alias("clock")) for k, x in (("tick", "tick"), ("client", "client_tick"), ("number", "number"))]
    return keyed[0].unionByName(keyed[1]).unionByName(keyed[2]).groupBy("kind", "clock").agg(F.count("*").alias("n"))


@query("SELECT a.row_id, count(b.row_id) AS n, CASE WHEN count(b.row_id) = 1 THEN min(b.row_id) END AS shot FROM (SELECT * FROM cmd WHERE kind = 'purchase') a LEFT JOIN cmd b ON b.slot = a.slot AND b.tick = a.tick AND b.row_id <> a.row_id AND (b.p1 & 1) <> 0 GROUP BY a.row_id", CMD)
def join_13_shot_clock(spark, d):
    c = commands(spark, d)
    b = c.where(C("p1").bitwiseAND(F.lit(1)) != 0).select("slot", "tick", C("row_id").alias("other"))
    met = c.where("kind = 'purchase'").select("row_id", "slot", "tick").join(b, ["slot", "tick"], "left").where("other IS NULL OR other != row_id")
    a = c.where("kind = 'purchase'").select("row_id")
    g = met.groupBy("row_id").agg(F.count("other").alias("n"), F.min("other").alias("m"))
    return a.join(g, "row_id", "left").select("row_id", F.coalesce("n", F.lit(0)).alias("n"), F.when(C("n") == 1, C("m")).alias("shot"))


@query("SELECT c.row_id, a.cents AS next_1, b.cents AS next_2 FROM cmd c LEFT JOIN cmd a ON a.row_id = c.row_id + 1 LEFT JOIN cmd b ON b.row_id = c.row_id + 2", CMD)
def join_20_next_numbers(spark, d):
    c = commands(spark, d).withColumn("all", F.lit(1))
    return joins.offset_join(c.select("row_id", "all"), c, "all", "row_id", (1, 2), "cents").select("row_id", C("cents_1").alias("next_1"), C("cents_2").alias("next_2"))


@query("SELECT slot, tick, CASE WHEN a.x IS NULL OR b.x IS NULL THEN 'uncovered' WHEN sha256(CAST(a.x AS VARCHAR)) IN (sha256(CAST(b.x AS VARCHAR)), sha256(CAST(-b.x AS VARCHAR))) THEN 'agrees' ELSE 'differs' END AS status FROM (SELECT slot, tick, x FROM st WHERE slot % 10 < 7) a FULL JOIN (SELECT slot - 3 AS slot, tick, x FROM st WHERE slot % 10 >= 3) b USING (slot, tick)", STATE)
def join_24_hash_agreement(spark, d):
    """Digests of each slot's states against those of the slot three on in its recording."""
    digest = lambda c: F.sha2(c.cast("string"), 256)
    a, b = neighbours(states(spark, d).select("slot", "tick", "x"), 3)
    met = a.withColumnRenamed("x", "xa").join(b.withColumnRenamed("x", "xb"), ["slot", "tick"], "full_outer")
    status = F.when(C("xa").isNull() | C("xb").isNull(), "uncovered").when(digest(C("xa")).isin(digest(C("xb")), digest(-C("xb"))), "agrees").otherwise("differs")
    return met.select("slot", "tick", status.alias("status"))


@query("SELECT f.slot, f.frame_index, a.x AS movie, b.x AS clock, c.x AS packet FROM pf f LEFT JOIN st a ON a.tick = f.start AND a.slot = f.slot LEFT JOIN st b ON b.tick = f.start AND b.slot = f.slot + 1 LEFT JOIN st c ON c.tick = f.start AND c.slot = f.slot + 2 WHERE f.slot % 10 < 8", STATE, PLAYER_FRAMES)
def join_25_frame_proofs(spark, d):
    """Each slot's frames with its own state at their start and those of the two slots after it in its recording."""
    out, s = player_frames(spark, d).where("slot % 10 < 8"), states(spark, d).select("slot", C("tick").alias("start"), "x")
    for k, name in enumerate(("movie", "clock", "packet")):
        out = out.join(s.select((C("slot") - k).alias("slot"), "start", C("x").alias(name)), ["slot", "start"], "left")
    return out.select("slot", "frame_index", "movie", "clock", "packet")


@query("SELECT c.row_id, list_contains(s.kinds, 'click') AS proven FROM cmd c LEFT JOIN (SELECT slot, tick, list(DISTINCT kind) AS kinds FROM cmd WHERE kind <> 'view' GROUP BY 1, 2) s USING (slot, tick)", CMD)
def join_28_row_proofs(spark, d):
    c = commands(spark, d)
    proofs = c.where("kind <> 'view'").groupBy("slot", "tick").agg(F.collect_set("kind").alias("kinds"))
    return c.join(proofs, ["slot", "tick"], "left").select("row_id", F.array_contains("kinds", "click").alias("proven"))


@query("SELECT row_id, CAST(sum(CASE WHEN kind = 'signup' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS epoch, max(tick) OVER w AS lifetime FROM cmd WINDOW w AS (PARTITION BY user_id ORDER BY row_id)", CMD)
def win_13_epoch_replay(spark, d):
    w = Window.partitionBy("user_id").orderBy("row_id").rowsBetween(Window.unboundedPreceding, 0)
    return commands(spark, d).select("row_id", F.sum((C("kind") == "signup").cast("long")).over(w).alias("epoch"), F.max("tick").over(w).alias("lifetime"))


@query("SELECT slot, round_id, held, count(*) AS n FROM (SELECT slot, round_id, lag((p1 & 1) <> 0) OVER w IS NOT DISTINCT FROM ((p1 & 1) <> ((p2 & 1))) AS held FROM (SELECT slot, round_id, row_id, p1, p2 FROM cmd) WINDOW w AS (PARTITION BY slot, round_id ORDER BY row_id)) GROUP BY 1, 2, 3".replace("((p1 & 1) <> ((p2 & 1)))", "(((p1 & 1) <> 0) <> ((p2 & 1) <> 0))"), CMD)
def win_25_held_boundaries(spark, d):
    from tideline.functions.bits import decode

    got = decode(C("p1"), C("p2"), C("p3"), 1)
    w = Window.partitionBy("slot", "round_id").orderBy("row_id")
    rows = commands(spark, d).withColumns({"end": got["held_end"], "begin": got["held_start"]})
    return rows.withColumn("held", F.lag("end").over(w).eqNullSafe(C("begin"))).groupBy("slot", "round_id", "held").agg(F.count("*").alias("n"))


@query("SELECT slot, len, min(tick) AS first, count(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY slot ORDER BY tick) - row_number() OVER (PARTITION BY slot, len ORDER BY tick) AS g FROM (SELECT slot, tick, lead(tick) OVER (PARTITION BY slot ORDER BY tick) - tick AS len FROM st) WHERE len IS NOT NULL) GROUP BY slot, len, g", STATE)
def win_31_equal_lengths(spark, d):
    w = Window.partitionBy("slot").orderBy("tick")
    rows = states(spark, d).withColumn("len", F.lead("tick").over(w) - C("tick")).where("len IS NOT NULL")
    runs = windows.islands(rows.withColumn("cut", C("len") != F.lag("len").over(w)), ["slot"], ["tick"], C("cut"))
    return runs.groupBy("slot", "len", "island").agg(F.min("tick").alias("first"), F.count("*").alias("n")).drop("island")


@query("SELECT user_id, count(*) FILTER (kind = pk) AS repeated, CAST(sum(CASE WHEN kind = 'click' THEN 1 ELSE -1 END) AS BIGINT) AS open, max(CASE WHEN kind = 'purchase' AND pk = 'click' THEN tick - pt END) AS longest FROM (SELECT *, lag(kind) OVER w AS pk, lag(tick) OVER w AS pt FROM cmd WHERE kind IN ('click', 'purchase') WINDOW w AS (PARTITION BY user_id ORDER BY row_id)) GROUP BY user_id", CMD)
def win_35_event_plan(spark, d):
    w = Window.partitionBy("user_id").orderBy("row_id")
    rows = commands(spark, d).where("kind IN ('click', 'purchase')").withColumns({"pk": F.lag("kind").over(w), "pt": F.lag("tick").over(w)})
    held = F.when((C("kind") == "purchase") & (C("pk") == "click"), C("tick") - C("pt"))
    return rows.groupBy("user_id").agg(F.count_if(C("kind") == C("pk")).alias("repeated"), F.sum(F.when(C("kind") == "click", 1).otherwise(-1)).alias("open"), F.max(held).alias("longest"))


@query("SELECT slot, tick, x, health FROM st WHERE tick % 1440 < 60 UNION ALL SELECT slot, tick, x, health FROM st WHERE tick % 1440 >= 60 AND health > 50", STATE)
def set_8_context_union(spark, d):
    """The context of every round (its first hour), and the rows selected of the rest of it."""
    s = states(spark, d).select("slot", "tick", "x", "health")
    context = C("tick") % 1440 < 60
    return s.where(context).unionByName(s.where(~context & (C("health") > 50)))


@query("SELECT kind, min(tick) AS first, max(tick) AS last, count(DISTINCT tick) AS ticks FROM cmd GROUP BY kind", CMD)
def agg_28_clock_range(spark, d):
    return commands(spark, d).groupBy("kind").agg(F.min("tick").alias("first"), F.max("tick").alias("last"), F.countDistinct("tick").alias("ticks"))


@query("SELECT round_id, n * 230 AS megabytes, n * 25 + 30 AS seconds, n * 230 <= 60000 AS fits FROM (SELECT round_id, count(*) AS n FROM cmd GROUP BY round_id)", CMD)
def agg_31_budget(spark, d):
    n = commands(spark, d).groupBy("round_id").agg(F.count("*").alias("n"))
    return n.select("round_id", (C("n") * 230).alias("megabytes"), (C("n") * 25 + 30).alias("seconds"), (C("n") * 230 <= 60000).alias("fits"))


@query("SELECT planned + excluded = total AS balanced, planned, excluded, total FROM (SELECT count(*) FILTER (alive) AS planned, count(*) FILTER (NOT alive) AS excluded, count(*) AS total FROM cmd)", CMD)
def agg_19_balance(spark, d):
    n = commands(spark, d).agg(F.count_if("alive").alias("planned"), F.count_if(~C("alive")).alias("excluded"), F.count("*").alias("total"))
    return n.select((C("planned") + C("excluded") == C("total")).alias("balanced"), "planned", "excluded", "total")


#: The picks one after another: `seen` counts the actions of those before, `byact` has the best row of each action.
DIVERSE = """
c AS (SELECT DISTINCT row_id, sha256(row_id::VARCHAR) AS h, kind AS s, kind || ':' || round_id AS r, kind || ':' || user_id AS p, p1 FROM cmd WHERE alive),
lim AS (SELECT least(64, count(DISTINCT h)) AS n FROM c),
pk AS (SELECT 0 AS pick, NULL::BIGINT AS row_id, []::BIGINT[] AS taken, []::VARCHAR[] AS ss, []::VARCHAR[] AS rs, []::VARCHAR[] AS ps, [0, 0, 0, 0, 0, 0] AS seen
  UNION ALL
  SELECT pick + 1, b.id, list_append(taken, b.id), list_append(ss, b.s), list_append(rs, b.r), list_append(ps, b.p), list_transform(range(0, 6), lambda k: seen[k + 1] + ((b.p1 >> k) & 1)::INTEGER)
  FROM (SELECT *, CASE WHEN pick < ceil(n * 0.5) THEN best ELSE coalesce(byact[list_min(list_transform(list_filter(range(1, 7), lambda k: byact[k] IS NOT NULL), lambda k: {'c': seen[k], 'k': k})).k], best) END AS b
    FROM (SELECT pick, any_value(n) AS n, any_value(taken) AS taken, any_value(ss) AS ss, any_value(rs) AS rs, any_value(ps) AS ps, any_value(seen) AS seen, min(o) AS best,
        [""" + ", ".join(f"min(o) FILTER ((p1 >> {k}) & 1 = 1)" for k in range(6)) + """] AS byact
      FROM (SELECT pk.*, n, p1, {'ns': len(list_filter(ss, lambda x: x = c.s)), 'nr': len(list_filter(rs, lambda x: x = c.r)), 'np': len(list_filter(ps, lambda x: x = c.p)), 'h': h, 'id': c.row_id, 's': c.s, 'r': c.r, 'p': c.p, 'p1': p1} AS o
        FROM pk, lim, c WHERE pick < n AND NOT list_contains(taken, c.row_id))
      GROUP BY pick)))"""


@query("SELECT pick::INTEGER AS pick, row_id FROM pk WHERE pick > 0", "RECURSIVE " + CMD.strip(), DIVERSE)
def ord_4_diverse_selection(spark, d):
    actions = {f"button_{k}": C("p1").bitwiseAND(F.lit(1 << k)) > 0 for k in range(6)}
    keys = selection.diverse(commands(spark, d).where("alive"), "row_id", "kind", "user_id", 64, "round_id", actions)
    return spark.createDataFrame([(i + 1, k) for i, k in enumerate(keys)], "pick int, row_id long")
