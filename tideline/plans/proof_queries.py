"""Queries of collection, acceptance, proofs and measured responses: operators put together."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tideline.functions import bits, wire
from tideline.functions.angles import wrap_degrees
from tideline.operators import audits, labels, samples, selection, windows
from tideline.plans.label_queries import JOINED, phases
from tideline.plans.registry import query
from tideline.plans.sample_queries import TARGET, TRIPLE
from tideline.plans.views import CMD, PLAYER_FRAMES, ROUNDS, STATE, WRAP, commands, player_frames, rounds, states
from tideline.sources import sinks, tables
from tideline.sources.scratch import new_folder

C = F.col


@query(
    "SELECT slot, CAST(sum(e - s) AS BIGINT) AS ticks, count(*) AS windows, sum(e - s) >= 30 AS planned FROM (SELECT slot, g, min(start) AS s, max(stop) AS e FROM (SELECT *, sum(c) OVER (PARTITION BY slot ORDER BY start, stop) AS g FROM (SELECT *, CASE WHEN start <= max(stop) OVER (PARTITION BY slot ORDER BY start, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS c FROM (SELECT slot, tick AS start, tick + 1 + k % 20 AS stop FROM (SELECT *, row_number() OVER (PARTITION BY slot, kind ORDER BY sha256(CAST(row_id AS VARCHAR)), row_id) AS rn FROM cmd WHERE kind IN ('view', 'click')) WHERE rn <= 3))) GROUP BY slot, g) GROUP BY slot",
    CMD,
)
def dom_40_collection(spark, d):
    """Pools of two sources put together, the first of each player and source in hash order, their windows merged; a player
    is planned if enough ticks came together."""
    c = commands(spark, d).select("slot", "kind", "row_id", C("tick").alias("start"), (C("tick") + 1 + C("k") % 20).alias("end"))
    pool = c.where("kind = 'view'").unionByName(c.where("kind = 'click'"))
    rn = F.row_number().over(Window.partitionBy("slot", "kind").orderBy(selection.hash_order("row_id"), "row_id"))
    chosen = pool.withColumn("rn", rn).where("rn <= 3")
    merged = windows.running_segments(chosen, ["slot"], "start", "end")
    ticks = F.sum(C("end") - C("start"))
    return merged.groupBy("slot").agg(ticks.alias("ticks"), F.count("*").alias("windows"), (ticks >= 30).alias("planned"))


@query(
    "SELECT tg.slot, frame_index, target, " + JOINED.format(r="CASE WHEN frame_index + 1 < 8 THEN 'insufficient_history_frames' END, CASE WHEN frame_index + 1 > last THEN 'insufficient_future_intervals' END, CASE WHEN cc.t <> upper + 2 THEN 'first_future_command_coverage_gap' END, CASE WHEN NOT st.alive THEN 'target_not_alive' END, CASE WHEN st.paused IS NULL THEN 'paused_unknown' WHEN st.paused THEN 'paused_active' END, CASE WHEN b.odd > 0 THEN 'packet_bound_unknown' END") + " AS reasons FROM tg JOIN cc ON cc.row_id = target JOIN st ON st.slot = tg.slot AND st.tick = cc.t JOIN (SELECT row_id, count(*) FILTER (kind = 'error') OVER (PARTITION BY slot, round_id ORDER BY row_id) AS odd FROM cmd) b ON b.row_id = target",
    STATE,
    PLAYER_FRAMES + TARGET,
)
def dom_23_causal_acceptance(spark, d):
    """Each frame's first command that it may be asked for, with every reason against it: of the frame, of the player's
    state then, and of what came before in the packets."""
    c = commands(spark, d)
    t = samples.causal_targets(player_frames(spark, d), c, "tick", 8, 2, 32, keys=("slot",)).where("target is not null")
    s = states(spark, d).select("slot", C("tick").alias("target_tick"), "alive", "paused")
    w = Window.partitionBy("slot", "round_id").orderBy("row_id").rowsBetween(Window.unboundedPreceding, 0)
    odd = c.select(C("row_id").alias("target"), F.sum((C("kind") == "error").cast("int")).over(w).alias("odd"))
    rows = t.join(s, ["slot", "target_tick"]).join(odd, "target")
    more = labels.sorted_reasons([(~C("alive"), "target_not_alive"), (C("paused").isNull(), "paused_unknown"), (C("paused"), "paused_active"), (C("odd") > 0, "packet_bound_unknown")])
    return rows.select("slot", "frame_index", "target", F.array_join(F.array_sort(F.array_union("reason_codes", more)), ",").alias("reasons"))


@query("SELECT round_id, phase_verified, clocks, bounds, CASE WHEN NOT phase_verified THEN 'phase' WHEN clocks > 0 THEN 'clock' WHEN bounds > 0 THEN 'bound' ELSE 'proven' END AS verdict FROM (SELECT r.round_id, coalesce(s.phase = 'competitive', false) AS phase_verified, coalesce(q.clocks, 0) AS clocks, coalesce(q.bounds, 0) AS bounds FROM rd r LEFT JOIN (SELECT round_id, CASE WHEN count(*) FILTER (NOT alive) > count(*) * 0.22 THEN 'setup' ELSE 'competitive' END AS phase FROM cmd WHERE round_id % 5 <> 2 GROUP BY round_id) s USING (round_id) LEFT JOIN (SELECT round_id, count(*) FILTER (falls > 0) AS clocks, count(*) FILTER (odd > 20) AS bounds FROM (SELECT slot, round_id, count(*) FILTER (number < p) AS falls, count(*) FILTER (kind = 'error') AS odd FROM (SELECT *, lag(number) OVER (PARTITION BY slot, round_id ORDER BY row_id) AS p FROM cmd) GROUP BY slot, round_id) GROUP BY round_id) q USING (round_id))", CMD, ROUNDS)
def dom_36_replay_proof(spark, d):
    """A round is proven if its phase, the clocks and the bounds of all its players are; else the first that is not."""
    before = F.lag("number").over(Window.partitionBy("slot", "round_id").orderBy("row_id"))
    players = commands(spark, d).withColumn("p", before).groupBy("slot", "round_id").agg(F.count_if(C("number") < C("p")).alias("falls"), F.count_if(C("kind") == "error").alias("odd"))
    per = players.groupBy("round_id").agg(F.count_if(C("falls") > 0).alias("clocks"), F.count_if(C("odd") > 20).alias("bounds"))
    r = phases(spark, d).select("round_id", C("verified").alias("phase_verified")).join(per, "round_id", "left").fillna(0, ["clocks", "bounds"])
    verdict = F.when(~C("phase_verified"), "phase").when(C("clocks") > 0, "clock").when(C("bounds") > 0, "bound").otherwise("proven")
    return r.withColumn("verdict", verdict)


EDGE = "count(yaw) = count(*) AND count(*) = 5"


@query(
    f"SELECT slot, round_id, CASE WHEN ok_a AND ok_b THEN round({WRAP.format(d='b - a')}, 6) + 0.0 END AS response, CASE WHEN NOT ok_a THEN 'no_plateau_before' WHEN NOT ok_b THEN 'no_plateau_after' END AS excluded FROM (SELECT a.slot, a.round_id, a.m AS a, a.ok AS ok_a, b.m AS b, b.ok AS ok_b FROM (SELECT slot, round_id, median(y) AS m, {EDGE} AS ok FROM (SELECT *, {WRAP.format(d='yaw - y0')} + y0 AS y FROM (SELECT slot, round_id, yaw, first_value(yaw) OVER (PARTITION BY slot, round_id ORDER BY row_id) AS y0, row_number() OVER (PARTITION BY slot, round_id ORDER BY row_id) AS i FROM cmd) WHERE i <= 5) GROUP BY slot, round_id) a JOIN (SELECT slot, round_id, median(y) AS m, {EDGE} AS ok FROM (SELECT *, {WRAP.format(d='yaw - y0')} + y0 AS y FROM (SELECT slot, round_id, yaw, first_value(yaw) OVER (PARTITION BY slot, round_id ORDER BY row_id DESC) AS y0, row_number() OVER (PARTITION BY slot, round_id ORDER BY row_id DESC) AS i FROM cmd) WHERE i <= 5) GROUP BY slot, round_id) b USING (slot, round_id))",
    CMD,
)
def dom_57_plateau_response(spark, d):
    """The turn from the plateau of a round's first five commands to that of its last five, each unwrapped around its outer
    one; without five known angles there is no plateau, and that is said."""

    def plateau(name, order):
        w = Window.partitionBy("slot", "round_id").orderBy(order)
        rows = commands(spark, d).select("slot", "round_id", "yaw", F.first("yaw").over(w).alias("y0"), F.row_number().over(w).alias("i")).where("i <= 5")
        return rows.groupBy("slot", "round_id").agg(F.median(wrap_degrees(C("yaw") - C("y0")) + C("y0")).alias(name), ((F.count("yaw") == F.count("*")) & (F.count("*") == 5)).alias(f"ok_{name}"))

    both = plateau("a", C("row_id")).join(plateau("b", C("row_id").desc()), ["slot", "round_id"])
    excluded = F.when(~C("ok_a"), "no_plateau_before").when(~C("ok_b"), "no_plateau_after")
    return both.select("slot", "round_id", F.when(excluded.isNull(), F.round(wrap_degrees(C("b") - C("a")), 6) + 0.0).alias("response"), excluded.alias("excluded"))


@query("SELECT slot, status, count(*) AS n FROM (SELECT l.slot, CASE WHEN e.n IS NULL THEN 'no_edge' WHEN e.up > 0 AND e.down > 0 THEN 'ambiguous' WHEN (e.up > 0) = l.pressed THEN 'agrees' ELSE 'contradicts' END AS status FROM (SELECT slot, tick, (h2 & 4) <> 0 AS pressed FROM tri WHERE third IS NOT NULL AND (p1 & 4 <> 0) <> (h2 & 4 <> 0)) l LEFT JOIN (SELECT slot, tick, count(*) AS n, count(*) FILTER (k % 2 = 0) AS up, count(*) FILTER (k % 2 = 1) AS down FROM cmd WHERE kind IN ('click', 'view') GROUP BY slot, tick) e ON e.slot = l.slot AND e.tick = l.tick) GROUP BY slot, status".replace("p1 & 4 <> 0", "(p1 & 4) <> 0").replace("h2 & 4 <> 0)", "(h2 & 4) <> 0)"), CMD + TRIPLE)
def dom_64_edge_label_agreement(spark, d):
    """Labels that say a button changed, against the edges seen in their tick."""
    w = Window.partitionBy("slot").orderBy("row_id")
    c = commands(spark, d)
    held, ends = bits.any_bit(C("p1"), 4), bits.any_bit(C("h2"), 4)
    said = c.withColumns({"h2": F.lead("p1", 2).over(w), "third": F.lead("row_id", 2).over(w)}).where(C("third").isNotNull() & (held != ends)).select("slot", "tick", ends.alias("pressed"))
    edges = c.where("kind in ('click', 'view')").groupBy("slot", "tick").agg(F.count("*").alias("n"), F.count_if(C("k") % 2 == 0).alias("up"), F.count_if(C("k") % 2 == 1).alias("down"))
    status = F.when(C("n").isNull(), "no_edge").when((C("up") > 0) & (C("down") > 0), "ambiguous").when((C("up") > 0) == C("pressed"), "agrees").otherwise("contradicts")
    return said.join(edges, ["slot", "tick"], "left").groupBy("slot", status.alias("status")).agg(F.count("*").alias("n"))


@query("SELECT slot, kind, n, pressed, effects, CASE WHEN n = 0 THEN 'untested' WHEN effects = pressed THEN 'consistent' WHEN effects = 0 THEN 'no_effect' ELSE 'mixed' END AS status FROM (SELECT slot, kind, count(*) AS n, count(*) FILTER (pressed) AS pressed, count(*) FILTER (pressed AND moved) AS effects FROM (SELECT slot, kind, (p2 & 1) <> 0 AS pressed, coalesce(lead(cents) OVER (PARTITION BY slot ORDER BY row_id) > cents, false) AS moved FROM cmd) GROUP BY slot, kind)", CMD)
def dom_59_keyboard_summary(spark, d):
    """Of each player and control: how many presses, how many of them had the effect that they should, and what follows."""
    moved = F.coalesce(F.lead("cents").over(Window.partitionBy("slot").orderBy("row_id")) > C("cents"), F.lit(False))
    rows = commands(spark, d).select("slot", "kind", bits.any_bit(C("p2"), 1).alias("pressed"), moved.alias("moved"))
    g = rows.groupBy("slot", "kind").agg(F.count("*").alias("n"), F.count_if("pressed").alias("pressed"), F.count_if(C("pressed") & C("moved")).alias("effects"))
    return g.withColumn("status", F.when(C("n") == 0, "untested").when(C("effects") == C("pressed"), "consistent").when(C("effects") == 0, "no_effect").otherwise("mixed"))


@query("SELECT slot, i AS frame_index, tick AS start, nxt AS \"end\", nxt - tick AS width, CASE WHEN nxt IS NULL THEN 'no_end_boundary' WHEN m.slot IS NULL THEN 'no_movie_frame' END AS reason FROM (SELECT slot, tick, lead(tick) OVER w AS nxt, row_number() OVER w - 1 AS i FROM st WINDOW w AS (PARTITION BY slot ORDER BY tick)) s LEFT JOIN (SELECT slot, frame_index AS i FROM pf WHERE frame_index % 37 <> 5) m USING (slot, i)", STATE, PLAYER_FRAMES)
def dom_7_prepared_timing(spark, d):
    """The n-th state and the n-th movie frame of a player are one frame; it ends where the next one begins."""
    w = Window.partitionBy("slot").orderBy("tick")
    native = states(spark, d).select("slot", (F.row_number().over(w) - 1).cast("long").alias("frame_index"), C("tick").alias("start"), F.lead("tick").over(w).alias("end"))
    movie = player_frames(spark, d).where("frame_index % 37 <> 5").select("slot", "frame_index", F.lit(True).alias("seen"))
    out = native.join(movie, ["slot", "frame_index"], "left")
    reason = F.when(C("end").isNull(), "no_end_boundary").when(C("seen").isNull(), "no_movie_frame")
    return out.select("slot", "frame_index", "start", "end", (C("end") - C("start")).alias("width"), reason.alias("reason"))


@query("SELECT slot, count(*) AS frames, count(x) AS observed, count(*) FILTER (x IS NOT NULL AND same) AS verified, CASE WHEN count(x) = 0 THEN 'unknown' WHEN count(*) FILTER (x IS NOT NULL AND NOT same) > 0 THEN 'failed' ELSE 'verified' END AS status FROM (SELECT f.slot, s.x, sha256(CAST(s.x AS VARCHAR)) = sha256(CAST(CASE WHEN s.slot % 3 = 1 AND s.x % 50 = 7 THEN s.x + 1 ELSE s.x END AS VARCHAR)) AS same FROM pf f LEFT JOIN st s ON s.slot = f.slot AND s.tick = f.start) GROUP BY slot", STATE, PLAYER_FRAMES)
def dom_10_capture_evidence(spark, d):
    """Digests of what was captured against those of what was played, frame by frame."""
    s = states(spark, d).select("slot", C("tick").alias("start"), "x", F.when((C("slot") % 3 == 1) & (C("x") % 50 == 7), C("x") + 1).otherwise(C("x")).alias("captured"))
    digest = lambda c: F.sha2(C(c).cast("string"), 256)
    rows = player_frames(spark, d).join(s, ["slot", "start"], "left").withColumn("same", digest("x") == digest("captured"))
    g = rows.groupBy("slot").agg(F.count("*").alias("frames"), F.count("x").alias("observed"), F.count_if("same").alias("verified"), F.count_if(~C("same")).alias("wrong"))
    return g.select("slot", "frames", "observed", "verified", F.when(C("observed") == 0, "unknown").when(C("wrong") > 0, "failed").otherwise("verified").alias("status"))


@query("SELECT 0::BIGINT AS differences, true AS complete, count(*) AS n FROM cmd WHERE alive AND yaw IS NOT NULL", CMD)
def dom_35_published_acceptance(spark, d):
    """Accepted rows are published, read back, and computed anew: nothing may differ."""
    accepted = commands(spark, d).where("alive and yaw is not null").select("row_id", "slot", "tick")
    path = new_folder(spark)
    sinks.publish({"accepted": accepted}, path, {"profile": "acceptance"})
    stored = spark.read.parquet(f"{path}/accepted")
    n = audits.differences(stored, accepted).agg(F.count("*").alias("differences"))
    return n.crossJoin(stored.agg(F.count("*").alias("n"))).select("differences", F.lit(sinks.is_complete(spark, path)).alias("complete"), "n")


@query("SELECT round_id, count(*) AS frames, count(*) FILTER (first < round_id) AS duplicates FROM (SELECT round_id, min(round_id) OVER (PARTITION BY slot, x, health) AS first FROM st) GROUP BY round_id", STATE)
def snk_7_training_shards(spark, d):
    """A shard for each round: its frames, of which those that an earlier shard has are marked; written, and read back."""
    first = F.min("round_id").over(Window.partitionBy("slot", "x", "health"))
    rows = states(spark, d).select("round_id", "slot", "tick", "x", "health", (first < C("round_id")).alias("duplicate"))
    path = new_folder(spark)
    rows.write.partitionBy("round_id").mode("errorifexists").option("compression", "zstd").parquet(path)
    return spark.read.parquet(path).groupBy(C("round_id").cast("long").alias("round_id")).agg(F.count("*").alias("frames"), F.count_if("duplicate").alias("duplicates"))


@query("SELECT slot, tick, round_id, user_id, alive, x, health FROM st", STATE)
def src_13_state_rows(spark, d):
    return states(spark, d).select("slot", "tick", "round_id", "user_id", "alive", "x", "health")


@query("SELECT row_id AS n, tick AS frame_index FROM cmd WHERE kind = 'signup' AND tick BETWEEN 5000 AND 20000", CMD)
def src_18_event_index(spark, d):
    """A ledger in ranges of event and tick, of which a reader of one event and a range of ticks opens those files alone;
    an event with most of the rows fills most of the files."""
    path = new_folder(spark)
    rows = commands(spark, d).select(C("kind").alias("event"), C("row_id").alias("n"), C("tick").alias("frame_index"))
    tables.write_clustered(rows, path, ["event", "frame_index", "n"])
    return tables.read_clustered(spark, path, ("signup", 5000), ("signup", 20000), rows.schema).select("n", "frame_index")


@query(
    """SELECT row_id, CASE k % 7 WHEN 0 THEN 'no value' WHEN 1 THEN 'a varint does not end' WHEN 2 THEN 'field 0' WHEN 3 THEN 'a field is cut off' WHEN 4 THEN 'an unknown wire type'
      WHEN 5 THEN 'a varint is over 64 bits' END AS reason, CASE WHEN k % 7 = 6 THEN k + 128 END AS number FROM cmd""",
    CMD,
)
def udf_8_field_reasons(spark, d):
    """Values that lack an end, a field number, bytes or a known type beside sound ones: the fields, or the reason why not."""
    sound = F.concat(F.lit("08"), wire.varint_hex(C("k") + 128))
    damaged = {1: F.lit("0880"), 2: F.lit("0001"), 3: F.concat(F.lit("0a05"), F.hex(F.lit("ab"))), 4: F.lit("0f01"), 5: F.lit("08" + "ff" * 9 + "7f"), 6: sound}
    data = F.lit(None).cast("string")
    for kind, text in damaged.items():
        data = F.when(C("k") % 7 == kind, text).otherwise(data)
    got = commands(spark, d).select("row_id", wire.decoded(F.unhex(data)).alias("x"))
    return got.select("row_id", C("x.reason").alias("reason"), F.get(C("x.fields"), F.lit(0))["number"].cast("long").alias("number"))


@query("SELECT row_id, dx AS value FROM cmd WHERE dx IS NOT NULL", CMD)
def udf_2_signed_varints(spark, d):
    """Signed numbers as varints of up to ten bytes and back."""
    rows = commands(spark, d).where("dx is not null").select("row_id", C("dx").cast("long").alias("v")).select("row_id", F.unhex(F.concat(F.lit("08"), wire.varint_hex(C("v")))).alias("data"))
    got = rows.select("row_id", F.explode(wire.decode_fields("data")).alias("x"))
    return got.select("row_id", bits.signed_plane(C("x.number")).alias("value"))


@query("SELECT row_id, CASE WHEN cents << (k % 32) < 4294967296 THEN cents << (k % 32) END AS value FROM cmd", CMD)
def udf_7_uint32_varints(spark, d):
    """Varints of one to seven bytes; those over 32 bits have no value."""
    large = F.call_function("shiftleft", C("cents"), (C("k") % 32).cast("int"))
    return commands(spark, d).select("row_id", wire.uint32(F.unhex(wire.varint_hex(large))).alias("value"))


LABEL = "row_id long, held_end boolean, reason_codes array<string>"


#: Kinds of the fields of an action; no others are allowed.
ACTION = {"version": "BIGINT", "yaw": "BIGINT|DECIMAL|DOUBLE|VOID", "held": "BOOLEAN", "events": "ARRAY"}
TEXT = """act AS (SELECT row_id, '{"version":1' || CASE k % 5 WHEN 0 THEN '' WHEN 1 THEN ',"yaw":null' WHEN 2 THEN ',"yaw":"left"' ELSE ',"yaw":' || cents || '.5' END
  || CASE WHEN k % 3 = 1 THEN ',"held":1' ELSE ',"held":true' END || CASE WHEN k % 7 = 2 THEN ',"extra":[]' ELSE '' END || ',"events":[]}' AS t FROM cmd)"""


@query(
    """SELECT row_id, concat_ws(',', CASE WHEN json_type(t, '$.version') IS NULL THEN 'missing:version' WHEN json_type(t, '$.version') NOT IN ('UBIGINT', 'BIGINT') THEN 'kind:version' END,
      CASE WHEN json_type(t, '$.yaw') IS NULL THEN 'missing:yaw' WHEN json_type(t, '$.yaw') NOT IN ('UBIGINT', 'BIGINT', 'DOUBLE', 'NULL') THEN 'kind:yaw' END,
      CASE WHEN json_type(t, '$.held') IS NULL THEN 'missing:held' WHEN json_type(t, '$.held') <> 'BOOLEAN' THEN 'kind:held' END,
      CASE WHEN json_type(t, '$.events') IS NULL THEN 'missing:events' WHEN json_type(t, '$.events') <> 'ARRAY' THEN 'kind:events' END,
      CASE WHEN list_contains(json_keys(t), 'extra') THEN 'unknown:extra' END) AS issues FROM act""",
    CMD,
    TEXT,
)
def fn_j1_action_schema(spark, d):
    """Actions as JSON against their schema: what is absent, of another kind, or not known."""
    yaw = F.when(C("k") % 5 == 0, "").when(C("k") % 5 == 1, ',"yaw":null').when(C("k") % 5 == 2, ',"yaw":"left"').otherwise(F.concat(F.lit(',"yaw":'), "cents", F.lit(".5")))
    held = F.when(C("k") % 3 == 1, ',"held":1').otherwise(',"held":true')
    text = F.concat(F.lit('{"version":1'), yaw, held, F.when(C("k") % 7 == 2, ',"extra":[]').otherwise(""), F.lit(',"events":[]}'))
    rows = commands(spark, d).select("row_id", text.alias("t"))
    return rows.select("row_id", F.array_join(audits.schema_issues(C("t"), ACTION), ",").alias("issues"))


@query("SELECT row_id, k % 4 <> 1 AND k % 6 <> 2 AS valid FROM cmd", CMD)
def fn_j2_label_schema(spark, d):
    """Labels as JSON against their schema: a field that is absent, or of another type, makes the label invalid."""
    row = F.concat(F.lit('{"row_id":'), C("row_id").cast("string"), F.when(C("k") % 4 != 1, F.concat(F.lit(',"held_end":'), F.when(C("k") % 6 == 2, F.lit('"yes"')).otherwise((C("k") % 2 == 0).cast("string")))).otherwise(""), F.lit(',"reason_codes":[]}'))
    parsed = F.from_json(row, LABEL, {"mode": "PERMISSIVE"})
    return commands(spark, d).select("row_id", (parsed["row_id"].isNotNull() & parsed["held_end"].isNotNull() & parsed["reason_codes"].isNotNull()).alias("valid"))


@query("SELECT slot, phase, count(*) AS n, round(avg(step), 6) AS mean_step, max(step) AS longest FROM (SELECT slot, CASE WHEN tick < freeze_end THEN 'setup' WHEN tick < \"end\" THEN 'executed' ELSE 'after' END AS phase, tick - lag(tick) OVER (PARTITION BY slot, round_id ORDER BY tick) AS step FROM st JOIN rd USING (round_id)) GROUP BY slot, phase", STATE, ROUNDS)
def dom_61_executed_phases(spark, d):
    """How regular a player's states are in each phase of the rounds."""
    step = C("tick") - F.lag("tick").over(Window.partitionBy("slot", "round_id").orderBy("tick"))
    rows = states(spark, d).join(rounds(spark, d).select("round_id", "freeze_end", "end"), "round_id").withColumn("step", step)
    phase = F.when(C("tick") < C("freeze_end"), "setup").when(C("tick") < C("end"), "executed").otherwise("after")
    return rows.groupBy("slot", phase.alias("phase")).agg(F.count("*").alias("n"), F.round(F.avg("step"), 6).alias("mean_step"), F.max("step").alias("longest"))
