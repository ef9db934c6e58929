"""Calibration, audits of evidence, planners and measured effects."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tideline.functions import angles, bits, names, wire
from tideline.operators import aggregates, intervals, joins, scans, selection, windows
from tideline.plans.registry import query
from tideline.plans.views import CMD, FRAMES, ROUNDS, STATE, commands, frames, neighbours, rounds, states
from tideline.plans.views import PLAYER_FRAMES, player_frames

C = F.col


@query("SELECT slot, tick, coalesce(lead(tick) OVER (PARTITION BY slot ORDER BY tick), (SELECT max(tick) + 1 FROM cmd)) AS boundary, coalesce(lead(tick) OVER (PARTITION BY slot ORDER BY tick), (SELECT max(tick) + 1 FROM cmd)) > tick AS rising FROM st", STATE)
def dom_8_boundaries(spark, d):
    end = commands(spark, d).agg((F.max("tick") + 1).alias("timeline_end"))
    nxt = F.coalesce(F.lead("tick").over(Window.partitionBy("slot").orderBy("tick")), "timeline_end")
    return states(spark, d).crossJoin(end).select("slot", "tick", nxt.alias("boundary"), (nxt > C("tick")).alias("rising"))


@query("SELECT slot, frame_index, k.c AS \"check\" FROM pf CROSS JOIN (VALUES ('view'), ('click'), ('error')) k(c) ANTI JOIN (SELECT slot, kind AS c, tick // 32 AS frame_index FROM cmd) h USING (slot, c, frame_index)", CMD, PLAYER_FRAMES)
def dom_15_scoped_proofs(spark, d):
    needed = player_frames(spark, d).select("slot", "frame_index", F.explode(F.array(*(F.lit(k) for k in ("view", "click", "error")))).alias("check"))
    have = commands(spark, d).select("slot", F.floor(C("tick") / 32).alias("frame_index"), C("kind").alias("check")).distinct()
    return needed.join(have, ["slot", "frame_index", "check"], "left_anti")


@query("SELECT status, count(*) AS n FROM (SELECT CASE WHEN s.n IS NULL THEN 'missing' WHEN s.n > 1 THEN 'ambiguous' ELSE 'matched' END AS status FROM cmd c LEFT JOIN (SELECT user_id, tick, count(*) AS n FROM cmd GROUP BY 1, 2) s ON s.user_id = c.user_id AND s.tick = c.client_tick) GROUP BY status", CMD)
def dom_18_synchronisation(spark, d):
    c = commands(spark, d)
    left = c.select("row_id", "user_id", C("client_tick").alias("t"))
    return joins.unique_join(left, c.select("user_id", C("tick").alias("t"), "cents"), ["user_id", "t"], ["cents"]).groupBy("status").agg(F.count("*").alias("n"))


@query("SELECT row_id, concat_ws(',', CASE WHEN tick < p_tick THEN 'tick_reversed' END, CASE WHEN number <> p_number + 1 THEN 'number_gap' END, CASE WHEN client_tick - p_client > 40 THEN 'client_gap' END, CASE WHEN dx / 40.0 > 1 OR dx / 40.0 < 0 THEN 'fraction_out_of_range' END) AS issues FROM (SELECT *, lag(tick) OVER w AS p_tick, lag(number) OVER w AS p_number, lag(client_tick) OVER w AS p_client FROM cmd WINDOW w AS (PARTITION BY slot ORDER BY row_id))", CMD)
def dom_20_command_issues(spark, d):
    w = Window.partitionBy("slot").orderBy("row_id")
    rows = commands(spark, d).withColumns({f"p_{c}": F.lag(c).over(w) for c in ("tick", "number", "client_tick")})
    rules = {"tick_reversed": C("tick") < C("p_tick"), "number_gap": C("number") != C("p_number") + 1, "client_gap": C("client_tick") - C("p_client_tick") > 40, "fraction_out_of_range": angles.bad_fraction(C("dx") / 40.0)}
    return rows.select("row_id", F.array_join(F.array_compact(F.array(*(F.when(c, F.lit(k)) for k, c in rules.items()))), ",").alias("issues"))


@query("SELECT slot, tick, x, x_2, x_3, x_4, x_2 IS NOT NULL AND x_3 IS NOT NULL AND x_4 IS NOT NULL AS complete FROM (SELECT a.slot, a.tick, a.x, b.x AS x_2, c.x AS x_3, e.x AS x_4 FROM st a LEFT JOIN st b ON b.slot = a.slot AND b.tick = a.tick + 2 LEFT JOIN st c ON c.slot = a.slot AND c.tick = a.tick + 3 LEFT JOIN st e ON e.slot = a.slot AND e.tick = a.tick + 4)", STATE)
def dom_30_control_candidates(spark, d):
    s = states(spark, d)
    out = joins.offset_join(s.select("slot", "tick", "x"), s.select("slot", "tick", C("x").alias("v")), "slot", "tick", (2, 3, 4), "v")
    done = C("v_2").isNotNull() & C("v_3").isNotNull() & C("v_4").isNotNull()
    return out.select("slot", "tick", "x", C("v_2").alias("x_2"), C("v_3").alias("x_3"), C("v_4").alias("x_4"), done.alias("complete"))


@query("SELECT kind, row_id, turn FROM (SELECT kind, row_id, row_number() OVER (PARTITION BY kind, user_id ORDER BY sha256(CAST(row_id AS VARCHAR))) AS turn FROM cmd WHERE EXISTS (SELECT 1 FROM rd WHERE tick >= freeze_end - 16 AND tick < \"end\" + 16)) WHERE turn <= 2", CMD, ROUNDS)
def dom_42_batch_plan(spark, d):
    from tideline.operators.filters import in_any_window

    w = rounds(spark, d).where("end is not null").select(C("freeze_end").alias("start"), "end")
    covered = in_any_window(commands(spark, d), w, "tick", margin=16)
    return selection.round_robin(covered, ["kind", "user_id"], "row_id").where("turn <= 2").select("kind", "row_id", C("turn").cast("long").alias("turn"))


@query("SELECT slot, CAST(sum(\"end\" - start) AS BIGINT) AS owned, (SELECT max(tick) + 21 FROM cmd) - CAST(sum(\"end\" - start) AS BIGINT) AS excluded FROM (SELECT slot, min(start) AS start, max(\"end\") AS \"end\" FROM (SELECT *, sum(s) OVER (PARTITION BY slot ORDER BY start, \"end\") AS g FROM (SELECT *, CASE WHEN start <= max(\"end\") OVER (PARTITION BY slot ORDER BY start, \"end\" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS s FROM (SELECT slot, tick AS start, tick + 1 + k % 20 AS \"end\" FROM cmd))) GROUP BY slot, g) GROUP BY slot", CMD)
def dom_44_timeline_accounting(spark, d):
    spans = commands(spark, d).select("slot", C("tick").alias("start"), (C("tick") + 1 + C("k") % 20).alias("end"))
    owned = windows.running_segments(spans, ["slot"], "start", "end")
    rest = intervals.complement(owned, 0, commands(spark, d).agg(F.max("tick") + 21), ["slot"])
    a = owned.groupBy("slot").agg(F.sum(C("end") - C("start")).alias("owned"))
    return a.join(rest.groupBy("slot").agg(F.sum(C("end") - C("start")).alias("excluded")), "slot")


@query("SELECT slot, min(h) AS lo, median(h) AS mid, max(h) AS hi, quantile_disc(h, 0.95) AS p95 FROM (SELECT slot, tick - lag(tick) OVER (PARTITION BY slot ORDER BY row_id) AS h FROM cmd) WHERE h IS NOT NULL GROUP BY slot", CMD)
def dom_48_dispatch_intervals(spark, d):
    h = C("tick") - F.lag("tick").over(Window.partitionBy("slot").orderBy("row_id"))
    return commands(spark, d).select("slot", h.alias("h")).where("h IS NOT NULL").groupBy("slot").agg(F.min("h").alias("lo"), F.median("h").alias("mid"), F.max("h").alias("hi"), aggregates.nearest_rank("h", 0.95).cast("long").alias("p95"))


@query("SELECT slot, row_id, step FROM (SELECT slot, row_id, tick - lag(tick) OVER (PARTITION BY slot ORDER BY row_id) AS step, row_number() OVER (PARTITION BY slot ORDER BY row_id) AS n FROM cmd) WHERE step IS NOT NULL ORDER BY step DESC, slot, row_id LIMIT 10", CMD)
def dom_49_stalls(spark, d):
    step = C("tick") - F.lag("tick").over(Window.partitionBy("slot").orderBy("row_id"))
    return commands(spark, d).select("slot", "row_id", step.alias("step")).where("step IS NOT NULL").orderBy(F.desc("step"), "slot", "row_id").limit(10)


@query("SELECT round_id, min(tick) FILTER (kind = 'view') - min(tick) AS to_view, min(tick) FILTER (kind = 'click') - min(tick) AS to_click, min(tick) FILTER (kind = 'purchase') - min(tick) AS to_purchase FROM cmd GROUP BY round_id", CMD)
def dom_50_startup_milestones(spark, d):
    first = lambda k: (F.min(F.when(C("kind") == k, C("tick"))) - F.min("tick")).alias(f"to_{k}")
    return commands(spark, d).groupBy("round_id").agg(first("view"), first("click"), first("purchase"))


@query("SELECT slot, tick, CASE WHEN a.x IS NULL THEN 'replay_only' WHEN b.x IS NULL THEN 'original_only' ELSE 'both' END AS status, abs(a.x - b.x) AS error FROM (SELECT slot, tick, x FROM st WHERE slot % 10 < 9) a FULL JOIN (SELECT slot - 1 AS slot, tick, x FROM st WHERE slot % 10 > 0) b USING (slot, tick)", STATE)
def dom_51_replay_comparison(spark, d):
    """Each slot's states as the original of those of the next slot of its recording, as the replay."""
    a, b = neighbours(states(spark, d).select("slot", "tick", "x"))
    met = a.withColumnRenamed("x", "xa").join(b.withColumnRenamed("x", "xb"), ["slot", "tick"], "full_outer")
    status = F.when(C("xa").isNull(), "replay_only").when(C("xb").isNull(), "original_only").otherwise("both")
    return met.select("slot", "tick", status.alias("status"), F.abs(C("xa") - C("xb")).alias("error"))


@query("SELECT row_id, CAST(coalesce(sum(b_dx), 0) AS BIGINT) AS moved FROM (SELECT a.row_id, b.dx AS b_dx FROM cmd a LEFT JOIN cmd b ON b.slot = a.slot AND b.tick BETWEEN a.tick - 8 AND a.tick + 8) GROUP BY row_id", CMD)
def dom_58_window_sums(spark, d):
    c = commands(spark, d)
    return joins.band_join(c.select("row_id", "slot", "tick"), c.select("slot", C("tick").alias("t"), C("dx").alias("m")), ("slot",), "tick", "t", 8, 8).groupBy("row_id").agg(F.coalesce(F.sum("m"), F.lit(0)).alias("moved"))


@query("SELECT slot, tick, nxt > tick AND (p8 IS NULL OR p8 < tick) AS sound FROM (SELECT slot, tick, lead(tick) OVER w AS nxt, lag(tick, 7) OVER w AS p8 FROM st WINDOW w AS (PARTITION BY slot ORDER BY tick)) WHERE nxt IS NOT NULL", STATE)
def dom_66_no_leakage(spark, d):
    w = Window.partitionBy("slot").orderBy("tick")
    s = states(spark, d).select("slot", "tick", F.lead("tick").over(w).alias("nxt"), F.lag("tick", 7).over(w).alias("p8")).where("nxt IS NOT NULL")
    return s.select("slot", "tick", ((C("nxt") > C("tick")) & (C("p8").isNull() | (C("p8") < C("tick")))).alias("sound"))


@query("SELECT slot, start, e AS \"end\", (e - start) % 2 AS odd_tail, e - start < 32 AS too_short FROM (SELECT slot, tick AS start, tick + k AS e FROM cmd)", CMD)
def set_4_tails(spark, d):
    rows = commands(spark, d).select("slot", C("tick").alias("start"), (C("tick") + C("k")).alias("end"))
    return rows.select("slot", "start", "end", ((C("end") - C("start")) % 2).alias("odd_tail"), (C("end") - C("start") < 32).alias("too_short"))


@query("SELECT slot, round_id, tick, row_number() OVER (PARTITION BY round_id ORDER BY tick, slot) AS place FROM st", STATE)
def ord_1_window_order(spark, d):
    """Places in a round of all recordings, which may have most of the rows."""
    order = ["tick", "slot"]
    rows = scans.ranged(states(spark, d).select("slot", "round_id", "tick"), ["round_id"], order)
    return scans.scan(rows, ["round_id"], order, place=scans.running_count()).select("slot", "round_id", "tick", "place")


@query("SELECT slot, '{' || string_agg('\"' || kind || '\":' || n, ',' ORDER BY kind) || '}' AS histogram FROM (SELECT slot, kind, count(*) AS n FROM cmd GROUP BY 1, 2) GROUP BY slot", CMD)
def ord_7_sorted_histogram(spark, d):
    n = commands(spark, d).groupBy("slot", "kind").agg(F.count("*").alias("n"))
    return n.groupBy("slot").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("kind", "n"))))).alias("histogram"))


@query("SELECT row_id, sha256('[\"profile\",' || row_id || ']') AS tie FROM cmd", CMD)
def ord_8_hash_ties(spark, d):
    return commands(spark, d).select("row_id", F.sha2(F.concat(F.lit('["profile",'), C("row_id").cast("string"), F.lit("]")), 256).alias("tie"))


@query("SELECT row_id, CAST(0.5 * power(2, greatest(floor(log2(cents)) - 23, -149)) AS DOUBLE) AS half FROM cmd WHERE cents > 0", CMD)
def fn_m5_half_ulp(spark, d):
    return commands(spark, d).where("cents > 0").select("row_id", wire.half_ulp(C("cents").cast("double")).alias("half"))


#: Two numbers out of 0.0, -0.0, NaN and k, by the row.
EDGES = ("CASE {x} % 4 WHEN 0 THEN 0.0 WHEN 1 THEN -0.0 WHEN 2 THEN 'NaN'::DOUBLE ELSE k::DOUBLE END", "k", "k // 4")


def edge_numbers():
    return [F.when(x % 4 == 0, F.lit(0.0)).when(x % 4 == 1, C("k") * F.lit(-1) * F.lit(0.0)).when(x % 4 == 2, F.lit(float("nan"))).otherwise(C("k").cast("double")) for x in (C("k"), F.floor(C("k") / 4))]


@query("SELECT row_id, k % 4 = k // 4 % 4 AS same FROM cmd", CMD)
def fn_m6_bitwise_equal(spark, d):
    a, b = edge_numbers()
    return commands(spark, d).select("row_id", (wire.double_bits(a) == wire.double_bits(b)).alias("same"))


@query("SELECT row_id, typeof(CASE WHEN a < 2 THEN 1 END) IS NOT NULL AND a = b AS same FROM (SELECT row_id, k % 3 AS a, k // 3 % 3 AS b FROM cmd)", CMD)
def fn_m7_typed_equal(spark, d):
    """1, 1.0 and true are three values: equal are variants of one type and one value."""
    kinds = lambda x: F.when(x % 3 == 0, F.parse_json(F.lit("1"))).when(x % 3 == 1, F.parse_json(F.lit("1.5"))).otherwise(F.parse_json(F.lit("true")))
    typed = lambda v: F.struct(F.schema_of_variant(v), v.cast("string"))
    return commands(spark, d).select("row_id", kinds(C("k")).alias("a"), kinds(F.floor(C("k") / 3)).alias("b")).select("row_id", (typed(C("a")) == typed(C("b"))).alias("same"))


@query("SELECT row_id, ([a, dx] IS NOT DISTINCT FROM [b, dx]) AS same FROM (SELECT row_id, dx::DOUBLE AS dx, " + EDGES[0].format(x="k") + " AS a, " + EDGES[0].format(x="(k // 4)") + " AS b FROM cmd)", CMD)
def fn_m8_nan_equal(spark, d):
    """NaN equals NaN and null equals null at any depth; 0.0 equals -0.0."""
    a, b = edge_numbers()
    row = lambda x: F.struct(F.array(x, C("dx").cast("double")).alias("v"))
    return commands(spark, d).select("row_id", row(a).eqNullSafe(row(b)).alias("same"))


@query("SELECT row_id, 1 AS field, k * 1000 + cents AS number FROM cmd", CMD)
def udf_1_fields(spark, d):
    """A field of one to five bytes for each row, written as a varint and read back."""
    n = C("k") * 1000 + C("cents")
    parts = [F.shiftright(n, 7 * i).bitwiseAND(F.lit(127)) for i in range(5)]
    more = [n >= (1 << (7 * (i + 1))) for i in range(5)]
    raw = F.concat(F.lit("08"), *(F.when((n >= (1 << (7 * i))) if i else F.lit(True), F.lpad(F.hex(p + F.when(m, 128).otherwise(0)), 2, "0")).otherwise("") for i, (p, m) in enumerate(zip(parts, more, strict=True))))
    got = commands(spark, d).select("row_id", F.explode(wire.decode_fields(F.unhex(raw))).alias("x"))
    return got.select("row_id", C("x.field").alias("field"), C("x.number").cast("long").alias("number"))


@query("SELECT row_id, kind AS text FROM cmd", CMD)
def udf_3_snappy(spark, d):
    n = F.octet_length("kind")
    data = F.concat(F.unhex(F.lpad(F.hex(n), 2, "0")), F.unhex(F.lpad(F.hex((n - 1) * 4), 2, "0")), C("kind").cast("binary"))
    return commands(spark, d).select("row_id", wire.uncompress(data).cast("string").alias("text"))


@query("SELECT row_id, unbin AS data, sha256(kind) AS digest FROM (SELECT row_id, kind AS unbin, kind FROM cmd)", CMD)
def fn_j3_base64_evidence(spark, d):
    rows = commands(spark, d).select("row_id", F.base64(C("kind").cast("binary")).alias("b"))
    return rows.select("row_id", F.unbase64("b").cast("string").alias("data"), F.sha2(F.unbase64("b"), 256).alias("digest"))


@query("SELECT row_id, CASE WHEN NOT alive OR yaw IS NULL THEN 'rejected' ELSE 'accepted' END AS verdict, count(*) OVER (PARTITION BY slot) AS n FROM cmd", CMD)
def snk_6_verdicts(spark, d):
    return commands(spark, d).select("row_id", F.when(~C("alive") | C("yaw").isNull(), "rejected").otherwise("accepted").alias("verdict"), F.count("*").over(Window.partitionBy("slot")).alias("n"))


@query("SELECT slot, tick, x, CAST(x + (x2 - x) * greatest(0.0, least(1.0, 1.5 - 1.0 * (t2 - tick) / 16)) AS DOUBLE) AS at FROM (SELECT slot, tick, x, lead(x) OVER w AS x2, lead(tick) OVER w AS t2 FROM st WINDOW w AS (PARTITION BY slot ORDER BY tick)) WHERE t2 IS NOT NULL", STATE)
def win_27_clamped_interpolation(spark, d):
    w = Window.partitionBy("slot").orderBy("tick")
    s = states(spark, d).withColumns({"x2": F.lead("x").over(w), "t2": F.lead("tick").over(w)}).where("t2 IS NOT NULL")
    return s.select("slot", "tick", "x", angles.interpolate(C("x").cast("double"), C("x2").cast("double"), 1.5 - (C("t2") - C("tick")) / 16.0).alias("at"))


@query("SELECT user_id, row_id, 'kind:' || pk || '>' || kind AS changed FROM (SELECT *, lag(kind) OVER (PARTITION BY user_id ORDER BY row_id) AS pk FROM cmd) WHERE pk <> kind", CMD)
def win_21_identity_transitions(spark, d):
    out = windows.changes(commands(spark, d), ["user_id"], "row_id", ["kind"])
    x = C("changed")[0]
    return out.select("user_id", "row_id", F.concat(x["name"], F.lit(":"), x["before"], F.lit(">"), x["after"]).alias("changed"))


@query("SELECT slot, count(*) FILTER (v) AS n_true, count(*) FILTER (NOT v) AS n_false, count(*) FILTER (v IS NULL) AS n_masked FROM (SELECT slot, CASE WHEN present IS NOT NULL THEN (p1 & 8) <> 0 END AS v FROM cmd) GROUP BY slot", CMD)
def agg_25_label_audit(spark, d):
    v = F.when(C("present").isNotNull(), bits.any_bit(C("p1"), 8))
    return commands(spark, d).select("slot", v.alias("v")).groupBy("slot").agg(F.count_if("v").alias("n_true"), F.count_if(~C("v")).alias("n_false"), F.count_if(C("v").isNull()).alias("n_masked"))


@query("SELECT kind, count(*) AS n, max(number) AS highest, count(*) FILTER (number >= row_id) AS ahead FROM cmd GROUP BY kind", CMD)
def agg_27_message_counts(spark, d):
    return commands(spark, d).groupBy("kind").agg(F.count("*").alias("n"), F.max("number").alias("highest"), F.count_if(C("number") >= C("row_id")).alias("ahead"))


@query("SELECT row_id, player FROM (SELECT row_id, 'steam:' || user_id AS player FROM cmd WHERE user_id > 0)", CMD)
def flt_14_selection(spark, d):
    key = names.player_key(C("user_id"), C("slot"))
    return commands(spark, d).where("user_id > 0").select("row_id", key.alias("player"))


@query("SELECT frame_index, x, x IS NOT NULL AS observed FROM fr LEFT JOIN (SELECT tick, min(x) AS x FROM st GROUP BY tick) s ON s.tick = frame_index * 32", STATE, FRAMES)
def join_14_by_index(spark, d):
    s = states(spark, d).groupBy("tick").agg(F.min("x").alias("x")).where("tick % 32 = 0").select((C("tick") / 32).cast("long").alias("frame_index"), "x")
    return frames(spark, d).join(s, "frame_index", "left").select("frame_index", "x", C("x").isNotNull().alias("observed"))


@query("SELECT a.row_id, b.row_id AS frame_row, c.n AS later FROM (SELECT * FROM cmd WHERE kind = 'click') a ASOF LEFT JOIN (SELECT slot, tick, max(row_id) AS row_id FROM cmd WHERE kind = 'view' GROUP BY 1, 2) b ON b.slot = a.slot AND b.tick <= a.tick LEFT JOIN (SELECT x.row_id, count(*) AS n FROM cmd x JOIN cmd y ON y.number BETWEEN x.number AND x.number + 4 AND y.slot = x.slot WHERE x.kind = 'click' GROUP BY x.row_id) c ON c.row_id = a.row_id", CMD)
def join_30_edge_anchor(spark, d):
    c = commands(spark, d)
    a = c.where("kind = 'click'").select("row_id", "slot", "tick", "number")
    v = c.where("kind = 'view'").groupBy("slot", C("tick").alias("t")).agg(F.max("row_id").alias("frame_row"))
    anchored = joins.asof_join(a, v, "tick", "t", ("slot",), ("frame_row",))
    near = joins.band_join(a, c.select("slot", C("number").alias("m")), ("slot",), "number", "m", 0, 4).groupBy("row_id").agg(F.count("*").alias("later"))
    return anchored.join(near, "row_id", "left").select("row_id", C("asof_frame_row").alias("frame_row"), "later")
