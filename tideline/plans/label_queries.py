"""Queries of labels, loaders and planners over nested commands."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tideline.operators import intervals, labels, windows
from tideline.operators.joins import interval_join
from tideline.plans.registry import query
from tideline.plans.sample_queries import TRIPLE
from tideline.plans.views import CMD, ROUNDS, STATE, commands, rounds, states

C = F.col
JOINED = "array_to_string(list_sort(list_distinct(list_filter([{r}], lambda x: x IS NOT NULL))), ',')"
#: Of each command up to three moves; some lists, moves and fractions are absent, some fractions out of range.
MOVES = """
, mv AS (SELECT *, CASE WHEN k % 7 <> 0 THEN list_transform(range(0, k % 4), lambda i: CASE WHEN (k + i) % 23 <> 0 THEN {'when': CASE (cents + i) % 9 WHEN 0 THEN NULL WHEN 1 THEN 1.5 WHEN 2 THEN 1.0 WHEN 3 THEN 'NaN'::DOUBLE ELSE ((cents + i) % 9)::DOUBLE / 10 END} END) END AS moves FROM cmd)"""
BAD = "len(list_filter(moves, lambda x: x IS NOT NULL AND x['when'] IS NOT NULL AND (isnan(x['when']) OR x['when'] < 0 OR x['when'] {op} 1))) > 0"


def with_moves(spark, d):
    n = F.when(C("k") % 4 > 0, F.sequence(F.lit(0).cast("long"), C("k") % 4 - 1)).otherwise(F.array().cast("array<bigint>"))

    def move(i):
        at = (C("cents") + i) % 9
        when = F.when(at == 0, F.lit(None).cast("double")).when(at == 1, 1.5).when(at == 2, 1.0).when(at == 3, float("nan")).otherwise(at.cast("double") / 10)
        return F.when((C("k") + i) % 23 != 0, F.struct(when.alias("when")))

    return commands(spark, d).withColumn("moves", F.when(C("k") % 7 != 0, F.transform(n, move)))


@query("SELECT row_id, " + JOINED.format(r="CASE WHEN moves IS NULL THEN 'missing_subtick_moves' END, CASE WHEN len(list_filter(moves, lambda x: x IS NULL)) > 0 THEN 'invalid_subtick_moves' END, CASE WHEN " + BAD.format(op=">") + " THEN 'invalid_subtick_fraction' END") + " AS reasons FROM mv", CMD + MOVES)
def dom_21_fraction_reasons(spark, d):
    rules = labels.fraction_rules(C("moves"), "subtick_moves", ["when"], "invalid_subtick_fraction")
    return with_moves(spark, d).select("row_id", F.array_join(labels.sorted_reasons(rules), ",").alias("reasons"))


NEXT = """
, ch AS (SELECT *, lead(row_id, 2) OVER w AS third, {leads} FROM mv WINDOW w AS (PARTITION BY slot ORDER BY row_id))""".replace("{leads}", ", ".join(f"lead({c}, {k}) OVER w AS {c}_{k}" for c in ("row_id", "user_id", "round_id", "alive", "number", "tick", "client_tick", "moves") for k in (1, 2)))


def chunk_sql():
    rules = ["CASE WHEN user_id_1 <> user_id OR user_id_2 <> user_id OR round_id_1 <> round_id OR round_id_2 <> round_id THEN 'command_identity_changed' END", "CASE WHEN NOT (alive AND alive_1 AND alive_2) THEN 'command_alive_not_true' END"]
    for c in ("number", "tick"):
        rules.append(f"CASE WHEN {c}_1 <> {c} + 1 OR {c}_2 <> {c}_1 + 1 THEN '{c}_discontinuity' END")
    rules.append("CASE WHEN client_tick_1 - client_tick NOT BETWEEN 0 AND 2 OR client_tick_2 - client_tick_1 NOT BETWEEN 0 AND 2 THEN 'client_tick_outside_measured_generation_cadence' END")
    for m in ("moves", "moves_1", "moves_2"):
        rules += [f"CASE WHEN {m} IS NULL THEN 'missing_subtick_moves' END", f"CASE WHEN len(list_filter({m}, lambda x: x IS NULL)) > 0 THEN 'invalid_subtick_moves' END", "CASE WHEN " + BAD.format(op=">=").replace("list_filter(moves", f"list_filter({m}") + " THEN 'unsupported_raw_fraction' END"]
    return JOINED.format(r=", ".join(rules))


def three(spark, d):
    """Each command with the two after it in its slot, as columns of _0, _1 and _2."""
    w = Window.partitionBy("slot").orderBy("row_id")
    names = ("row_id", "user_id", "round_id", "alive", "number", "tick", "client_tick", "moves")
    rows = with_moves(spark, d)
    return rows.withColumns({f"{c}_{k}": F.lead(c, k).over(w) if k else C(c) for c in names for k in (0, 1, 2)}).where("row_id_2 is not null")


def chunk_reasons():
    rows = [{c: C(f"{c}_{k}") for c in ("row_id", "user_id", "round_id", "alive", "number", "tick", "client_tick")} for k in (0, 1, 2)]
    rules = labels.chunk_rules(rows, ["user_id", "round_id"], ["number", "tick"], "client_tick", {"alive": True})
    for k in (0, 1, 2):
        rules += labels.fraction_rules(C(f"moves_{k}"), "subtick_moves", ["when"], "unsupported_raw_fraction", closed=False)
    return labels.sorted_reasons(rules)


@query("SELECT row_id, " + chunk_sql() + " AS reasons FROM ch WHERE third IS NOT NULL", CMD + MOVES + NEXT)
def dom_28_chunk_reasons(spark, d):
    return three(spark, d).select("row_id", F.array_join(chunk_reasons(), ",").alias("reasons"))


#: Fields whose meaning is reviewed, and the row each needs a proof of; a row's proof holds for fields by its number.
FIELDS = {"held_start": (0,), "held_mid": (1,), "held_end": (2,), "net_changed": (1, 2)}
REVIEWED = ("held_start", "held_end", "net_changed")
LABEL_SQL = """
, lb AS (SELECT row_id, slot, f, CASE f WHEN 'held_start' THEN (p1 & 4) <> 0 WHEN 'held_mid' THEN (h1 & 4) <> 0 WHEN 'held_end' THEN (h2 & 4) <> 0 ELSE ((c1 & 4) <> 0) <> ((c2 & 4) <> 0) END AS v,
  CASE WHEN NOT alive THEN 'command_not_known_alive' END AS r1, CASE WHEN f = 'held_mid' THEN 'competitive_button_field_semantics_unverified' END AS r2,
  CASE WHEN f <> 'held_mid' AND NOT CASE f WHEN 'held_start' THEN row_id % 5 <> 0 WHEN 'held_end' THEN third % 5 <> 0 ELSE next % 5 <> 0 AND third % 5 <> 0 END THEN 'competitive_button_row_semantics_unverified' END AS r3
  FROM (SELECT *, lead(row_id) OVER (PARTITION BY slot ORDER BY row_id) AS next FROM tri) CROSS JOIN (VALUES ('held_start'), ('held_mid'), ('held_end'), ('net_changed')) n(f) WHERE third IS NOT NULL)"""


@query("SELECT row_id, f AS field, CASE WHEN r1 IS NULL AND r2 IS NULL AND r3 IS NULL THEN v END AS value, r1 IS NULL AND r2 IS NULL AND r3 IS NULL AS valid, " + JOINED.format(r="r1, r2, r3") + " AS reasons FROM lb", CMD + TRIPLE + LABEL_SQL)
def dom_34_masked_labels(spark, d):
    """Each field of a button over three rows: masked as a whole by the command's reasons, by field where its meaning is not
    reviewed, and by row where a row that it needs has no proof."""
    w = Window.partitionBy("slot").orderBy("row_id")
    names = {"p1": "h", "p2": "c", "row_id": "id"}
    rows = commands(spark, d).withColumns({f"{n}{k}": F.lead(c, k).over(w) for c, n in names.items() for k in (1, 2)}).where("id2 is not null")
    proof = [C(c) % 5 != 0 for c in ("row_id", "id1", "id2")]
    cells = []
    for name, value in labels.held_fields([C("p1"), C("h1"), C("h2")], [C("c1"), C("c2")], 4).items():
        known = F.lit(name in REVIEWED)
        proven = F.array(*(proof[i] for i in FIELDS[name]))
        reasons = labels.sorted_reasons([(~C("alive"), "command_not_known_alive"), (~known, "competitive_button_field_semantics_unverified"), (known & F.array_contains(proven, False), "competitive_button_row_semantics_unverified")])
        cells.append(F.struct(F.lit(name).alias("field"), labels.masked(value, reasons).alias("cell")))
    out = rows.select("row_id", F.explode(F.array(*cells)).alias("x"))
    return out.select("row_id", "x.field", "x.cell.value", "x.cell.valid", F.array_join("x.cell.reason_codes", ",").alias("reasons"))


@query(
    "SELECT row_id, CASE WHEN r IS NULL THEN CAST((coalesce(a, 0) & 2 <> 0) AS INT) + 2 * CAST((coalesce(b, 0) & 2 <> 0) AS INT) + 4 * CAST((coalesce(c, 0) & 2 <> 0) AS INT) END AS observation, r AS reason FROM (SELECT *, CASE WHEN base <> (k % 11 <> 0) THEN 'base_presence_mismatch' WHEN NOT base THEN 'missing_base_parent' WHEN NOT (k % 6 <> 0) THEN 'missing_button_parent' WHEN k % 8 = 5 THEN 'unsupported_command_flags' WHEN a IS DISTINCT FROM CASE WHEN k % 17 = 3 THEN p1 + 1 ELSE a END THEN 'button_projection_mismatch' END AS r FROM (SELECT row_id, k, p1, k % 11 <> 0 AND k % 13 <> 0 AS base, CASE WHEN k % 9 <> 0 THEN p1 END AS a, p2 AS b, p3 AS c FROM cmd))".replace("coalesce(a, 0) & 2 <> 0", "(coalesce(a, 0) & 2) <> 0").replace("coalesce(b, 0) & 2 <> 0", "(coalesce(b, 0) & 2) <> 0").replace("coalesce(c, 0) & 2 <> 0", "(coalesce(c, 0) & 2) <> 0"),
    CMD,
)
def dom_38_button_observations(spark, d):
    """Unknown is not zero: an absent plane is zero only in a parent that is there, and a mismatch has no observation."""
    base = (C("k") % 11 != 0) & (C("k") % 13 != 0)
    raw = F.when(C("k") % 9 != 0, C("p1"))
    present = {"base": (base, C("k") % 11 != 0), "button": (C("k") % 6 != 0, C("k") % 6 != 0)}
    planes = [(raw, F.when(C("k") % 17 == 3, C("p1") + 1).otherwise(raw)), (C("p2"), C("p2")), (C("p3"), C("p3"))]
    seen = labels.button_observation(present, F.when(C("k") % 8 == 5, 1), planes, 2)
    return commands(spark, d).select("row_id", seen.alias("x")).select("row_id", "x.*")


@query("SELECT slot, round_id, n, " + JOINED.format(r="CASE WHEN repeats THEN 'action_event_not_a_transition' END, CASE WHEN falls THEN 'action_events_out_of_order' END") + " AS errors FROM (SELECT slot, round_id, count(*) AS n, bool_or(pressed = coalesce(before, false)) AS repeats, bool_or(o < coalesce(po, -1)) AS falls FROM (SELECT slot, round_id, k % 2 = 0 AS pressed, sec % 600 AS o, lag(k % 2 = 0) OVER w AS before, lag(sec % 600) OVER w AS po FROM cmd WINDOW w AS (PARTITION BY slot, round_id ORDER BY row_id)) GROUP BY slot, round_id)", CMD)
def dom_31_held_events(spark, d):
    """A fold over the events of each slot and round."""
    rows = commands(spark, d).groupBy("slot", "round_id").agg(F.array_sort(F.collect_list(F.struct("row_id", (C("sec") % 600).alias("offset"), (C("k") % 2 == 0).alias("pressed")))).alias("events"))
    errors = labels.replay_held(F.lit(False), C("events"))
    return rows.select("slot", "round_id", F.size("events").cast("long").alias("n"), F.array_join(errors, ",").alias("errors"))


@query("SELECT r.round_id, CASE WHEN s.phase IS NULL THEN 'unknown' ELSE s.phase END AS phase, coalesce(s.phase = 'competitive', false) AS verified, CASE WHEN s.phase IS NULL THEN 'phase_sidecar_not_supplied' END AS reason FROM rd r LEFT JOIN (SELECT round_id, CASE WHEN count(*) FILTER (NOT alive) > count(*) * 0.22 THEN 'setup' ELSE 'competitive' END AS phase FROM cmd WHERE round_id % 5 <> 2 GROUP BY round_id) s USING (round_id)", CMD, ROUNDS)
def dom_2_phase_evidence(spark, d):
    return phases(spark, d).select("round_id", "phase", "verified", "reason")


def phases(spark, d):
    """The rounds with the phase that a side-car states; a round without one is unknown, and says so."""
    side = commands(spark, d).where("round_id % 5 <> 2").groupBy("round_id").agg(F.when(F.count_if(~C("alive")) > F.count("*") * 0.22, "setup").otherwise("competitive").alias("stated"))
    r = rounds(spark, d).join(side, "round_id", "left")
    return r.withColumns({"phase": F.coalesce("stated", F.lit("unknown")), "verified": F.coalesce(C("stated") == "competitive", F.lit(False)), "reason": F.when(C("stated").isNull(), "phase_sidecar_not_supplied")})


JOBS_SQL = """
, ph AS (SELECT r.round_id, coalesce(s.phase = 'competitive', false) AS verified, r.freeze_end, r."end" AS round_end FROM rd r LEFT JOIN (SELECT round_id, CASE WHEN count(*) FILTER (NOT alive) > count(*) * 0.22 THEN 'setup' ELSE 'competitive' END AS phase FROM cmd WHERE round_id % 5 <> 2 GROUP BY round_id) s USING (round_id)),
cut AS (SELECT *, CASE WHEN lag(alive) OVER w AND tick - lag(tick) OVER w <= 240 AND lag(round_id) OVER w = round_id THEN 0 ELSE 1 END AS c FROM st WINDOW w AS (PARTITION BY slot ORDER BY tick)),
isl AS (SELECT *, sum(c) OVER (PARTITION BY slot ORDER BY tick) AS g FROM cut),
win AS (SELECT slot, i.round_id, greatest(min(tick), any_value(freeze_end), 500) AS start, least(max(tick) + 1, any_value(round_end), 40000) AS "end" FROM isl i JOIN ph USING (round_id) WHERE alive AND verified AND round_end IS NOT NULL GROUP BY slot, i.round_id, g),
inside AS (SELECT w.slot, w.round_id, w.start, w."end", c.tick, lag(c.tick) OVER (PARTITION BY w.slot, w.start ORDER BY c.tick, c.row_id) AS p FROM win w JOIN cmd c ON c.slot = w.slot AND c.tick >= w.start AND c.tick < w."end" WHERE w."end" - w.start >= 32),
job AS (SELECT slot, round_id, start, "end", count(*) AS n, greatest(coalesce(max(tick - p), 0), min(tick) - start, "end" - 1 - max(tick)) AS gap FROM inside GROUP BY 1, 2, 3, 4)"""


@query("SELECT slot, round_id, start, \"end\", n AS n_commands, gap AS largest_gap, substr(sha256(slot || ':' || round_id || ':' || start || ':' || \"end\" || ':render-v1'), 1, 24) AS clip_id FROM job WHERE gap <= 200", STATE, ROUNDS + JOBS_SQL)
def dom_3_render_jobs(spark, d):
    """Alive windows, of rounds whose phase is verified, cut to the live part and to the ticks asked for, long enough, with
    commands in them and no gap between those, or to the edges, over the limit; named by a digest of their key."""
    alive = windows.gap_islands(states(spark, d), ["slot"], "tick", C("alive"), ["round_id"], 240)
    live = alive.join(phases(spark, d).where("verified and end is not null").select("round_id", "freeze_end", C("end").alias("round_end")), "round_id")
    cut = intervals.clip(intervals.clip(live, C("freeze_end"), C("round_end")), 500, 40000).where("end - start >= 32").select("slot", "round_id", "start", "end")
    met = interval_join(commands(spark, d).select("slot", "tick", "row_id"), cut, "tick", keys=("slot",))
    before = F.lag("tick").over(Window.partitionBy("slot", "start").orderBy("tick", "row_id"))
    g = met.withColumn("step", C("tick") - before).groupBy("slot", "round_id", "start", "end").agg(F.count("*").alias("n_commands"), F.max("step").alias("step"), F.min("tick").alias("lo"), F.max("tick").alias("hi"))
    gap = F.greatest(F.coalesce("step", F.lit(0)), C("lo") - C("start"), C("end") - 1 - C("hi"))
    key = F.concat_ws(":", "slot", "round_id", "start", "end", F.lit("render-v1"))
    return g.withColumn("largest_gap", gap).where("largest_gap <= 200").select("slot", "round_id", "start", "end", "n_commands", "largest_gap", F.substring(F.sha2(key, 256), 1, 24).alias("clip_id"))


@query("SELECT slot, count(*) AS n, CASE WHEN count(t) = 0 THEN 'absent' WHEN count(t) < count(*) THEN 'incomplete' WHEN bool_or(t <= p) THEN 'not_rising' ELSE 'observed' END AS status FROM (SELECT slot, t, lag(t) OVER (PARTITION BY slot ORDER BY tick) AS p FROM (SELECT slot, tick, CASE slot % 4 WHEN 0 THEN NULL WHEN 1 THEN CASE WHEN x % 97 <> 0 THEN tick END WHEN 2 THEN tick // 16 ELSE tick END AS t FROM st)) GROUP BY slot", STATE)
def dom_9_render_boundaries(spark, d):
    """All or none: the boundaries of a slot count only if every one was observed and each is later than the last."""
    kind = C("slot") % 4
    t = F.when(kind == 1, F.when(C("x") % 97 != 0, C("tick"))).when(kind == 2, F.floor(C("tick") / 16)).when(kind == 3, C("tick"))
    rows = states(spark, d).select("slot", "tick", t.alias("t")).withColumn("p", F.lag("t").over(Window.partitionBy("slot").orderBy("tick")))
    status = F.when(F.count("t") == 0, "absent").when(F.count("t") < F.count("*"), "incomplete").when(F.coalesce(F.max(C("t") <= C("p")), F.lit(False)), "not_rising").otherwise("observed")
    return rows.groupBy("slot").agg(F.count("*").alias("n"), status.alias("status"))


@query("SELECT c.row_id, " + JOINED.format(r="CASE WHEN k1 IS DISTINCT FROM k THEN 'k_differs' END, CASE WHEN c1 IS DISTINCT FROM cents THEN 'cents_differs' END, CASE WHEN d1 IS DISTINCT FROM dx THEN CASE WHEN d1 IS NULL OR dx IS NULL THEN 'dx_presence_differs' ELSE 'dx_differs' END END") + " AS mismatches FROM cmd c LEFT JOIN (SELECT row_id, CASE WHEN k % 19 = 4 THEN k + 1 ELSE k END AS k1, cents AS c1, CASE WHEN k % 21 <> 7 THEN dx END AS d1 FROM cmd WHERE k % 29 <> 3) f USING (row_id)", CMD)
def dom_24_field_agreement(spark, d):
    """A table of decoded fields against the columns: values and presence."""
    c = commands(spark, d)
    fields = c.where("k % 29 <> 3").select("row_id", F.explode(F.create_map(F.lit("k"), F.when(C("k") % 19 == 4, C("k") + 1).otherwise(C("k")), F.lit("cents"), C("cents"), F.lit("dx"), F.when(C("k") % 21 != 7, C("dx")))).alias("field", "value"))
    wide = fields.groupBy("row_id").agg(*(F.max(F.when(C("field") == n, C("value"))).alias(f"raw_{n}") for n in ("k", "cents", "dx")))
    both = c.join(wide, "row_id", "left")
    differs = lambda n: ~C(f"raw_{n}").eqNullSafe(C(n))
    one_sided = C("raw_dx").isNull() | C("dx").isNull()
    rules = [(differs("k"), "k_differs"), (differs("cents"), "cents_differs"), (differs("dx") & one_sided, "dx_presence_differs"), (differs("dx") & ~one_sided, "dx_differs")]
    return both.select("row_id", F.array_join(labels.sorted_reasons(rules), ",").alias("mismatches"))


@query("SELECT row_id, ceiling, status, reason FROM (SELECT *, CASE WHEN reason IS NULL THEN 'verified' ELSE 'unknown' END AS status FROM (SELECT row_id, ceiling, CASE WHEN errors > 0 THEN 'non_ordinary_command_in_prefix' WHEN ceiling > tick + 3 THEN 'bound_after_frame' END AS reason FROM (SELECT row_id, tick, max(client_tick) OVER w AS ceiling, count(*) FILTER (kind = 'error') OVER w AS errors FROM cmd WINDOW w AS (PARTITION BY slot, round_id ORDER BY row_id))))", CMD)
def dom_26_packet_bounds(spark, d):
    """What is the latest that a row can know: the running maximum of the clocks before it, if nothing odd came before."""
    w = Window.partitionBy("slot", "round_id").orderBy("row_id").rowsBetween(Window.unboundedPreceding, 0)
    rows = commands(spark, d).select("row_id", "tick", F.max("client_tick").over(w).alias("ceiling"), F.sum((C("kind") == "error").cast("int")).over(w).alias("errors"))
    reason = F.when(C("errors") > 0, "non_ordinary_command_in_prefix").when(C("ceiling") > C("tick") + 3, "bound_after_frame")
    return rows.select("row_id", "ceiling", F.when(reason.isNull(), "verified").otherwise("unknown").alias("status"), reason.alias("reason"))


@query("SELECT slot, count(*) AS n, count(*) FILTER (late) AS overlapping, count(*) FILTER (backwards) AS reversed, bool_and(NOT late AND NOT backwards) AS accepted FROM (SELECT slot, \"end\" <= start AS backwards, coalesce(start < lag(\"end\") OVER (PARTITION BY slot ORDER BY start, row_id), false) AS late FROM (SELECT slot, row_id, tick AS start, tick + k % 50 AS \"end\" FROM cmd)) GROUP BY slot", CMD)
def src_25_segment_gate(spark, d):
    """A side-car's segments are taken only if none is empty or begins before the one before it has ended."""
    s = commands(spark, d).select("slot", "row_id", C("tick").alias("start"), (C("tick") + C("k") % 50).alias("end"))
    late = F.coalesce(C("start") < F.lag("end").over(Window.partitionBy("slot").orderBy("start", "row_id")), F.lit(False))
    g = s.withColumns({"overlaps": late, "reversed": C("end") <= C("start")}).groupBy("slot")
    return g.agg(F.count("*").alias("n"), F.count_if("overlaps").alias("overlapping"), F.count_if("reversed").alias("reversed"), F.min(~C("overlaps") & ~C("reversed")).alias("accepted"))


@query("SELECT demo, count(*) AS n_series, CASE WHEN count(*) = 1 THEN min(series) END AS series FROM (SELECT DISTINCT user_id AS demo, k % 40 AS series FROM cmd) GROUP BY demo", CMD)
def src_26_series_groups(spark, d):
    """Series list their demos; a demo that two series list has none."""
    listed = commands(spark, d).groupBy((C("k") % 40).alias("series")).agg(F.collect_set("user_id").alias("demo_ids"))
    return listed.select("series", F.explode("demo_ids").alias("demo")).groupBy("demo").agg(F.count("*").alias("n_series"), F.when(F.count("*") == 1, F.min("series")).alias("series"))


@query("SELECT slot, round_id, n, CASE WHEN falls > 0 THEN 'out_of_order' WHEN lo > round_id * 1440 + 400 OR hi < round_id * 1440 + 1000 THEN 'window_not_covered' ELSE 'complete' END AS status FROM (SELECT slot, round_id, count(*) AS n, count(*) FILTER (client_tick < p) AS falls, min(client_tick) AS lo, max(client_tick) AS hi FROM (SELECT slot, round_id, client_tick, lag(client_tick) OVER (PARTITION BY slot, round_id ORDER BY row_id) AS p FROM cmd) GROUP BY slot, round_id)", CMD)
def src_24_clock_gate(spark, d):
    """The messages of a clock, in order and over the whole window, or the reason why they are not taken."""
    rows = commands(spark, d).withColumn("p", F.lag("client_tick").over(Window.partitionBy("slot", "round_id").orderBy("row_id")))
    g = rows.groupBy("slot", "round_id").agg(F.count("*").alias("n"), F.count_if(C("client_tick") < C("p")).alias("falls"), F.min("client_tick").alias("lo"), F.max("client_tick").alias("hi"))
    begin = C("round_id") * 1440
    status = F.when(C("falls") > 0, "out_of_order").when((C("lo") > begin + 400) | (C("hi") < begin + 1000), "window_not_covered").otherwise("complete")
    return g.select("slot", "round_id", "n", status.alias("status"))


@query("SELECT row_id, sha256('[\"dict\",[[\"alive\",[\"bool\",' || alive || ']],[\"dx\",' || CASE WHEN dx IS NULL THEN '[\"null\"]' ELSE '[\"int\",\"' || dx || '\"]' END || '],[\"kind\",[\"str\",\"' || kind || '\"]],[\"row_id\",[\"int\",\"' || row_id || '\"]]]]') AS digest FROM cmd", CMD)
def fn_h3_typed_digest(spark, d):
    """A digest of a row that keeps the types: 1, true and null differ from each other and from their texts."""
    quoted = lambda c: F.concat(F.lit('"'), c.cast("string"), F.lit('"'))
    tagged = lambda tag, c: F.when(c.isNull(), F.lit('["null"]')).otherwise(F.concat(F.lit(f'["{tag}",'), c, F.lit("]")))
    cells = {"alive": tagged("bool", C("alive").cast("string")), "dx": tagged("int", quoted(C("dx"))), "kind": tagged("str", F.to_json(F.array("kind")).substr(F.lit(2), F.octet_length(F.to_json(F.array("kind"))) - 2)), "row_id": tagged("int", quoted(C("row_id")))}
    text = F.concat(F.lit('["dict",['), F.concat_ws(",", *(F.concat(F.lit(f'["{k}",'), v, F.lit("]")) for k, v in sorted(cells.items()))), F.lit("]]"))
    return commands(spark, d).select("row_id", F.sha2(text, 256).alias("digest"))


@query("SELECT slot, code, count(*) AS n, count(*) FILTER (known) AS known FROM (SELECT slot, present IS NOT NULL AS known, CAST((p1 & 8) <> 0 AS INT) + 2 * CAST((p2 & 8) <> 0 AS INT) + 4 * CAST((p3 & 8) <> 0 AS INT) AS code FROM cmd) GROUP BY slot, code", CMD)
def dom_37_button_evidence(spark, d):
    from tideline.functions.bits import decode

    rows = commands(spark, d).select("slot", C("present").isNotNull().alias("known"), decode(C("p1"), C("p2"), C("p3"), 8)["code"].alias("code"))
    return rows.groupBy("slot", "code").agg(F.count("*").alias("n"), F.count_if("known").alias("known"))


@query("SELECT row_id, epoch, max(cents) OVER (PARTITION BY slot, epoch ORDER BY row_id) AS in_epoch, max(cents) OVER (PARTITION BY slot ORDER BY row_id) AS lifetime FROM (SELECT row_id, slot, cents, count(*) FILTER (kind = 'error') OVER (PARTITION BY slot ORDER BY row_id) AS epoch FROM cmd)", CMD)
def str_8_epochs(spark, d):
    """Some events begin an epoch, in which a maximum starts anew; another is kept for the lifetime."""
    w = Window.partitionBy("slot").orderBy("row_id").rowsBetween(Window.unboundedPreceding, 0)
    own = Window.partitionBy("slot", "epoch").orderBy("row_id").rowsBetween(Window.unboundedPreceding, 0)
    rows = commands(spark, d).select("row_id", "slot", "cents", F.sum((C("kind") == "error").cast("long")).over(w).alias("epoch"), F.max("cents").over(w).alias("lifetime"))
    return rows.select("row_id", "epoch", F.max("cents").over(own).alias("in_epoch"), "lifetime")


@query("SELECT slot, tick, count(*) OVER w AS n, min(tick) OVER w AS oldest, count(*) OVER w < 8 AS short FROM st WINDOW w AS (PARTITION BY slot ORDER BY tick ROWS BETWEEN 7 PRECEDING AND CURRENT ROW)", STATE)
def str_5_sliding_history(spark, d):
    out = windows.history(states(spark, d), ["slot"], "tick", "tick", 8)
    return out.select("slot", "tick", F.size("history").cast("long").alias("n"), F.array_min("history").alias("oldest"), (F.size("reason_codes") > 0).alias("short"))
