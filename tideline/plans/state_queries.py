"""Queries of running work without bound, of streams with state, of digests, commits and clustered ledgers."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.operators import aggregates, cadence, digests, integrity, joins, samples, scans, selection
from tideline.plans.registry import query
from tideline.plans.source_queries import EVENTS, drained, rocks
from tideline.plans.views import CMD, ROUNDS, STATE, commands, commands_of, rounds, states
from tideline.sources import sinks, tables
from tideline.sources.scratch import new_folder
from tideline.streaming import processors, stateful

C = F.col


@query(
    """SELECT row_id, place, highest, lowest, total, previous_kind, last_yaw, island FROM (
      SELECT *, sum(CASE WHEN previous_kind IS DISTINCT FROM kind OR sec - p > 60 THEN 1 ELSE 0 END) OVER (ORDER BY sec, row_id) AS island FROM (
        SELECT row_id, sec, kind, row_number() OVER w AS place, max(cents) OVER w AS highest, min(cents) OVER w AS lowest, CAST(sum(cents) OVER w AS BIGINT) AS total,
          lag(kind) OVER w AS previous_kind, lag(sec) OVER w AS p, last_value(yaw IGNORE NULLS) OVER w AS last_yaw FROM cmd WINDOW w AS (ORDER BY sec, row_id)))""",
    CMD,
)
def win_34_whole_scan(spark, d):
    """All commands as one key in the order of their seconds: place, extremes, total, the kind before, the last known yaw,
    and runs of one kind without a pause of a minute."""
    order = ["sec", "row_id"]
    rows = scans.ranged(commands(spark, d).select("row_id", "sec", "kind", "cents", "yaw"), [], order)
    out = scans.scan(rows, [], order, place=scans.running_count(), highest=scans.running_max(C("cents")), lowest=scans.running_min(C("cents")), total=scans.running_sum(C("cents")))
    out = scans.last_known(scans.previous(out, [], order, ["kind"]), [], order, ["yaw"])
    out = scans.scanned_islands(out, [], order, ["kind", "sec"], lambda before: ~before("kind").eqNullSafe(C("kind")) | (C("sec") - before("sec") > 60))
    return out.select("row_id", "place", "highest", "lowest", "total", "previous_kind", "last_yaw", "island")


@query("SELECT kind, row_id, place, total FROM (SELECT kind, row_id, row_number() OVER w AS place, CAST(sum(cents) OVER w AS BIGINT) AS total FROM cmd WINDOW w AS (PARTITION BY kind ORDER BY sec, row_id))", CMD)
def win_35_kind_totals(spark, d):
    """Running totals of five kinds, each with a fifth of all commands, over all partitions."""
    rows = scans.ranged(commands(spark, d).select("kind", "row_id", "sec", "cents"), ["kind"], ["sec", "row_id"])
    return scans.scan(rows, ["kind"], ["sec", "row_id"], place=scans.running_count(), total=scans.running_sum(C("cents"))).select("kind", "row_id", "place", "total")


@query(
    """SELECT p.row_id, count(s.lo) AS n, CAST(sum(s.hi - s.lo) AS BIGINT) AS spans FROM cmd p LEFT JOIN (
      SELECT slot, tick - (1::BIGINT << CAST(row_id % 41 AS INTEGER)) // 2 AS lo, tick - (1::BIGINT << CAST(row_id % 41 AS INTEGER)) // 2 + (1::BIGINT << CAST(row_id % 41 AS INTEGER)) AS hi FROM cmd WHERE kind = 'signup') s
      ON s.slot = p.slot AND p.tick >= s.lo AND p.tick < s.hi GROUP BY p.row_id HAVING count(s.lo) > 0""",
    CMD,
)
def join_27_dyadic(spark, d):
    """Every command with the intervals around its slot's sign-ups, which are 1 to 2 ** 40 ticks long."""
    c = commands(spark, d)
    length = F.expr("shiftleft(CAST(1 AS BIGINT), CAST(row_id % 41 AS INT))")
    spans = c.where("kind = 'signup'").select("slot", (C("tick") - F.floor(length / 2)).alias("lo"), length.alias("length")).withColumn("hi", C("lo") + C("length")).drop("length")
    met = joins.dyadic_join(c.select("row_id", "slot", "tick"), spans, "tick", "lo", "hi", ("slot",))
    return met.groupBy("row_id").agg(F.count("*").alias("n"), F.sum(C("hi") - C("lo")).alias("spans"))


@query(
    """SELECT slot, n, s AS sampled, m AS median, median(abs(cents - m)) AS mad FROM (SELECT slot, cents, n, count(*) OVER (PARTITION BY slot) AS s, median(cents) OVER (PARTITION BY slot) AS m FROM (
      SELECT slot, cents, count(*) OVER (PARTITION BY slot) AS n FROM cmd)) GROUP BY slot, n, s, m""",
    CMD,
)
def agg_17_reservoir(spark, d):
    """Median and spread of each slot by bounded accumulators of 1,000 values: exact, as no slot has more rows."""
    return aggregates.sampled_median_and_mad(commands(spark, d), ["slot"], "cents", "row_id", 1000)


@query("SELECT kind, row_id, turn FROM (SELECT kind, row_id, row_number() OVER (PARTITION BY kind ORDER BY sha256(CAST(row_id AS VARCHAR))) AS turn FROM cmd) WHERE turn <= 40", CMD)
def ord_9_first_turns(spark, d):
    """The first forty turns of each kind, of which a partition sends no more."""
    return selection.first_turns(commands(spark, d).select("kind", "row_id"), ["kind"], "row_id", 40).select("kind", "row_id", C("turn").cast("long").alias("turn"))


@query(
    """SELECT row_id, CASE row_id % 500 WHEN 7 THEN 'changed' WHEN 11 THEN 'missing' WHEN 13 THEN 'repeated' END AS status FROM cmd WHERE row_id % 500 IN (7, 11, 13)
      UNION ALL SELECT row_id + 5000000000, 'added' FROM cmd WHERE row_id % 500 = 17""",
    CMD,
)
def aud_10_digest_tree(spark, d):
    """Commands published with their digests, then computed anew with some rows edited, left out, repeated and added: the
    tree of ranges leads to each."""
    path, columns = new_folder(spark), ["slot", "tick", "cents", "yaw"]
    c = commands(spark, d).select("row_id", *columns)
    digests.publish_with_digests(c, path, "row_id", columns, 64)
    anew = c.where("row_id % 500 != 11").withColumn("cents", C("cents") + (C("row_id") % 500 == 7).cast("long"))
    anew = anew.unionByName(c.where("row_id % 500 = 13")).unionByName(c.where("row_id % 500 = 17").withColumn("row_id", C("row_id") + 5_000_000_000))
    return digests.compare_with_published(spark, anew, path, "row_id", columns, 64).rows


@query("SELECT row_id, tick, kind FROM cmd", CMD)
def snk_7_commit_log(spark, d):
    """Three commits, one of them tried twice, beside what a writer that died has left: readers see each row once."""
    path = new_folder(spark)
    log = sinks.CommitLog(spark, path)
    rows = commands(spark, d).select("row_id", "tick", "kind")
    for i in (0, 1, 1, 2):
        log.append(rows.where(C("row_id") % 3 == i), f"part-{i}")
    rows.write.parquet(f"{path}/data/part-1-lost")
    return log.read(rows.schema)


@query("SELECT event, n, frame_index FROM (SELECT kind AS event, row_id AS n, tick AS frame_index FROM cmd) WHERE event = 'signup' AND frame_index BETWEEN 5000 AND 20000", CMD)
def src_31_clustered_ledger(spark, d):
    """A ledger in ranges of (event, frame), of which a reader opens the files that its manifest names."""
    path = new_folder(spark)
    rows = commands(spark, d).select(C("kind").alias("event"), C("tick").alias("frame_index"), C("row_id").alias("n"))
    tables.write_clustered(rows, path, ["event", "frame_index", "n"])
    return tables.read_clustered(spark, path, ("signup", 5000), ("signup", 20000), rows.schema)


def in_batches(spark, d, n: int = 3, closing: bool = True) -> DataFrame:
    """All events as a stream of n batches in the order of their times, and, if closing, one event of no user a year later,
    which takes the watermark past them all. A batch is as many files as hold a quarter of a million of its rows each, of all
    batches the same number: rows dealt in turn leave no file empty."""
    path = new_folder(spark)
    events = spark.read.schema(EVENTS).parquet(f"{d}/events.parquet")
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    step = (last - first) / n
    own = [(C("ts") >= F.lit(first + step * i)) & (C("ts") < F.lit(first + step * (i + 1)) if i + 1 < n else F.lit(True)) for i in range(n)]
    files = max(1, min(events.agg(*(F.count_if(x) for x in own)).first()) // 250_000)
    for x in own:
        part = events.where(x)
        (part.repartition(files) if files > 1 else part.coalesce(1)).write.mode("append").parquet(path)
    if closing:
        end = spark.range(1).select((F.lit(last) + F.expr("INTERVAL 1 YEAR")).alias("ts"))
        end.select(F.lit(-1).cast("long").alias("event_id"), "ts", F.lit(-1).cast("long").alias("user_id"), F.lit("end").alias("event_type"), F.lit(0.0).alias("value"), F.lit('{"k": 0}').alias("props")).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files).parquet(path)


@query(
    """SELECT user_id, min(ts) AS start, max(ts) AS last, state, count(*) AS n FROM (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS g FROM (
      SELECT *, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 2 HOUR AND lag(state) OVER w = state THEN 0 ELSE 1 END AS s FROM (SELECT *, CASE WHEN event_type IN ('view', 'click') THEN 'looking' ELSE 'acting' END AS state FROM events)
      WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))) GROUP BY user_id, state, g"""
)
def str_11_closed_sessions(spark, d):
    """Sessions that a gap or another state closes, put out by timers, over several batches."""
    state = F.when(C("event_type").isin("view", "click"), "looking").otherwise("acting")
    with rocks(spark):
        out = drained(spark, processors.stream_state_sessions(in_batches(spark, d), "user_id", "ts", "event_id", state, 7200), "append")
    return out.where("user_id >= 0")


@query(
    """SELECT slot, row_id, array_to_string(h, ',') AS history FROM (SELECT slot, row_id, list(cents) OVER (PARTITION BY slot, g ORDER BY sec, row_id ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS h FROM (
      SELECT *, sum(s) OVER (PARTITION BY slot ORDER BY sec, row_id) AS g FROM (SELECT *, CASE WHEN sec - lag(sec) OVER w <= 21600 AND lag(alive) OVER w = alive THEN 0 ELSE 1 END AS s FROM cmd
      WINDOW w AS (PARTITION BY slot ORDER BY sec, row_id)))) WHERE len(h) = 8""",
    CMD,
)
def str_12_histories(spark, d):
    """The last eight values of each command that has so many since a pause of six hours or a death, over several batches."""
    with rocks(spark):
        out = drained(spark, processors.stream_histories(commands_of(in_batches(spark, d, closing=False)), "slot", "sec", "row_id", C("alive"), "cents", 8, 21600), "append")
    return out.select("slot", "row_id", F.array_join(F.transform("history", lambda x: x.cast("string")), ",").alias("history"))


@query(
    """SELECT slot, row_id, coalesce(place - before <= 16, false) AS duplicate FROM (SELECT slot, row_id, place, lag(place) OVER (PARTITION BY slot, item ORDER BY place) AS before FROM (
      SELECT slot, row_id, kind || (k % 4) AS item, row_number() OVER (PARTITION BY slot ORDER BY sec, row_id) AS place FROM cmd))""",
    CMD,
)
def str_13_recent_keys(spark, d):
    """Commands whose item was among the sixteen before them, by a ring of that size, over several batches."""
    with rocks(spark):
        out = drained(spark, processors.stream_repeated_within(commands_of(in_batches(spark, d, closing=False)), "slot", "sec", "row_id", F.concat("kind", (C("k") % 4).cast("string")), 16), "append")
    return out


@query(
    """SELECT slot, row_id, epoch, max(v) OVER (PARTITION BY slot, epoch ORDER BY sec, row_id) AS in_epoch, max(v) OVER (PARTITION BY slot ORDER BY sec, row_id) AS lifetime FROM (
      SELECT *, CASE WHEN kind <> 'view' THEN cents END AS v, count(*) FILTER (kind = 'error') OVER (PARTITION BY slot ORDER BY sec, row_id) AS epoch FROM cmd)""",
    CMD,
)
def str_14_epochs(spark, d):
    """Errors begin an epoch, views don't count, and the lifetime's maximum outlives the epochs, over several batches."""
    with rocks(spark):
        out = drained(spark, processors.stream_epochs(commands_of(in_batches(spark, d, closing=False)), "slot", "sec", "row_id", C("kind") == "error", C("kind") == "view", "cents"), "append")
    return out


@query(
    """SELECT 'slot:' || slot AS scope, code, severity, n FROM (SELECT slot, unnest([{'code': 'number_gaps', 'severity': 'warning', 'n': gaps}, {'code': 'number_reversals', 'severity': 'warning', 'n': reversals}, {'code': 'tick_reversals', 'severity': 'warning', 'n': back},
        {'code': 'repeated_commands', 'severity': 'warning', 'n': repeated}, {'code': 'numbers_out_of_range', 'severity': 'error', 'n': odd},
        {'code': 'all_view_angles_missing', 'severity': 'error', 'n': CASE WHEN no_view = n THEN no_view ELSE 0 END}, {'code': 'some_view_angles_missing', 'severity': 'warning', 'n': CASE WHEN no_view < n THEN no_view ELSE 0 END},
        {'code': 'all_buttons_missing', 'severity': 'error', 'n': CASE WHEN no_buttons = n THEN no_buttons ELSE 0 END}, {'code': 'some_buttons_missing', 'severity': 'warning', 'n': CASE WHEN no_buttons < n THEN no_buttons ELSE 0 END}], recursive := true)
      FROM (SELECT slot, count(*) AS n, count(*) FILTER (number > pn + 1) AS gaps, count(*) FILTER (number <= pn) AS reversals, count(*) FILTER (tick < pt) AS back, count(*) FILTER (place - before <= 4096) AS repeated,
          count(*) FILTER (pitch NOT BETWEEN -90 AND 90 OR yaw NOT BETWEEN -180 AND 180 OR p1 NOT BETWEEN 0 AND 255) AS odd, count(*) FILTER (yaw IS NULL) AS no_view, count(*) FILTER (present IS NULL) AS no_buttons
        FROM (SELECT *, lag(place) OVER (PARTITION BY slot, tick, number ORDER BY place) AS before FROM (SELECT *, row_number() OVER w AS place, lag(number) OVER w AS pn, lag(tick) OVER w AS pt FROM cmd WINDOW w AS (PARTITION BY slot ORDER BY row_id))) GROUP BY slot)) WHERE n > 0
      UNION ALL SELECT 'commands', 'command_row_order', 'error', n FROM (SELECT count(*) FILTER (row_id <> p + 1) AS n FROM (SELECT row_id, lag(row_id) OVER (ORDER BY row_id) AS p FROM cmd WHERE row_id % 1000 <> 3)) WHERE n > 0
      UNION ALL SELECT 'slot:' || slot, 'identity_changes', 'warning', n FROM (SELECT slot, count(*) FILTER (user_id <> p) AS n FROM (SELECT *, lag(user_id) OVER (PARTITION BY slot ORDER BY tick) AS p FROM st) GROUP BY slot) WHERE n > 0
      UNION ALL SELECT 'rounds', 'rounds_without_end', 'warning', n FROM (SELECT count(*) FILTER ("end" IS NULL) AS n FROM rd) WHERE n > 0
      UNION ALL SELECT 'manifest', 'command_count_mismatch', 'error', abs(count(*) - 12345) FROM cmd UNION ALL SELECT 'manifest', 'state_count_mismatch', 'error', abs(count(*) - 12345) FROM st
      UNION ALL SELECT 'manifest', 'unaccounted_payloads', 'error', abs(12345 - count(*) - 45) FROM cmd""",
    STATE,
    ROUNDS,
)
def dom_47_integrity(spark, d):
    """All checks of commands, states and rounds against each other and a manifest that is wrong; some rows are gone."""
    c = commands(spark, d)
    stated = {"commands": 12345, "states": 12345, "eligible": 12345, "rejected": 45}
    parts = [integrity.command_issues(c), integrity.order_issues(c.where("row_id % 1000 != 3")), integrity.state_issues(states(spark, d)), integrity.round_issues(rounds(spark, d)), integrity.count_issues(c, states(spark, d), stated)]
    return reduce(lambda a, b: a.unionByName(b), parts)


STEPS = """
steps AS (SELECT slot, row_id, p AS before, sec AS after, CASE WHEN sec > p THEN sec - p END AS gap FROM (SELECT slot, row_id, sec, lag(sec) OVER (PARTITION BY slot ORDER BY sec_order) AS p, n FROM (
  SELECT *, row_number() OVER (PARTITION BY slot ORDER BY sec, row_id) AS sec_order, row_number() OVER (PARTITION BY slot ORDER BY sec, row_id) AS n FROM cmd)) WHERE n > 1)"""


def _steps(spark, d) -> DataFrame:
    """Steps of each slot's seconds, in the order of (second, row)."""
    rows = commands(spark, d).select("slot", "row_id", "sec", F.struct("sec", "row_id").alias("place"))
    return cadence.intervals(rows, ["slot"], "place", "sec", 3600).withColumn("row_id", C("place.row_id")).drop("place")


@query(
    """SELECT slot, count(*) AS n, count(*) FILTER (gap IS NULL) AS invalid, count(*) FILTER (gap > 3600) AS above, min(gap) AS least, median(gap) AS middle, quantile_disc(gap, 0.95) AS high, max(gap) AS most FROM steps GROUP BY slot""",
    CMD,
    STEPS,
)
def dom_49_cadence(spark, d):
    """Cadence of each slot's clock: its intervals, those over an hour, those that are none."""
    return cadence.summary(_steps(spark, d), ["slot"]).withColumn("high", C("high").cast("long"))


@query(
    """SELECT s.slot, s.row_id, s.gap, s.place, (SELECT max(sec) FROM cmd m WHERE m.kind = 'signup' AND m.slot = s.slot AND m.sec <= s.before) AS previous_at, (SELECT min(sec) FROM cmd m WHERE m.kind = 'signup' AND m.slot = s.slot AND m.sec >= s.after) AS next_at,
      (SELECT count(*) FROM cmd a WHERE a.kind = 'purchase' AND a.slot = s.slot AND a.sec BETWEEN s.before - 1800 AND s.after + 1800) AS actions
      FROM (SELECT *, row_number() OVER (PARTITION BY slot ORDER BY gap DESC, row_id) AS place FROM steps WHERE gap IS NOT NULL) s WHERE place <= 10""",
    CMD,
    STEPS,
)
def dom_49_largest_stalls(spark, d):
    """The ten largest intervals of each slot, the sign-ups around them, and purchases within half an hour of them."""
    c = commands(spark, d)
    most = cadence.largest(_steps(spark, d), ["slot"], "row_id", 10)
    marks = c.where("kind = 'signup'").select("slot", "sec", "kind")
    out = cadence.nearby(cadence.around(most, marks, ["slot"], "sec", "kind"), c.where("kind = 'purchase'"), ["slot"], "sec", 1800, "row_id")
    return out.select("slot", "row_id", "gap", C("place").cast("long").alias("place"), "previous_at", "next_at", "actions")


@query(
    """SELECT slot, stage, count(*) AS samples, count(gap) AS valid, count(*) FILTER (gap > 0) AS positive, count(*) FILTER (gap > 20000) AS above, max(gap) AS most,
      arg_max(row_id, (gap, -row_id)) FILTER (gap IS NOT NULL) AS most_at, arg_max(coalesce(p, -1), (gap, -row_id)) FILTER (gap IS NOT NULL) AS sample_before
      FROM (SELECT slot, row_id, k % 3 AS stage, CASE WHEN cents - 500 >= 0 THEN cents - 500 END AS gap, lag(row_id) OVER (PARTITION BY slot ORDER BY row_id) AS p FROM cmd WHERE kind = 'view') GROUP BY slot, stage""",
    CMD,
)
def dom_50_startup_stages(spark, d):
    """Three stages of views as start-up samples: recorded gaps, and the largest with the sample before it."""
    out = cadence.startup(commands(spark, d).where("kind = 'view'"), ["slot"], "row_id", C("k") % 3, C("cents") - 500, 20000)
    return out.withColumn("sample_before", F.when(C("most").isNotNull(), F.coalesce("sample_before", F.lit(-1))))


@query("SELECT user_id, time_bucket(INTERVAL 6 HOUR, ts) AS start, time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 6 HOUR AS \"end\", count(*) AS n FROM events GROUP BY 1, 2, 3")
def str_15_closed_chunks(spark, d):
    """Counts in windows of six hours, each put out once the watermark has passed it, over several batches."""
    return drained(spark, stateful.stream_chunks(in_batches(spark, d), "user_id", "ts", "6 hours"), "append").where("user_id >= 0")


SAMPLES = """
judged AS (SELECT c.slot, c.row_id, c.sec, c.present, list_filter([CASE WHEN c.yaw IS NULL THEN 'missing_viewangles' END, CASE WHEN NOT c.alive THEN 'not_alive' END,
  CASE WHEN s.paused THEN 'paused' WHEN s.paused IS NULL THEN 'pause_unknown' END], lambda x: x IS NOT NULL) AS own FROM cmd c JOIN st s ON s.slot = c.slot AND s.tick = c.tick),
sampled AS (SELECT slot, row_id, list_sort(list_distinct(list_concat(flatten(list(own) OVER (PARTITION BY slot ORDER BY sec, row_id ROWS BETWEEN 3 PRECEDING AND 1 FOLLOWING)),
  list_filter([CASE WHEN count(*) OVER (PARTITION BY slot ORDER BY sec, row_id ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) < 4 THEN 'insufficient_history' END,
    CASE WHEN count(*) OVER (PARTITION BY slot ORDER BY sec, row_id ROWS BETWEEN 1 FOLLOWING AND 1 FOLLOWING) < 1 THEN 'insufficient_future' END,
    CASE WHEN present IS NULL THEN 'proof_unknown' WHEN NOT present THEN 'proof_rejected' END], lambda x: x IS NOT NULL)))) AS codes FROM judged)"""


def _samples(spark, d) -> DataFrame:
    """Commands as samples: quality by view angles, life and the pauses of their states, proof by presence."""
    paused = states(spark, d).select("slot", "tick", "paused")
    rows = commands(spark, d).select("slot", "row_id", "sec", "tick", "yaw", "alive", "present").join(paused, ["slot", "tick"])
    pause = F.when(C("paused"), F.lit("paused")).when(C("paused").isNull(), F.lit("pause_unknown"))
    quality = F.array_compact(F.array(F.when(C("yaw").isNull(), F.lit("missing_viewangles")), F.when(~C("alive"), F.lit("not_alive")), pause))
    return samples.accept_samples(rows, ["slot"], ["sec", "row_id"], "row_id", quality, C("present"), 4, 1)


@query("SELECT slot, row_id, array_to_string(codes, ',') AS reasons, len(codes) = 0 AS training_ready, NOT list_has_any(codes, ['insufficient_history', 'insufficient_future']) AS window_complete FROM sampled", STATE, SAMPLES)
def dom_17_samples(spark, d):
    """Each command as a sample, and all that is against it: its window, its rows, their states and its proof."""
    return _samples(spark, d).select("slot", "row_id", F.array_join("reason_codes", ",").alias("reasons"), "training_ready", "window_complete")


@query(
    """SELECT slot, count(*) AS candidates, count(*) FILTER (NOT list_has_any(codes, ['insufficient_history', 'insufficient_future'])) AS complete, count(*) FILTER (len(codes) = 0) AS accepted, count(*) FILTER (len(codes) > 0) AS rejected, any_value(reasons) AS reasons
      FROM sampled JOIN (SELECT slot, '{' || string_agg('"' || code || '":' || n, ',' ORDER BY code) || '}' AS reasons FROM (SELECT slot, code, count(*) AS n FROM (SELECT slot, unnest(codes) AS code FROM sampled) GROUP BY slot, code) GROUP BY slot) USING (slot) GROUP BY slot""",
    STATE,
    SAMPLES,
)
def dom_17_report(spark, d):
    """How many samples of each slot are complete, accepted and rejected, and why."""
    return samples.acceptance_report(_samples(spark, d), ["slot"])
