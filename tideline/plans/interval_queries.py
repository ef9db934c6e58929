"""Interval algebra, selection order, audits."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tideline.operators import audits, digests, intervals, selection, windows
from tideline.plans.registry import query
from tideline.plans.views import CMD, ROUNDS, STATE, commands, rounds, states
from tideline.sources.scratch import new_folder

C = F.col
SPANS = ", sp AS (SELECT row_id, slot, tick AS start, tick + 1 + k % 20 AS \"end\" FROM cmd)"
UNION_SQL = "un AS (SELECT slot, min(start) AS start, max(\"end\") AS \"end\", count(*) AS n FROM (SELECT *, sum(s) OVER (PARTITION BY slot ORDER BY start, \"end\") AS g FROM (SELECT *, CASE WHEN start <= max(\"end\") OVER (PARTITION BY slot ORDER BY start, \"end\" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS s FROM sp)) GROUP BY slot, g)"


def spans(spark, d):
    return commands(spark, d).select("row_id", "slot", C("tick").alias("start"), (C("tick") + 1 + C("k") % 20).alias("end"))


def union(spark, d):
    return windows.running_segments(spans(spark, d), ["slot"], "start", "end")


@query("SELECT * FROM un", CMD + SPANS, UNION_SQL)
def set_1_interval_union(spark, d):
    return union(spark, d)


@query("SELECT slot, a AS start, b AS \"end\" FROM (SELECT slot, \"end\" AS a, lead(start) OVER (PARTITION BY slot ORDER BY start, \"end\") AS b FROM (SELECT slot, start, \"end\" FROM un UNION ALL SELECT DISTINCT slot, 0, 0 FROM un UNION ALL SELECT DISTINCT slot, (SELECT max(\"end\") + 1 FROM un), (SELECT max(\"end\") + 1 FROM un) FROM un)) WHERE b > a", CMD + SPANS, UNION_SQL)
def set_2_complement(spark, d):
    owned = union(spark, d)
    return intervals.complement(owned, 0, owned.agg(F.max("end") + 1), ["slot"])


@query("SELECT slot, reason, min(tick) AS start, max(tick) + 1 AS \"end\" FROM (SELECT *, sum(s) OVER (PARTITION BY slot ORDER BY tick) AS g FROM (SELECT *, CASE WHEN lag(tick) OVER w = tick - 1 AND lag(reason) OVER w IS NOT DISTINCT FROM reason THEN 0 ELSE 1 END AS s FROM (SELECT slot, tick, CASE WHEN tick < freeze_end THEN 'freeze' WHEN paused THEN 'paused' WHEN NOT alive THEN 'not_alive' WHEN tick >= rd.\"end\" THEN 'after_round' END AS reason FROM st JOIN rd USING (round_id)) WINDOW w AS (PARTITION BY slot ORDER BY tick))) WHERE reason IS NOT NULL GROUP BY slot, reason, g", STATE, ROUNDS)
def set_2_excluded_reasons(spark, d):
    s = states(spark, d).join(rounds(spark, d), "round_id")
    rules = [("freeze", C("tick") < C("freeze_end")), ("paused", C("paused")), ("not_alive", ~C("alive")), ("after_round", C("tick") >= C("end"))]
    return intervals.reasons_by_tick(s, ["slot"], "tick", rules).select("slot", "reason", "start", "end")


@query("SELECT row_id, greatest(start, 1000) AS start, least(\"end\", 9000) AS \"end\" FROM sp WHERE greatest(start, 1000) < least(\"end\", 9000)", CMD + SPANS)
def set_3_clipped(spark, d):
    return intervals.clip(spans(spark, d), 1000, 9000).select("row_id", "start", "end")


@query("SELECT row_id, slot, start, \"end\" FROM (SELECT *, max(\"end\") OVER (PARTITION BY slot ORDER BY start, \"end\", row_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM sp) WHERE start < m", CMD + SPANS)
def set_5_overlaps(spark, d):
    return intervals.overlapping(spans(spark, d), ["slot"], ("row_id",))


@query("SELECT count(*) AS n FROM (SELECT user_id FROM cmd WHERE kind = 'view' EXCEPT SELECT user_id FROM cmd)", CMD)
def set_6_set_equality(spark, d):
    c = commands(spark, d)
    return c.where("kind = 'view'").select("user_id").subtract(c.select("user_id")).agg(F.count("*").alias("n"))


@query("SELECT row_id, 'view' AS source FROM cmd WHERE kind = 'view' UNION ALL SELECT row_id, 'click' FROM cmd WHERE kind = 'click'", CMD)
def set_7_pool_union(spark, d):
    c = commands(spark, d)
    return c.where("kind = 'view'").select("row_id", F.lit("view").alias("source")).unionByName(c.where("kind = 'click'").select("row_id", F.lit("click").alias("source")))


@query("SELECT slot, tick, min(row_id) AS row_id FROM cmd GROUP BY slot, tick", CMD)
def set_9_first_of_key(spark, d):
    return windows.latest(commands(spark, d), ["slot", "tick"], [C("row_id")]).select("slot", "tick", "row_id")


@query("SELECT slot, \"end\" AS start, nxt AS \"end\" FROM (SELECT *, lead(start) OVER (PARTITION BY slot ORDER BY start) AS nxt FROM un) WHERE nxt > \"end\"", CMD + SPANS, UNION_SQL)
def set_10_gaps(spark, d):
    return intervals.gaps(union(spark, d), ["slot"])


SPLIT_SQL = """
, src AS (SELECT row_id, greatest(199, tick) AS s, greatest(199, tick) + (tick + k * 37 - greatest(199, tick)) // 2 * 2 AS e FROM cmd),
cuts AS (SELECT row_id, s AS cursor, s AS cap, least(e, s + 640) AS stop0, e, 0 AS piece FROM src WHERE e - s >= 32),
fix AS (SELECT row_id, cursor, cap, CASE WHEN e - stop0 > 0 AND e - stop0 < 18 THEN stop0 - (18 - (e - stop0)) ELSE stop0 END AS stop, e, piece FROM cuts
  UNION ALL SELECT row_id, cursor, cap, CASE WHEN e - stop0 > 0 AND e - stop0 < 18 THEN stop0 - (18 - (e - stop0)) ELSE stop0 END, e, piece
  FROM (SELECT row_id, stop AS cursor, stop - 14 AS cap, least(e, stop - 14 + 640) AS stop0, e, piece + 1 AS piece FROM fix WHERE stop < e))"""


@query("SELECT row_id, piece, cursor AS owned_start, stop AS owned_end, cap AS capture_start FROM fix", "RECURSIVE " + CMD.strip() + SPLIT_SQL)
def win_8_split_windows(spark, d):
    rows = commands(spark, d).select("row_id", C("tick").alias("start"), (C("tick") + C("k") * 37).alias("end"))
    return intervals.split(rows, 640, 14, 32, floor=199).select("row_id", "piece", "owned_start", "owned_end", "capture_start")


@query("SELECT row_id, rank FROM (SELECT row_id, row_number() OVER (ORDER BY round_id, tick, slot, row_id) AS rank FROM cmd) WHERE rank <= 50", CMD)
def ord_2_first_jobs(spark, d):
    top = commands(spark, d).orderBy("round_id", "tick", "slot", "row_id").limit(50)
    return top.withColumn("rank", F.row_number().over(Window.orderBy("round_id", "tick", "slot", "row_id"))).select("row_id", C("rank").cast("long").alias("rank"))


@query("SELECT slot, start, \"end\" FROM un ORDER BY \"end\" - start DESC, start, slot LIMIT 10", CMD + SPANS, UNION_SQL)
def ord_3_largest(spark, d):
    return union(spark, d).orderBy(F.desc(C("end") - C("start")), "start", "slot").limit(10).select("slot", "start", "end")


@query("SELECT round_id, user_id, row_id, row_number() OVER (PARTITION BY round_id, user_id ORDER BY sha256(CAST(row_id AS VARCHAR))) AS turn FROM cmd", CMD)
def ord_5_round_robin(spark, d):
    return selection.round_robin(commands(spark, d), ["round_id", "user_id"], "row_id").select("round_id", "user_id", "row_id", C("turn").cast("long").alias("turn"))


@query("SELECT kind, row_id FROM (SELECT kind, row_id, row_number() OVER (PARTITION BY kind ORDER BY sha256(CAST(row_id AS VARCHAR))) AS turn FROM cmd) ORDER BY turn, kind LIMIT 100", CMD)
def ord_6_across_sources(spark, d):
    """A hundred picks: no kind gives more, so no partition sends more of one."""
    return selection.dealt_turns(commands(spark, d).select("kind", "row_id"), ["kind"], "row_id", 100).select("kind", "row_id")


@query("SELECT slot, tick, count(*) AS n FROM cmd GROUP BY slot, tick HAVING count(*) > 1", CMD)
def aud_1_repeated_keys(spark, d):
    return audits.repeated_keys(commands(spark, d), ["slot", "tick"])


@query("SELECT user_id, count(*) FILTER (tick <= p) AS violations FROM (SELECT user_id, tick, lag(tick) OVER (PARTITION BY user_id ORDER BY row_id) AS p FROM cmd) GROUP BY user_id", CMD)
def aud_2_not_rising(spark, d):
    return audits.not_rising(commands(spark, d), ["user_id"], "row_id", "tick")


@query("SELECT l_orderkey, count(*) AS n, min(l_linenumber) = 0 AND max(l_linenumber) = count(*) - 1 AND count(DISTINCT l_linenumber) = count(*) AS contiguous FROM (SELECT l_orderkey, l_linenumber - 1 AS l_linenumber FROM lineitem) GROUP BY l_orderkey")
def aud_3_contiguous(spark, d):
    li = spark.read.parquet(f"{d}/lineitem.parquet").select("l_orderkey", (C("l_linenumber") - 1).alias("l_linenumber"))
    return audits.contiguous_index(li, ["l_orderkey"], "l_linenumber")


@query("SELECT slot, row_id, number, previous FROM (SELECT *, lag(number) OVER (PARTITION BY slot ORDER BY row_id) AS previous FROM cmd) WHERE previous IS NOT NULL AND number <> previous + 1", CMD)
def aud_4_sequence_gaps(spark, d):
    return audits.sequence_gaps(commands(spark, d), ["slot"], "row_id", "number").select("slot", "row_id", "number", "previous")


@query("SELECT row_id, kind FROM cmd WHERE kind <> 'view'", CMD)
def aud_6_constancy(spark, d):
    return audits.different_from(commands(spark, d), "kind", "view").select("row_id", "kind")


@query(
    """SELECT user_id, CASE WHEN m IS NULL THEN 'missing' ELSE 'changed' END AS status FROM (SELECT user_id, count(*) AS n, sum(cents) AS x FROM cmd GROUP BY user_id) p
      LEFT JOIN (SELECT user_id, count(*) AS m, sum(cents) AS y FROM cmd WHERE NOT (kind = 'error' AND k = 7) AND user_id % 97 <> 5 GROUP BY user_id) r USING (user_id) WHERE m IS DISTINCT FROM n OR y IS DISTINCT FROM x""",
    CMD,
)
def aud_8_recompute(spark, d):
    """A published table of users computed anew from commands of which some are gone; the digests lead to who differs."""
    path, columns = new_folder(spark), ["n", "x"]
    profile = lambda rows: rows.groupBy("user_id").agg(F.count("*").alias("n"), F.sum("cents").alias("x"))
    c = commands(spark, d)
    digests.publish_with_digests(profile(c), path, "user_id", columns, 16)
    anew = profile(c.where("not (kind = 'error' and k = 7) and user_id % 97 != 5"))
    return digests.compare_with_published(spark, anew, path, "user_id", columns, 16).rows


@query("SELECT slot, c AS \"check\", n, p AS passed, f AS failed, CASE WHEN f > 0 THEN 'failed' WHEN p = n THEN 'passed' ELSE 'unknown' END AS status FROM (SELECT slot, 'alive' AS c, count(*) AS n, count(*) FILTER (alive) AS p, count(*) FILTER (NOT alive) AS f FROM cmd GROUP BY slot UNION ALL SELECT slot, 'present', count(*), count(*) FILTER (present), count(*) FILTER (NOT present) FROM cmd GROUP BY slot UNION ALL SELECT slot, 'tick', count(*), count(*) FILTER (tick >= 0), count(*) FILTER (tick < 0) FROM cmd GROUP BY slot)", CMD)
def dom_47_checks(spark, d):
    return audits.checks(commands(spark, d), ["slot"], {"alive": C("alive"), "present": C("present"), "tick": C("tick") >= 0})
