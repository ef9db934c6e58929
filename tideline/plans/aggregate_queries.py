"""Profiles, statistics, evidence, coverage."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tideline.functions.bits import decode, verdict
from tideline.operators import aggregates
from tideline.plans.registry import query
from tideline.plans.views import CMD, FRAMES, ROUNDS, STATE, commands, frames, rounds, states

C = F.col


@query("SELECT user_id, count(*) AS n, count(*) FILTER (alive) AS n_alive, count(*) FILTER (yaw IS NULL) AS n_no_yaw, count(*) FILTER (dx <> 0) AS n_moved, count(DISTINCT round_id) AS rounds, min(tick) AS first_tick, max(tick) AS last_tick, arg_min(kind, row_id) AS first_kind, arg_max(kind, row_id) AS last_kind, min(cents) AS lo, max(cents) AS hi, CAST(sum(cents) AS BIGINT) AS total FROM cmd GROUP BY user_id", CMD)
def agg_1_player_profile(spark, d):
    return commands(spark, d).groupBy("user_id").agg(
        F.count("*").alias("n"), F.count_if("alive").alias("n_alive"), F.count_if(C("yaw").isNull()).alias("n_no_yaw"), F.count_if(C("dx") != 0).alias("n_moved"),
        F.countDistinct("round_id").alias("rounds"), F.min("tick").alias("first_tick"), F.max("tick").alias("last_tick"), F.min_by("kind", "row_id").alias("first_kind"),
        F.max_by("kind", "row_id").alias("last_kind"), F.min("cents").alias("lo"), F.max("cents").alias("hi"), F.sum("cents").alias("total"),
    )


@query("SELECT slot, 100.0 * count(*) FILTER (alive) / count(*) AS alive_share, CASE WHEN count(*) FILTER (dx > 60) > 0 THEN 100.0 * count(*) FILTER (dx > 60 AND alive) / count(*) FILTER (dx > 60) END AS fast_share FROM cmd GROUP BY slot", CMD)
def agg_2_shares(spark, d):
    g = commands(spark, d).groupBy("slot").agg(F.count("*").alias("n"), F.count_if("alive").alias("a"), F.count_if(C("dx") > 60).alias("f"), F.count_if((C("dx") > 60) & C("alive")).alias("fa"))
    return g.select("slot", aggregates.share(C("a"), C("n")).alias("alive_share"), aggregates.share(C("fa"), C("f")).alias("fast_share"))


@query("SELECT user_id, round(coalesce(var_samp(cents), 0), 4) AS variance FROM cmd GROUP BY user_id", CMD)
def agg_3_variance(spark, d):
    return commands(spark, d).groupBy("user_id").agg(F.round(aggregates.sample_variance("cents"), 4).alias("variance"))


@query("SELECT slot, CAST(coalesce(sum(step), 0) AS BIGINT) AS observed FROM (SELECT slot, CASE WHEN alive AND lag(alive) OVER w AND sec - lag(sec) OVER w BETWEEN 1 AND 600 THEN sec - lag(sec) OVER w END AS step FROM cmd WINDOW w AS (PARTITION BY slot ORDER BY row_id)) GROUP BY slot", CMD)
def agg_4_observed_seconds(spark, d):
    return aggregates.observed_seconds(commands(spark, d), ["slot"], "row_id", "sec", C("alive"), most=600)


@query("SELECT slot, count(*) AS rows, count(*) FILTER (yaw IS NULL) AS rejected, count(*) FILTER (yaw IS NOT NULL) AS kept, count(*) - count(*) FILTER (yaw IS NULL) - count(*) FILTER (yaw IS NOT NULL) AS unaccounted FROM cmd GROUP BY slot", CMD)
def agg_5_accounting(spark, d):
    g = commands(spark, d).groupBy("slot").agg(F.count("*").alias("rows"), F.count_if(C("yaw").isNull()).alias("rejected"), F.count_if(C("yaw").isNotNull()).alias("kept"))
    return g.withColumn("unaccounted", C("rows") - C("rejected") - C("kept"))


@query("SELECT CAST(client_tick - tick AS VARCHAR) AS value, count(*) AS n FROM cmd GROUP BY 1", CMD)
def agg_6_histogram(spark, d):
    return aggregates.histogram(commands(spark, d), C("client_tick") - C("tick"))


@query("SELECT slot, m AS median, median(abs(cents - m)) AS mad, count(*) AS n FROM (SELECT slot, cents, median(cents) OVER (PARTITION BY slot) AS m FROM cmd) GROUP BY slot, m", CMD)
def agg_7_median_mad(spark, d):
    return aggregates.median_and_mad(commands(spark, d), ["slot"], "cents")


@query("SELECT user_id, median(cents / dx) AS ratio, count(*) AS n FROM cmd WHERE abs(dx) > 10 AND yaw IS NOT NULL GROUP BY user_id", CMD)
def agg_8_guarded_ratio(spark, d):
    return commands(spark, d).where((F.abs("dx") > 10) & C("yaw").isNotNull()).groupBy("user_id").agg(F.median(C("cents") / C("dx")).alias("ratio"), F.count("*").alias("n"))


@query("SELECT slot, count(*) AS n, count(*) FILTER (present) AS passed, count(*) FILTER (NOT present) AS failed, CASE WHEN count(*) FILTER (NOT present) > 0 THEN 'failed' WHEN count(*) FILTER (present) = count(*) THEN 'passed' ELSE 'unknown' END AS status FROM cmd WHERE k > 80 + slot GROUP BY slot", CMD)
def agg_9_evidence(spark, d):
    g = commands(spark, d).where(C("k") > 80 + C("slot")).groupBy("slot").agg(F.count("*").alias("n"), F.count_if("present").alias("passed"), F.count_if(~C("present")).alias("failed"))
    return g.withColumn("status", verdict(C("n"), C("failed"), C("passed")))


@query("SELECT r.round_id, r.start, r.e AS \"end\", count(c.tick) AS n, count(DISTINCT c.tick) AS ticks, min(c.tick) AS first, max(c.tick) AS last, CASE WHEN count(c.tick) = 0 THEN 0 ELSE greatest(coalesce(max(c.gap), 0), min(c.tick) - r.start, r.e - max(c.tick)) END AS max_gap, count(c.tick) > 0 AND greatest(coalesce(max(c.gap), 0), min(c.tick) - r.start, r.e - max(c.tick)) <= 40 AS complete, count(DISTINCT c.tick) / (r.e - r.start) AS fraction FROM (SELECT round_id, start, \"end\" AS e FROM rd WHERE \"end\" IS NOT NULL) r LEFT JOIN (SELECT x.round_id, x.tick, x.tick - lag(x.tick) OVER (PARTITION BY x.round_id ORDER BY x.tick) AS gap FROM cmd x JOIN rd y ON y.round_id = x.round_id AND x.tick < y.\"end\") c ON c.round_id = r.round_id GROUP BY r.round_id, r.start, r.e", CMD, ROUNDS)
def agg_10_window_coverage(spark, d):
    w = rounds(spark, d).where("end is not null").select("round_id", "start", "end")
    return aggregates.window_coverage(w, commands(spark, d), ["round_id"], "tick", 40)


@query("SELECT reason, count(*) AS n FROM (SELECT unnest(list_filter([CASE WHEN yaw IS NULL THEN 'no_yaw' END, CASE WHEN NOT alive THEN 'dead' END, CASE WHEN dx IS NULL THEN 'no_mouse' END], lambda x: x IS NOT NULL)) AS reason FROM cmd) GROUP BY reason", CMD)
def agg_11_reason_histogram(spark, d):
    reasons = F.array_compact(F.array(F.when(C("yaw").isNull(), "no_yaw"), F.when(~C("alive"), "dead"), F.when(C("dx").isNull(), "no_mouse")))
    return aggregates.exploded_counts(commands(spark, d).withColumn("reasons", reasons), "reasons", "reason")


@query("SELECT slot, kind, count(*) AS n, count(DISTINCT user_id) AS users, count(DISTINCT (user_id, round_id)) AS pairs FROM cmd GROUP BY GROUPING SETS ((slot, kind), (kind), ())", CMD)
def agg_12_roll_up(spark, d):
    commands(spark, d).createOrReplaceTempView("tideline_commands")
    return spark.sql("SELECT slot, kind, count(*) AS n, count(DISTINCT user_id) AS users, count(DISTINCT user_id, round_id) AS pairs FROM tideline_commands GROUP BY GROUPING SETS ((slot, kind), (kind), ())")


@query(" UNION ALL ".join(f"SELECT '{name}' AS button, '{f}' AS field, count(*) FILTER (v) AS n_true, count(*) FILTER (NOT v) AS n_false, count(*) FILTER (v IS NULL) AS n_unknown FROM (SELECT CASE WHEN present IS NOT NULL THEN {e} END AS v FROM cmd)" for name, m in (("attack", 1), ("jump", 2), ("use", 32)) for f, e in (("held", f"(p1 & {m}) <> 0"), ("pressed", f"(p1 & {m}) <> 0 AND (p2 & {m}) <> 0"))), CMD)
def agg_13_label_coverage(spark, d):
    cells = []
    for name, m in (("attack", 1), ("jump", 2), ("use", 32)):
        got = decode(C("p1"), C("p2"), C("p3"), m)
        cells += [F.struct(F.lit(name).alias("button"), F.lit(f).alias("field"), F.when(C("present").isNotNull(), got[k]).alias("v")) for f, k in (("held", "held_end"), ("pressed", "pressed"))]
    x = commands(spark, d).select(F.explode(F.array(*cells)).alias("x")).select("x.*")
    return x.groupBy("button", "field").agg(F.count_if("v").alias("n_true"), F.count_if(~C("v")).alias("n_false"), F.count_if(C("v").isNull()).alias("n_unknown"))


@query("SELECT kind, min(cents) AS lo, median(cents) AS mid, max(cents) AS hi, quantile_disc(cents, 0.95) AS p95 FROM cmd GROUP BY kind", CMD)
def agg_15_nearest_rank(spark, d):
    return commands(spark, d).groupBy("kind").agg(F.min("cents").alias("lo"), F.median("cents").alias("mid"), F.max("cents").alias("hi"), aggregates.nearest_rank("cents", 0.95).cast("long").alias("p95"))


@query("SELECT user_id, string_agg(DISTINCT kind, ' / ' ORDER BY kind) AS names FROM cmd GROUP BY user_id", CMD)
def agg_16_roster(spark, d):
    return commands(spark, d).select("user_id", "kind").distinct().groupBy("user_id").agg(F.array_join(F.array_sort(F.collect_list("kind")), " / ").alias("names"))


@query("SELECT reason, sum(e - s) / 64.0 AS seconds FROM (SELECT tick AS s, tick + 1 + k AS e, CASE WHEN yaw IS NULL THEN 'no_yaw' ELSE kind END AS reason FROM cmd) GROUP BY reason", CMD)
def agg_17_exclusion_seconds(spark, d):
    reason = F.when(C("yaw").isNull(), "no_yaw").otherwise(C("kind"))
    return commands(spark, d).groupBy(reason.alias("reason")).agg((F.sum(C("k") + 1) / 64.0).alias("seconds"))


@query("SELECT round_id, status, count(*) AS n, CAST(sum(k) AS BIGINT) AS planned, CAST(coalesce(sum(CASE WHEN status = 'done' THEN k END), 0) AS BIGINT) AS captured FROM (SELECT *, CASE WHEN alive THEN 'done' ELSE 'open' END AS status FROM cmd) GROUP BY ROLLUP (round_id, status)", CMD)
def agg_18_round_roll_up(spark, d):
    rows = commands(spark, d).withColumn("status", F.when(C("alive"), "done").otherwise("open"))
    return rows.rollup("round_id", "status").agg(F.count("*").alias("n"), F.sum("k").alias("planned"), F.coalesce(F.sum(F.when(C("status") == "done", C("k"))), F.lit(0)).alias("captured"))


@query("SELECT kind, count(*) AS before, count(*) FILTER (present) AS after FROM cmd GROUP BY kind", CMD)
def agg_20_before_after(spark, d):
    return commands(spark, d).groupBy("kind").agg(F.count("*").alias("before"), F.count_if("present").alias("after"))


@query("SELECT slot, count(*) FILTER (moving AND NOT pm) AS starts, count(*) FILTER (NOT moving AND pm) AS stops, count(*) FILTER (health < ph) AS drops FROM (SELECT *, lag(moving) OVER w AS pm, lag(health) OVER w AS ph FROM st WINDOW w AS (PARTITION BY slot ORDER BY tick)) GROUP BY slot", STATE)
def agg_21_state_counters(spark, d):
    w = Window.partitionBy("slot").orderBy("tick")
    s = states(spark, d).withColumns({"pm": F.lag("moving").over(w), "ph": F.lag("health").over(w)})
    return s.groupBy("slot").agg(F.count_if(C("moving") & ~C("pm")).alias("starts"), F.count_if(~C("moving") & C("pm")).alias("stops"), F.count_if(C("health") < C("ph")).alias("drops"))


@query(" UNION ALL ".join(f"SELECT '{h}' AS hypothesis, count(*) AS tested, count(*) FILTER ({e}) AS matches, count(*) FILTER (NOT ({e})) AS mismatches FROM cmd WHERE dx IS NOT NULL" for h, e in (("zero", "dx = 0"), ("sign", "dx > 0"), ("even", "dx % 2 = 0"))), CMD)
def agg_22_hypotheses(spark, d):
    rows = commands(spark, d).where("dx IS NOT NULL").select((C("dx") == 0).alias("zero"), (C("dx") > 0).alias("sign"), (C("dx") % 2 == 0).alias("even"))
    x = rows.select(F.expr("stack(3, 'zero', zero, 'sign', sign, 'even', even) AS (hypothesis, ok)"))
    return x.groupBy("hypothesis").agg(F.count("*").alias("tested"), F.count_if("ok").alias("matches"), F.count_if(~C("ok")).alias("mismatches"))


@query("SELECT slot, round((t1 * s22 - t2 * s12) / (s11 * s22 - s12 * s12), 6) AS b1, round((t2 * s11 - t1 * s12) / (s11 * s22 - s12 * s12), 6) AS b2 FROM (SELECT slot, sum(a * a) AS s11, sum(a * b) AS s12, sum(b * b) AS s22, sum(a * y) AS t1, sum(b * y) AS t2 FROM (SELECT slot, dx::DOUBLE AS a, (k % 7)::DOUBLE AS b, cents::DOUBLE AS y FROM cmd WHERE dx IS NOT NULL) GROUP BY slot)", CMD)
def agg_23_least_squares(spark, d):
    rows = commands(spark, d).where("dx IS NOT NULL").select("slot", C("dx").cast("double").alias("a"), (C("k") % 7).cast("double").alias("b"), C("cents").cast("double").alias("y"))
    return aggregates.least_squares_2x2(rows, ["slot"], ("a", "b"), "y").select("slot", F.round("b1", 6).alias("b1"), F.round("b2", 6).alias("b2"))


@query("SELECT round_id, n_offsets, CASE WHEN n_offsets = 1 OR greatest(hi - mid, mid - lo) <= 2 THEN mid END AS \"offset\", greatest(hi - mid, mid - lo) AS residual FROM (SELECT round_id, count(DISTINCT o) AS n_offsets, median(o) AS mid, min(o) AS lo, max(o) AS hi FROM (SELECT round_id, client_tick - tick AS o FROM cmd) GROUP BY round_id)", CMD)
def agg_24_offset_fit(spark, d):
    return aggregates.offset_fit(commands(spark, d).withColumn("o", C("client_tick") - C("tick")), ["round_id"], "o", 2.0)


@query("SELECT CAST((p1 & 4) <> 0 AS INT) + 2 * CAST((p2 & 4) <> 0 AS INT) + 4 * CAST((p3 & 4) <> 0 AS INT) AS code, count(*) AS n FROM cmd GROUP BY 1", CMD)
def agg_26_state_codes(spark, d):
    return commands(spark, d).groupBy(decode(C("p1"), C("p2"), C("p3"), 4)["code"].alias("code")).agg(F.count("*").alias("n"))


@query("SELECT slot, median(((yaw - y0 + 180.0) % 360.0 + 360.0) % 360.0 - 180.0 + y0) AS plateau FROM (SELECT slot, yaw, first_value(yaw) OVER (PARTITION BY slot ORDER BY row_id) AS y0 FROM cmd WHERE yaw IS NOT NULL) GROUP BY slot", CMD)
def agg_29_circular_plateau(spark, d):
    from tideline.functions.angles import wrap_degrees

    w = Window.partitionBy("slot").orderBy("row_id")
    rows = commands(spark, d).where("yaw IS NOT NULL").withColumn("y0", F.first("yaw").over(w))
    return rows.groupBy("slot").agg(F.median(wrap_degrees(C("yaw") - C("y0")) + C("y0")).alias("plateau"))


@query("SELECT max(n) AS most, count(*) FILTER (n = 0) AS empty FROM (SELECT frame_index, count(row_id) AS n FROM fr LEFT JOIN cmd ON tick >= start AND tick < \"end\" GROUP BY frame_index)", CMD, FRAMES)
def agg_30_frame_fill(spark, d):
    from tideline.operators.joins import interval_join

    n = interval_join(commands(spark, d), frames(spark, d), "tick", width=32).groupBy("frame_index").agg(F.count("*").alias("n"))
    return frames(spark, d).join(n, "frame_index", "left").agg(F.max("n").alias("most"), F.count_if(C("n").isNull()).alias("empty"))


@query("SELECT slot, count(*) AS n, count(DISTINCT sha256(CAST(cents AS VARCHAR))) AS distinct_images, count(*) - count(DISTINCT cents) AS repeats FROM cmd GROUP BY slot", CMD)
def agg_32_distinct_images(spark, d):
    return commands(spark, d).groupBy("slot").agg(F.count("*").alias("n"), F.countDistinct(F.sha2(C("cents").cast("string"), 256)).alias("distinct_images"), (F.count("*") - F.countDistinct("cents")).alias("repeats"))


@query("SELECT delta, count(*) AS n, min(row_id) AS first, max(row_id) AS last FROM (SELECT row_id, tick - lag(tick) OVER (PARTITION BY slot ORDER BY row_id) AS delta FROM cmd) WHERE delta IS NOT NULL GROUP BY delta", CMD)
def agg_33_tick_deltas(spark, d):
    step = C("tick") - F.lag("tick").over(Window.partitionBy("slot").orderBy("row_id"))
    return commands(spark, d).select("row_id", step.alias("delta")).where("delta IS NOT NULL").groupBy("delta").agg(F.count("*").alias("n"), F.min("row_id").alias("first"), F.max("row_id").alias("last"))


@query("SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_price, round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2")
def agg_priced_summary(spark, d):
    li = spark.read.parquet(f"{d}/lineitem.parquet").where(C("l_shipdate") <= F.expr("timestamp_ntz'1998-09-02 00:00:00'"))
    return li.groupBy("l_returnflag", "l_linestatus").agg(F.sum(C("l_quantity").cast("long")).alias("sum_qty"), F.round(F.sum("l_extendedprice"), 2).alias("sum_price"), F.round(F.sum(C("l_extendedprice") * (1 - C("l_discount"))), 2).alias("sum_disc"), F.count("*").alias("n"))
