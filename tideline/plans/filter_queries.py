"""Predicates and projections."""

from pyspark.sql import functions as F

from tideline.functions.angles import bad_fraction, finite
from tideline.functions.names import clean_name, is_sha256, numeric_identity, parse_windows, player_key, short_id, split_of
from tideline.operators import filters
from tideline.plans.registry import query
from tideline.plans.views import CMD, ROUNDS, STATE, commands, rounds, states

C = F.col


@query("SELECT row_id, tick, slot FROM cmd WHERE round_id = 3 AND user_id = 42 AND slot = 2", CMD)
def flt_1_identity_filter(spark, d):
    return commands(spark, d).where((C("round_id") == 3) & (C("user_id") == 42) & (C("slot") == 2)).select("row_id", "tick", "slot")


@query("SELECT a.row_id, (a.p1 IS NOT DISTINCT FROM a.p2 AND a.dx IS NOT DISTINCT FROM a.k) AS same FROM cmd a", CMD)
def flt_2_same_identity(spark, d):
    return commands(spark, d).select("row_id", filters.same_identity({"p": C("p1"), "k": C("dx")}, {"p": C("p2"), "k": C("k")}).alias("same"))


@query("SELECT row_id, coalesce(dx = k - 50, false) AS same FROM cmd", CMD)
def flt_3_strict_identity(spark, d):
    return commands(spark, d).select("row_id", filters.same_identity({"k": C("dx")}, {"k": C("k") - 50}, null_equal=False).alias("same"))


@query("SELECT row_id, tick FROM cmd WHERE tick >= 1000 AND tick < 2000", CMD)
def flt_4_half_open(spark, d):
    return commands(spark, d).where(filters.half_open(C("tick"), 1000, 2000)).select("row_id", "tick")


@query("SELECT row_id, client_tick FROM cmd WHERE client_tick > 1000 AND client_tick <= 2000", CMD)
def flt_5_left_open(spark, d):
    return commands(spark, d).where(filters.left_open(C("client_tick"), 1000, 2000)).select("row_id", "client_tick")


@query("SELECT row_id, tick FROM cmd WHERE row_id IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')", CMD)
def flt_6_members(spark, d):
    ids = spark.read.parquet(f"{d}/orders.parquet").where("o_orderstatus = 'F'").select(C("o_orderkey").alias("row_id"))
    return filters.members(commands(spark, d), ids, "row_id").select("row_id", "tick")


@query("SELECT row_id FROM cmd WHERE alive AND NOT coalesce(present, false)", CMD)
def flt_7_live_commands(spark, d):
    return commands(spark, d).where(filters.live(C("alive"), C("present"))).select("row_id")


@query("SELECT slot, tick FROM st WHERE alive AND NOT coalesce(paused, false)", STATE)
def flt_8_live_states(spark, d):
    return states(spark, d).where(filters.live(C("alive"), C("paused"))).select("slot", "tick")


@query("SELECT slot, tick FROM st JOIN rd USING (round_id) WHERE alive AND paused = false AND tick >= greatest(199, freeze_end) AND tick < rd.\"end\" AND user_id > 0", STATE, ROUNDS)
def flt_9_strict_schedule(spark, d):
    r = rounds(spark, d)
    return states(spark, d).join(r, "round_id").where(C("alive") & filters.known_false(C("paused")) & (C("tick") >= F.greatest(F.lit(199), C("freeze_end"))) & (C("tick") < C("end")) & (C("user_id") > 0)).select("slot", "tick")


@query("SELECT slot, tick FROM st WHERE NOT coalesce(paused, false) AND NOT coalesce(moving, false)", STATE)
def flt_10_lenient(spark, d):
    return states(spark, d).where(filters.not_known_true(C("paused"), C("moving"))).select("slot", "tick")


@query("SELECT row_id, yaw IS NOT NULL AS ok, k % 5 <> 0 AS ok_ratio FROM cmd", CMD)
def flt_11_finite(spark, d):
    ratio = F.when(C("k") % 5 != 0, C("cents") / 2.0).otherwise(F.lit(float("nan")))
    return commands(spark, d).select("row_id", finite(C("yaw")).alias("ok"), finite(ratio).alias("ok_ratio"))


@query("SELECT row_id, coalesce(f < 0 OR f > 1, false) AS bad FROM (SELECT row_id, dx / 40.0 AS f FROM cmd)", CMD)
def flt_12_bad_fraction(spark, d):
    return commands(spark, d).select("row_id", bad_fraction(C("dx") / 40.0).alias("bad"))


@query("SELECT row_id, yaw IS NOT NULL AND dx IS NOT NULL AS ok FROM cmd", CMD)
def flt_13_all_finite(spark, d):
    every = F.array(C("yaw"), C("pitch"), C("dx").cast("double"))
    return commands(spark, d).select("row_id", F.forall(every, finite).alias("ok"))


@query("SELECT row_id, CASE WHEN t ~ '^[0-9]+$' AND CAST(t AS HUGEINT) BETWEEN 1 AND 18446744073709551615 THEN t END AS id FROM (SELECT row_id, CASE WHEN k % 4 = 0 THEN 'x' || k WHEN k % 4 = 1 THEN '0' ELSE CAST(76561197960265728 + user_id AS VARCHAR) END AS t FROM cmd)", CMD)
def flt_15_numeric_identity(spark, d):
    text = F.when(C("k") % 4 == 0, F.concat(F.lit("x"), C("k"))).when(C("k") % 4 == 1, F.lit("0")).otherwise((F.lit(76561197960265728) + C("user_id")).cast("string"))
    return commands(spark, d).select("row_id", numeric_identity(text).cast("string").alias("id"))


@query("SELECT row_id, tick FROM cmd WHERE EXISTS (SELECT 1 FROM rd WHERE \"end\" IS NOT NULL AND tick >= freeze_end - 16 AND tick < \"end\" + 16)", CMD, ROUNDS)
def flt_16_window_margin(spark, d):
    w = rounds(spark, d).where("end is not null").select(C("freeze_end").alias("start"), "end")
    return filters.in_any_window(commands(spark, d), w, "tick", margin=16).select("row_id", "tick")


@query("SELECT slot, round_id, count(*) AS n FROM cmd WHERE alive GROUP BY 1, 2 HAVING count(*) >= 20 ORDER BY n DESC, round_id, slot LIMIT 25", CMD)
def flt_17_limited_jobs(spark, d):
    return commands(spark, d).where("alive").groupBy("slot", "round_id").agg(F.count("*").alias("n")).where("n >= 20").orderBy(F.desc("n"), "round_id", "slot").limit(25)


@query("SELECT row_id, lower(lpad(to_hex(cents), 16, '0')) AS plane, to_base64(encode(kind)) AS blob, sha256(kind) AS digest FROM cmd", CMD)
def flt_18_raw_projection(spark, d):
    return commands(spark, d).select("row_id", F.lower(F.lpad(F.hex("cents"), 16, "0")).alias("plane"), F.base64(C("kind").cast("binary")).alias("blob"), F.sha2("kind", 256).alias("digest"))


@query("SELECT CAST(row_id AS VARCHAR) AS row_id, CAST(strlen(kind) AS INTEGER) AS n_bytes FROM cmd", CMD)
def flt_19_json_safe(spark, d):
    return commands(spark, d).select(C("row_id").cast("string").alias("row_id"), F.octet_length("kind").alias("n_bytes"))


@query("SELECT row_id, user_id, tick FROM cmd", CMD)
def flt_20_selection(spark, d):
    return commands(spark, d).select("row_id", "user_id", "tick")


@query("SELECT row_id, CASE WHEN kind IN ('view', 'click') THEN CASE WHEN present IS NULL THEN 'legacy' WHEN present THEN 'match' ELSE 'marker' END ELSE 'unknown_profile' END AS status FROM cmd", CMD)
def flt_21_profile_match(spark, d):
    profiles = F.broadcast(spark.createDataFrame([("view",), ("click",)], "kind string").withColumn("known", F.lit(True)))
    status = F.when(C("known").isNull(), "unknown_profile").when(C("present").isNull(), "legacy").when(C("present"), "match").otherwise("marker")
    return commands(spark, d).join(profiles, "kind", "left").select("row_id", status.alias("status"))


@query("SELECT row_id, sha256(kind) = sha256('view') AS is_view, regexp_matches(left(sha256(kind), 63 + CAST(k % 2 AS INTEGER)), '^[0-9a-f]{64}$') AS valid FROM cmd", CMD)
def fn_s1_sha_identity(spark, d):
    digest = F.sha2("kind", 256)
    return commands(spark, d).select("row_id", (digest == F.sha2(F.lit("view"), 256)).alias("is_view"), is_sha256(F.left(digest, (63 + C("k") % 2).cast("int"))).alias("valid"))


@query("SELECT name, CAST(regexp_extract(name, '^clip-([0-9]+)-([a-z]+)$', 1) AS BIGINT) AS n FROM (SELECT 'clip-' || row_id || '-' || kind AS name FROM cmd)", CMD)
def fn_s2_name_pattern(spark, d):
    name = F.concat(F.lit("clip-"), C("row_id").cast("string"), F.lit("-"), C("kind"))
    return commands(spark, d).select(name.alias("name"), F.regexp_extract(name, "^clip-([0-9]+)-([a-z]+)$", 1).cast("long").alias("n"))


@query("SELECT row_id, CASE WHEN user_id % 3 <> 0 THEN 'steam:' || user_id ELSE 'slot:' || slot END AS player FROM cmd", CMD)
def fn_s3_player_key(spark, d):
    return commands(spark, d).select("row_id", player_key(F.when(C("user_id") % 3 != 0, C("user_id")), C("slot")).alias("player"))


@query("SELECT doc_id, substr(trim(regexp_replace(substr(text, 1, 300), '[\\t\\n\\x0B\\f\\r ]+', ' ', 'g'), ' '), 1, 100) AS name FROM documents")
def fn_s4_clean_name(spark, d):
    return spark.read.parquet(f"{d}/documents.parquet").select("doc_id", clean_name(C("text")).alias("name"))


@query("SELECT row_id, CASE WHEN k % 3 = 0 THEN NULL ELSE tick END AS a, CASE WHEN k % 3 = 0 THEN NULL ELSE 2 END AS n FROM cmd", CMD)
def fn_s5_parse_windows(spark, d):
    good = F.format_string("%d:%d,%d:%d", C("tick"), C("tick") + 5, C("tick") + 9, C("tick") + 12)
    bad = F.format_string("%d:%d,%d:%d", C("tick"), C("tick") + 5, C("tick") + 2, C("tick") + 12)
    parsed = parse_windows(F.when(C("k") % 3 == 0, bad).otherwise(good))
    return commands(spark, d).select("row_id", F.get(parsed, F.lit(0))["start"].alias("a"), F.when(parsed.isNotNull(), F.size(parsed)).alias("n"))


@query("SELECT row_id, printf('%d:%02d.%03d', cents * 10 // 60000, cents * 10 // 1000 % 60, cents * 10 % 1000) AS label FROM cmd", CMD)
def fn_s6_time_label(spark, d):
    from tideline.functions.angles import time_label

    return commands(spark, d).select("row_id", time_label(C("cents") / 100.0).alias("label"))


@query("SELECT user_id, CASE WHEN b < 8000 THEN 'train' WHEN b < 9000 THEN 'validation' ELSE 'test' END AS split FROM (SELECT user_id, list_reduce(list_prepend(0::BIGINT, list_transform(range(0, 16), lambda i: ('0x' || substr(sha256('seed-1:' || user_id), i * 4 + 1, 4))::BIGINT)), lambda a, x: (a * 65536 + x) % 10000) AS b FROM (SELECT DISTINCT user_id FROM cmd))", CMD)
def fn_h4_stable_split(spark, d):
    return commands(spark, d).select("user_id").distinct().select("user_id", split_of("seed-1", C("user_id")).alias("split"))


@query("SELECT row_id, substr(sha256(round_id || ':' || slot || ':' || tick), 1, 24) AS clip_id FROM cmd", CMD)
def fn_h5_clip_id(spark, d):
    return commands(spark, d).select("row_id", short_id(C("round_id"), C("slot"), C("tick")).alias("clip_id"))


@query("SELECT row_id, sha256('{\"kind\":\"' || kind || '\",\"slot\":' || slot || ',\"tick\":' || tick || '}' || chr(10)) AS digest FROM cmd", CMD)
def fn_h2_canonical_digest(spark, d):
    from tideline.functions.names import canonical_json

    return commands(spark, d).select("row_id", F.sha2(F.concat(canonical_json("tick", "slot", "kind"), F.lit("\n")), 256).alias("digest"))
