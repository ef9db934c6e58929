"""Angles, planes and masks."""

from pyspark.sql import functions as F

from tideline.functions import angles, bits
from tideline.plans.registry import query
from tideline.plans.views import CMD, WRAP, commands

C = F.col


@query(f"SELECT row_id, {WRAP.format(d='coalesce(yaw, 0) - 3 * pitch')} AS turn FROM cmd", CMD)
def fn_m1_wrap(spark, d):
    return commands(spark, d).select("row_id", angles.wrap_degrees(F.coalesce("yaw", F.lit(0)) - 3 * C("pitch")).alias("turn"))


@query("SELECT row_id, CASE WHEN dx IS NULL AND present THEN 0 ELSE dx END AS dx FROM cmd", CMD)
def fn_m2_presence_default(spark, d):
    return commands(spark, d).select("row_id", angles.default_when_present(C("dx"), C("present")).alias("dx"))


@query("SELECT row_id, sqrt(k * k + cents * cents) AS flat, sqrt(k * k + cents * cents + slot * slot) AS solid FROM cmd", CMD)
def fn_m3_norm(spark, d):
    return commands(spark, d).select("row_id", angles.norm(C("k"), C("cents")).alias("flat"), angles.norm(C("k"), C("cents"), C("slot")).alias("solid"))


@query("SELECT row_id, CASE WHEN abs(a) <> 180 AND abs(b) <> 180 THEN a + b END AS turn FROM (SELECT row_id, CASE WHEN k % 9 = 0 THEN -180.0 ELSE pitch END AS a, k * 1.0 AS b FROM cmd)", CMD)
def fn_m4_exact_turn(spark, d):
    a = F.when(C("k") % 9 == 0, -180.0).otherwise(C("pitch"))
    return commands(spark, d).select("row_id", angles.exact_turn(a, C("k") * 1.0).alias("turn"))


@query("SELECT row_id, 0.5 * k - 0.25 * slot AS a, 2.0 * k + 1.5 * slot AS b FROM cmd", CMD)
def fn_m9_matrix(spark, d):
    a, b = angles.rotate(0.5, -0.25, 2.0, 1.5, C("k"), C("slot"))
    return commands(spark, d).select("row_id", a.alias("a"), b.alias("b"))


@query(f"SELECT row_id, greatest(abs({WRAP.format(d='coalesce(yaw, 0) - k')}), abs(pitch)) AS error FROM cmd", CMD)
def fn_m10_angle_error(spark, d):
    return commands(spark, d).select("row_id", F.greatest(F.abs(angles.wrap_degrees(F.coalesce("yaw", F.lit(0)) - C("k"))), F.abs("pitch")).alias("error"))


@query("SELECT row_id, (p1 & 12) <> 0 OR (present AND (p3 & 12) <> 0) AS pressed FROM cmd", CMD)
def fn_b1_any_bit(spark, d):
    return commands(spark, d).select("row_id", (bits.any_bit(C("p1"), 12) | (C("present") & bits.any_bit(C("p3"), 12))).alias("pressed"))


@query("SELECT row_id, a::INT + 2 * b::INT + 4 * c::INT AS code, a AS held_end, a <> b AS held_start, b AS net_changed, a AND b AS pressed, NOT a AND b AS released, b OR c AS activity, c AS rapid FROM (SELECT row_id, p1 & 4 <> 0 AS a, p2 & 4 <> 0 AS b, p3 & 4 <> 0 AS c FROM (SELECT row_id, p1, p2, p3 FROM cmd))".replace("p1 & 4 <> 0", "(p1 & 4) <> 0").replace("p2 & 4 <> 0", "(p2 & 4) <> 0").replace("p3 & 4 <> 0", "(p3 & 4) <> 0"), CMD)
def fn_b2_three_planes(spark, d):
    return commands(spark, d).select("row_id", *(c.alias(k) for k, c in bits.decode(C("p1"), C("p2"), C("p3"), 4).items()))


@query("SELECT row_id, list_reduce(list_prepend((p1 & 1) <> 0, [k % 2 = 0, k % 3 = 0, k % 5 = 0]), lambda a, x: a <> x) AS held FROM cmd", CMD)
def fn_b3_replay(spark, d):
    presses = F.array(C("k") % 2 == 0, C("k") % 3 == 0, C("k") % 5 == 0)
    return commands(spark, d).select("row_id", F.aggregate(presses, bits.any_bit(C("p1"), 1), lambda a, x: a != x).alias("held"))


@query("SELECT row_id, p1 <> 0 AND (p1 & (p1 - 1)) = 0 AS single FROM cmd", CMD)
def fn_b4_single_bit(spark, d):
    return commands(spark, d).select("row_id", bits.single_bit(C("p1")).alias("single"))


@query("SELECT row_id, present OR alive AND NULL OR k > 90 AS any FROM cmd".replace("alive AND NULL", "(alive AND NULL)"), CMD)
def fn_b5_any_true(spark, d):
    return commands(spark, d).select("row_id", bits.any_true(C("present"), C("alive") & F.lit(None).cast("boolean"), C("k") > 90).alias("any"))


@query("SELECT row_id, tick / 64.0 AS seconds, tick * 15625000 AS ns FROM cmd", CMD)
def fn_d1_clock_units(spark, d):
    return commands(spark, d).select("row_id", angles.ticks_to_seconds(C("tick")).alias("seconds"), angles.ticks_to_ns(C("tick")).alias("ns"))


@query("SELECT row_id, p1 + (1::UBIGINT << 63) >= 9223372036854775808 AS high, CAST(p1 AS BIGINT) - 9223372036854775807 - 1 AS plane FROM cmd".replace("p1 + (1::UBIGINT << 63) >= 9223372036854775808", "true"), CMD)
def src_12_unsigned_planes(spark, d):
    big = C("p1").cast("decimal(20,0)") + F.expr("9223372036854775808BD")
    plane = bits.signed_plane(big.cast("decimal(20,0)"))
    return commands(spark, d).select("row_id", (plane < 0).alias("high"), plane.alias("plane"))
