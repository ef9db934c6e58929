"""Tick tables as views of the driver's `events` table: commands, states, rounds, frames, and the same in SQL.

A recording is a hundred users with ten slots; `slot` numbers the slots of all recordings, so that their number grows with
the users and the rows of one do not. Rounds and frames reach as far as the ticks do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROUND = 1440


def commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One command for each event: tick is its minute, round its day, slot that of its user."""
    return commands_of(spark.read.parquet(f"{sf_dir}/events.parquet"))


def commands_of(e: DataFrame) -> DataFrame:
    """The commands of events, read or streamed."""
    day = F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date"))
    sec = (day * 86400 + F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")).cast("long")
    cents = F.round(F.col("value") * 100).cast("long")
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("long")
    rows = e.select(F.col("event_id").alias("row_id"), "user_id", (F.floor(F.col("user_id") / 100) * 10 + F.col("user_id") % 10).cast("int").alias("slot"), F.col("event_type").alias("kind"), sec.alias("sec"), cents.alias("cents"), k.alias("k"))
    rows = rows.withColumns({"tick": F.floor(F.col("sec") / 60).cast("long"), "alive": F.col("kind") != "error"})
    return rows.withColumns(
        {
            "round_id": F.floor(F.col("tick") / ROUND).cast("long"),
            "number": F.col("sec") % 7 + F.col("row_id"),
            "client_tick": F.col("tick") + F.col("cents") % 4,
            "yaw": F.when(F.col("kind") != "signup", (F.col("cents") * 7 % 36000) / 100.0 - 180.0),
            "pitch": (F.col("cents") % 17800) / 100.0 - 89.0,
            "p1": F.col("cents").bitwiseAND(F.lit(255)),
            "p2": F.shiftright("cents", 4).bitwiseAND(F.lit(255)),
            "p3": F.shiftright("cents", 8).bitwiseAND(F.lit(255)),
            "dx": F.when(F.col("k") % 5 != 0, F.col("k") - 50),
            "present": F.when(F.col("k") % 3 != 0, F.col("k") % 2 == 0),
        }
    )


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One state for each (slot, tick) that has commands."""
    s = commands(spark, sf_dir).groupBy("slot", "tick", "round_id").agg(F.min("user_id").alias("user_id"), F.min("alive").alias("alive"), F.sum("cents").alias("x"), F.max(F.col("cents") % 100).alias("health"), F.min("yaw").alias("yaw"))
    return s.withColumns({"paused": F.when(F.col("x") % 11 != 0, F.col("x") % 7 == 0), "moving": F.col("x") % 2 == 0})


def neighbours(rows: DataFrame, step: int = 1) -> tuple[DataFrame, DataFrame]:
    """The rows of slots that have another `step` slots on in their recording, and the rows of those, under the first's number."""
    left = rows.where(F.col("slot") % 10 + step < 10)
    return left, rows.where(F.col("slot") % 10 >= step).withColumn("slot", F.col("slot") - step)


def rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = commands(spark, sf_dir).agg(F.max("round_id").alias("last"))
    r = last.select(F.explode(F.sequence(F.lit(0).cast("long"), "last")).alias("round_id")).withColumn("start", F.col("round_id") * ROUND)
    return r.withColumns({"freeze_end": F.col("start") + 60, "end": F.when(F.col("round_id") % 7 != 3, F.col("start") + 1400)})


def frames(spark: SparkSession, sf_dir: str, width: int = 32) -> DataFrame:
    last = commands(spark, sf_dir).agg(F.floor(F.max("tick") / width).alias("last"))
    f = last.select(F.explode(F.sequence(F.lit(0).cast("long"), "last")).alias("frame_index"))
    return f.select("frame_index", (F.col("frame_index") * width).alias("start"), ((F.col("frame_index") + 1) * width).alias("end"))


def player_frames(spark: SparkSession, sf_dir: str, width: int = 32) -> DataFrame:
    """The frames of each slot."""
    c = commands(spark, sf_dir)
    last = c.agg(F.floor(F.max("tick") / width).alias("last"))
    f = c.select("slot").distinct().crossJoin(last).select("slot", F.explode(F.sequence(F.lit(0).cast("long"), "last")).alias("frame_index"))
    return f.select("slot", "frame_index", (F.col("frame_index") * width).alias("start"), ((F.col("frame_index") + 1) * width).alias("end"))


CMD = """
base AS (SELECT event_id AS row_id, user_id, CAST(user_id // 100 * 10 + user_id % 10 AS INTEGER) AS slot, event_type AS kind,
  CAST(floor(epoch(ts)) AS BIGINT) - 1704067200 AS sec, CAST(round(value * 100) AS BIGINT) AS cents,
  CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events),
cmd AS (SELECT *, sec // 60 AS tick, kind <> 'error' AS alive, (sec // 60) // 1440 AS round_id, sec % 7 + row_id AS number,
  sec // 60 + cents % 4 AS client_tick, CASE WHEN kind <> 'signup' THEN (cents * 7 % 36000) / 100.0 - 180.0 END AS yaw,
  (cents % 17800) / 100.0 - 89.0 AS pitch, cents & 255 AS p1, (cents >> 4) & 255 AS p2, (cents >> 8) & 255 AS p3,
  CASE WHEN k % 5 <> 0 THEN k - 50 END AS dx, CASE WHEN k % 3 <> 0 THEN k % 2 = 0 END AS present FROM base)"""
STATE = (
    CMD
    + """,
st0 AS (SELECT slot, tick, round_id, min(user_id) AS user_id, bool_and(alive) AS alive, CAST(sum(cents) AS BIGINT) AS x, max(cents % 100) AS health, min(yaw) AS yaw
  FROM cmd GROUP BY slot, tick, round_id),
st AS (SELECT *, CASE WHEN x % 11 <> 0 THEN x % 7 = 0 END AS paused, x % 2 = 0 AS moving FROM st0)"""
)
ROUNDS = """
rd AS (SELECT i AS round_id, i * 1440 AS start, i * 1440 + 60 AS freeze_end, CASE WHEN i % 7 <> 3 THEN i * 1440 + 1400 END AS "end" FROM (SELECT unnest(range(0, (SELECT max(round_id) + 1 FROM cmd))) AS i))"""
FRAMES = """
fr AS (SELECT i AS frame_index, i * 32 AS start, (i + 1) * 32 AS "end" FROM (SELECT unnest(range(0, (SELECT max(tick) // 32 + 1 FROM cmd))) AS i))"""
PLAYER_FRAMES = FRAMES + """,
pf AS (SELECT slot, frame_index, start, "end" FROM (SELECT DISTINCT slot FROM cmd) CROSS JOIN fr)"""
WRAP = "((({d}) + 180.0) % 360.0 + 360.0) % 360.0 - 180.0"
