"""Interval algebra: union, complement with reasons, clipping, splitting, overlap checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.operators.windows import islands


def clip(df: DataFrame, lo: Column | int, hi: Column | int) -> DataFrame:
    """[start, end) cut to [lo, hi); empty rests go."""
    lo, hi = (x if isinstance(x, Column) else F.lit(x) for x in (lo, hi))
    return df.withColumns({"start": F.greatest("start", lo), "end": F.least("end", hi)}).where("start < end")


def gaps(df: DataFrame, keys: list[str]) -> DataFrame:
    """What lies between one interval and the next of its key, where something does."""
    nxt = F.lead("start").over(Window.partitionBy(*keys).orderBy("start", "end"))
    return df.withColumn("_next", nxt).where(F.col("_next") > F.col("end")).select(*keys, F.col("end").alias("start"), F.col("_next").alias("end"))


def overlapping(df: DataFrame, keys: list[str], ties: tuple[str, ...] = ()) -> DataFrame:
    """Intervals that begin before an earlier one of their key has ended; `ties` order equal ones."""
    w = Window.partitionBy(*keys).orderBy("start", "end", *ties).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("_reached", F.max("end").over(w)).where(F.col("start") < F.col("_reached")).drop("_reached")


def complement(owned: DataFrame, lo: int, hi: int | DataFrame, keys: list[str]) -> DataFrame:
    """The parts of [lo, hi) that disjoint intervals leave, per key. hi: a number, or a table of one row that holds it."""
    end = hi if isinstance(hi, DataFrame) else owned.sparkSession.range(1).select(F.lit(hi))
    inside = owned.select(*keys, "start", "end").crossJoin(F.broadcast(end.toDF("_hi").withColumn("_hi", F.col("_hi").cast("long"))))
    inside = clip(inside, lo, F.col("_hi"))
    edges = inside.groupBy(*keys).agg(F.first("_hi").alias("_hi"))
    at = lambda x: edges.select(*keys, x.cast("long").alias("start"), x.cast("long").alias("end"))
    return gaps(inside.drop("_hi").unionByName(at(F.lit(lo))).unionByName(at(F.col("_hi"))), keys)


def reasons_by_tick(ticks: DataFrame, keys: list[str], t: str, reasons: list[tuple[str, Column]], otherwise: str | None = None) -> DataFrame:
    """Runs of ticks with the same first reason that applies; ticks without one are left out."""
    (first, when), *rest = reasons
    reason = F.when(when, first)
    for name, c in rest:
        reason = reason.when(c, name)
    rows = ticks.withColumn("reason", reason.otherwise(F.lit(otherwise)) if otherwise else reason)
    w = Window.partitionBy(*keys).orderBy(t)
    cut = (F.col(t) != F.lag(t).over(w) + 1) | ~F.lag("reason").over(w).eqNullSafe(F.col("reason"))
    runs = islands(rows.withColumn("_cut", cut), keys, [t], F.col("_cut")).where("reason is not null")
    return runs.groupBy(*keys, "reason", "island").agg(F.min(t).alias("start"), (F.max(t) + 1).alias("end")).drop("island")


def split(df: DataFrame, most: int, history: int, least: int, floor: int = 0) -> DataFrame:
    """Windows cut into captures of at most `most` ticks that own what the `history` ticks before them only repeat.

    A window begins at `floor` at the earliest and loses a last odd tick; under `least` ticks it has no capture. If less
    than history + 4 ticks would be left for a last capture, the one before gives up the difference. In closed form: the
    first capture owns `most` ticks and every other one most - history.
    """
    start = F.greatest("start", F.lit(floor))
    even = start + F.floor((F.col("end") - start) / 2) * 2
    rows = df.withColumns({"_s": start, "_e": even}).where(F.col("_e") - F.col("_s") >= least)
    stride, tail = most - history, history + 4
    n = F.when(F.col("_e") - F.col("_s") <= most, F.lit(0)).otherwise(F.ceil((F.col("_e") - F.col("_s") - most) / stride)).cast("int")
    rows = rows.withColumn("_n", n).withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("_n"))))
    edge = lambda k: F.col("_s") + F.lit(most) + (k - 1) * stride
    rest = F.col("_e") - edge(F.col("_n"))
    give = F.when((F.col("_n") > 0) & (rest < tail), tail - rest).otherwise(F.lit(0))
    cursor = F.when(F.col("piece") == 0, F.col("_s")).otherwise(edge(F.col("piece")) - F.when(F.col("piece") == F.col("_n"), give).otherwise(F.lit(0)))
    own_end = F.when(F.col("piece") == F.col("_n"), F.col("_e")).otherwise(edge(F.col("piece") + 1) - F.when(F.col("piece") == F.col("_n") - 1, give).otherwise(F.lit(0)))
    capture = F.when(F.col("piece") == 0, cursor).otherwise(cursor - history)
    return rows.withColumns({"owned_start": cursor.cast("long"), "owned_end": own_end.cast("long"), "capture_start": capture.cast("long")}).drop("_s", "_e", "_n")
