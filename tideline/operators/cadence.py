"""Cadence of a clock: its intervals, those over a threshold, what stood before and after them and what went on nearby."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.operators.aggregates import nearest_rank
from tideline.operators.joins import asof_join, dyadic_join

C = F.col


def intervals(rows: DataFrame, keys: list[str], order: str, clock: str, threshold: int) -> DataFrame:
    """The step of `clock` from each row's neighbour before it: before, after, gap, above (strictly over the threshold).
    A clock that stands or runs back is no interval: gap is null then, and for unknown clocks."""
    w = Window.partitionBy(*keys).orderBy(order)
    step = C(clock) - C("before")
    rows = rows.withColumn("before", F.lag(clock).over(w)).withColumn("has_before", F.row_number().over(w) > 1).where("has_before")
    gap = F.when(step > 0, step)
    return rows.select(*keys, order, "before", C(clock).alias("after"), gap.alias("gap"), F.coalesce(gap > threshold, F.lit(False)).alias("above"))


def summary(steps: DataFrame, keys: list[str], gap: str = "gap") -> DataFrame:
    """Of each key: intervals, those that are none, those above, and least, median, nearest-rank 95 % and largest gap."""
    return steps.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.count_if(C(gap).isNull()).alias("invalid"),
        F.count_if("above").alias("above"),
        F.min(gap).alias("least"),
        F.median(gap).alias("middle"),
        nearest_rank(gap, 0.95).alias("high"),
        F.max(gap).alias("most"),
    )


def around(steps: DataFrame, milestones: DataFrame, keys: list[str], at: str, name: str) -> DataFrame:
    """steps with the last milestone of their key before `before` or at it, and the first after `after` or at it."""
    marks = milestones.select(*keys, C(at).alias("_at"), C(name).alias("_name"))
    last = marks.groupBy(*keys, "_at").agg(F.min("_name").alias("previous"))
    first = marks.groupBy(*keys, (-C("_at")).alias("_back")).agg(F.min("_name").alias("next"))
    out = asof_join(steps, last, "before", "_at", tuple(keys), ("previous",))
    out = out.withColumnsRenamed({"asof_previous": "previous_milestone", "asof__at": "previous_at"}).withColumn("_after", -C("after"))
    out = asof_join(out, first, "_after", "_back", tuple(keys), ("next",))
    return out.withColumn("next_at", -C("asof__back")).withColumnRenamed("asof_next", "next_milestone").drop("_after", "asof__back")


def nearby(steps: DataFrame, actions: DataFrame, keys: list[str], at: str, window: int, order: str) -> DataFrame:
    """steps with `actions`: how many actions of their key lie within `window` of the interval, ends included."""
    spans = steps.select(*keys, C(order).alias("_step"), (C("before") - window).alias("_from"), (C("after") + window + 1).alias("_to"))
    n = dyadic_join(actions.select(*keys, at), spans, at, "_from", "_to", tuple(keys)).groupBy(*keys, C("_step").alias(order)).agg(F.count("*").alias("actions"))
    return steps.join(n, [*keys, order], "left").withColumn("actions", F.coalesce("actions", F.lit(0)))


def largest(steps: DataFrame, keys: list[str], order: str, n: int) -> DataFrame:
    """The n largest intervals of each key, largest first in `place`; Spark keeps n of a key in each partition."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("gap"), order))
    return steps.where("gap is not null").withColumn("place", place).where(C("place") <= n)


def startup(samples: DataFrame, keys: list[str], order: str, stage: Column, gap: Column, threshold: int) -> DataFrame:
    """By key and stage: samples, those whose recorded gap is valid (known and not negative), positive, above; the sample
    with the largest gap and the sample before it, of any stage. The spacing of samples is no gap: only what they record."""
    w = Window.partitionBy(*keys).orderBy(order)
    rows = samples.select(*keys, order, stage.alias("stage"), F.when(gap >= 0, gap).alias("gap"), F.lag(order).over(w).alias("_previous"))
    most = F.max(F.when(C("gap").isNotNull(), F.struct("gap", (-C(order)).alias("_order"), "_previous")))
    out = rows.groupBy(*keys, "stage").agg(F.count("*").alias("samples"), F.count("gap").alias("valid"), F.count_if(C("gap") > 0).alias("positive"), F.count_if(C("gap") > threshold).alias("above"), most.alias("_most"))
    return out.select(*keys, "stage", "samples", "valid", "positive", "above", C("_most.gap").alias("most"), (-C("_most._order")).alias("most_at"), C("_most._previous").alias("sample_before"))
