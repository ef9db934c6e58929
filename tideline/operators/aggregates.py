"""Conditional profiles, robust statistics, evidence and coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def share(part: Column, whole: Column, empty: float | None = None) -> Column:
    """100 * part / whole; `empty` where there is nothing to share."""
    return F.when(whole > 0, 100.0 * part / whole).otherwise(F.lit(empty).cast("double"))


def sample_variance(x: str) -> Column:
    """0 for fewer than two values."""
    return F.coalesce(F.var_samp(x), F.lit(0.0))


def nearest_rank(x: str, p: float) -> Column:
    """The value at place ceil(p * n) of the ordered values."""
    return F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY {x})")


def median_and_mad(df: DataFrame, keys: list[str], x: str) -> DataFrame:
    """Median of x and the median distance from it, exact."""
    mid = df.where(F.col(x).isNotNull()).groupBy(*keys).agg(F.median(x).alias("median"), F.count("*").alias("n"))
    away = df.where(F.col(x).isNotNull()).join(mid, keys).groupBy(*keys).agg(F.median(F.abs(F.col(x) - F.col("median"))).alias("mad"))
    return mid.join(away, keys)


def reservoir(df: DataFrame, keys: list[str], x: str, id_column: str, k: int = 512) -> DataFrame:
    """The k values of each key whose ids have the smallest hashes: the same rows however the table is partitioned, a fair
    sample of a larger key and all of a smaller one. Spark keeps k rows of a key in each partition before the shuffle (its
    group limit, for k up to spark.sql.optimizer.windowGroupLimitThreshold, 1000). Null values are left out."""
    rows = df.where(F.col(x).isNotNull()).select(*keys, x, id_column)
    w = Window.partitionBy(*keys).orderBy(F.xxhash64(id_column), id_column, x)
    return rows.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k).drop("_rank")


def sampled_median_and_mad(df: DataFrame, keys: list[str], x: str, id_column: str, k: int = 512) -> DataFrame:
    """n, sampled, median and mad of each key: n is exact, the others are of its reservoir(), and exact up to k values. Of
    more, the median stands at a share of 0.5 +- 0.5 / sqrt(k) of the ordered values, in two of three samples."""
    n = df.where(F.col(x).isNotNull()).groupBy(*keys).agg(F.count("*").alias("n"))
    kept = reservoir(df, keys, x, id_column, k).groupBy(*keys).agg(F.collect_list(F.col(x).cast("double")).alias("_values"))
    at = lambda c, i: F.get(c, i.cast("int"))
    middle = lambda c: (at(c, F.floor((F.size(c) - 1) / 2)) + at(c, F.floor(F.size(c) / 2))) / 2
    out = kept.withColumn("_sorted", F.array_sort("_values")).withColumn("median", middle(F.col("_sorted")))
    out = out.withColumn("_away", F.array_sort(F.transform("_values", lambda v: F.abs(v - F.col("median"))))).withColumn("mad", middle(F.col("_away")))
    return n.join(out.select(*keys, F.size("_values").cast("long").alias("sampled"), "median", "mad"), keys)


def observed_seconds(df: DataFrame, keys: list[str], order: str, seconds: str, alive: Column, most: float = 1.0) -> DataFrame:
    """Per key, the sum of the steps in (0, most] of `seconds` that begin and end alive."""
    w = Window.partitionBy(*keys).orderBy(order)
    rows = df.withColumn("_alive", F.coalesce(alive, F.lit(False)))
    step = F.col(seconds) - F.lag(seconds).over(w)
    rows = rows.withColumn("_step", F.when(F.col("_alive") & F.lag("_alive").over(w) & (step > 0) & (step <= most), step))
    return rows.groupBy(*keys).agg(F.coalesce(F.sum("_step"), F.lit(0)).alias("observed"))


def histogram(df: DataFrame, value: Column) -> DataFrame:
    return df.groupBy(value.cast("string").alias("value")).agg(F.count("*").alias("n"))


def exploded_counts(df: DataFrame, array: str, name: str) -> DataFrame:
    return df.select(F.explode(array).alias(name)).groupBy(name).agg(F.count("*").alias("n"))


def window_coverage(windows: DataFrame, commands: DataFrame, keys: list[str], t: str, max_gap: int) -> DataFrame:
    """For each window [start, end): commands, distinct ticks, first, last, the widest gap (edges count), whether it is
    within max_gap, and the share of ticks. Without commands the gap is 0 and the window incomplete."""
    from tideline.operators.joins import interval_join

    met = interval_join(commands.select(*keys, t), windows.select(*keys, "start", "end"), t, keys=tuple(keys))
    w = Window.partitionBy(*keys, "start", "end").orderBy(t)
    met = met.withColumn("_gap", F.col(t) - F.lag(t).over(w))
    some = met.groupBy(*keys, "start", "end").agg(F.count("*").alias("n"), F.countDistinct(t).alias("ticks"), F.min(t).alias("first"), F.max(t).alias("last"), F.max("_gap").alias("_gap"))
    out = windows.select(*keys, "start", "end").join(some, [*keys, "start", "end"], "left")
    gap = F.greatest(F.coalesce("_gap", F.lit(0)), F.col("first") - F.col("start"), F.col("end") - F.col("last"))
    gap = F.when(F.col("n").isNull(), F.lit(0)).otherwise(gap)
    return out.select(*keys, "start", "end", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("ticks", F.lit(0)).alias("ticks"), "first", "last", gap.cast("long").alias("max_gap"), (F.col("n").isNotNull() & (gap <= max_gap)).alias("complete"), (F.coalesce("ticks", F.lit(0)) / (F.col("end") - F.col("start"))).alias("fraction"))


def least_squares_2x2(df: DataFrame, keys: list[str], x: tuple[str, str], y: str) -> DataFrame:
    """b1, b2 of y = b1 x1 + b2 x2 without intercept; null where the determinant is under 1e-9."""
    a, b = F.col(x[0]), F.col(x[1])
    s = df.groupBy(*keys).agg(F.sum(a * a).alias("s11"), F.sum(a * b).alias("s12"), F.sum(b * b).alias("s22"), F.sum(a * F.col(y)).alias("t1"), F.sum(b * F.col(y)).alias("t2"))
    det = F.col("s11") * F.col("s22") - F.col("s12") * F.col("s12")
    fine = F.abs(det) >= 1e-9
    return s.select(*keys, F.when(fine, (F.col("t1") * F.col("s22") - F.col("t2") * F.col("s12")) / det).alias("b1"), F.when(fine, (F.col("t2") * F.col("s11") - F.col("t1") * F.col("s12")) / det).alias("b2"))


def offset_fit(df: DataFrame, keys: list[str], offset: str, within: float) -> DataFrame:
    """The one distinct offset of each key, or else the median if every offset is within `within` of it; else null."""
    mid = df.groupBy(*keys).agg(F.countDistinct(offset).alias("n_offsets"), F.median(offset).alias("_mid"), F.min(offset).alias("_lo"), F.max(offset).alias("_hi"))
    residual = F.greatest(F.col("_hi") - F.col("_mid"), F.col("_mid") - F.col("_lo"))
    return mid.select(*keys, "n_offsets", F.when((F.col("n_offsets") == 1) | (residual <= within), F.col("_mid")).alias("offset"), residual.alias("residual"))
