"""Ordered work within a key: transitions, islands, chunks, runs and history windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.functions.angles import finite, wrap_degrees


def transitions(commands: DataFrame, key: str = "slot", order: str = "row_id", max_gap: int = 16, same: tuple[str, ...] = ("round_id", "user_id")) -> DataFrame:
    """Each command with its turn since the one before it, or the first reason why there is none.

    Reasons, in this order: first_command, changed_<column>, not_alive, missing_viewangles, demo_tick_discontinuity,
    command_number_discontinuity, client_tick_reset. Turns and previous ids are null where there is a reason.
    """
    w = Window.partitionBy(key).orderBy(order)
    before = {c: F.lag(c).over(w) for c in {order, "alive", "yaw", "pitch", "tick", "number", "client_tick", *same}}
    out = commands.withColumns({f"_p_{c}": x for c, x in before.items()})
    p = lambda c: F.col(f"_p_{c}")
    reason = F.when(p(order).isNull(), "first_command")
    for c in same:
        reason = reason.when(~p(c).eqNullSafe(F.col(c)), f"changed_{c}")
    reason = reason.when(p("alive").eqNullSafe(False) | F.col("alive").eqNullSafe(False), "not_alive")
    angles = [p("yaw"), p("pitch"), F.col("yaw"), F.col("pitch")]
    reason = reason.when(~(finite(angles[0]) & finite(angles[1]) & finite(angles[2]) & finite(angles[3])), "missing_viewangles")
    step = F.col("tick") - p("tick")
    reason = reason.when((step < 0) | (step > max_gap), "demo_tick_discontinuity")
    reason = reason.when(F.col("number") != p("number") + 1, "command_number_discontinuity")
    reason = reason.when(F.col("client_tick") < p("client_tick"), "client_tick_reset")
    out = out.withColumn("reset_reason", reason)
    fine = F.col("reset_reason").isNull()
    out = out.withColumns({"delta_yaw": F.when(fine, wrap_degrees(F.col("yaw") - p("yaw"))), "delta_pitch": F.when(fine, F.col("pitch") - p("pitch")), "previous_row_id": F.when(fine, p(order))})
    return out.select(*commands.columns, "reset_reason", "delta_yaw", "delta_pitch", "previous_row_id")


def islands(df: DataFrame, keys: list[str], order: list[str], starts: Column, name: str = "island") -> DataFrame:
    """Number the runs of rows within keys; `starts` says where one begins (the first row always does)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    first = F.row_number().over(w) == 1
    flagged = df.withColumn("_start", (first | F.coalesce(starts, F.lit(True))).cast("int"))
    return flagged.withColumn(name, F.sum("_start").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_start")


def gap_islands(df: DataFrame, keys: list[str], t: str, valid: Column, same: list[str], max_gap: int) -> DataFrame:
    """start, end, n of each maximal run of valid rows with equal `same` columns and no gap in t over max_gap; end is one
    past the last t."""
    w = Window.partitionBy(*keys).orderBy(t)
    rows = df.withColumn("_valid", F.coalesce(valid, F.lit(False)))
    cut = ~F.lag("_valid").over(w) | (F.col(t) - F.lag(t).over(w) > max_gap)
    for c in same:
        cut = cut | ~F.lag(c).over(w).eqNullSafe(F.col(c))
    runs = islands(rows.withColumn("_cut", cut), keys, [t], F.col("_cut"))
    return runs.where("_valid").groupBy(*keys, *same, "island").agg(F.min(t).alias("start"), (F.max(t) + 1).alias("end"), F.count("*").alias("n")).drop("island")


def chunks(df: DataFrame, keys: list[str], t: str, size: int, step: int = 1) -> DataFrame:
    """Rows of whole chunks of `size` rows that follow each other by `step` in t; a shorter rest is dropped."""
    w = Window.partitionBy(*keys).orderBy(t)
    runs = islands(df.withColumn("_cut", F.col(t) - F.lag(t).over(w) != step), keys, [t], F.col("_cut"))
    own = Window.partitionBy(*keys, "island").orderBy(t)
    runs = runs.withColumn("chunk", F.floor((F.row_number().over(own) - 1) / size))
    n = F.count("*").over(Window.partitionBy(*keys, "island", "chunk"))
    return runs.withColumn("_n", n).where(F.col("_n") == size).drop("_n", "_cut")


def run_length_segments(df: DataFrame, keys: list[str], t: str, state: list[str]) -> DataFrame:
    """[start, end) segments of equal state over consecutive t, one row per t."""
    w = Window.partitionBy(*keys).orderBy(t)
    cut = F.col(t) != F.lag(t).over(w) + 1
    for c in state:
        cut = cut | ~F.lag(c).over(w).eqNullSafe(F.col(c))
    runs = islands(df.withColumn("_cut", cut), keys, [t], F.col("_cut"))
    return runs.groupBy(*keys, *state, "island").agg(F.min(t).alias("start"), (F.max(t) + 1).alias("end")).drop("island")


def repeated_within(df: DataFrame, player: str, key: list[str], order: str, back: int) -> DataFrame:
    """df with `duplicate`: its key was among the player's `back` rows before it."""
    place = F.row_number().over(Window.partitionBy(player).orderBy(order))
    rows = df.withColumn("_place", place)
    before = F.lag("_place").over(Window.partitionBy(player, *key).orderBy("_place"))
    return rows.withColumn("duplicate", F.coalesce(F.col("_place") - before <= back, F.lit(False))).drop("_place")


def history(df: DataFrame, keys: list[str], order: str, value: str, back: int, ahead: int = 0) -> DataFrame:
    """df with `history` (the last `back` values, its own the last), `future` (the next `ahead`, its own the first) and
    the reasons why either is short."""
    w = Window.partitionBy(*keys).orderBy(order)
    out = df.withColumns({"history": F.collect_list(value).over(w.rowsBetween(-(back - 1), 0)), "future": F.collect_list(value).over(w.rowsBetween(0, max(0, ahead - 1)))})
    reasons = F.array_compact(F.array(F.when(F.size("history") < back, F.lit("insufficient_history_frames")), F.when(F.size("future") < ahead, F.lit("insufficient_future_intervals"))))
    return out.withColumn("reason_codes", reasons)


def changes(df: DataFrame, keys: list[str], order: str, watched: list[str]) -> DataFrame:
    """The rows in which a watched column differs from the row before, with (name, before, after) of each."""
    w = Window.partitionBy(*keys).orderBy(order)
    rows = df.withColumns({f"_b_{c}": F.lag(c).over(w) for c in watched}).withColumn("_first", F.row_number().over(w) == 1)
    each = [F.when(~F.col("_first") & ~F.col(f"_b_{c}").eqNullSafe(F.col(c)), F.struct(F.lit(c).alias("name"), F.col(f"_b_{c}").cast("string").alias("before"), F.col(c).cast("string").alias("after"))) for c in watched]
    return rows.withColumn("changed", F.array_compact(F.array(*each))).where(F.size("changed") > 0).select(*df.columns, "changed")


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rn = 1").drop("_rn")


def carried_rounding(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """df with `emitted`: whole numbers whose running sums are the nearest to the running sums of value (halves up)."""
    w = Window.partitionBy(*keys).orderBy(order)
    total = F.floor(F.sum(F.col(value)).over(w.rowsBetween(Window.unboundedPreceding, 0)) + F.lit(0.5))
    rows = df.withColumn("_total", total)
    return rows.withColumn("emitted", F.col("_total") - F.coalesce(F.lag("_total").over(w), F.lit(0))).drop("_total")


def running_segments(df: DataFrame, keys: list[str], start: str, end: str, slack: int = 0) -> DataFrame:
    """The union of the intervals of each key: those that overlap or touch within slack merge."""
    w = Window.partitionBy(*keys).orderBy(start, end)
    reached = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    runs = islands(df.withColumn("_cut", F.col(start) > reached + slack), keys, [start, end], F.col("_cut"))
    return runs.groupBy(*keys, "island").agg(F.min(start).alias("start"), F.max(end).alias("end"), F.count("*").alias("n")).drop("island")
