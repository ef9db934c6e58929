"""Measured responses and plans: effects, gains, hypotheses and their confirmation, budgets, compiled counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def effect(known: Column, observed: Column, unknown: str) -> Column:
    """(status, reason): unknown with its reason where the evidence isn't whole, else whether the response was seen."""
    whole = F.coalesce(known, F.lit(False))
    seen = F.when(F.coalesce(observed, F.lit(False)), "observed_response_evidence").otherwise("missing_observed_response")
    return F.struct(F.when(whole, seen).otherwise("unknown").alias("status"), F.when(~whole, F.lit(unknown)).alias("reason"))


def gain_agreement(df: DataFrame, keys: list[str], turns: list[str], counts: list[str], injected: list[str], gain: list[list[float]], absolute: float, relative: float) -> DataFrame:
    """Of each case, the labelled turns of both axes against what the gain says of its counts.

    n rows, missing (rows without a turn or a count), the residual of each axis, and agrees: nothing is missing, the
    counts are those injected, and each residual is within absolute + relative * |prediction|.
    """
    lacking = F.lit(False)
    for c in (*turns, *counts):
        lacking = lacking | F.col(c).isNull()
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(f"_sum_{c}") for c in (*turns, *counts, *injected)]
    rows = df.groupBy(*keys).agg(F.count("*").alias("n"), F.count_if(lacking).alias("missing"), *sums)
    total = lambda c: F.col(f"_sum_{c}")
    fine, out = F.col("missing") == 0, []
    for c, d in zip(counts, injected, strict=True):
        fine = fine & (total(c) == total(d))
    for turn, (a, b) in zip(turns, gain, strict=True):
        said = total(counts[0]) * a + total(counts[1]) * b
        residual = total(turn) - said
        fine = fine & (F.abs(residual) <= absolute + relative * F.abs(said))
        out.append(residual.alias(f"residual_{turn}"))
    return rows.select(*keys, "n", "missing", *out, fine.alias("agrees"))


def confirmed(df: DataFrame, keys: list[str], derivation: Column, hypotheses: dict[str, Column]) -> DataFrame:
    """Hypotheses frozen on the derivation rows and tested on the others: for each, tested and matching rows of both
    parts, and the status: untested, rejected (some derivation row contradicts it), unconfirmed (no other row to test it
    on), contradicted, confirmed. A null outcome is no test."""
    pairs = ", ".join(f"'{name}', `_h_{name}`" for name in hypotheses)
    rows = df.select(*keys, derivation.alias("_first"), *(c.alias(f"_h_{name}") for name, c in hypotheses.items()))
    rows = rows.select(*keys, "_first", F.expr(f"stack({len(hypotheses)}, {pairs}) AS (hypothesis, _ok)")).where("_ok is not null and _first is not null")
    count = lambda when, name: F.count_if(when).alias(name)
    first, ok = F.col("_first"), F.col("_ok")
    got = rows.groupBy(*keys, "hypothesis").agg(count(first, "tested"), count(first & ok, "matches"), count(~first, "tested_again"), count(~first & ok, "matches_again"))
    status = F.when(F.col("tested") == 0, "untested").when(F.col("matches") < F.col("tested"), "rejected").when(F.col("tested_again") == 0, "unconfirmed")
    return got.withColumn("status", status.when(F.col("matches_again") < F.col("tested_again"), "contradicted").otherwise("confirmed"))


def whole_clips(windows: DataFrame, clip: int, least: int) -> DataFrame:
    """[start, end) windows with n_clips, planned, short and odd: clips of `clip` ticks from the start on, then one of
    what is left but for a last odd tick, if that is `least` ticks or more; short and odd are the ticks left out."""
    length = F.col("end") - F.col("start")
    even = F.floor(length / 2) * 2
    rest = even % clip
    tail = rest >= least
    return windows.withColumns({"n_clips": F.floor(even / clip) + tail.cast("long"), "planned": F.when(tail, even).otherwise(even - rest), "short": F.when(tail, 0).otherwise(rest), "odd": length - even})


def within_budget(clips: DataFrame, keys: list[str], most: int, rate: int, bytes_a_second: float, bytes_a_clip: float, seconds_a_second: float, seconds_a_clip: float, storage: float, seconds: float) -> DataFrame:
    """Of each key, the sums of whole_clips(), the storage and time that they are projected to need, and the verdict: the
    first bound that is broken, or planned."""
    total = [F.sum(c).alias(c) for c in ("n_clips", "planned", "short", "odd")]
    rows = clips.groupBy(*keys).agg(*total)
    length = F.col("planned") / float(rate)
    rows = rows.withColumns({"projected_bytes": F.ceil(length * bytes_a_second + F.col("n_clips") * bytes_a_clip), "projected_seconds": length * seconds_a_second + F.col("n_clips") * seconds_a_clip})
    verdict = F.when(F.col("n_clips") == 0, "no_clip").when(F.col("n_clips") > most, "too_many_clips").when(F.col("projected_bytes") > storage, "storage_exceeds_budget")
    return rows.withColumn("verdict", verdict.when(F.col("projected_seconds") > seconds, "time_exceeds_budget").otherwise("planned"))


def compiled_counts(df: DataFrame, keys: list[str], order: str, desired: Column) -> DataFrame:
    """df with `emitted` and `residual`: whole counts whose running sum is the running sum of desired rounded half away
    from zero, and what is carried on."""
    w = Window.partitionBy(*keys).orderBy(order)
    rows = df.withColumn("_total", F.sum(desired).over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_whole", F.round("_total").cast("long"))
    emitted = F.col("_whole") - F.coalesce(F.lag("_whole").over(w), F.lit(0))
    return rows.withColumns({"emitted": emitted, "residual": F.col("_total") - F.col("_whole")}).drop("_total", "_whole")
