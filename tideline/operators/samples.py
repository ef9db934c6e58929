"""Causal targets, labels with masks, acceptance, and training splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.functions.angles import exact_turn, finite, wrap_degrees
from tideline.functions.bits import any_bit
from tideline.functions.names import split_of
from tideline.operators.joins import interval_join


def causal_targets(frames: DataFrame, commands: DataFrame, tick: str, history: int, horizon: int, width: int, keys: tuple[str, ...] = ()) -> DataFrame:
    """For each frame the first command it may be asked to predict: one whose support [tick - 1, tick] lies after the
    frame's end, and whose tick is not after the end of the horizon's last frame.

    frame_index, upper, cutoff, target, target_tick, gap (target_tick - 1 - upper), remaining (later commands up to the
    cutoff), overlapping (commands whose support holds the frame's end), reason_codes. Frames are of `width` ticks and
    in order, each of `keys` on its own; eligible frames have no reasons. A first command that is not at floor(upper) + 2 leaves a coverage gap.
    """
    f = frames.withColumns({"upper": F.col("end"), "cutoff": F.col("end") + width * (horizon - 1), "seen": F.col("frame_index") + 1})
    n = frames.agg(F.max("frame_index").alias("_last"))
    f = f.crossJoin(F.broadcast(n)).withColumn("short", F.col("frame_index") + horizon - 1 > F.col("_last")).drop("_last")
    c = commands.select(*keys, "row_id", F.col(tick).alias("_t"))
    near = interval_join(c, f.select(*keys, "frame_index", "upper", "cutoff", (F.col("upper") - 1).alias("_from"), (F.col("cutoff") + 1).alias("_to")), "_t", "_from", "_to", keys=keys, width=width * (horizon + 1))
    later = (F.col("_t") - 1 > F.col("upper")) & (F.col("_t") <= F.col("cutoff"))
    holds = (F.col("_t") - 1 <= F.col("upper")) & (F.col("upper") <= F.col("_t"))
    g = near.groupBy(*keys, "frame_index").agg(F.min(F.when(later, F.struct(F.col("row_id"), F.col("_t")))).alias("first"), F.count_if(later).alias("n_later"), F.count_if(holds).alias("overlapping"))
    out = f.join(g, [*keys, "frame_index"], "left").withColumns({"target": F.col("first.row_id"), "target_tick": F.col("first._t")})
    reasons = F.array_compact(
        F.array(
            F.when(F.col("seen") < history, F.lit("insufficient_history_frames")),
            F.when(F.col("short"), F.lit("insufficient_future_intervals")),
            F.when(F.col("target").isNull(), F.lit("no_future_command")),
            F.when(F.col("target_tick") != F.floor("upper") + 2, F.lit("first_future_command_coverage_gap")),
        )
    )
    return out.select(*keys, "frame_index", "upper", "cutoff", "target", "target_tick", (F.col("target_tick") - 1 - F.col("upper")).alias("gap"), F.greatest(F.coalesce("n_later", F.lit(0)) - 1, F.lit(0)).alias("remaining"), F.coalesce("overlapping", F.lit(0)).alias("overlapping"), reasons.alias("reason_codes"))


def cell(value: Column, reason: Column) -> Column:
    """A masked value: valid where there is no reason against it."""
    fine = reason.isNull() & value.isNotNull()
    codes = F.when(fine, F.array().cast("array<string>")).otherwise(F.array(F.coalesce(reason, F.lit("unknown"))))
    return F.struct(F.when(fine, value).alias("value"), fine.alias("valid"), codes.alias("reason_codes"))


def aim_label(yaws: list[Column], pitches: list[Column]) -> tuple[Column, Column]:
    """The turn over three rows, exact, or masked: missing view angles mask both, a half turn masks the yaw."""
    known = finite(yaws[0]) & finite(yaws[1]) & finite(yaws[2]) & finite(pitches[0]) & finite(pitches[1]) & finite(pitches[2])
    absent = F.when(~known, F.lit("missing_viewangles"))
    turn = exact_turn(wrap_degrees(yaws[1] - yaws[0]), wrap_degrees(yaws[2] - yaws[1]))
    return cell(turn, F.coalesce(absent, F.when(turn.isNull(), F.lit("half_turn_ambiguous")))), cell(pitches[2] - pitches[0], absent)


def button_label(p1: list[Column], p2: list[Column], p3: list[Column], mask: int) -> Column:
    """held_end, net_changed, net_pressed, net_released, rapid, activity over the rows (p, a, b); null is masked.

    Where the change that a plane reports contradicts the held state before and after, every field is masked.
    """
    held, changed = [any_bit(x, mask) for x in p1], [any_bit(x, mask) for x in p2[1:]]
    again = [any_bit(x, mask) for x in p3[1:]]
    wrong = F.coalesce(((held[0] != held[1]) != changed[0]), F.lit(False)) | F.coalesce(((held[1] != held[2]) != changed[1]), F.lit(False))
    net = changed[0] != changed[1]
    known = lambda c: F.when(~wrong, c)
    pressed = F.when(~net, F.lit(False)).otherwise(net & held[2])
    released = F.when(~net, F.lit(False)).otherwise(net & ~held[2])
    return F.struct(known(held[2]).alias("held_end"), known(net).alias("net_changed"), known(pressed).alias("net_pressed"), known(released).alias("net_released"), known(again[0] | again[1]).alias("rapid"), known(changed[0] | changed[1] | again[0] | again[1]).alias("activity"))


def range_reasons(samples: DataFrame, states: DataFrame, key: str, first: str, last: str, rules: dict[str, Column]) -> DataFrame:
    """sample key and the sorted reasons of all ticks in [first, last]; a tick without a state is one."""
    ticks = samples.select(key, "slot", F.explode(F.sequence(first, last)).alias("tick"))
    met = ticks.join(states, ["slot", "tick"], "left")
    absent = F.col("_has").isNull()
    each = F.array_compact(F.array(F.when(absent, F.lit("missing_player_state")), *(F.when(~absent & c, F.lit(k)) for k, c in rules.items())))
    met = met.select(key, F.explode_outer(each).alias("reason"))
    return met.groupBy(key).agg(F.array_sort(F.collect_set("reason")).alias("reason_codes"))


def assemble(samples: DataFrame, key: list[str], order: list[str], series: str, seed: str) -> DataFrame:
    """Samples without later duplicates of their key, with the split of their series, so that no series is in two."""
    from tideline.operators.windows import latest

    return latest(samples, key, [F.col(c) for c in order]).withColumn("split", split_of(seed, F.col(series)))


def masked_array(cells: list[Column], empty: float = 0.0) -> tuple[Column, Column]:
    """Values with a placeholder where they are unknown, and the mask that says so."""
    return F.array(*(F.coalesce(c.cast("double"), F.lit(empty)) for c in cells)), F.array(*(c.isNotNull() for c in cells))


#: Reasons that a window's edge gives; a sample without them is complete, whatever else is wrong with it.
BOUNDARY = ("insufficient_future", "insufficient_history")


def accept_samples(rows: DataFrame, keys: list[str], order: list[str], id_column: str, quality: Column, proof: Column, history: int = 8, ahead: int = 1) -> DataFrame:
    """rows with the reasons against each as a sample: its own row is the last of `history` observed ones and the next
    `ahead` are its targets. reason_codes, sorted, each once: a window that is short, `quality` (an array of codes) of any
    row in the window, and `proof`, true only where it was verified (`proof_rejected`, `proof_unknown` else). Also
    training_ready (no reasons), window_complete (no short window), window_ids and a sample_id made of them."""
    w = Window.partitionBy(*keys).orderBy(*order)
    around = w.rowsBetween(-(history - 1), ahead)
    out = rows.withColumns({"_own": F.coalesce(quality, F.array().cast("array<string>")), "_proof": proof})
    out = out.withColumns(
        {
            "_codes": F.flatten(F.collect_list("_own").over(around)),
            "window_ids": F.collect_list(id_column).over(around),
            "_before": F.count("*").over(w.rowsBetween(-(history - 1), 0)),
            "_after": F.count("*").over(w.rowsBetween(1, ahead)),
        }
    )
    verdict = F.when(F.col("_proof").isNull(), "proof_unknown").when(~F.col("_proof"), "proof_rejected")
    edges = F.array(F.when(F.col("_before") < history, F.lit(BOUNDARY[1])), F.when(F.col("_after") < ahead, F.lit(BOUNDARY[0])), verdict)
    codes = F.array_sort(F.array_distinct(F.concat("_codes", F.array_compact(edges))))
    out = out.withColumn("reason_codes", codes)
    complete = ~F.arrays_overlap("reason_codes", F.array(*map(F.lit, BOUNDARY)))
    name = F.sha2(F.concat_ws(",", F.lit(f"{history}:{ahead}"), F.transform("window_ids", lambda x: x.cast("string"))), 256)
    out = out.withColumns({"training_ready": F.size("reason_codes") == 0, "window_complete": complete, "sample_id": F.substring(name, 1, 32)})
    return out.drop("_own", "_proof", "_codes", "_before", "_after")


def acceptance_report(samples: DataFrame, keys: list[str]) -> DataFrame:
    """Of each key: candidates, complete windows, accepted, rejected, and how often each reason was given, as JSON in order."""
    n = samples.groupBy(*keys).agg(F.count("*").alias("candidates"), F.count_if("window_complete").alias("complete"), F.count_if("training_ready").alias("accepted"), F.count_if(~F.col("training_ready")).alias("rejected"))
    why = samples.select(*keys, F.explode("reason_codes").alias("code")).groupBy(*keys, "code").agg(F.count("*").alias("n"))
    why = why.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("code", "n"))).alias("reasons"))
    text = F.coalesce(F.to_json(F.map_from_entries("reasons")), F.lit("{}")).alias("reasons")
    return n.join(why, keys, "left").select(*keys, "candidates", "complete", "accepted", "rejected", text)
