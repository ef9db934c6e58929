"""Discovery of candidate windows: whole windows of sound states, what their commands hint at, and a balanced choice."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.functions.bits import decode
from tideline.operators.joins import asof_join
from tideline.operators.selection import diverse
from tideline.operators.windows import islands

C = F.col
Before = Callable[[str], Column]


def state_windows(states: DataFrame, keys: list[str], t: str, valid: Column, same: list[str], length: int, max_gap: int, evidence: dict[str, Callable[[Before], Column]]) -> DataFrame:
    """[start, end) of each `length` valid states of a key that follow each other within max_gap in t, with equal `same`.

    A run of such states is cut into windows from its front and a shorter rest is dropped. Each name in `evidence` counts
    the states of a window for which its condition holds; `before(c)` is there the column of the state before it in the
    window, null at the first. An unknown `valid` is not valid, and a null in `same` equals a null.
    """
    w = Window.partitionBy(*keys).orderBy(t)
    rows = states.withColumn("_valid", F.coalesce(valid, F.lit(False)))
    cut = ~F.lag("_valid").over(w) | (C(t) - F.lag(t).over(w) > max_gap)
    for c in same:
        cut = cut | ~F.lag(c).over(w).eqNullSafe(C(c))
    runs = islands(rows.withColumn("_cut", cut), keys, [t], C("_cut"), "_run").where("_valid")
    place = F.row_number().over(Window.partitionBy(*keys, "_run").orderBy(t)) - 1
    runs = runs.withColumn("_chunk", F.floor(place / length))
    own = Window.partitionBy(*keys, "_run", "_chunk").orderBy(t)
    runs = runs.withColumns({f"_e_{k}": f(lambda c: F.lag(c).over(own)) for k, f in evidence.items()})
    out = runs.groupBy(*keys, *same, "_run", "_chunk").agg(F.min(t).alias("start"), (F.max(t) + 1).alias("end"), F.count("*").alias("_n"), *(F.count_if(f"_e_{k}").alias(k) for k in evidence))
    return out.where(C("_n") == length).drop("_n", "_run", "_chunk")


def action_hints(
    windows: DataFrame,
    commands: DataFrame,
    keys: list[str],
    t: str,
    order: list[str],
    planes: list[str],
    known: Column,
    follows: Callable[[Before], Column],
    buttons: dict[str, int],
    movement: list[int],
    attack: int,
    margin: int,
    max_gap: int,
    sustained: int,
) -> DataFrame:
    """windows (of a key, none overlapping) with what the commands within them hint at.

    commands, known and unknown count them; boundary_gaps the known ones that don't follow a known one (`follows`, of the
    command `before` it). At least `margin` after the start of the window count: each of `buttons` held at a command's end
    or active, and movement_start and movement_stop, when a command that follows its known predecessor and agrees with it
    on all `movement` masks passes from none held to one, or back. attack_run is the longest run of commands that hold
    `attack` throughout, each following the one before, and sustained_attack says if it reaches `sustained`. max_gap is the
    longest stretch without a command, the window's ends included, and covered says if it is within the allowed one.
    A window without commands has zeros, a null max_gap and is not covered. Commands of an unknown t are in no window.
    """
    spans = windows.select(*keys, "start", "end")
    met = asof_join(commands.where(C(t).isNotNull()), spans, t, "start", tuple(keys), ("end",)).withColumnsRenamed({"asof_start": "start", "asof_end": "end"}).where(C(t) < C("end"))
    w = Window.partitionBy(*keys, "start").orderBy(*order)
    before = lambda c: F.lag(c).over(w)
    sound = F.coalesce(known, F.lit(False))
    for p in planes:
        sound = sound & C(p).isNotNull()
    rows = met.withColumn("_known", sound)
    seen = {m: decode(*(C(p) for p in planes), m) for m in {*buttons.values(), *movement, attack}}
    rows = rows.withColumns({f"_{k}_{m}": d[k] for m, d in seen.items() for k in ("held_start", "held_end", "activity", "code")})
    either = lambda cells: reduce(lambda a, b: a | b, cells)
    agrees = reduce(lambda a, b: a & b, (before(f"_held_end_{m}") == C(f"_held_start_{m}") for m in movement))
    rows = rows.withColumns(
        {
            "_follows": F.coalesce(C("_known") & before("_known") & follows(before), F.lit(False)),
            "_inside": C(t) >= C("start") + margin,
            "_agrees": F.coalesce(agrees, F.lit(False)),
            "_moved": either(before(f"_held_end_{m}") for m in movement),
            "_moves": either(C(f"_held_end_{m}") for m in movement),
            "_held": F.coalesce(C("_known") & (C(f"_code_{attack}") == 1), F.lit(False)),
            "_before_held": F.coalesce(before(f"_held_end_{attack}"), F.lit(False)),
            "_gap": C(t) - before(t),
        }
    )
    goes_on = C("_held") & C("_follows") & C("_before_held")
    rows = islands(rows.withColumn("_cut", ~goes_on), [*keys, "start"], order, C("_cut"), "_hold")
    hold = Window.partitionBy(*keys, "start", "_hold").orderBy(*order)
    rows = rows.withColumn("_run", F.row_number().over(hold) - 1 + F.first("_held").over(hold).cast("int"))
    turn = C("_known") & C("_follows") & C("_agrees") & C("_inside")
    counts = rows.groupBy(*keys, "start").agg(
        F.count("*").alias("commands"),
        F.count_if("_known").alias("known"),
        F.count_if(C("_known") & ~C("_follows")).alias("boundary_gaps"),
        *(F.count_if(C("_known") & C("_inside") & (C(f"_held_end_{m}") | C(f"_activity_{m}"))).alias(k) for k, m in buttons.items()),
        F.count_if(turn & ~C("_moved") & C("_moves")).alias("movement_start"),
        F.count_if(turn & C("_moved") & ~C("_moves")).alias("movement_stop"),
        F.coalesce(F.max(F.when(C("_inside") & C("_known"), C("_run"))), F.lit(0)).cast("long").alias("attack_run"),
        F.max("_gap").alias("_gap"),
        F.min(t).alias("_first"),
        F.max(t).alias("_last"),
    )
    out = windows.join(counts, [*keys, "start"], "left")
    filled = ["commands", "known", "boundary_gaps", *buttons, "movement_start", "movement_stop", "attack_run"]
    longest = F.when(C("_first").isNotNull(), F.greatest(F.coalesce("_gap", F.lit(0)), C("_first") - C("start"), C("end") - C("_last")))
    out = out.withColumns({c: F.coalesce(c, F.lit(0)) for c in filled} | {"max_gap": longest})
    marks = {"unknown": C("commands") - C("known"), "sustained_attack": C("attack_run") >= sustained, "covered": F.coalesce(C("max_gap") <= max_gap, F.lit(False))}
    return out.withColumns(marks).drop("_gap", "_first", "_last")


def coverage_report(candidates: DataFrame, keys: list[str], actions: list[str]) -> DataFrame:
    """Of each key: candidates, covered ones, known and unknown commands, and for each action how many candidates hint at
    it and how many covered ones do. A hint is a count above 0 or a true flag."""
    hint = {a: C(a).cast("long") > 0 for a in actions}
    return candidates.groupBy(*keys).agg(
        F.count("*").alias("candidates"),
        F.count_if("covered").alias("eligible"),
        F.sum("known").alias("known"),
        F.sum("unknown").alias("unknown"),
        *(F.count_if(h).alias(f"n_{a}") for a, h in hint.items()),
        *(F.count_if(h & C("covered")).alias(f"eligible_{a}") for a, h in hint.items()),
    )


def choose(candidates: DataFrame, key: str, source: str, round_: str, player: str, actions: list[str], picks: int, ordinary: float = 0.5) -> list:
    """Keys of at most `picks` covered candidates: an action-blind share first, then one for the action covered least."""
    return diverse(candidates.where("covered"), key, source, player, picks, round_, {a: C(a).cast("long") > 0 for a in actions}, ordinary)
