"""Reasons, masks and observations over nested commands: what a label may say, field by field, and why it may not."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tideline.functions import reasons
from tideline.functions.bits import any_bit, decode


def sorted_reasons(rules: list[tuple[Column, str]]) -> Column:
    """The names of the rules that hold, in order of the names, each once; an unknown outcome doesn't hold."""
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*(F.when(when, F.lit(name)) for when, name in rules)))))


def fraction_rules(items: Column, name: str, fractions: list[str], invalid: str, closed: bool = True) -> list[tuple[Column, str]]:
    """Rules of a list of structs with fractions of a tick: the list is missing, an item is null, a fraction is outside
    [0, 1] ([0, 1) unless closed) or no number. A null fraction has the default 0 and is fine."""
    def outside(x: Column) -> Column:
        wrong = [x[f].isNotNull() & (F.isnan(x[f]) | (x[f] < 0) | ((x[f] > 1) if closed else (x[f] >= 1))) for f in fractions]
        return F.coalesce(F.array_contains(F.array(*wrong), True), F.lit(False))

    return [(items.isNull(), f"missing_{name}"), (F.exists(items, lambda x: x.isNull()), f"invalid_{name}"), (F.exists(items, outside), invalid)]


def chunk_rules(rows: list[dict[str, Column]], identity: list[str], rising: list[str], generation: str, flags: dict[str, bool]) -> list[tuple[Column, str]]:
    """Rules of consecutive commands: one identity, flags known to be as they must, clocks that rise by one, and the
    generation clock by zero to two."""
    rules = []
    for i, row in enumerate(rows):
        rules += [(~row[c].eqNullSafe(rows[0][c]), reasons.COMMAND_IDENTITY_CHANGED) for c in identity]
        rules += [(~row[c].eqNullSafe(F.lit(want)), f"command_{c}_not_{str(want).lower()}") for c, want in flags.items()]
        if i:
            before = rows[i - 1]
            rules += [(~row[c].eqNullSafe(before[c] + 1), f"{c}_discontinuity") for c in rising]
            step = row[generation] - before[generation]
            rules.append((~F.coalesce(step.between(0, 2), F.lit(False)), generation + reasons.OUTSIDE_MEASURED_GENERATION_CADENCE))
            rules.append((~F.coalesce(row["row_id"] > before["row_id"], F.lit(False)), reasons.CANONICAL_SOURCE_ORDER_NOT_STRICTLY_INCREASING))
    return rules


def masked(value: Column, against: Column) -> Column:
    """A cell: the value where there is no reason against it; else null, not valid, with the reasons."""
    fine = (F.size(against) == 0) & value.isNotNull()
    return F.struct(F.when(fine, value).alias("value"), fine.alias("valid"), F.when(fine, F.array().cast("array<string>")).otherwise(against).alias("reason_codes"))


def button_observation(present: dict[str, tuple[Column, Column]], flags: Column, planes: list[tuple[Column, Column]], mask: int) -> Column:
    """observation (the decoded code of a button) and reason, the first that forbids one.

    present: of each parent, whether it was seen in the raw bytes and whether the column says so. planes: each raw value
    and its column; a raw value that is absent is zero only because its parent is there.
    """
    reason = F.lit(None).cast("string")
    steps = []
    for name, (raw, said) in present.items():
        steps += [(~raw.eqNullSafe(said), f"{name}_presence_mismatch"), (~raw, f"missing_{name}_parent")]
    steps.append((F.coalesce(flags, F.lit(0)) != 0, reasons.UNSUPPORTED_COMMAND_FLAGS))
    steps += [(~raw.eqNullSafe(said), reasons.BUTTON_PROJECTION_MISMATCH) for raw, said in planes]
    for when, name in reversed(steps):
        reason = F.when(when, name).otherwise(reason)
    zero = [F.coalesce(raw, F.lit(0)) for raw, _ in planes]
    return F.struct(F.when(reason.isNull(), decode(*zero, mask)["code"]).alias("observation"), reason.alias("reason"))


def replay_held(held: Column, events: Column) -> Column:
    """Errors of a list of (offset, pressed) applied to a held state in order: action_event_not_a_transition where an
    event repeats the state, action_events_out_of_order where an offset falls. The state after a wrong event is its own."""
    start = F.struct(held.alias("held"), F.lit(-1).cast("long").alias("offset"), F.lit(False).alias("repeats"), F.lit(False).alias("falls"))
    step = lambda a, e: F.struct(e["pressed"].alias("held"), e["offset"].cast("long").alias("offset"), (a["repeats"] | (a["held"] == e["pressed"])).alias("repeats"), (a["falls"] | (e["offset"] < a["offset"])).alias("falls"))
    end = F.aggregate(events, start, step)
    return sorted_reasons([(end["repeats"], reasons.ACTION_EVENT_NOT_A_TRANSITION), (end["falls"], reasons.ACTION_EVENTS_OUT_OF_ORDER)])


def held_fields(planes: list[Column], changed: list[Column], mask: int) -> dict[str, Column]:
    """held_start, held_mid, held_end and net_changed of a button over three rows, before any mask."""
    held = [any_bit(p, mask) for p in planes]
    return {"held_start": held[0], "held_mid": held[1], "held_end": held[2], "net_changed": any_bit(changed[0], mask) != any_bit(changed[1], mask)}
