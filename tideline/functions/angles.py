"""Angles, distances and clock conversions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TICKS_PER_SECOND = 64
NS_PER_TICK = 15_625_000


def wrap_degrees(d: Column) -> Column:
    """The shortest signed rotation, in [-180, 180). Both remainders round, as in its SQL: with pmod, which takes the second
    for negative angles alone, a half turn that is off by the last bit stays one on one side only."""
    return ((d + 180.0) % 360.0 + 360.0) % 360.0 - 180.0


def finite(x: Column) -> Column:
    """Known, not NaN and not infinite; never null."""
    return F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))


def bad_fraction(x: Column) -> Column:
    """Outside [0, 1], or NaN or infinite. A null is no bad fraction."""
    return F.coalesce(F.isnan(x) | (x < 0) | (x > 1), F.lit(False))


def norm(*parts: Column) -> Column:
    return F.sqrt(sum((p * p for p in parts[1:]), parts[0] * parts[0]))


def default_when_present(x: Column, present: Column) -> Column:
    """0 for a null whose parent is known to be there; a null stays null otherwise."""
    return F.when(x.isNull() & present.eqNullSafe(True), F.lit(0)).otherwise(x)


def exact_turn(first: Column, second: Column) -> Column:
    """Sum of two wrapped turns; null where either is a half turn, whose direction is not known."""
    return F.when((F.abs(first) != 180.0) & (F.abs(second) != 180.0), first + second)


def ticks_to_seconds(t: Column) -> Column:
    return t / float(TICKS_PER_SECOND)


def ticks_to_ns(t: Column) -> Column:
    return t * F.lit(NS_PER_TICK).cast("long")


def interpolate(a: Column, b: Column, at: Column) -> Column:
    """Between a and b, at a place clamped to [0, 1]."""
    return a + (b - a) * F.greatest(F.lit(0.0), F.least(F.lit(1.0), at))


def interpolate_degrees(a: Column, b: Column, at: Column) -> Column:
    """The same along the shorter arc."""
    return wrap_degrees(a + wrap_degrees(b - a) * F.greatest(F.lit(0.0), F.least(F.lit(1.0), at)))


def rotate(m11: float, m12: float, m21: float, m22: float, x: Column, y: Column) -> tuple[Column, Column]:
    return m11 * x + m12 * y, m21 * x + m22 * y


def time_label(seconds: Column) -> Column:
    """m:ss.mmm"""
    ms = F.round(seconds * 1000).cast("long")
    return F.format_string("%d:%02d.%03d", F.floor(ms / 60000), F.floor(ms / 1000) % 60, ms % 1000)
