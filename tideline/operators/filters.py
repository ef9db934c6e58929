"""Predicates on identity, liveness and intervals."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def same_identity(left: dict[str, Column], right: dict[str, Column], null_equal: bool = True) -> Column:
    """Equal as strings in every key; with null_equal=False an unknown part makes them differ."""
    pairs = [(left[k].cast("string"), right[k].cast("string")) for k in left]
    if null_equal:
        return reduce(lambda a, b: a & b, (x.eqNullSafe(y) for x, y in pairs))
    return reduce(lambda a, b: a & b, (F.coalesce(x == y, F.lit(False)) for x, y in pairs))


def half_open(t: Column, a: Column | int, b: Column | int) -> Column:
    """a <= t < b"""
    return (t >= a) & (t < b)


def left_open(t: Column, a: Column | int, b: Column | int) -> Column:
    """a < t <= b"""
    return (t > a) & (t <= b)


def known_false(*flags: Column) -> Column:
    """Every flag is known and false."""
    return reduce(lambda a, b: a & b, (f.eqNullSafe(False) for f in flags))


def not_known_true(*flags: Column) -> Column:
    """No flag is known to be true; unknown ones pass."""
    return reduce(lambda a, b: a & b, (~F.coalesce(f, F.lit(False)) for f in flags))


def live(alive: Column, *flags: Column) -> Column:
    """Known to be alive, and no flag (warm-up, freeze, pause) known to be true."""
    return F.coalesce(alive, F.lit(False)) & not_known_true(*flags)


def members(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids.select(key).distinct(), key, "left_semi")


def in_any_window(df: DataFrame, windows: DataFrame, t: str, margin: int = 0, width: int = 1024) -> DataFrame:
    """Rows whose t lies in some window [start, end) widened by margin; an equi-join on cells of `width`."""
    lo, hi = F.col("start") - margin, F.col("end") + margin
    cells = windows.select(lo.alias("_lo"), hi.alias("_hi"), F.explode(F.sequence(F.floor(lo / width), F.floor((hi - 1) / width))).alias("_cell"))
    return df.withColumn("_cell", F.floor(F.col(t) / width)).alias("l").join(cells, (F.col("l._cell") == cells["_cell"]) & (F.col(t) >= F.col("_lo")) & (F.col(t) < F.col("_hi")), "left_semi").drop("_cell")
