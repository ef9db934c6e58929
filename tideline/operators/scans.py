"""Running work on a key without bound: an associative scan in two passes.

Rows are sorted into ranges of (keys, order), so that a key with most of the rows has most of the ranges. Each range sums
up what it adds to a running state: a sum, a maximum, a last value. The states before a range, combined, are one more row
in front of it; then each range runs by itself. No task holds more than a range, and what crosses ranges is a row each.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.sources.scratch import written

RANGE = "_range"


@dataclass(frozen=True)
class Running:
    """A state: how rows of a range, and ranges, are combined, and how it runs over rows."""

    value: Column
    combined: Callable[[Column], Column]
    run: Callable[[Column], Column] | None = None


def running_sum(value: Column) -> Running:
    return Running(value, F.sum)


def running_count(condition: Column | None = None) -> Running:
    """Rows so far for which the condition is known to be true; of all rows, the row's number."""
    return Running((F.lit(1) if condition is None else F.when(condition, 1).otherwise(0)).cast("long"), F.sum)


def running_max(value: Column) -> Running:
    return Running(value, F.max)


def running_min(value: Column) -> Running:
    return Running(value, F.min)


def ranged(df: DataFrame, keys: list[str], order: list[str], parts: int | None = None) -> DataFrame:
    """df in `parts` ranges of (keys, order), numbered in `_range` and written, as the numbers must not change between the
    passes. `order` should tell rows apart: equal rows share a range."""
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return written(df.repartitionByRange(n, *keys, *order).withColumn(RANGE, F.spark_partition_id()))


def _with_carry(rows: DataFrame, keys: list[str], order: list[str], states: dict[str, Callable], values: dict[str, Column]) -> tuple[DataFrame, Column]:
    """rows and, in front of each range that has ranges of its key before it, one row of their combined states; and the
    order in which both stand."""
    ours = rows.withColumns({**values, "_carry": F.lit(0)})
    per_range = ours.groupBy(*keys, RANGE).agg(*(f(F.col(name)).alias(name) for name, f in states.items()))
    before = Window.partitionBy(*keys).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    carried = per_range.select(*keys, RANGE, *(f(F.col(name)).over(before).alias(name) for name, f in states.items()), F.count("*").over(before).alias("_n"))
    fronts = carried.where("_n > 0").drop("_n").withColumn("_carry", F.lit(-1))
    return ours.unionByName(fronts, allowMissingColumns=True), Window.partitionBy(*keys, RANGE).orderBy("_carry", *order)


def scan(rows: DataFrame, keys: list[str], order: list[str], **adds: Running) -> DataFrame:
    """ranged() rows with a column for each running state: it includes the row itself, and is what a window over the whole
    key would give. Nulls add nothing. `_range` stays, for a further scan."""
    states = {f"_s_{name}": r.combined for name, r in adds.items()}
    both, w = _with_carry(rows, keys, order, states, {f"_s_{name}": r.value for name, r in adds.items()})
    w = w.rowsBetween(Window.unboundedPreceding, 0)
    out = both.select(*rows.columns, "_carry", *((r.run or r.combined)(F.col(f"_s_{name}")).over(w).alias(name) for name, r in adds.items()))
    return out.where("_carry = 0").drop("_carry")


def previous(rows: DataFrame, keys: list[str], order: list[str], columns: list[str], prefix: str = "previous_") -> DataFrame:
    """ranged() rows with the columns of the row before in its key (null for the first), and `<prefix>row`: there is one."""
    whole = F.struct(*order, *(F.col(c).alias(f"_{c}") for c in columns))
    both, w = _with_carry(rows, keys, order, {"_last": F.max}, {"_last": whole})
    before = F.lag("_last").over(w)
    out = both.withColumn("_before", before).where("_carry = 0")
    return out.select(*rows.columns, *(F.col("_before")[f"_{c}"].alias(f"{prefix}{c}") for c in columns), F.col("_before").isNotNull().alias(f"{prefix}row"))


def last_known(rows: DataFrame, keys: list[str], order: list[str], columns: list[str], prefix: str = "last_") -> DataFrame:
    """ranged() rows with the last value so far of each column that isn't null."""
    values = {f"_l_{c}": F.when(F.col(c).isNotNull(), F.struct(*order, F.col(c).alias("_value"))) for c in columns}
    both, w = _with_carry(rows, keys, order, dict.fromkeys(values, F.max), values)
    w = w.rowsBetween(Window.unboundedPreceding, 0)
    found = both.select(*rows.columns, "_carry", *(F.last(f"_l_{c}", ignorenulls=True).over(w)["_value"].alias(f"{prefix}{c}") for c in columns))
    return found.where("_carry = 0").drop("_carry")


def scanned_islands(rows: DataFrame, keys: list[str], order: list[str], watched: list[str], starts: Callable[[Callable[[str], Column]], Column], name: str = "island") -> DataFrame:
    """ranged() rows with the number of their island: `starts`, given a function from a watched column to its value in the
    row before, says where one begins; the first row of a key always does, and so does one of which that isn't known."""
    flagged = previous(rows, keys, order, watched, "_p_")
    cut = F.coalesce(~F.col("_p_row") | starts(lambda c: F.col(f"_p_{c}")), F.lit(True))
    flagged = written(flagged.withColumn("_cut", cut).select(*rows.columns, "_cut"))
    return scan(flagged, keys, order, **{name: running_count(F.col("_cut"))}).drop("_cut")
