"""Interval, as-of, band and uniqueness joins. Ranges become equi-joins on cells, so both sides stay partitioned."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def interval_join(points: DataFrame, intervals: DataFrame, t: str, start: str = "start", end: str = "end", keys: tuple[str, ...] = (), closed: str = "left", width: int = 1024, how: str = "inner") -> DataFrame:
    """Points with every interval that holds them: [start, end), or (start, end] with closed='right'.

    An interval is entered in each cell of `width` that it touches; a point looks in its own cell. Choose a width near the
    usual length of an interval. Unknown times match nothing.
    """
    lo, hi = F.col(start), F.col(end)
    last = hi if closed == "right" else hi - 1
    cells = intervals.where(lo < hi).withColumn("_cell", F.explode(F.sequence(F.floor(lo / width), F.floor(last / width))))
    right = cells.select(*(F.col(c).alias(f"_{c}") if c in keys else F.col(c) for c in cells.columns))
    on = [F.col("p._cell") == right["_cell"], *(F.col(f"p.{k}") == right[f"_{k}"] for k in keys)]
    x = F.col(f"p.{t}")
    on.append((x > right[start]) & (x <= right[end]) if closed == "right" else (x >= right[start]) & (x < right[end]))
    left = points.withColumn("_cell", F.floor(F.col(t) / width)).alias("p")
    out = left.join(right, on, how)
    return out.select("p.*", *(right[c] for c in right.columns if c != "_cell" and c not in {f"_{k}" for k in keys})).drop("_cell")


def dyadic_nodes(start: Column, end: Column) -> Column:
    """(level, node) of the fewest aligned ranges of 2 ** level that make up [start, end): two of a level at most."""

    def at(k: Column) -> Column:
        first, last = -F.call_function("shiftright", -start, k), F.call_function("shiftright", end, k) - 1
        node = lambda x: F.struct(k.alias("level"), x.alias("node"))
        return F.array(F.when((first <= last) & (first % 2 != 0), node(first)), F.when((first <= last) & (last % 2 == 0), node(last)))

    return F.array_compact(F.flatten(F.transform(F.sequence(F.lit(0), F.lit(62)), at)))


def dyadic_join(points: DataFrame, intervals: DataFrame, t: str, start: str = "start", end: str = "end", keys: tuple[str, ...] = ()) -> DataFrame:
    """Points with every interval [start, end) that holds them, of any lengths in one table: whole numbers under 2 ** 61.

    An interval is entered as its dyadic_nodes(), under two for each doubling of its length; a point looks in one range of
    each level that some interval has. Levels of few ranges, which all points meet, are dealt out by a hash of the point.
    Both sides are shuffled: Spark's estimate of the ranges doesn't know how many an interval has, and would broadcast them.
    Empty intervals, null bounds and null points match nothing.
    """
    as_long = intervals.withColumns({"_lo": F.col(start).cast("long"), "_hi": F.col(end).cast("long")}).where("_lo < _hi")
    entered = as_long.withColumn("_n", F.explode(dyadic_nodes(F.col("_lo"), F.col("_hi")))).withColumns({"_level": F.col("_n.level"), "_node": F.col("_n.node")}).drop("_n", "_lo", "_hi")
    #: A row for each level, at most 63: how many ranges and keys its points are spread over.
    levels = entered.groupBy("_level").agg(F.approx_count_distinct(F.struct("_node", *keys)).alias("n")).collect()
    parts = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if not levels:
        deal = {0: 1}
    else:
        deal = {r["_level"]: max(1, -(-parts // max(1, r["n"]))) for r in levels}
    salts = F.create_map(*(x for k, n in sorted(deal.items()) for x in (F.lit(k), F.lit(n))))
    right = entered.withColumn("_salt", F.explode(F.sequence(F.lit(0), salts[F.col("_level")] - 1)))
    right = right.select(*(F.col(c).alias(f"_{c}") if c in keys else F.col(c) for c in right.columns))
    own = F.array(*(F.struct(F.lit(k).alias("level"), F.shiftright(F.col(t).cast("long"), k).alias("node"), F.pmod(F.xxhash64(t, F.monotonically_increasing_id()), F.lit(n)).cast("int").alias("salt")) for k, n in sorted(deal.items())))
    left = points.where(F.col(t).isNotNull()).withColumn("_own", F.explode(own)).alias("p")
    on = [F.col("p._own.level") == right["_level"], F.col("p._own.node") == right["_node"], F.col("p._own.salt") == right["_salt"], *(F.col(f"p.{k}") == right[f"_{k}"] for k in keys)]
    hidden = {"_level", "_node", "_salt", *(f"_{k}" for k in keys)}
    return left.join(right.hint("merge"), on).select(*(F.col(f"p.{c}") for c in points.columns), *(right[c] for c in right.columns if c not in hidden))


def asof_join(left: DataFrame, right: DataFrame, t: str, right_t: str, keys: tuple[str, ...], values: tuple[str, ...], strict: bool = False) -> DataFrame:
    """left with the values of the last right row of its keys at or before t (before, if strict); null where there is none.

    One sort by (keys, t) of both sides together; nothing is paired that is not wanted. Clocks keep the wider of their own
    types, so whole numbers beyond 2^53 stay apart.
    """
    rank = F.lit(1 if strict else -1)
    packed = F.struct(F.col(right_t).alias(right_t), *values)
    both = left.withColumns({"_t": F.col(t), "_side": F.lit(0), "_right": F.lit(None).cast(right.select(packed.alias("x")).schema["x"].dataType)})
    other = right.where(F.col(right_t).isNotNull()).select(*keys, F.col(right_t).alias("_t"), rank.alias("_side"), packed.alias("_right"))
    w = Window.partitionBy(*keys).orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    found = both.unionByName(other, allowMissingColumns=True).withColumn("_found", F.last("_right", ignorenulls=True).over(w)).where("_side = 0")
    return found.select(*left.columns, *(F.col("_found")[c].alias(f"asof_{c}") for c in (right_t, *values)))


def bracket_join(left: DataFrame, states: DataFrame, t: str, keys: tuple[str, ...], state_t: str, values: tuple[str, ...]) -> DataFrame:
    """left with the states at floor(t) and ceil(t): exact hits and one-tick brackets only; never extrapolated."""
    lo = states.select(*keys, F.col(state_t).alias("_lo"), *(F.col(v).alias(f"{v}_before") for v in values))
    hi = states.select(*keys, F.col(state_t).alias("_hi"), *(F.col(v).alias(f"{v}_after") for v in values))
    out = left.withColumns({"_lo": F.floor(t), "_hi": F.ceil(t)})
    return out.join(lo, [*keys, "_lo"], "left").join(hi, [*keys, "_hi"], "left").drop("_lo", "_hi")


def unique_join(left: DataFrame, right: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """left with the values of its one match and a status: matched, missing or ambiguous (values are null then)."""
    once = right.groupBy(*keys).agg(F.count("*").alias("_n"), *(F.first(v).alias(v) for v in values))
    out = left.join(once, keys, "left")
    status = F.when(F.col("_n").isNull(), "missing").when(F.col("_n") > 1, "ambiguous").otherwise("matched")
    return out.withColumns({"status": status, **{v: F.when(F.col("_n") == 1, F.col(v)) for v in values}}).drop("_n")


def band_join(left: DataFrame, right: DataFrame, keys: tuple[str, ...], t: str, right_t: str, below: int, above: int) -> DataFrame:
    """Pairs with right_t in [t - below, t + above]; a right row is entered in two cells of that width at most."""
    width = below + above + 1
    r = right.withColumn("_cell", F.explode(F.array_distinct(F.array(F.floor((F.col(right_t) - above) / width), F.floor((F.col(right_t) + below) / width)))))
    l_ = left.withColumn("_cell", F.floor(F.col(t) / width))
    return l_.join(r, [*keys, "_cell"]).where(F.col(right_t).between(F.col(t) - below, F.col(t) + above)).drop("_cell")


def offset_join(left: DataFrame, right: DataFrame, key: str, number: str, offsets: tuple[int, ...], value: str) -> DataFrame:
    """left with the value of right at number + each offset; each must be there exactly once, else it is null."""
    once = right.groupBy(key, number).agg(F.count("*").alias("_n"), F.min(value).alias("_v")).where("_n = 1").drop("_n")
    out = left
    for k in offsets:
        shifted = once.select(key, (F.col(number) - k).alias(number), F.col("_v").alias(f"{value}_{k}"))
        out = out.join(shifted, [key, number], "left")
    return out


def paired_once(left: DataFrame, right: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys of either side, a status (matched, ambiguous, left_only, right_only) and left_<value> and right_<value>, which
    are there where each side has the keys in just one row. Null keys meet nothing and stay with their side."""
    side = lambda df, n, v: df.groupBy(*keys).agg(F.count("*").alias(n), F.min(value).alias(v))
    both = side(left, "_a", f"left_{value}").join(side(right, "_b", f"right_{value}"), keys, "full_outer")
    status = F.when(F.col("_a").isNull(), "right_only").when(F.col("_b").isNull(), "left_only").when((F.col("_a") > 1) | (F.col("_b") > 1), "ambiguous").otherwise("matched")
    shown = [F.when(F.col("status") == "matched", F.col(f"{s}_{value}")).alias(f"{s}_{value}") for s in ("left", "right")]
    return both.withColumn("status", status).select(*keys, "status", *shown)


def compare_tables(left: DataFrame, right: DataFrame, key: str | list[str], columns: list[str]) -> DataFrame:
    """key (one column or more) and status of rows that differ: missing_left, missing_right or changed; NaN equals NaN."""
    key = [key] if isinstance(key, str) else key
    l_, r = left.select(*key, F.struct(*columns).alias("_l")), right.select(*key, F.struct(*columns).alias("_r"))
    status = F.when(F.col("_l").isNull(), "missing_left").when(F.col("_r").isNull(), "missing_right").when(~F.col("_l").eqNullSafe(F.col("_r")), "changed")
    return l_.join(r, key, "full_outer").select(*key, status.alias("status")).where("status is not null")


def not_covered(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys that only one side has, and which: 'missing' from right, 'added' by right."""
    missing = left.select(key).distinct().join(right.select(key).distinct(), key, "left_anti").withColumn("kind", F.lit("missing"))
    added = right.select(key).distinct().join(left.select(key).distinct(), key, "left_anti").withColumn("kind", F.lit("added"))
    return missing.unionByName(added)


def overlap(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    return (a_start < b_end) & (b_start < a_end)
