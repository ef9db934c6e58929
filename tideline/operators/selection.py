"""Deterministic selection: hash order, round robins, and a greedy diverse pick."""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

C = F.col
#: Rows that a pick looks at first.
NEAR = 8192


def hash_order(key: str) -> Column:
    return F.sha2(F.col(key).cast("string"), 256)


def round_robin(df: DataFrame, groups: list[str], key: str) -> DataFrame:
    """df with `turn`: the place of a row within its group by the hash of its key. Ordered by turn, groups take turns."""
    return df.withColumn("turn", F.row_number().over(Window.partitionBy(*groups).orderBy(hash_order(key))))


def first_turns(df: DataFrame, groups: list[str], key: str, turns: int) -> DataFrame:
    """round_robin(), of the first `turns` turns alone: Spark keeps that many rows of a group in each partition before the
    shuffle (its group limit, for up to spark.sql.optimizer.windowGroupLimitThreshold, 1000), so a group may be of any size."""
    return round_robin(df, groups, key).where(F.col("turn") <= turns)


def dealt_turns(df: DataFrame, groups: list[str], key: str, n: int) -> DataFrame:
    """The first n rows when groups take turns, with their `turn`: no group gives more than n of them."""
    return first_turns(df, groups, key, n).orderBy("turn", *groups).limit(n)


def _counted(column: str, counts: Counter) -> Column:
    """The count of a column's value, 0 where it has none."""
    out = F.lit(0)
    for n in sorted(set(counts.values())):
        out = F.when(C(column).isin([k for k, v in counts.items() if v == n]), n).otherwise(out)
    return out


def diverse(df: DataFrame, key: str, source: str, player: str, picks: int, round_: str | None = None, actions: dict[str, Column] | None = None, ordinary: float = 0.5, near: int = NEAR) -> list:
    """Keys picked one after another, each the least (picks of its source, of its source and round, of its source and
    player, hash of the key) among all rows not yet picked.

    The first ceil(ordinary * n) of the n picks look at no action. Each later one is for the action that the picks cover
    least, ties to the earlier in `actions` (name: is it in the row?), of those that a row not yet picked has; where none
    has any, all rows stand. Keys are unique: rows of one key are picked at once, and rows without a key are not picked.

    Each pick changes the counts for the next one, so each is a job. It looks at the rows of the least hashes, about NEAR of
    them, and for each (source, round, actions) at the least hash beyond, as of a row whose player has no picks: no row
    beyond comes before that one. Where it comes first, the pick isn't known yet, and NEAR is made 16 times as large, at
    last all rows. So the result is that over all rows; only `picks`, which is the feature's own limit, bounds the jobs.
    """
    actions = actions or {}
    group = lambda *c: F.to_json(F.struct(*(C(x).alias(f"c{i}") for i, x in enumerate(c))))
    spread = {"s": group(source), "r": group(source, round_) if round_ else F.lit(""), "p": group(source, player)}
    hints = {f"a{i}": F.coalesce(x, F.lit(False)) for i, x in enumerate(actions.values())}
    df = df.where(C(key).isNotNull())
    rows = df.select(C(key).alias("key"), hash_order(key).alias("h"), *(x.alias(k) for k, x in (spread | hints).items()))
    total, size = df.count(), near
    seen, n = _nearest(rows, total, size, hints), None
    try:
        counts: dict[str, Counter] = {k: Counter() for k in spread}
        covered: Counter = Counter()
        out: list = []
        taken: list[str] = []
        while True:
            if n is None:
                found = seen.where("known").select("h").distinct().count()
                if found < picks and size < total:
                    size, seen = _widened(rows, total, size, hints, seen)
                    continue
                n = min(picks, found)
                blind = math.ceil(n * ordinary)
            if len(out) >= n:
                return out
            #: The player of a row beyond counts as one without picks.
            order = F.struct(*(F.when(C("known") | F.lit(k != "p"), _counted(k, counts[k])).otherwise(0).alias(f"n_{k}") for k in spread if k != "r" or round_), "h", "key", "known", *spread, *hints)
            sought = [None, *(hints if len(out) >= blind else [])]
            least = [F.min("order" if a is None else F.when(C(a), C("order"))).alias(a or "any") for a in sought]
            best = (seen.where(~C("known") | ~C("h").isin(taken)) if taken else seen).withColumn("order", order).agg(*least).first()
            action = min((a for a in sought[1:] if best[a]), key=lambda a: covered[a], default="any")
            pick = best[action]
            if not pick["known"]:
                size, seen = _widened(rows, total, size, hints, seen)
                continue
            out.append(pick["key"])
            taken.append(pick["h"])
            for k in spread:
                counts[k][pick[k]] += 1
            covered.update(a for a in hints if pick[a])
    finally:
        seen.unpersist()


def _nearest(rows: DataFrame, total: int, size: int, hints: dict[str, Column]) -> DataFrame:
    """About `size` rows of the least hashes, `known`, and one for each group of the others with the least hash of them."""
    if size >= total:
        return rows.withColumn("known", F.lit(True)).persist()
    bound = F.lit(f"{(size << 60) // total:015x}")
    beyond = rows.where(C("h") >= bound).groupBy("s", "r", *hints).agg(F.min("h").alias("h")).withColumn("known", F.lit(False))
    return rows.where(C("h") < bound).withColumn("known", F.lit(True)).unionByName(beyond, allowMissingColumns=True).persist()


def _widened(rows: DataFrame, total: int, size: int, hints: dict[str, Column], seen: DataFrame) -> tuple[int, DataFrame]:
    seen.unpersist()
    return size * 16, _nearest(rows, total, size * 16, hints)
