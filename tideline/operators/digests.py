"""Digests of tables that add up: of a row, of a range of keys, of ranges of ranges. A published table keeps its tree; a
table that is computed anew is compared from the root down, and only ranges that differ are opened."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.sources.scratch import written

#: Ranges of a node of the tree, and ranges of leaves that are looked up by name; more are joined.
FAN, MOST_NAMED = 16, 256


def row_hashes(columns: list[str]) -> list[Column]:
    """Two 64-bit hashes of a row; nulls are told apart from what is beside them by the column's number."""
    parts = [x for i, c in enumerate(columns) for x in (F.lit(i), F.col(c).isNull(), F.col(c))]
    return [F.xxhash64(F.lit(1), *parts).alias("h1"), F.xxhash64(F.lit(2), *reversed(parts)).alias("h2")]


def leaf_of(key: str, width: int) -> Column:
    """The range of a whole-number key; null keys have a range of their own."""
    return F.floor(F.col(key) / width).cast("long")


def digest_tree(df: DataFrame, key: str, columns: list[str], width: int) -> DataFrame:
    """level, node, n, s1, s2: the number of rows of each range and the sums of their hashes, whatever their order. Level 0
    has ranges of `width` keys, each further level FAN nodes of the one below, the last a single root (node 0, or -1 beside
    it where keys are negative, and null for null keys)."""
    wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    rows = df.select(leaf_of(key, width).alias("node"), *row_hashes([key, *columns]))
    level = written(rows.groupBy("node").agg(F.count("*").alias("n"), wide("h1").alias("s1"), wide("h2").alias("s2")).withColumn("level", F.lit(0)))
    out, k = level, 0
    while level.where("node not in (0, -1)").limit(1).count():
        k += 1
        level = written(level.groupBy(F.floor(F.col("node") / FAN).cast("long").alias("node")).agg(F.sum("n").alias("n"), F.sum("s1").cast("decimal(38,0)").alias("s1"), F.sum("s2").cast("decimal(38,0)").alias("s2")).withColumn("level", F.lit(k)))
        out = out.unionByName(level)
    return out.select("level", "node", "n", "s1", "s2")


@dataclass
class Comparison:
    """rows: key, status (missing, added, changed, repeated) of what differs; opened: leaves whose rows were read, of
    `leaves`; compared: nodes that were looked at on the way down."""

    rows: DataFrame
    opened: int
    leaves: int
    compared: int


def publish_with_digests(df: DataFrame, path: str, key: str, columns: list[str], width: int) -> None:
    """Write df by ranges of its key, and its tree beside it."""
    rows = df.select(key, *columns)
    rows.repartitionByRange(key).sortWithinPartitions(key).write.mode("errorifexists").option("compression", "zstd").parquet(f"{path}/rows")
    digest_tree(df.sparkSession.read.parquet(f"{path}/rows"), key, columns, width).write.mode("errorifexists").parquet(f"{path}/digests")


def _differing(mine: DataFrame, theirs: DataFrame) -> DataFrame:
    """Nodes of one level that aren't the same on both sides."""
    right = theirs.select(*(F.col(c).alias(f"_{c}") for c in ("node", "n", "s1", "s2")))
    both = mine.join(right, F.col("node").eqNullSafe(F.col("_node")) & F.coalesce(F.col("n"), F.col("_n")).isNotNull(), "full_outer")
    same = F.col("n").eqNullSafe(F.col("_n")) & F.col("s1").eqNullSafe(F.col("_s1")) & F.col("s2").eqNullSafe(F.col("_s2"))
    return both.where(~same).select(F.when(F.col("_n").isNull(), F.col("node")).otherwise(F.col("_node")).alias("node"))


def compare_with_published(spark: SparkSession, df: DataFrame, path: str, key: str, columns: list[str], width: int) -> Comparison:
    """How df, computed anew, differs from what was published at `path`: key and status of each difference."""
    kept = spark.read.parquet(f"{path}/digests")
    mine = written(digest_tree(df, key, columns, width))
    top = max(kept.agg(F.max("level")).first()[0] or 0, mine.agg(F.max("level")).first()[0] or 0)
    leaves, compared, open_nodes = kept.where("level = 0").count(), 0, None
    for level in range(top, -1, -1):
        sides = [t.where(F.col("level") == level).drop("level") for t in (mine, kept)]
        if open_nodes is not None:
            inside = F.floor(F.col("node") / FAN).cast("long")
            sides = [s.withColumn("_up", inside).join(open_nodes.select(F.col("node").alias("_parent")), F.col("_up").eqNullSafe(F.col("_parent")), "left_semi").drop("_up") for s in sides]
        compared += max(s.count() for s in sides)
        nodes = written(_differing(*sides))
        #: A tree that is lower than the other's has no nodes up here; what is below it is all open.
        if any(t.where(F.col("level") == level).isEmpty() for t in (mine, kept)):
            continue
        open_nodes = nodes
        if nodes.isEmpty():
            break
    if open_nodes is None:
        open_nodes = written(_differing(mine.where("level = 0").drop("level"), kept.where("level = 0").drop("level")))
    opened = open_nodes.count()
    chosen = [_within(t, open_nodes, opened, key, width) for t in (df.select(key, *columns), spark.read.parquet(f"{path}/rows"))]
    counted = [t.select(key, *row_hashes([key, *columns])).groupBy(key, "h1", "h2").agg(F.count("*").alias("n")) for t in chosen]
    return Comparison(_statuses(*counted, key), opened, leaves, compared)


def _within(rows: DataFrame, nodes: DataFrame, n: int, key: str, width: int) -> DataFrame:
    """The rows of the leaves named: a filter that reaches the scan where they are few, else a join."""
    if n > MOST_NAMED:
        return rows.withColumn("_leaf", leaf_of(key, width)).join(nodes.withColumnRenamed("node", "_node"), F.col("_leaf").eqNullSafe(F.col("_node")), "left_semi").drop("_leaf")
    named = [r["node"] for r in nodes.collect()]
    keep = F.lit(False)
    for x in named:
        keep = keep | (F.col(key).isNull() if x is None else F.col(key).between(x * width, (x + 1) * width - 1))
    return rows.where(keep)


def _statuses(mine: DataFrame, theirs: DataFrame, key: str) -> DataFrame:
    """A key's status by what rows each side has for it, and how often."""
    rows = lambda t: t.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("h1", "h2", "n"))).alias("rows"))
    a, b = rows(mine), rows(theirs).select(F.col(key).alias("_key"), F.col("rows").alias("_rows"))
    both = a.join(b, F.col(key).eqNullSafe(F.col("_key")), "full_outer").where(~F.col("rows").eqNullSafe(F.col("_rows")))
    kinds = lambda c: F.transform(c, lambda x: F.struct(x["h1"], x["h2"]))
    status = F.when(F.col("rows").isNull(), "missing").when(F.col("_rows").isNull(), "added").when(kinds("rows") == kinds("_rows"), "repeated").otherwise("changed")
    return both.select(F.coalesce(key, "_key").alias(key), status.alias("status"))
