"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from tideline.llm.shared import stored

#: A table of sources of at most so many rows is broadcast; a longer one is joined by a shuffle.
BROADCAST_ROWS = 10_000
#: Terms of the Poisson distribution that are added up: so many standard deviations and as many more on both sides of the
#: mean. The rest is under 1e-19 for any mean, and a draw has 52 bits.
SPREAD, TERMS = 10.0, 30


def uniform(seed: str, *parts: Column) -> Column:
    """A number in [0, 1) with 52 bits of the md5 of the seed and the parts."""
    text = F.concat_ws("|", F.lit(seed), *(F.coalesce(p.cast("string"), F.lit("null")) for p in parts))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / float(2**52)


def poisson(rate: float) -> tuple[int, np.ndarray]:
    """first, below: below[i] is the probability of at most first + i. Terms are built from the mode outwards, so no
    rate is too large for the first of them."""
    far = SPREAD * rate**0.5 + TERMS
    first, mode, last = max(0, int(rate - far)), int(rate), int(rate + far) + 1
    fewer = np.cumprod(np.arange(mode, first, -1) / rate)[::-1] if mode > first else np.zeros(0)
    below = np.cumsum(np.concatenate([fewer, [1.0], np.cumprod(rate / np.arange(mode + 1, last + 1))]))
    return first, below / below[-1]


def rates(docs: DataFrame, weights: dict[str | None, float] | None = None, alpha: float = 0.5, size: float = 1.0) -> DataFrame:
    """source, n, rate, first, below: rate is the mean number of copies of a document that brings its source to its target.

    Targets are `weights` (sources left out get none), or each source's count to the power alpha; they are scaled so that
    the mix has size * count rows in the mean. below[i] is the probability of at most first + i copies. A null source is
    one source, which `weights` knows as None. `docs` is read for the counts only.
    """
    n = docs.groupBy("source").agg(F.count("*").alias("n"))
    if weights is None:
        target = F.pow(F.col("n").cast("double"), F.lit(alpha))
    else:
        pairs = [F.lit(x) for k, v in weights.items() if k is not None for x in (k, float(v))]
        named = F.coalesce(F.create_map(*pairs)[F.col("source")], F.lit(0.0)) if pairs else F.lit(0.0)
        target = F.when(F.col("source").isNull(), F.lit(float(weights.get(None, 0.0)))).otherwise(named)
    n = stored(n.withColumn("target", target), "rates")
    total, goal = n.agg(F.sum("n"), F.sum("target")).first()
    rate = F.col("target") / F.lit(float(goal or 1)) * F.lit(float(total or 0) * size) / F.col("n")
    known = n.withColumn("rate", rate).select("source", "n", "rate")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, below = zip(*map(poisson, batch.column("rate").to_pylist()), strict=True) if batch.num_rows else ((), ())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(first, pa.int64()), pa.array(below, pa.list_(pa.float64()))], [*batch.schema.names, "first", "below"])

    return known.mapInArrow(run, StructType([*known.schema, StructField("first", LongType()), StructField("below", ArrayType(DoubleType()))]))


def mix_sources(docs: DataFrame, weights: dict[str | None, float] | None = None, alpha: float = 0.5, size: float = 1.0, seed: str = "mix-1") -> DataFrame:
    """The rows of docs, each as often as a Poisson draw with its source's rate says, in one global random order.

    The draw inverts the distribution at a hash of (seed, doc_id), so it is the same on every run and any partitioning.
    Added columns: copy (from 0), rate, order_key, a uniform hash: equal ranges of it are the partitions, each sorted by
    it, so no sample of the rows is taken to find the bounds. Null doc_ids draw
    alike, as do repeated rows; a null source is a source; an empty table gives an empty mix. Columns named like the
    added ones are replaced.
    """
    table = rates(docs, weights, alpha, size).select(F.col("source").alias("_source"), "rate", "first", "below")
    table = stored(table, "below")
    table = F.broadcast(table) if table.count() <= BROADCAST_ROWS else table
    kept = docs.drop("copy", "rate", "order_key")
    drawn = kept.join(table, kept["source"].eqNullSafe(table["_source"])).withColumn("_u", uniform(seed, kept["doc_id"]))
    n = F.col("first") + F.size(F.filter("below", lambda p: p <= F.col("_u")))
    copies = drawn.withColumn("_n", n).where("_n > 0").withColumn("copy", F.explode(F.sequence(F.lit(0), (F.col("_n") - 1).cast("int"))))
    copies = copies.withColumn("order_key", F.md5(F.concat_ws("|", F.lit(f"{seed}-order"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("copy").cast("string"))))
    out = copies.drop("_source", "_u", "_n", "first", "below")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = F.conv(F.substring("order_key", 1, 8), 16, 10).cast("long")
    return out.repartitionById(parts, F.shiftright(at * parts, 32).cast("int")).sortWithinPartitions("order_key")
