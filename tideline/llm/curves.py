"""Approximate nearest neighbours by shifted Hilbert curves.

Vectors are projected several times to a few dimensions, shifted, and ordered along a Hilbert curve. Spark sorts every
order by ranges; an order's ranks are cut into blocks, and a query is compared with its own block and the two beside it
on every curve. Candidates of all curves merge and keep their exact scores. How wide a block must be depends on the
data: it is measured on a bounded sample of queries against all rows.

Vectors are dealt into levels by their lengths, each with its own curves, scale and width: one vector far longer than
the others would otherwise put all of them at one pole. A query is looked up on the curves of every level.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, StructField, StructType

from tideline.llm.shared import stored


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of cell numbers (each under 2 ** bits)."""
    x = cells.astype(np.int64).copy()
    dims = x.shape[1]
    q = 1 << (bits - 1)
    while q > 1:
        for i in range(dims):
            on = (x[:, i] & q) != 0
            change = np.where(on, 0, (x[:, 0] ^ x[:, i]) & (q - 1))
            x[:, 0] ^= np.where(on, q - 1, change)
            x[:, i] ^= change if i else 0
        q >>= 1
    for i in range(1, dims):
        x[:, i] ^= x[:, i - 1]
    flip = np.zeros(len(x), np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        flip = np.where(x[:, -1] & q, flip ^ (q - 1), flip)
        q >>= 1
    x ^= flip[:, None]
    key = np.zeros(len(x), np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = key << 1 | ((x[:, i] >> b) & 1)
    return key


#: Levels of lengths: so many at most, of a factor of two each where they are fewer; one of less rows than a block is part
#: of the longer one before it. Queries of one block that are compared in one group.
MOST_LEVELS, MOST_QUERIES = 32, 8192


def log_lengths(vectors: np.ndarray) -> np.ndarray:
    """The binary logarithms of the rows' lengths, which no square over- or underflows."""
    most = np.abs(vectors).max(axis=1)
    return np.log2(most) + np.log2(((vectors / most[:, None]) ** 2).sum(axis=1)) / 2


def with_lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of vec_id and vector, all of one size, with their `length`: its logarithm."""
    for batch in batches:
        if batch.num_rows:
            vector = batch.column("vector")
            lengths = log_lengths(as_matrix(vector, len(vector.flatten()) // len(vector)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lengths)], [*batch.schema.names, "length"])


def levels_of(counts: list[tuple[int, int, float]], least: int) -> list[tuple[int, float]]:
    """(octave, log-length of the longest) with which each level begins, from (octave, rows, longest) of each octave below
    the longest vector. An octave of under `least` rows joins the longer one before it; of more than MOST_LEVELS levels the
    adjoining two of fewest rows become one."""
    out: list[list] = []
    for octave, n, top in sorted(counts):
        if out and n < least:
            out[-1][1] += n
        else:
            out.append([octave, n, top])
    while len(out) > MOST_LEVELS:
        i = min(range(len(out) - 1), key=lambda i: out[i][1] + out[i + 1][1])
        out[i][1] += out.pop(i + 1)[1]
    return [(octave, top) for octave, _, top in out]


class Curves:
    """The projections and shifts of all curves; the vectors of a level are scaled by its longest to a sphere on which
    nearness is the inner product."""

    def __init__(self, size: int, curves: int, dims: int, seed: int = 7):
        draw, dims = np.random.default_rng(seed), min(dims, size + 1)
        self.dims, self.bits = dims, 60 // dims
        self.frames = [np.linalg.qr(draw.normal(size=(size + 1, dims)))[0] * np.sqrt(size + 1) * 1.2 for _ in range(curves)]
        self.shifts = draw.random((curves, dims)) / 2

    def keys(self, vectors: np.ndarray, shares: np.ndarray) -> np.ndarray:
        """shares: the length of each vector as a share of its level's longest; of a query, 1."""
        on = vectors / np.abs(vectors).max(axis=1, keepdims=True)
        shares = np.minimum(shares, 1.0)[:, None]
        on = np.hstack([on / np.linalg.norm(on, axis=1, keepdims=True) * shares, np.sqrt(1 - shares**2)])
        top = (1 << self.bits) - 1
        out = []
        for frame, shift in zip(self.frames, self.shifts, strict=True):
            unit = (0.5 + np.arctan(on @ frame) / np.pi) / 2 + shift
            out.append(hilbert(np.minimum((unit * (top + 1)).astype(np.int64), top), self.bits))
        return np.stack(out, 1)


def as_matrix(column: pa.Array, size: int) -> np.ndarray:
    values = column.flatten() if hasattr(column, "flatten") else column
    return values.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def scores_of(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products of rows, each summed in the same order wherever it stands, so that equal vectors tie."""
    return (q * v).sum(-1)


def best_of(queries: np.ndarray, q_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int, itself: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query place, id, score) of the k best rows for each query, ties to smaller ids; `itself`: its own row counts too."""
    out: list[tuple] = []
    #: What rounding can make of a product grows with both lengths, not with the product.
    slack = 1e-13 * vectors.shape[-1] * np.linalg.norm(queries, axis=1) * np.linalg.norm(vectors, axis=1).max(initial=0.0)
    for a in range(0, len(queries), 256):
        rough = queries[a : a + 256] @ vectors.T
        for j, row in enumerate(rough):
            at = np.arange(len(ids))
            if len(ids) > k + 1:
                edge = np.partition(row, len(ids) - k - 1)[len(ids) - k - 1]
                at = np.flatnonzero(row >= edge - max(slack[a + j], 1e-9 * abs(edge)))
            at = at if itself else at[ids[at] != q_ids[a + j]]
            exact = scores_of(queries[a + j], vectors[at])
            by = np.lexsort((ids[at], -exact))[:k]
            out.append((np.full(len(by), a + j), ids[at][by], exact[by]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))


def valid_vectors(table: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """vec_id, vector: rows with an id and a finite, non-zero vector of the usual size (the most frequent; ties: the longest).
    Vectors of floats stay floats, which are half as long to send; scores are computed in double precision."""
    vector = F.col(vector_column)
    if table.schema[vector_column].dataType != ArrayType(FloatType()):
        vector = vector.cast("array<double>")
    rows = table.select(F.col(id_column).cast("long").alias("vec_id"), vector.alias("vector"))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & fine)
    sizes = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    return rows.where(F.size("vector") == (sizes[0]["size"] if sizes else 0))


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, id_column: str = "vec_id", vector_column: str = "embedding", curves: int = 16, dims: int = 6, recall: float = 0.96, sample: int = 96, least_block: int = 128, most_block: int = 2048) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows of largest inner product found for each row whose id `every` divides.

    Null, zero and non-finite vectors take no part, nor do vectors of an unusual size or without an id. Of equal vectors
    only the k + 1 smallest ids can be among anyone's nearest, so only these are indexed. Repeated rows of one id count
    once (the smallest vector). With fewer rows than k + 1, all are returned. A query meets blocks as far to both sides as
    `recall` of the true neighbours of `sample` queries (drawn by hash) needs, measured for each level of lengths; a block
    has `most_block` rows at most, and a wider reach is more blocks, not larger ones. Queries that crowd at one block are
    dealt into groups of some MOST_QUERIES by a hash, each with the block's rows. A small table is one block and its result
    exact. Queries of equal vectors are asked once, for k + 1 rows, and each leaves itself out. Very long vectors are rows
    like others; of components whose products overflow the scores are infinite or no numbers. Columns beside the two named
    are left out.
    """
    spark = vectors.sparkSession
    rows = valid_vectors(vectors, id_column, vector_column).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    rows = stored(rows.mapInArrow(with_lengths, StructType([*rows.schema, StructField("length", DoubleType())])), "vectors")
    size, longest, n = rows.agg(F.max(F.size("vector")), F.max("length"), F.count("*")).first()
    out = "query_id long, rank int, vec_id long, score double"
    if not n:
        return spark.createDataFrame([], out)
    #: Goes to the tasks in their closure, by value.
    plan = Curves(size, curves, dims)
    octave = F.floor(F.lit(longest) - F.col("length")).cast("int")
    #: A row for each octave of a double's range at most.
    counts = rows.groupBy(octave.alias("octave")).agg(F.count("*").alias("n"), F.max("length").alias("longest")).collect()
    levels = levels_of([tuple(r) for r in counts], most_block)
    tops = np.array([top for _, top in levels])
    level = sum((F.when(octave >= first, 1).otherwise(0) for first, _ in levels[1:]), F.lit(0))
    same = Window.partitionBy(F.xxhash64(F.lit(1), "vector"), F.xxhash64("vector", F.lit(2))).orderBy("vec_id")
    kept = rows.withColumn("_copy", F.row_number().over(same)).where(F.col("_copy") <= k + 1)
    kept = stored(kept.select("vec_id", "vector", "length", level.alias("level")), "indexed")
    asking = rows.where(F.col("vec_id") % every == 0).select("vec_id", "vector")
    alike = stored(asking.groupBy("vector").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("n")), "asked")
    queries = alike.select("vec_id", "vector")
    #: A curve of a level has a number of its own: level * curves + curve.
    entry, spaces = "curve int, key long, is_query boolean, vec_id long", curves * len(levels)

    def entries_of(keys: np.ndarray, of: np.ndarray, ids: np.ndarray, is_query: bool) -> pa.RecordBatch:
        at = of[:, None] * curves + np.arange(curves)
        return pa.RecordBatch.from_arrays([pa.array(at.ravel().astype(np.int32)), pa.array(keys.ravel()), pa.array(np.full(keys.size, is_query)), pa.array(np.repeat(ids, curves))], ["curve", "key", "is_query", "vec_id"])

    def enter(batches):
        for batch in batches:
            of, length = batch.column("level").to_numpy(), batch.column("length").to_numpy()
            keys = plan.keys(as_matrix(batch.column("vector"), size), np.exp2(length - tops[of]))
            yield entries_of(keys, of, batch.column("vec_id").to_numpy(), False)

    def ask(batches):
        for batch in batches:
            if batch.num_rows:
                keys = plan.keys(as_matrix(batch.column("vector"), size), np.ones(batch.num_rows))
                for i in range(len(tops)):
                    yield entries_of(keys, np.full(batch.num_rows, i), batch.column("vec_id").to_numpy(), True)

    entries = kept.where("level is not null").mapInArrow(enter, entry).unionByName(queries.mapInArrow(ask, entry))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = entries.repartitionByRange(parts, "curve", "key", "vec_id", "is_query").sortWithinPartitions("curve", "key", "vec_id", "is_query")

    def number(batches):
        part, seen = TaskContext.get().partitionId(), np.zeros(spaces, np.int64)
        for batch in batches:
            curve = batch.column("curve").to_numpy(zero_copy_only=False)
            row = ~batch.column("is_query").to_numpy(zero_copy_only=False)
            place = np.zeros(len(curve), np.int64)
            for c in np.unique(curve):
                at = np.flatnonzero(curve == c)
                before = seen[c] + np.cumsum(row[at]) - row[at]
                place[at], seen[c] = before, seen[c] + row[at].sum()
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(curve), part, np.int32)), batch.column("curve"), pa.array(place), batch.column("is_query"), batch.column("vec_id")], ["part", "curve", "place", "is_query", "vec_id"])

    placed = stored(ordered.mapInArrow(number, "part int, curve int, place long, is_query boolean, vec_id long"), "placed")
    #: A row for each range and curve of a level that meet: under ranges + curves of them.
    totals = sorted((r["curve"], r["part"], r["n"]) for r in placed.where("not is_query").groupBy("curve", "part").agg(F.count("*").alias("n")).collect())
    seen = {(r["curve"], r["part"]) for r in placed.select("curve", "part").distinct().collect()}
    counted, offsets, before = {(c, p): m for c, p, m in totals}, [], {}
    for c, p in sorted(seen):
        offsets.append((c, p, before.get(c, 0)))
        before[c] = before.get(c, 0) + counted.get((c, p), 0)
    ranks = placed.join(F.broadcast(spark.createDataFrame(offsets, "curve int, part int, offset long")), ["curve", "part"]).select("curve", (F.col("place") + F.col("offset")).alias("rank"), "is_query", "vec_id")

    widths = _widths(queries, kept, ranks, size, k, sample, recall, least_block, curves, len(levels))
    blocks = [min(w, most_block) for w in widths]
    of = F.floor(F.col("curve") / curves) + 1
    block, reach = (F.element_at(F.array(*map(F.lit, x)), of.cast("int")) for x in (blocks, [-(-w // b) for w, b in zip(widths, blocks, strict=True)]))
    block_of = F.floor(F.col("rank") / block)
    asked = ranks.where("is_query").select("curve", F.explode(F.sequence(block_of - reach, block_of + reach)).alias("block"), "vec_id").where("block >= 0")
    #: Blocks that too many queries ask for one group to hold them.
    crowded = asked.groupBy("curve", "block").agg(F.ceil(F.count("*") / MOST_QUERIES).cast("int").alias("groups")).where("groups > 1")
    crowded = stored(crowded, "crowded")
    groups = F.coalesce("groups", F.lit(1))
    asked = asked.join(crowded, ["curve", "block"], "left").withColumn("part", F.pmod(F.xxhash64("vec_id"), groups).cast("int")).drop("groups")
    data = ranks.where("not is_query").select("curve", block_of.alias("block"), "vec_id").join(crowded, ["curve", "block"], "left")
    data = data.withColumn("part", F.explode(F.sequence(F.lit(0), groups - 1))).drop("groups")
    data = data.join(kept.select("vec_id", "vector"), "vec_id").withColumn("is_query", F.lit(False))
    asked = asked.join(queries, "vec_id").withColumn("is_query", F.lit(True))

    def compare(table: pa.Table) -> pa.Table:
        schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
        kind = table.column("is_query").to_numpy()
        every_id, matrix = table.column("vec_id").to_numpy(), as_matrix(table.column("vector").combine_chunks(), size)
        if kind.all() or not kind.any():
            return schema.empty_table()
        q_ids, ids = every_id[kind], every_id[~kind]
        at, found, score = best_of(matrix[kind], q_ids, matrix[~kind], ids, k + 1, itself=True)
        return pa.table({"query_id": q_ids[at], "vec_id": found, "score": score}, schema)

    got = data.unionByName(asked).select("curve", "block", "part", "vec_id", "vector", "is_query").groupBy("curve", "block", "part").applyInArrow(compare, "query_id long, vec_id long, score double")
    merged = got.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    best = merged.withColumn("rank", rank).where(F.col("rank") <= k + 1).groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("best"))
    #: Further queries of a vector take the answer of the first.
    others = asking.join(alike.where("n > 1").select("vector", F.col("vec_id").alias("query_id")), "vector").where("vec_id != query_id").select(F.col("vec_id").alias("own"), "query_id")
    answers = best.select(F.col("query_id").alias("own"), "best").unionByName(others.join(best, "query_id").select("own", "best"))
    left = F.slice(F.filter("best", lambda x: x["vec_id"] != F.col("own")), 1, k)
    rows = answers.select(F.col("own").alias("query_id"), F.posexplode(left).alias("rank", "x"))
    return rows.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), "x.vec_id", "x.score")


def exact_nearest(queries: DataFrame, rows: DataFrame, size: int, k: int) -> DataFrame:
    """query_id, vec_id, score: the true k nearest of a bounded set of queries, which is broadcast."""
    asked = queries.toArrow()
    shared = rows.sparkSession.sparkContext.broadcast((asked.column("vec_id").to_numpy(), as_matrix(asked.column("vector").combine_chunks(), size)))

    def run(batches):
        q_ids, q = shared.value
        for batch in batches:
            at, found, score = best_of(q, q_ids, as_matrix(batch.column("vector"), size), batch.column("vec_id").to_numpy(zero_copy_only=False), k)
            yield pa.RecordBatch.from_arrays([pa.array(q_ids[at]), pa.array(found), pa.array(score)], ["query_id", "vec_id", "score"])

    got = rows.mapInArrow(run, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return got.withColumn("rank", rank).where(F.col("rank") <= k).drop("rank")


def _widths(queries: DataFrame, kept: DataFrame, ranks: DataFrame, size: int, k: int, sample: int, recall: float, least: int, curves: int, levels: int) -> list[int]:
    """For each level the distance in ranks within which some curve has `recall` of the sampled queries' true neighbours
    that the level holds."""
    drawn = queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample)
    pairs = [(r["query_id"], r["vec_id"]) for r in exact_nearest(drawn, kept, size, k).collect()]
    if not pairs:
        return [least] * levels
    spark = kept.sparkSession
    ids = spark.createDataFrame([(x,) for x in sorted({x for p in pairs for x in p})], "vec_id long")
    asked, found = {}, {}
    for r in ranks.join(F.broadcast(ids), "vec_id").collect():
        (asked if r["is_query"] else found).setdefault(r["vec_id"], {})[r["curve"]] = r["rank"]
    far: list[list[int]] = [[] for _ in range(levels)]
    for q, v in pairs:
        far[next(iter(found[v])) // curves].append(min(abs(asked[q][c] - rank) for c, rank in found[v].items()))
    return [max(least, sorted(x)[int(np.ceil(recall * len(x))) - 1] + 1) if x else least for x in far]
