"""Helpers that several training-data operators share: the shared folder, and text columns as arrays."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names. Where it is unset, a local session (tests) makes one and sets it; on a
    cluster, whose machines share no temporary folder, that is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        set_before = spark.sparkContext.getCheckpointDir()
        if not set_before:
            if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
                raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tideline-"))
            set_before = spark.sparkContext.getCheckpointDir()
        folder = set_before
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/tideline-{name}-{uuid.uuid4().hex}"


#: Rows of ids that one task of a small step may have.
TASK_ROWS = 250_000


def stored(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """df, written to the shared folder and read back: its lineage ends there and a lost executor costs nothing.

    rows: a bound on the rows of df, where one is known; df is then written by as many tasks as they are worth.
    """
    path = new_path(df.sparkSession, name)
    if rows is not None and rows // TASK_ROWS + 1 < int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        df = df.coalesce(rows // TASK_ROWS + 1)
    df.write.option("compression", "zstd").parquet(path)
    if (made := _made.get()) is not None:
        made.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """The tables that stored() writes inside are deleted at the end, but for those taken out of the list."""
    token = _made.set([])
    made = _made.get()
    try:
        yield made
    finally:
        _made.reset(token)
        for path in made:
            _delete(spark, path)


def forget(df: DataFrame) -> None:
    """Delete a table that stored() wrote, once nothing reads it any more."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/tideline-" in path:
            _delete(df.sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


#: A side of a join is broadcast only if it has been counted and holds at most so many rows of ids (16 MB).
BROADCAST_ROWS = 1_000_000


def without(rows: DataFrame, gone: DataFrame, on: str | list[str]) -> DataFrame:
    """The rows that have no match in `gone`, a table of their keys. Rows with a null key stay."""
    gone = stored(gone.distinct(), "gone")
    return rows.join(F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone, on, "left_anti")


#: A table of one row for each key is broadcast if it has been counted and holds at most so many rows.
BROADCAST_GROUPS = 200_000


def spread_join(rows: DataFrame, groups: DataFrame, on: str | list[str], count: str) -> DataFrame:
    """rows left joined with groups, which has one row for each key and in `count` how many of the rows have it.

    Few groups are broadcast. Of many, the largest are: a group of at least total / BROADCAST_GROUPS rows, so there are at
    most BROADCAST_GROUPS of them; rows of the others are joined by a shuffle, in which no key has more rows than that.
    Rows with a null key have no group; keys must not be null where such rows matter.
    """
    on = [on] if isinstance(on, str) else on
    groups = stored(groups, "groups")
    n, total = groups.agg(F.count("*"), F.coalesce(F.sum(count), F.lit(0))).first()
    if n <= BROADCAST_GROUPS:
        return rows.join(F.broadcast(groups), on, "left")
    least = int(total) // BROADCAST_GROUPS + 1
    heavy, light = groups.where(F.col(count) >= least), groups.where(F.col(count) < least)
    hot = rows.join(F.broadcast(heavy), on)
    other = rows.join(F.broadcast(heavy.select(*on)), on, "left_anti").join(light.hint("shuffle_merge"), on, "left")
    return hot.unionByName(other.select(hot.columns))


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def row_name() -> list[Column]:
    """128 bits that name a row by its doc_id and text, null or not."""
    return [F.xxhash64(F.lit(1), "doc_id", "text").alias("k1"), F.xxhash64(F.lit(2), "text", "doc_id").alias("k2")]


#: Words are runs of bytes that are neither a space nor 09-0D.
BLANK_SEPARATED = np.ones(256, bool)
BLANK_SEPARATED[[0x20, *range(0x09, 0x0E)]] = False

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2**64 - 1], np.uint64)
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on every input bit; works in place."""
    h ^= h >> np.uint64(32)
    h *= _A
    h ^= h >> np.uint64(29)
    h *= _B
    h ^= h >> np.uint64(32)
    return h


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column (null: empty) and the n + 1 offsets of its rows in them."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    n = len(column)
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def pieces(batch: pa.RecordBatch, text: str, most: int = 4 << 20):
    """Slices of a batch whose texts hold about `most` bytes; a longer text has a slice of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    group = np.maximum(np.cumsum(sizes) - sizes, 0) // most
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


class Words:
    """The words of many texts at once.

    buf: the bytes; at: the texts' offsets; start, end: of each word; doc: the row of each word; n: words of each text.
    """

    def __init__(self, column, lower: bool = False, table: np.ndarray = BLANK_SEPARATED):
        self.buf, self.at = utf8(column)
        if lower:
            self.buf = _LOWER[self.buf]
        inside = table[self.buf]
        edge = np.zeros(len(inside) + 1, bool)
        edge[self.at] = True
        before = np.zeros_like(inside)
        before[1:] = inside[:-1]
        after = np.zeros_like(inside)
        after[:-1] = inside[1:]
        self.start = np.flatnonzero(inside & (~before | edge[:-1]))
        self.end = np.flatnonzero(inside & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.start, self.at)
        self.n = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(self.n)), self.n)

    def hashes(self, seed: int) -> np.ndarray:
        """A 64-bit hash of each word, eight bytes at a time."""
        padded = np.concatenate([self.buf, np.zeros(8, np.uint8)])
        eight = np.ndarray((len(padded) - 7,), "<u8", padded, 0, (1,))
        left = self.end - self.start
        h = mix(left.astype(np.uint64) * _C + np.uint64(seed))
        at, rows = self.start, None
        while len(at):
            new = eight[at] & _MASKS[np.minimum(left, 8)]
            if rows is None:
                h = mix(h ^ new)
                rows = np.arange(len(h))
            else:
                h[rows] = mix(h[rows] ^ new)
            more = np.flatnonzero(left > 8)
            rows, at, left = rows[more], at[more] + 8, left[more] - 8
        return h

    def grams(self, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of each run of k words within one text."""
        n = max(0, len(hashes) - k + 1)
        h = np.zeros(n, np.uint64)
        for j in range(k):
            h = h * _C + hashes[j : n + j]
        first = np.flatnonzero(self.doc[:n] == self.doc[k - 1 : n + k - 1])
        return first, mix(h[first])
