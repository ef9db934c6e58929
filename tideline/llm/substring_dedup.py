"""Repeated passages: a count-min prefilter over word windows, then exact groups of what it lets through.

Documents are dealt into blocks of consecutive doc_id. Each block sends one partition sketch: for each row of the
sketch, the counters it touches, coded as gaps. Sketches merge by ranges of counters, and each block hears which of its
counters stand at two or more. An estimate is the least of a window's counters, so no repeated window is missed; only
windows estimated repeated go on to the second pass, which groups them by a 128-bit hash of the words and finds the
first block that holds each. The sketch is never whole anywhere: its width follows the input, and a range of counters
is one small group.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.shared import Words, mix

SEEDS = (0x1F3D5B79, 0x2A4C6E80)
#: Quantiles of doc_id that are asked for, whatever the size of the table, and the cell of the rows without an id.
CELLS, NO_ID = 2048, 1 << 30


def to_gaps(values: np.ndarray) -> bytes:
    """Ascending integers as gaps of 7 bits a byte, low bits first, the high bit set where more follows."""
    gaps = np.diff(values, prepend=np.uint64(0))
    size = np.ones(len(gaps), np.int64)
    for k in range(1, 10):
        size += gaps >= np.uint64(1 << (7 * k))
    at = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint8)
    for k in range(int(size.max(initial=0))):
        rows = np.flatnonzero(size > k)
        out[at[rows] + k] = ((gaps[rows] >> np.uint64(7 * k)) & np.uint64(127)) | ((size[rows] > k + 1).astype(np.uint64) << np.uint64(7))
    return out.tobytes()


def from_gaps(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    last = np.flatnonzero(raw < 128)
    start = np.concatenate([[0], last[:-1] + 1]).astype(np.int64) if len(last) else last
    size = last - start + 1
    gaps = np.zeros(len(last), np.uint64)
    for k in range(int(size.max(initial=0))):
        rows = np.flatnonzero(size > k)
        gaps[rows] |= (raw[start[rows] + k] & np.uint8(127)).astype(np.uint64) << np.uint64(7 * k)
    return np.cumsum(gaps, dtype=np.uint64)


class Block:
    """The documents of one block in the order of (doc_id, draw, text), and their windows."""

    def __init__(self, table: pa.Table, window: int):
        self.table = table.sort_by([("doc_id", "ascending"), ("draw", "ascending"), ("text", "ascending")])
        self.words = Words(self.table.column("text"))
        self.first, self.h = self.words.grams(self.words.hashes(SEEDS[0]), window)
        self.window = window

    def second(self) -> np.ndarray:
        return self.words.grams(self.words.hashes(SEEDS[1]), self.window)[1]

    def cells(self, row: int, bits: int) -> np.ndarray:
        return mix(self.h ^ np.uint64(0x5851F42D4C957F2D * (row + 1) % 2**64)) >> np.uint64(64 - bits)

    def repeated(self, said: dict[int, np.ndarray], bits: int, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows estimated repeated: their places among the windows, the distinct pairs of hashes, the pair of each."""
        keep = np.ones(len(self.h), bool)
        for row in range(depth):
            distinct, which = np.unique(self.cells(row, bits), return_inverse=True)
            flags = said.get(row, np.zeros(0, bool))
            assert len(flags) == len(distinct), "a block's windows changed between two passes"
            keep &= flags[which]
        at = np.flatnonzero(keep)
        pair = np.empty(len(at), [("a", np.uint64), ("b", np.uint64)])
        pair["a"], pair["b"] = self.h[at], self.second()[at]
        order = np.lexsort((pair["b"], pair["a"]))
        ordered = pair[order]
        new = np.ones(len(at), bool)
        new[1:] = ordered[1:] != ordered[:-1]
        which = np.empty(len(at), np.int64)
        which[order] = np.cumsum(new) - 1
        return at, ordered[new], which


def _answers(table: pa.Table, kind: int) -> dict[int, np.ndarray]:
    """The flags that one block got, by row of the sketch, in the order of the ranges."""
    out: dict[int, list] = {}
    rows = [r for r in table.to_pylist() if r["kind"] == kind]
    for r in sorted(rows, key=lambda r: (r["row"], r["shard"])):
        out.setdefault(r["row"], []).append(np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=r["n"]).astype(bool))
    return {k: np.concatenate(v) for k, v in out.items()}


def _split(values: np.ndarray, shift: int):
    """Ascending values in runs that share what stands above `shift` bits."""
    shard = (values >> np.uint64(shift)).astype(np.int64)
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(shard)) + 1, [len(values)]])
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield int(shard[a]), a, b


def _in_blocks(rows: DataFrame, places: list[int], n_blocks: int, block_bytes: int) -> DataFrame:
    """The rows with their `block`, of about block_bytes of text: blocks ascend with (doc_id, draw), nulls come last.

    Quantiles of doc_id cut the table into at most CELLS cells, and an id that fills a block by itself has a cell of its
    own. A cell of several blocks is cut evenly by its ids and, where it has more blocks than ids, by the hash of the
    texts, so that neither one id nor the rows without an id end in one task. No list here grows with the table.
    """
    step = max(1, CELLS // n_blocks)
    heavy = [x for x, n in Counter(places).items() if n > 1 and n * n_blocks >= CELLS]
    inner = sorted({float(x) for x in (*places[step::step], *heavy, *(x + 1 for x in heavy))})
    at = F.coalesce(F.col("doc_id").cast("double"), F.lit(math.inf))
    placed = rows.withColumn("_at", at)
    placed = Bucketizer(splits=[-math.inf, *inner, math.inf], inputCol="_at", outputCol="_cell").transform(placed) if inner else placed.withColumn("_cell", F.lit(0.0))
    placed = placed.withColumn("cell", F.when(F.col("doc_id").isNotNull(), F.col("_cell").cast("int")).otherwise(F.lit(NO_ID)))
    totals = placed.groupBy("cell").agg(F.sum(F.octet_length("text")).alias("size"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).collect()
    cells, begin = [], 0
    for t in sorted(totals, key=lambda t: t["cell"]):
        n = max(1, round((t["size"] or 0) / block_bytes))
        cells.append((t["cell"], t["lo"], t["hi"], begin, n))
        begin += n
    table = rows.sparkSession.createDataFrame(cells, "cell int, lo long, hi long, begin int, n int")
    share = F.col("draw") / F.lit(float(1 << 53))
    lo, width = F.col("lo").cast("double"), F.col("hi").cast("double") - F.col("lo").cast("double") + 1
    #: Far ids are told apart by their doubles alone, and ids of one double are in one block.
    near = (F.try_subtract("doc_id", "lo").cast("double") + share) / width
    far = (F.col("doc_id").cast("double") - lo) / width
    part = F.when(F.col("doc_id").isNull(), share).when(width < 1 << 40, near).otherwise(far)
    inside = F.least(F.floor(part * F.col("n")), F.col("n") - 1)
    return placed.join(F.broadcast(table), "cell").withColumn("block", (F.col("begin") + inside).cast("int"))


def dedup_substrings(docs: DataFrame, window: int = 20, depth: int = 2, cells_per_window: int = 16, block_bytes: int = 8 << 20) -> DataFrame:
    """doc_id, n_words, n_removed, kept: each document's words joined by a space, without those that any window covers
    whose words also start earlier (in a smaller doc_id, or further up in the same document).

    A null text has no words; a null doc_id stands after all others; rows that repeat a doc_id are separate documents,
    in the order of a hash of their texts. A text of fewer than `window` words keeps them all. Other columns are left out.
    depth and cells_per_window set the sketch; they change what the second pass has to group, never the result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("draw", F.shiftrightunsigned(F.xxhash64("text"), 11))
    size, places = rows.agg(F.sum(F.octet_length("text")), F.percentile_approx("doc_id", [k / CELLS for k in range(CELLS)], 20 * CELLS)).first()
    size = size or 0
    n_blocks = max(1, math.ceil(size / block_bytes))
    #: A window has at least a byte and a blank for each word, and starts at a word.
    bits = min(56, max(10, math.ceil(math.log2(max(1, size / 2) * cells_per_window))))
    shard_bits = max(1, min(bits - 1, math.ceil(math.log2(n_blocks))))
    dealt = _in_blocks(rows, places or [], n_blocks, block_bytes) if n_blocks > 1 else rows.withColumn("block", F.lit(0))
    dealt = dealt.select("block", "doc_id", "draw", "text")

    def sketch(table: pa.Table) -> pa.Table:
        block, own = Block(table, window), table.column("block")[0].as_py()
        out = []
        for row in range(depth):
            cells, n = np.unique(block.cells(row, bits), return_counts=True)
            for shard, a, b in _split(cells, bits - shard_bits):
                out.append({"row": row, "shard": shard, "block": own, "cells": to_gaps(cells[a:b] * np.uint64(2) + (n[a:b] > 1).astype(np.uint64))})
        return pa.Table.from_pylist(out, pa.schema([("row", pa.int32()), ("shard", pa.int64()), ("block", pa.int32()), ("cells", pa.binary())]))

    def merge(table: pa.Table) -> pa.Table:
        got = [from_gaps(x) for x in table.column("cells").to_pylist()]
        cells = [x >> np.uint64(1) for x in got]
        distinct, n = np.unique(np.concatenate(cells), return_counts=True)
        many = n > 1
        for x, c in zip(got, cells, strict=True):
            many[np.searchsorted(distinct, c[(x & np.uint64(1)).astype(bool)])] = True
        flags = [many[np.searchsorted(distinct, c)] for c in cells]
        return _reply(table, 0, table.column("row").to_pylist(), flags)

    def _reply(table, kind, row, flags):
        return pa.table(
            {"block": table.column("block").combine_chunks(), "kind": pa.array([kind] * len(flags), pa.int32()), "row": pa.array(row, pa.int32()), "shard": table.column("shard").combine_chunks(), "n": pa.array([len(x) for x in flags], pa.int64()), "bits": pa.array([np.packbits(x).tobytes() for x in flags], pa.binary())}
        )

    def candidates(table: pa.Table, said: pa.Table) -> pa.Table:
        schema = pa.schema([("shard", pa.int64()), ("block", pa.int32()), ("pairs", pa.binary())])
        if not table.num_rows:
            return schema.empty_table()
        block, own = Block(table, window), table.column("block")[0].as_py()
        _, pairs, _ = block.repeated(_answers(said, 0), bits, depth)
        return pa.Table.from_pylist([{"shard": shard, "block": own, "pairs": pairs[a:b].tobytes()} for shard, a, b in _split(pairs["a"], 64 - shard_bits)], schema)

    def owners(table: pa.Table) -> pa.Table:
        kind = [("a", np.uint64), ("b", np.uint64)]
        got = [np.frombuffer(x, kind) for x in table.column("pairs").to_pylist()]
        block = np.repeat(np.array(table.column("block").to_pylist(), np.int64), [len(x) for x in got])
        pairs = np.concatenate(got)
        order = np.lexsort((block, pairs["b"], pairs["a"]))
        later = np.zeros(len(pairs), bool)
        later[order[1:]] = pairs[order[1:]] == pairs[order[:-1]]
        return _reply(table, 1, [0] * len(got), np.split(later, np.cumsum([len(x) for x in got])[:-1]))

    def rewrite(table: pa.Table, said: pa.Table) -> pa.Table:
        schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])
        if not table.num_rows:
            return schema.empty_table()
        block = Block(table, window)
        at, pairs, which = block.repeated(_answers(said, 0), bits, depth)
        later = _answers(said, 1).get(0, np.zeros(0, bool))[which] if len(at) else np.zeros(0, bool)
        first = np.zeros(len(at), bool)
        first[np.unique(which, return_index=True)[1]] = True
        begins = block.first[at[later | ~first]]
        words = block.words
        cover = np.zeros(len(words.start) + 1, np.int64)
        np.add.at(cover, begins, 1)
        np.add.at(cover, begins + window, -1)
        keep = np.cumsum(cover)[:-1] == 0
        removed = np.diff(np.concatenate([[0], np.cumsum(~keep)])[words.first])
        text, ends = join_words(words, keep)
        kept = pa.LargeStringArray.from_buffers(len(words.n), pa.py_buffer(ends.tobytes()), pa.py_buffer(text.tobytes()))
        return pa.table({"doc_id": block.table.column("doc_id").combine_chunks(), "n_words": pa.array(words.n, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "kept": kept.cast(pa.string())})

    reply = "block int, kind int, row int, shard long, n long, bits binary"
    first = dealt.groupBy("block").applyInArrow(sketch, "row int, shard long, block int, cells binary")
    told = first.groupBy("row", "shard").applyInArrow(merge, reply)
    second = dealt.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(candidates, "shard long, block int, pairs binary")
    owned = second.groupBy("shard").applyInArrow(owners, reply)
    both = told.unionByName(owned)
    return dealt.groupBy("block").cogroup(both.groupBy("block")).applyInArrow(rewrite, "doc_id long, n_words long, n_removed long, kept string")


def join_words(words: Words, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of each text's kept words with one space between, and the texts' offsets."""
    start, end, doc = words.start[keep], words.end[keep], words.doc[keep]
    follows = np.zeros(len(start), bool)
    follows[:-1] = doc[1:] == doc[:-1]
    buf = np.concatenate([words.buf, np.zeros(1, np.uint8)])
    take = np.zeros(len(buf) + 1, np.int8)
    np.add.at(take, start, 1)
    np.add.at(take, end, -1)
    inside = np.cumsum(take[:-1], dtype=np.int8).astype(bool)
    inside[end[follows]] = True
    buf[end[follows]] = 0x20
    ends = np.concatenate([[0], np.cumsum(inside)])[words.at]
    return buf[inside], ends.astype(np.int64)
