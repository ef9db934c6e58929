"""Token ids in a canonical, length-limited Huffman code, in blocks that decode on their own.

The file format is a folder of Parquet tables. `codebook` has (symbol, length), from which the canonical code follows.
`blocks` has a row for each block: shard, block, the ids of all its documents coded back to back (payload, low bit of a
byte first), bit offsets of every STEP-th id (checkpoints), and the documents' ids and token counts. `shards` has each
shard's first position. Shards and blocks ascend with doc_id. Between checkpoints all runs decode in step: one table
look-up for each id, for all runs of a block at once.
"""

from __future__ import annotations

import json
import re
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.shared import Words, forget, pieces, stored, utf8

LIMIT, STEP, BLOCK_IDS = 20, 512, 1 << 20
#: Pieces that a worker remembers; each takes some 30 bytes.
CACHE = 1_500_000
SEEDS = (0x7A11, 0x7A12)


def cut_places(buf: np.ndarray, at: np.ndarray, whole: np.ndarray | None = None) -> np.ndarray:
    """Bytes at which texts may be cut before they are encoded, since a pre-token begins there either way: a space before
    a visible character; the changes between letters or digits, other visible characters, and single line ends. Only
    ASCII and the letters of C3 80 to C3 BF are judged; a change beside an apostrophe is never a cut. whole has the
    starts and ends of stretches that are one piece each, as text and text meet at their ends."""
    n = len(buf)
    if whole is not None and len(whole):
        buf = buf.copy()
        for a, b in whole.tolist():
            buf[a:b] = 0
    wide = np.concatenate([np.zeros(2, np.uint8), buf, np.zeros(2, np.uint8)])
    kind = _KINDS[wide]
    second = np.zeros(n + 4, bool)
    second[1:] = (wide[:-1] == 0xC3) & (kind[1:] == HIGH) & (wide[1:] != 0x97) & (wide[1:] != 0xB7)
    first = np.zeros(n + 4, bool)
    first[:-1] = second[1:]
    kind[second | first] = LETTER
    back, last, this, coming = (kind[k : n + k] for k in range(4))
    seen = lambda k: (k == LETTER) | (k == SIGN) | (k == QUOTE)
    cut = (this == SPACE) & seen(coming)
    cut |= (last == LETTER) & (this == SIGN) | (last == SIGN) & (this == LETTER)
    cut |= (this == LINE) & seen(last)
    cut |= (last == LINE) & seen(back) & ((this == LETTER) | (this == SIGN))
    cut[at[:-1][at[:-1] < n]] = True
    if whole is not None and len(whole):
        cut[whole[whole < n]] = True
    return np.flatnonzero(cut)


OTHER, LETTER, SIGN, QUOTE, SPACE, LINE, HIGH = range(7)
_KINDS = np.zeros(256, np.uint8)
_KINDS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = LETTER
_KINDS[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = SIGN
_KINDS[[0x27, 0x20, 0x0A]] = QUOTE, SPACE, LINE
_KINDS[0x80:] = HIGH


class Encoder:
    """Texts to ids by the tokenizers library. Each distinct piece is encoded once and remembered by 128 bits of hash.

    added: an added token's literal in a text is that token's id, as it is by the library's own settings; without it,
    special ones are text like any other.
    """

    def __init__(self, path: str, added: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added
        tokens = [t for t in self.tokenizer.get_added_tokens_decoder().values() if added or not t.special]
        shape = json.loads(self.tokenizer.to_str())
        before = shape["pre_tokenizer"] or {}
        #: cut_places() knows one pre-tokenizer; texts for any other are encoded whole, as are those for tokens that take
        #: blanks along, need a word's edge or match normalised text.
        known = shape["normalizer"] is None and before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
        self.by_text = not known or any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in tokens)
        names = sorted((t.content.encode() for t in tokens), key=len, reverse=True)
        self.literal = re.compile(b"|".join(map(re.escape, names))) if names else None
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.h1, self.h2 = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.start, self.size, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, f"<u{self.width}")

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _cuts(self, buf: np.ndarray, at: np.ndarray) -> np.ndarray:
        """cut_places(), and the ends of the added tokens' literals, none of which is cut."""
        if self.by_text:
            return np.unique(at[:-1][at[:-1] < len(buf)])
        raw = buf.tobytes() if self.literal else b""
        if not self.literal or not self.literal.search(raw):
            return cut_places(buf, at)
        found = [m.span() for a, b in zip(at.tolist(), at[1:].tolist(), strict=False) for m in self.literal.finditer(raw, a, b)]
        return cut_places(buf, at, np.array(found, np.int64).reshape(-1, 2))

    def encode(self, column: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text's followed by end_id, and the n + 1 bounds of the texts."""
        buf, at = utf8(column)
        start = self._cuts(buf, at)
        pieces_ = Words.__new__(Words)
        pieces_.buf, pieces_.start, pieces_.end = buf, start, np.append(start[1:], len(buf)) if len(start) else start
        one, two = (pieces_.hashes(seed) for seed in SEEDS)
        distinct, example, which = np.unique(one, return_index=True, return_inverse=True)
        if (two != two[example][which]).any():  # two pieces of one hash
            got = self._library([t or "" for t in column.to_pylist()])
            return np.array([i for ids in got for i in [*ids, end_id]], self.ids.dtype), np.cumsum([0, *(len(x) + 1 for x in got)])
        place = np.minimum(np.searchsorted(self.h1, distinct), max(0, len(self.h1) - 1))
        known = (self.h1[place] == distinct) & (self.h2[place] == two[example]) if len(self.h1) else np.zeros(len(distinct), bool)
        new = np.flatnonzero(~known)
        raw = buf.tobytes()
        fresh = self._library([raw[pieces_.start[k] : pieces_.end[k]].decode() for k in example[new].tolist()])
        size, begin = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64)
        size[known], begin[known] = self.size[place[known]], self.start[place[known]]
        size[new] = [len(x) for x in fresh]
        begin[new] = len(self.ids) + np.cumsum(size[new]) - size[new]
        pool = np.concatenate([self.ids, np.array([i for x in fresh for i in x], self.ids.dtype)])
        # The ids of all pieces in order, and a gap for end_id behind each text.
        n, cut = size[which], np.searchsorted(start, at)
        text_of = np.repeat(np.arange(len(at) - 1), np.diff(cut))
        to = np.cumsum(n) - n + text_of
        total = np.concatenate([[0], np.cumsum(n)])[cut]
        bounds = total + np.arange(len(at))
        out = np.full(int(bounds[-1]), end_id, self.ids.dtype)
        step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        out[np.repeat(to, n) + step] = pool[np.repeat(begin[which], n) + step]
        if len(self.h1) + len(new) <= CACHE:
            add = np.searchsorted(self.h1, distinct[new])
            self.h1, self.h2 = np.insert(self.h1, add, distinct[new]), np.insert(self.h2, add, two[example][new])
            self.start, self.size, self.ids = np.insert(self.start, add, begin[new]), np.insert(self.size, add, size[new]), pool
        return out, bounds


def encoder(path: str, added: bool = False) -> Encoder:
    """This worker's encoder for a tokenizer file: it outlives the task, as workers do."""
    kept = sys.__dict__.setdefault("_tideline_encoders", {})
    if (path, added) not in kept:
        kept[path, added] = Encoder(path, added)
    return kept[path, added]


def tokenize(docs: DataFrame, path: str, end_id: int = 0, added: bool = False) -> DataFrame:
    """doc_id, n_tokens, width, ids: each whole text's ids and end_id, as little-endian unsigned integers of width bytes.
    added: see Encoder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, added)
        for batch in batches:
            for part in pieces(batch, "text", 2 << 20):
                ids, at = own.encode(part.column("text"), end_id)
                each = [ids[a:b].tobytes() for a, b in zip(at, at[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.diff(at), pa.int64()), pa.array(np.full(len(each), own.width, np.int32)), pa.array(each, pa.binary())], ["doc_id", "n_tokens", "width", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, n_tokens long, width int, ids binary")


def as_ids(batch: pa.RecordBatch) -> np.ndarray:
    """The ids of all rows of a batch of tokenize()."""
    width = batch.column("width")[0].as_py() if batch.num_rows else 4
    return np.frombuffer(b"".join(batch.column("ids").to_pylist()), f"<u{width}")


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Lengths of an optimal prefix code with no word over `limit` bits, by package-merge; 0 where the count is 0."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.int64)
    if len(used) < 2:
        out[used] = 1
        return out
    assert len(used) <= 1 << limit, "more symbols than words of that length"
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    n = len(leaves)
    # At each level: is the item a package (-1) or a leaf (its place)? Packages of a level pair the items of the one below.
    levels: list[np.ndarray] = []
    packages = np.zeros(0)
    for _ in range(limit):
        weights = np.concatenate([leaves, packages])
        what = np.concatenate([np.arange(n), np.full(len(packages), -1)])
        by = np.argsort(weights, kind="stable")
        weights, what = weights[by], what[by]
        levels.append(what)
        packages = weights[: len(weights) // 2 * 2].reshape(-1, 2).sum(1)
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for what in reversed(levels):
        taken = what[:take]
        lengths[taken[taken >= 0]] += 1
        take = 2 * int((taken < 0).sum())
    out[order] = lengths
    return out


def canonical(lengths: np.ndarray) -> np.ndarray:
    """The code words, by length and then symbol, each with its bits reversed, since payloads fill bytes from below."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    words, word, last = np.zeros(len(lengths), np.uint64), 0, 0
    for s in order.tolist():
        size = int(lengths[s])
        word <<= size - last
        words[s] = int(f"{word:0{size}b}"[::-1], 2)
        word, last = word + 1, size
    return words


def pack(ids: np.ndarray, words: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The coded ids, and the bit at which every STEP-th begins."""
    size = lengths[ids]
    at = np.cumsum(size) - size
    out = np.zeros(int(at[-1] + size[-1]) // 64 + 2, np.uint64) if len(ids) else np.zeros(1, np.uint64)
    cell, low = at >> 6, (at & 63).astype(np.uint64)
    value = words[ids]
    if len(ids):
        first = np.flatnonzero(np.diff(cell, prepend=-1))
        out[cell[first]] = np.bitwise_or.reduceat(value << low, first)
        over = np.flatnonzero((at & 63) + size > 64)
        out[cell[over] + 1] |= value[over] >> (np.uint64(64) - low[over])
    return out.tobytes(), at[::STEP]


class Decoder:
    def __init__(self, lengths: np.ndarray):
        self.bits = max(1, int(lengths.max(initial=1)))
        words, some = canonical(lengths), np.flatnonzero(lengths)
        self.symbol, self.size = np.zeros(1 << self.bits, np.uint32), np.ones(1 << self.bits, np.uint8)
        for s in some.tolist():
            self.symbol[int(words[s]) :: 1 << int(lengths[s])] = s
            self.size[int(words[s]) :: 1 << int(lengths[s])] = lengths[s]

    def ids(self, payload: bytes, checkpoints: np.ndarray, n: int) -> np.ndarray:
        """All n ids of a block: the runs between checkpoints advance together, one id each."""
        raw = np.frombuffer(payload + bytes(8), np.uint8)
        four = np.ndarray((len(raw) - 3,), "<u4", raw, 0, (1,))
        at, mask = checkpoints.astype(np.int64), np.uint32((1 << self.bits) - 1)
        out = np.zeros((len(at), STEP), np.uint32)
        for k in range(min(STEP, n)):
            at = at[: -(-(n - k) // STEP)] if n - k < (len(at) - 1) * STEP + 1 else at
            look = (four[at >> 3] >> (at & 7).astype(np.uint32)) & mask
            out[: len(at), k] = self.symbol[look]
            at = at + self.size[look]
        return out.ravel()[:n]


def write_tokens(tokens: DataFrame, path: str, limit: int = LIMIT, shards: int | None = None) -> None:
    """Write tokenize()'s rows in this format, in ascending (doc_id, ids); a null doc_id comes first."""
    spark = tokens.sparkSession
    tokens = stored(tokens, "tokens")

    def count(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            for part in pieces(batch, "ids"):
                own = np.bincount(as_ids(part), minlength=len(total))
                own[: len(total)] += total
                total = own
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], ["symbol", "n"])

    #: As many rows as the vocabulary has ids, however large the corpus.
    counts = tokens.select("width", "ids").mapInArrow(count, "symbol long, n long").groupBy("symbol").agg(F.sum("n").alias("n")).toPandas()
    table = np.zeros(int(counts["symbol"].max()) + 1 if len(counts) else 1, np.int64)
    table[counts["symbol"]] = counts["n"]
    lengths = code_lengths(table, limit)
    some = np.flatnonzero(lengths)
    spark.createDataFrame([(int(s), int(lengths[s])) for s in some], "symbol long, length int").coalesce(1).write.parquet(f"{path}/codebook")
    shared = spark.sparkContext.broadcast((lengths, canonical(lengths)))

    def encode(batches):
        lengths, words = shared.value
        shard, block, position, waiting, size, width = TaskContext.get().partitionId(), 0, 0, [], 0, 4

        def row():
            nonlocal block, position, waiting, size
            ids = np.frombuffer(b"".join(x for _, x in waiting), f"<u{width}")
            payload, checkpoints = pack(ids, words, lengths)
            out = {"shard": shard, "block": block, "position": position, "n_ids": len(ids), "payload": payload, "checkpoints": checkpoints.astype("<i8").tobytes(), "docs": [d for d, _ in waiting], "counts": [len(x) // width for _, x in waiting]}
            block, position, waiting, size = block + 1, position + len(ids), [], 0
            return pa.RecordBatch.from_pylist([out], SCHEMA)

        for batch in batches:
            width = batch.column("width")[0].as_py() if batch.num_rows else 4
            for doc, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                waiting.append((doc, ids))
                size += len(ids) // width
                if size >= BLOCK_IDS:
                    yield row()
        if waiting:
            yield row()

    n = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = tokens.select("doc_id", "width", "ids", F.xxhash64("ids").alias("tie")).repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "width", "ids")
    ordered.mapInArrow(encode, "shard int, block int, position long, n_ids long, payload binary, checkpoints binary, docs array<long>, counts array<long>").write.parquet(f"{path}/blocks")
    #: One row for each shard.
    sizes = sorted((r["shard"], r["n"]) for r in spark.read.parquet(f"{path}/blocks").groupBy("shard").agg(F.sum("n_ids").alias("n")).collect())
    starts = np.cumsum([0, *(n for _, n in sizes)])
    spark.createDataFrame([(s, int(at)) for (s, _), at in zip(sizes, starts, strict=False)], "shard int, first long").coalesce(1).write.parquet(f"{path}/shards")
    forget(tokens)


SCHEMA = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("position", pa.int64()), ("n_ids", pa.int64()), ("payload", pa.binary()), ("checkpoints", pa.binary()), ("docs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, ids (little-endian 32-bit) of every document, from the files alone.

    start is the number of ids of all documents before it, ids_crc32 the unsigned crc32 of `ids`.
    """
    book = spark.read.parquet(f"{path}/codebook").collect()
    lengths = np.zeros(max((r["symbol"] for r in book), default=0) + 1, np.int64)
    for r in book:
        lengths[r["symbol"]] = r["length"]
    shared = spark.sparkContext.broadcast(lengths)

    def decode(batches):
        decoder = Decoder(shared.value)
        for batch in batches:
            for r in (x for i in range(batch.num_rows) for x in batch.slice(i, 1).to_pylist()):
                ids = decoder.ids(r["payload"], np.frombuffer(r["checkpoints"], "<i8"), r["n_ids"])
                ends = np.cumsum(r["counts"])
                each = [ids[b - n : b].tobytes() for b, n in zip(ends.tolist(), r["counts"], strict=True)]
                out = [pa.array(r["docs"], pa.int64()), pa.array(r["first"] + r["position"] + ends - np.array(r["counts"]), pa.int64()), pa.array(r["counts"], pa.int64()), pa.array([zlib.crc32(x) for x in each], pa.int64()), pa.array(each, pa.binary())]
                yield pa.RecordBatch.from_arrays(out, ["doc_id", "start", "n_tokens", "ids_crc32", "ids"])

    shards = spark.read.parquet(f"{path}/shards")
    rows = spark.read.parquet(f"{path}/blocks").join(F.broadcast(shards), "shard")
    return rows.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")


def write_and_read(docs: DataFrame, tokenizer: str, path: str, end_id: int = 0, added: bool = False) -> DataFrame:
    """read_tokens() of what write_tokens() wrote for docs. A null text is empty: its only id is end_id. Repeated rows
    are repeated documents; an empty table gives an empty result; other columns are left out. added: see Encoder."""
    write_tokens(tokenize(docs, tokenizer, end_id, added), path)
    return read_tokens(docs.sparkSession, path)
