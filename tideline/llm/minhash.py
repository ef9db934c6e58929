"""Near duplicates: b-bit MinHash signatures, a multi-index Hamming join, links confirmed on the full sets.

A signature has `slots` minima of which b = 16 bits are kept; the distance of two signatures is the number of slots that
differ. It is cut into `slots / chunk` chunks. By the pigeonhole principle, two signatures that differ in fewer than
2 * slots / chunk slots have a chunk with one difference at most; each chunk is therefore entered once for each slot
left out, which enumerates every chunk with up to one error. All pairs under that distance meet under some key.

Rows of one set are one class with one entry, so groups of copies cost nothing. Buckets are never expanded into pairs.
Buckets that share members make a family; a family's sets meet block by block, the sizes of all intersections in a group
of two blocks are counted at once, exactly, and the group puts out a spanning forest of its links: a row for each member
at most, however many pairs are linked. What joined within a block is one component from then on, so across blocks only
members outside their family's largest component are compared.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.components import components
from tideline.llm.shared import BROADCAST_ROWS, Words, forget, mix, pieces, stored

SEED = 0x3C6EF372
#: Most members and bytes of sets of a block; a larger set is a block of its own. Groups of small blocks share a cell.
BLOCK, BLOCK_BYTES, CELL_BYTES = 512, 16 << 20, 8 << 20
#: A family of more blocks is compared by its rarest shingles where it still is in several components.
WIDE = 16
#: A list of meetings of at most so many rows is broadcast.
MEETINGS = 200_000


def shingle_sets(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingles of each text, ascending, one text after the other, and the n + 1 bounds.
    A text of fewer words has its whole sequence as its one shingle, and one without words has none."""
    hashes = words.hashes(SEED)
    first, h = words.grams(hashes, k)
    doc = words.doc[first]
    short = np.flatnonzero((words.n > 0) & (words.n < k))
    if len(short):
        whole = np.zeros(len(short), np.uint64)
        for j in range(k - 1):
            rows = np.flatnonzero(words.n[short] > j)
            whole[rows] = mix((whole[rows] ^ hashes[words.first[short[rows]] + j]) + np.uint64(0x9E3779B97F4A7C15))
        doc, h = np.concatenate([doc, short]), np.concatenate([h, whole])
        order = np.argsort(doc, kind="stable")
        doc, h = doc[order], h[order]
    at = np.searchsorted(doc, np.arange(len(words.n) + 1))
    sets = [np.unique(h[a:b]) for a, b in zip(at, at[1:], strict=False)]
    return np.concatenate(sets) if sets else h, np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int64)


def signatures(values: np.ndarray, at: np.ndarray, slots: int) -> np.ndarray:
    """Of each non-empty set, for each slot 16 bits of the least value under the slot's own order."""
    out = np.zeros((len(at) - 1, slots), np.uint16)
    some = np.flatnonzero(np.diff(at))
    if not len(some):
        return out
    draw = np.random.default_rng(20_241).integers(1, 2**63, (slots, 2), np.uint64)
    for j, (x, m) in enumerate(draw):
        h = (values ^ x) * (m | np.uint64(1))
        h ^= h >> np.uint64(31)
        out[some, j] = (mix(np.minimum.reduceat(h, at[some])) >> np.uint64(48)).astype(np.uint16)
    return out


def chunk_keys(sigs: np.ndarray, chunk: int) -> np.ndarray:
    """For each signature, the keys of every chunk with each of its slots left out in turn."""
    keys = []
    for c in range(sigs.shape[1] // chunk):
        own = sigs[:, c * chunk : (c + 1) * chunk].astype(np.uint64)
        for gone in range(chunk):
            h = np.full(len(sigs), c * chunk + gone + 1, np.uint64)
            for j in range(chunk):
                if j != gone:
                    h = mix((h << np.uint64(16) | own[:, j]) ^ (h >> np.uint64(48)))
            keys.append(h)
    return np.stack(keys, 1).view(np.int64)


def near_duplicates(docs: DataFrame, shingle_words: int = 5, percent: int = 80, slots: int = 60, chunk: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row: linked are rows whose sets of lower-cased shingles have
    100 * intersection >= percent * union; component_id is the smallest doc_id reachable; kept marks it.

    Every pair whose signatures differ in fewer than 2 * slots / chunk slots is compared. With 60 slots in chunks of 5 a
    pair at a similarity of 0.8 shares no key with a probability of 1e-7; with 40 slots one at 0.85 with 6e-7.
    A null or empty text has an empty set and is its own component. A null doc_id can't be named: its row has a null
    component_id and stays (kept is true). Rows that repeat a doc_id are one node; their sets all count.
    """
    spark = docs.sparkSession

    def sign(batches):
        for batch in batches:
            for part in pieces(batch, "text"):
                values, at = shingle_sets(Words(part.column("text"), lower=True), shingle_words)
                sigs = signatures(values, at, slots)
                raw = values.tobytes()
                names = [hashlib.blake2b(raw[8 * a : 8 * b], digest_size=16).digest() if b > a else None for a, b in zip(at, at[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.diff(at), pa.int64()), pa.array(names, pa.binary()), pa.array([x.tobytes() for x in sigs], pa.binary())], ["doc_id", "n_shingles", "set", "sig"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = stored(texts.mapInArrow(sign, "doc_id long, n_shingles long, set binary, sig binary"), "signed")
    named = signed.where("set is not null and doc_id is not null")
    classes = stored(named.groupBy("set").agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("size"), F.first("sig").alias("sig")), "classes")

    def enter(batches):
        for batch in batches:
            sigs = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint16).reshape(-1, slots)
            keys = chunk_keys(sigs, chunk)
            n = keys.shape[1]
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(batch.column("node").to_numpy(zero_copy_only=False), n))], ["key", "node"])

    entries = classes.mapInArrow(enter, "key long, node long")
    shared = entries.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("pivot")).where("n > 1")
    shared = stored(shared.select("key", "pivot"), "shared")
    buckets = stored(entries.join(shared, "key"), "buckets")
    forget(shared)
    #: Only texts that share a key with another are ever compared.
    touching = buckets.where("node != pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    family = components(touching).withColumnRenamed("component", "family")
    forget(buckets)
    weights = classes.groupBy("node").agg(F.sum(F.col("size") * 8).alias("bytes"))
    members = stored(_in_blocks(family.join(weights, "node").withColumn("place", F.col("family"))), "members")
    sets = stored(_sets(texts, members, shingle_words), "sets")

    #: Two classes that one doc_id names (repeated rows) are one node.
    names = named.join(classes.select("set", "node"), "set").select("doc_id", "node").distinct()
    first = names.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("last")).where("a != last").drop("last")
    same = names.join(first, "doc_id").where("node != a").select("a", F.col("node").alias("b"))
    within = members.select("place", F.col("block").alias("i"), F.col("block").alias("j"), "node", F.col("node").alias("label"), "bytes", F.lit(True).alias("is_row"), F.lit(True).alias("is_column"))
    links = stored(same.unionByName(_linked(within, sets, percent)), "links")
    group = components(links)
    across = _across(members.where("blocks > 1"), group, sets, percent)
    if not across.isEmpty():
        links = stored(links.unionByName(_linked(across, sets, percent)), "links")
        group = components(links)
    for table in (members, sets):
        forget(table)
    of = classes.select("set", "node").join(group, "node", "left").select("set", F.coalesce("component", "node").alias("component_id"))
    #: Empty sets and rows without an id meet nothing; their names are their own, so that no join piles them up.
    keyed = signed.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("set")).alias("set"))
    joined = keyed.where("set is not null").join(stored(of, "of"), "set").select("doc_id", "n_shingles", "component_id")
    alone = keyed.where("set is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    out = joined.unionByName(alone)
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _in_blocks(rows: DataFrame) -> DataFrame:
    """Rows (place, node, bytes) with `blocks`, the number of blocks that their place needs, and the `block` of each."""
    per = rows.groupBy("place").agg(_blocks(F.count("*"), F.sum("bytes")).alias("blocks"))
    return rows.join(per, "place").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))


def _blocks(n: Column, size: Column) -> Column:
    return F.greatest(F.ceil(n / BLOCK), F.ceil(size / BLOCK_BYTES), F.lit(1)).cast("long")


def _across(members: DataFrame, group: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The meetings across blocks that can still join components: in each place that holds several, each member outside
    the largest component with all members. A place is a family, or, in a family of over WIDE blocks, one of the rarest
    shingles of its sets (_prefixes)."""
    placed = members.join(group, "node", "left").withColumn("component", F.coalesce("component", "node"))
    far = placed.where(F.col("blocks") > WIDE)
    open_far = far.join(far.groupBy("place").agg((F.min("component") < F.max("component")).alias("open")).where("open").select("place"), "place")
    rows = placed.where(F.col("blocks") <= WIDE).select("place", "node", "bytes", "component")
    if not members.where(F.col("blocks") > WIDE).isEmpty():
        open_far = stored(open_far.select("node", "bytes", "component"), "wide")
        met = _prefixes(sets.join(open_far.select("node"), "node", "left_semi"), percent)
        rows = rows.unionByName(met.join(open_far, "node").select("place", "node", "bytes", "component"))
    rows = stored(rows, "placed")
    tally = rows.groupBy("place", "component").agg(F.count("*").alias("n"), F.sum("bytes").alias("size"))
    largest = F.max(F.struct("n", "size", "component"))
    per = tally.groupBy("place").agg(F.count("*").alias("components"), F.sum("n").alias("n"), F.sum("size").alias("size"), largest.alias("most")).where("components > 1")
    per = per.select("place", F.col("most.component").alias("most"), _blocks(F.col("n"), F.col("size")).alias("columns"), _blocks(F.col("n") - F.col("most.n"), F.col("size") - F.col("most.size")).alias("rows"))
    left = rows.join(per, "place")
    own = lambda n: F.pmod(F.xxhash64("node"), F.col(n))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    asking = left.where("component != most").select("place", own("rows").alias("i"), each("columns").alias("j"), "node", F.col("component").alias("label"), "bytes", F.lit(True).alias("is_row"), F.lit(False).alias("is_column"))
    asked = left.select("place", each("rows").alias("i"), own("columns").alias("j"), "node", F.col("component").alias("label"), "bytes", F.lit(False).alias("is_row"), F.lit(True).alias("is_column"))
    return stored(asking.unionByName(asked), "across")


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """(node, place) of the rarest shingles of each set, as many as two linked sets can't both do without.

    Two sets with 100 * intersection >= percent * union share at least percent of the larger one's shingles. Where all
    sets are in one order (here the rarest shingle first), the first n - ceil(percent * n / 100) + 1 of each therefore
    hold a common one. What many texts have in common stands behind what they have not, and brings no texts together.
    """

    def run(batches):
        for batch in batches:
            for node, raw in zip(batch.column("node").to_pylist(), batch.column("shingles").to_pylist(), strict=True):
                values = np.frombuffer(raw, np.int64)
                own = int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little", signed=True)
                for at in range(0, len(values), 1 << 16):
                    part = values[at : at + (1 << 16)]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), x, np.int64)) for x in (node, own, len(values))] + [pa.array(part)], ["node", "own", "n", "place"])

    rows = stored(sets.mapInArrow(run, "node long, own long, n long, place long"), "shingles")
    held = rows.groupBy("place").agg(F.count("*").alias("df")).where("df > 1")
    rank = F.row_number().over(Window.partitionBy("node", "own").orderBy(F.coalesce("df", F.lit(1)), "place"))
    first = rows.join(held, "place", "left").withColumn("rank", rank).where(F.col("rank") <= F.col("n") - F.ceil(F.lit(percent) * F.col("n") / 100) + 1)
    return first.where("df is not null").select("node", "place").distinct()


def _sets(texts: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """node, shingles: the whole shingle sets of the members, as ascending longs."""

    def run(batches):
        for batch in batches:
            for part in pieces(batch, "text", 1 << 20):
                values, at = shingle_sets(Words(part.column("text"), lower=True), k)
                raw = values.tobytes()
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([raw[8 * a : 8 * b] for a, b in zip(at, at[1:], strict=False)], pa.binary())], ["node", "shingles"])

    ids = members.select(F.col("node").alias("doc_id"))
    rows = texts.join(F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids, "doc_id", "left_semi")
    return rows.mapInArrow(run, "node long, shingles binary")


def _linked(meetings: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of each group (place, i, j), a spanning forest (a, b) of the links between its rows and its columns, where rows of
    one label (a node, or a component that is known) are one. Nothing comes out of a group that adds nothing."""
    n, size = meetings.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    cell = F.pmod(F.xxhash64("place", "i", "j"), F.lit(size // CELL_BYTES + 1))
    dealt = meetings.withColumn("cell", cell).drop("bytes")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def meet(table: pa.Table) -> pa.Table:
        place, i, j, node, label, is_row, is_column = (table.column(c).to_numpy() for c in ("place", "i", "j", "node", "label", "is_row", "is_column"))
        shingles = table.column("shingles")
        order = np.lexsort((node, j, i, place))
        same = np.stack([place, i, j])[:, order]
        cuts = np.concatenate([[0], np.flatnonzero((np.diff(same) != 0).any(0)) + 1, [len(order)]])
        out_a, out_b = [], []
        for x, y in zip(cuts, cuts[1:], strict=False):
            at = order[x:y]
            own = {r: np.frombuffer(shingles[r].as_buffer(), np.uint64) for r in at}
            rows, columns = at[is_row[at]], at[is_column[at]]
            if len(rows) and len(columns) and len(at) > 1:
                r, c = alike([own[k] for k in rows], [own[k] for k in columns], percent)
                least, ids = forest(label[rows[r]], label[columns[c]])
                out_a.append(least)
                out_b.append(ids)
        if not out_a:
            return schema.empty_table()
        return pa.table({"a": np.concatenate(out_a), "b": np.concatenate(out_b)}, schema)

    met = sets.join(F.broadcast(dealt) if n <= MEETINGS else dealt, "node")
    return met.groupBy("cell").applyInArrow(meet, "a long, b long")


def alike(rows: list[np.ndarray], columns: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The places (row, column) of all pairs of sets with 100 * intersection >= percent * union, intersection not empty."""
    n_rows, n_columns = (np.array([len(s) for s in x]) for x in (rows, columns))
    both = shared_counts(rows, columns)
    return np.nonzero((both > 0) & (100 * both >= percent * (n_rows[:, None] + n_columns - both)))


def shared_counts(rows: list[np.ndarray], columns: list[np.ndarray]) -> np.ndarray:
    """The size of each row's intersection with each column. Values held by few are counted pair by pair, those held by
    many as a product of 0/1 matrices, some thousand values at a time."""
    n, m = len(rows), len(columns)
    values, of = np.unique(np.concatenate([*rows, *columns]), return_inverse=True)
    cut = sum(len(s) for s in rows)
    sides = []
    for v, sets in ((of[:cut], rows), (of[cut:], columns)):
        who = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        by = np.argsort(v, kind="stable")
        sides.append((v[by], who[by], np.bincount(v, minlength=len(values))))
    (v, who, df), (w, whom, dg) = sides
    met = df * dg
    light = (met > 0) & (met <= max(256, n * m // 100))
    out = np.zeros(n * m, np.int64)
    some = np.flatnonzero(light[v])
    begin = np.cumsum(dg) - dg
    each = dg[v[some]]
    total = np.cumsum(each)
    for a in range(0, int(total[-1]) if len(total) else 0, 1 << 21):
        x, y = np.searchsorted(total, [a, a + (1 << 21)], side="right")
        part = some[x : y + 1]
        k = dg[v[part]]
        first = total[x : y + 1] - k
        step = np.arange(int(k.sum())) - np.repeat(np.cumsum(k) - k, k)
        inside = (np.repeat(first, k) + step >= a) & (np.repeat(first, k) + step < a + (1 << 21))
        to = np.repeat(begin[v[part]], k) + step
        out += np.bincount((np.repeat(who[part], k) * m + whom[to])[inside], minlength=n * m)
    out = out.reshape(n, m)
    heavy = np.flatnonzero((met > 0) & ~light)
    for a in range(0, len(heavy), 4096):
        some = heavy[a : a + 4096]
        place = np.full(len(values), -1)
        place[some] = np.arange(len(some))
        left, right = np.zeros((n, len(some)), np.float32), np.zeros((m, len(some)), np.float32)
        for matrix, vals, owner in ((left, v, who), (right, w, whom)):
            x, y = np.searchsorted(vals, [some[0], some[-1] + 1])
            at = place[vals[x:y]]
            matrix[owner[x:y][at >= 0], at[at >= 0]] = 1
        out += (left @ right.T).astype(np.int64)
    return out


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, node) of each node of the links (a, b) that is not the least of its component."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    least = np.arange(len(nodes))
    while True:
        before = least.copy()
        low = np.minimum(least[x], least[y])
        np.minimum.at(least, least[x], low)
        np.minimum.at(least, least[y], low)
        least = least[least]
        if (least == before).all():
            break
    other = np.flatnonzero(least != np.arange(len(nodes)))
    return nodes[least[other]], nodes[other]
