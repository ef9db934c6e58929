"""Repair of conversations by a scan of min-plus matrices.

A conversation is legal if the initials of its roles read `(s?(ua)+)?`: a machine of four states (begin, after a system
turn, after a user turn, after an assistant turn). A turn is a 4x4 matrix: entry (i, j) is the cheapest way, and its audit,
to get from state i to j by keeping, rerolling or deleting that turn, and by inserting any number of turns behind it. The
product of two matrices takes the least (cost, audit) over the state between; it is associative, so a conversation is
reduced as a tree, piece by piece and wherever its pieces lie.

That ties go to the least audit is sound: ways of equal cost over the same turns have the same number of letters but for
inserts, and each insert costs, so that of two such audits none begins with the other.

Turns are sorted by ranges of (conversation, turn). What lies within one partition is repaired there; only a conversation
that reaches over a partition's edge, or over more than PIECE_ROWS turns, sends the matrices of its pieces on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.shared import spread_join, stored

#: Costs of the edits, and what a truncated turn that stays costs besides.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
BLANKS = " \t\n\x0b\x0c\r"
#: A piece of a conversation that is held at once.
PIECE_ROWS, PIECE_BYTES = 4096, 4 << 20
#: Neighbouring pieces that one task multiplies, in each round.
FAN = 16

BEGIN, SYSTEM, USER, ASSISTANT = range(4)
Element = tuple[int, str] | None
Matrix = tuple[tuple[Element, ...], ...]


def times(a: Matrix, b: Matrix) -> Matrix:
    """The product: for each pair of states the least (cost, audit) over the state between."""
    rows = []
    for i in range(4):
        row: list[Element] = []
        for j in range(4):
            best: Element = None
            for k in range(4):
                x, y = a[i][k], b[k][j]
                if x is not None and y is not None and (best is None or x[0] + y[0] <= best[0]):
                    way = (x[0] + y[0], x[1] + y[1])
                    best = way if best is None else min(best, way)
            row.append(best)
        rows.append(tuple(row))
    return tuple(rows)


def _matrix(ways: dict[tuple[int, int], tuple[int, str]]) -> Matrix:
    return tuple(tuple(ways.get((i, j)) for j in range(4)) for i in range(4))


#: Where a turn of each initial leads; `(s?(ua)+)?`.
STEPS = {"s": ((BEGIN, SYSTEM),), "u": ((BEGIN, USER), (SYSTEM, USER), (ASSISTANT, USER)), "a": ((USER, ASSISTANT),)}
NOTHING = _matrix({(i, i): (0, "") for i in range(4)})
_ONE = _matrix({(i, i): (0, "") for i in range(4)} | {e: (INSERT, "I") for x in "ua" for e in STEPS[x]})
#: Any number of inserts: two reach whatever inserts can reach at least cost.
INSERTS = times(_ONE, _ONE)


@lru_cache(64)
def turn_matrix(kind: str) -> Matrix:
    """Of one turn: x must go; s, u, a and o (any other role) may stay, and are truncated in upper case."""
    ways = {(i, i): (DELETE, "D") for i in range(4)}
    if kind != "x":
        more = TRUNCATED if kind.isupper() else 0
        ways |= {e: (REROLE + more, "R") for x in "ua" for e in STEPS[x]}
        ways |= {e: (more, "K") for e in STEPS.get(kind.lower(), ())}
    return times(_matrix(ways), INSERTS)


@lru_cache(1 << 16)
def _short(kinds: str) -> Matrix:
    return reduced([turn_matrix(k) for k in kinds])


def reduced(matrices: list[Matrix]) -> Matrix:
    """Their product, as a tree of neighbours."""
    while len(matrices) > 1:
        matrices = [times(*matrices[i : i + 2]) if i + 1 < len(matrices) else matrices[i] for i in range(0, len(matrices), 2)]
    return matrices[0] if matrices else NOTHING


def matrix_of(kinds: str) -> Matrix:
    """Of a run of turns; runs of eight turns repeat, and are remembered."""
    return reduced([_short(kinds[i : i + 8]) for i in range(0, len(kinds), 8)])


def cheapest(matrix: Matrix) -> tuple[int, str]:
    """The least cost and audit of a whole conversation with this product."""
    whole = times(INSERTS, matrix)
    return min(x for x in (whole[BEGIN][BEGIN], whole[BEGIN][ASSISTANT]) if x is not None)


@lru_cache(1 << 16)
def _cheapest_short(kinds: str) -> tuple[int, str]:
    return cheapest(matrix_of(kinds))


def repaired(turns: Iterator[tuple[str, str]], audit: str, before: int, odd: bool) -> Iterator[tuple[str, str, str]]:
    """(role, text, edit) of the turns that stay or come in; `before` of the conversation's turns stand before them, and
    `odd` says that the whole has an odd number, and thus a system turn in front."""
    for letter in audit:
        role, text = next(turns) if letter != "I" else (None, "")
        if letter == "D":
            continue
        if letter != "K":
            role = "user" if (before - odd) % 2 == 0 else "assistant"
        yield role, text, letter
        before += 1


def stays(audit: str) -> int:
    return len(audit) - audit.count("D")


@dataclass
class Summary:
    """What joins with a neighbour's: counts, the first and last turn number and initial, and the kinds of the rows."""

    rows: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    distinct: int = 0
    first_turn: int | None = None
    last_turn: int | None = None
    first_initial: str = ""
    last_initial: str = ""

    def __add__(self, other: Summary) -> Summary:
        if not self.rows or not other.rows:
            return other if not self.rows else self
        illegal = self.illegal + other.illegal + (self.last_initial + other.first_initial not in ("su", "ua", "au"))
        same = self.last_turn is not None and self.last_turn == other.first_turn
        return Summary(
            self.rows + other.rows,
            self.blank + other.blank,
            self.duplicate + other.duplicate,
            self.truncated + other.truncated,
            illegal,
            self.distinct + other.distinct - same,
            other.first_turn if self.first_turn is None else self.first_turn,
            self.last_turn if other.last_turn is None else other.last_turn,
            self.first_initial,
            other.last_initial,
        )

    @property
    def gaps(self) -> int:
        return 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.distinct


NUMBERS = ("rows", "blank", "duplicate", "truncated", "illegal", "distinct", "first_turn", "last_turn")
SUMMARY = pa.schema([*((k, pa.int64()) for k in NUMBERS), ("first_initial", pa.string()), ("last_initial", pa.string())])
TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
EDITED = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string()), ("edit", pa.string())]))
MATRIX = [("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string()))]
PIECE = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("piece", pa.int64()), ("closed", pa.bool_()), *SUMMARY, *MATRIX, ("turns", TURNS), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string()), ("repaired", EDITED)])
_SUMMARY_SQL = ", ".join(f"{k} long" for k in NUMBERS) + ", first_initial string, last_initial string"
_MATRIX_SQL = "costs array<long>, audits array<string>"
_EDITED_SQL = "array<struct<role:string,text:string,edit:string>>"
PIECE_SQL = f"conv_id long, part long, piece long, closed boolean, {_SUMMARY_SQL}, {_MATRIX_SQL}, turns array<struct<role:string,text:string>>, cost long, audit string, repaired_sha256 string, repaired {_EDITED_SQL}"


def _flat(matrix: Matrix) -> dict:
    cells = [x for row in matrix for x in row]
    return {"costs": [-1 if x is None else x[0] for x in cells], "audits": ["" if x is None else x[1] for x in cells]}


def _square(costs: list[int], audits: list[str]) -> Matrix:
    cells = [None if c < 0 else (c, a) for c, a in zip(costs, audits, strict=True)]
    return tuple(tuple(cells[4 * i : 4 * i + 4]) for i in range(4))


def _marked(turns: DataFrame) -> DataFrame:
    """turns with what is asked of each row: blank, truncated, initial, and whether its role and text stood before."""
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")))
    end = F.rtrim("text", F.lit(BLANKS))
    blank = end == ""
    rows = rows.withColumns({"h1": F.xxhash64(F.lit(1), "conv_id", "role", "text"), "h2": F.xxhash64("text", "role", "conv_id", F.lit(2))})
    rows = rows.withColumns({"blank": blank, "truncated": ~blank & ~F.right(end, F.lit(1)).isin(".", "!", "?")})
    #: Null turns are first, so the least (is a number, number) is the earliest.
    at = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    seen = rows.where("not blank").groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(at).alias("earliest")).where("n > 1")
    rows = spread_join(rows, seen, ["h1", "h2"], "n")
    return rows.withColumn("later", F.coalesce(~at.eqNullSafe(F.col("earliest")), F.lit(False)) & F.col("n").isNotNull()).drop("earliest", "n")


def _pieces(turns: DataFrame, texts: bool) -> DataFrame:
    """Each conversation that lies within its partition, repaired; of the others, their pieces with their matrices."""
    order = ["conv_id", "turn", F.substring("role", 1, 40), F.substring("text", 1, 40), "h1", "h2"]
    n = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = _marked(turns).repartitionByRange(n, *order).sortWithinPartitions(*order)

    def run(batches):
        part = TaskContext.get().partitionId()
        out: list[dict] = []
        held: list[tuple] = []
        size = number = weight = 0
        #: The conversation of `held`, whether it may have begun in another partition, and whether pieces of it are out.
        conv, first, cut, last = None, True, False, None

        def piece(closed: bool) -> dict:
            nonlocal number
            kinds, s = [], Summary(rows=len(held))
            before, turn_before = None, None
            for turn, role, _, blank, truncated, repeated in held:
                initial = role[:1]
                if blank:
                    s.blank += 1
                elif repeated:
                    s.duplicate += 1
                elif truncated:
                    s.truncated += 1
                kind = initial if initial in ("s", "u", "a") else "o"
                kinds.append("x" if blank or repeated else kind.upper() if truncated else kind)
                if before is not None and before + initial not in ("su", "ua", "au"):
                    s.illegal += 1
                before = initial
                if turn is not None:
                    s.distinct += turn != turn_before
                    s.first_turn, s.last_turn, turn_before = turn if s.first_turn is None else s.first_turn, turn, turn
            s.first_initial, s.last_initial = held[0][1][:1], before
            row = {"conv_id": conv, "part": part, "piece": 0 if closed else number, "closed": closed, **vars(s)}
            number += not closed
            kinds = "".join(kinds)
            if closed:
                cost, audit = _cheapest_short(kinds) if len(kinds) <= 8 else cheapest(matrix_of(kinds))
                done = list(repaired(((role, text) for _, role, text, *_ in held), audit, 0, stays(audit) % 2 == 1))
                row |= {"cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t, _ in done).encode()).hexdigest()}
                if texts:
                    row["repaired"] = [{"role": r, "text": t, "edit": e} for r, t, e in done]
            else:
                row |= _flat(matrix_of(kinds)) | {"turns": [{"role": role, "text": text} for _, role, text, *_ in held]}
            return row

        def close(closed: bool):
            nonlocal held, size, weight
            if held:
                out.append(piece(closed))
                weight += size if texts or not closed else 200
            held, size = [], 0

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "blank", "truncated", "later")]
            for own, turn, role, text, blank, truncated, later in zip(*columns, strict=True):
                if held and own != conv:
                    close(not first and not cut)
                    first = cut = False
                elif len(held) >= PIECE_ROWS or size >= PIECE_BYTES:
                    close(False)
                    cut = True
                same = (own, turn, role, text)
                held.append((turn, role, text, blank, truncated, later or (not blank and same == last)))
                conv, last, size = own, same, size + len(text)
                if weight >= 4 << 20 or len(out) >= 4096:
                    yield pa.RecordBatch.from_pylist(out, PIECE)
                    out, weight = [], 0
        close(False)
        if out:
            yield pa.RecordBatch.from_pylist(out, PIECE)

    return placed.select("conv_id", "turn", "role", "text", "blank", "truncated", "later").mapInArrow(run, PIECE_SQL)


def _multiplied(rows: list[dict]) -> dict:
    """The product of neighbouring pieces, in their order."""
    total = Summary()
    for r in rows:
        total = total + Summary(**{k: r[k] for k in SUMMARY.names})
    return {"conv_id": rows[0]["conv_id"], **vars(total), **_flat(reduced([_square(r["costs"], r["audits"]) for r in rows]))}


def _reduced_over_partitions(pieces: DataFrame) -> DataFrame:
    """conv_id, a summary, cost and audit of each conversation in pieces: in each round, neighbours are multiplied, within a
    run of FAN pieces, then within a partition, then within runs of FAN partitions, until there is one of each."""
    columns = ["conv_id", *SUMMARY.names, "costs", "audits"]
    node = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("piece", pa.int64()), *SUMMARY, *MATRIX])
    node_sql = f"conv_id long, part long, piece long, {_SUMMARY_SQL}, {_MATRIX_SQL}"

    def multiply(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: (r["part"], r["piece"]))
        return pa.Table.from_pylist([_multiplied(rows) | {"part": rows[0]["part"], "piece": rows[0]["piece"]}], node)

    level = pieces.select("conv_id", "part", "piece", *columns[1:])
    parts, numbers = pieces.agg(F.max("part"), F.max("piece")).first()
    for column, most in (("piece", numbers), ("part", parts)):
        width = FAN
        while True:
            keys = ["conv_id", "part", F.floor(F.col("piece") / width).alias("run")] if column == "piece" else ["conv_id", F.floor(F.col("part") / width).alias("run")]
            level = stored(level.groupBy(*keys).applyInArrow(multiply, node_sql), "level")
            if width > most:
                break
            width *= FAN

    def finish(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                cost, audit = cheapest(_square(r["costs"], r["audits"]))
                out.append({k: r[k] for k in ("conv_id", *SUMMARY.names)} | {"cost": cost, "audit": audit})
            yield pa.RecordBatch.from_pylist(out, pa.schema([("conv_id", pa.int64()), *SUMMARY, ("cost", pa.int64()), ("audit", pa.string())]))

    return level.mapInArrow(finish, f"conv_id long, {_SUMMARY_SQL}, cost long, audit string")


def _applied(pieces: DataFrame, whole: DataFrame) -> DataFrame:
    """conv_id, part, piece, repaired, before of each piece: its own share of its conversation's audit, applied."""
    slices = pa.schema([("part", pa.int64()), ("piece", pa.int64()), ("letters", pa.string()), ("before", pa.int64()), ("odd", pa.bool_())])

    def cut(places: pa.Table, audits: pa.Table) -> pa.Table:
        audit, out, at, before = audits.column("audit")[0].as_py(), [], 0, 0
        odd = stays(audit) % 2 == 1
        rows = sorted(places.to_pylist(), key=lambda r: (r["part"], r["piece"]))
        for i, r in enumerate(rows):
            end, left = at, r["rows"]
            while left:
                left -= audit[end] != "I"
                end += 1
            end = len(audit) if i + 1 == len(rows) else end
            out.append({"part": r["part"], "piece": r["piece"], "letters": audit[at:end], "before": before, "odd": odd})
            at, before = end, before + stays(audit[at:end])
        return pa.Table.from_pylist(out, slices)

    narrow = pieces.select("conv_id", "part", "piece", "rows").groupBy("conv_id")
    shares = narrow.cogroup(whole.select("conv_id", "audit").groupBy("conv_id")).applyInArrow(cut, "part long, piece long, letters string, before long, odd boolean")

    def apply(batches):
        schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("piece", pa.int64()), ("before", pa.int64()), ("repaired", EDITED)])
        for batch in batches:
            for i in range(batch.num_rows):
                (r,) = batch.slice(i, 1).to_pylist()
                done = repaired(((x["role"], x["text"]) for x in r["turns"]), r["letters"], r["before"], r["odd"])
                edited = [{"role": a, "text": b, "edit": c} for a, b, c in done]
                yield pa.RecordBatch.from_pylist([{"conv_id": r["conv_id"], "part": r["part"], "piece": r["piece"], "before": r["before"], "repaired": edited}], schema)

    joined = pieces.select("conv_id", "part", "piece", "turns").join(shares, ["part", "piece"])
    return joined.mapInArrow(apply, f"conv_id long, part long, piece long, before long, repaired {_EDITED_SQL}")


def _hashed(applied: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256: a hash goes through its conversation from front to back, and holds one piece at a time."""
    schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])

    def run(batches):
        conv, state, begun = None, None, False
        for batch in batches:
            for i in range(batch.num_rows):
                (r,) = batch.slice(i, 1).to_pylist()
                if state is None or r["conv_id"] != conv:
                    if state is not None:
                        yield pa.RecordBatch.from_pylist([{"conv_id": conv, "repaired_sha256": state.hexdigest()}], schema)
                    conv, state, begun = r["conv_id"], hashlib.sha256(), False
                for x in r["repaired"]:
                    state.update((("\n" if begun else "") + f"{x['role']}:{x['text']}").encode())
                    begun = True
        if state is not None:
            yield pa.RecordBatch.from_pylist([{"conv_id": conv, "repaired_sha256": state.hexdigest()}], schema)

    return applied.repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece").mapInArrow(run, "conv_id long, repaired_sha256 string")


def repair_conversations(turns: DataFrame, texts: bool = True) -> tuple[DataFrame, DataFrame | None]:
    """Two tables for turns (conv_id, turn, role, text): a report for each conversation, and its repaired turns.

    The report has conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256 (of `role:text`,
    joined by newlines). The turns are conv_id, part, piece, first (the place of the first), repaired: an array of (role,
    text, edit); a long conversation has several such rows, in the order of (part, piece). Without `texts` there are none.

    A conversation's rows stand by turn (nulls first), ties by the first 40 characters of role and text, then by a hash of
    them, so that equal rows are neighbours. A row is blank if its text has nothing but
    blanks, else a duplicate if its role and text stood before, else truncated if its last character that is no blank is
    not one of `.!?`. Blank and duplicate rows must go. Null roles and texts are one space; a null conv_id is a conversation
    of its own; an empty table has no report; other columns are left out, whatever they are called. A conversation may be
    longer than a partition; its audit, a letter a row, is one string, and its digest is the only step that goes through
    it in order.
    """
    pieces = stored(_pieces(turns, texts), "pieces")
    report = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    gaps = F.when(F.col("first_turn").isNull(), 0).otherwise(F.col("last_turn") - F.col("first_turn") + 1 - F.col("distinct")).cast("long").alias("gaps")
    closed = pieces.where("closed").select("conv_id", gaps, *report[2:])
    opened = pieces.where("not closed")
    if opened.isEmpty():
        return closed, pieces.where("closed").select("conv_id", "part", "piece", F.lit(0).cast("long").alias("first"), "repaired") if texts else None
    whole = stored(_reduced_over_partitions(opened), "whole")
    applied = stored(_applied(opened, whole), "applied")
    digests = _hashed(applied).withColumnRenamed("conv_id", "_conv")
    far = whole.join(digests, whole["conv_id"].eqNullSafe(digests["_conv"])).select("conv_id", gaps, *report[2:])
    both = closed.unionByName(far)
    if not texts:
        return both, None
    near = pieces.where("closed").select("conv_id", "part", "piece", F.lit(0).cast("long").alias("first"), "repaired")
    return both, near.unionByName(applied.select("conv_id", "part", "piece", F.col("before").alias("first"), "repaired"))


def damaged(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of turns with faults put in by crc32(`conv_id:turn`) modulo 20: 0 drops a row, 1 empties
    its text, 2 takes its `.!?` out, 3 repeats it, 4 makes it the user's. Nulls are one space."""
    known = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn")).cast("binary")) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.translate(known("text"), ".!?", "")).otherwise(known("text"))
    rows = turns.select("conv_id", "turn", F.when(fault == 4, "user").otherwise(known("role")).alias("role"), text.alias("text"), fault.alias("fault")).where("fault != 0")
    return rows.withColumn("_", F.explode(F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))).drop("_", "fault")
