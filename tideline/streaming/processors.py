"""Streams with state of their own: sessions that close, sliding histories, rings of recent keys, epochs.

Each is what the batch operator of the same kind gives, whatever batches its input comes in. They need the RocksDB state
store (spark.sql.streaming.stateStore.providerClass). Rows of one key in one batch are sorted together, so the trigger
bounds what a task holds of them; between batches a key keeps what its docstring says and no more. Every call to the state
store is a message, and what a key puts out is a batch of its own, so a key's rows are taken in, kept and put out together.
"""

from __future__ import annotations

import pickle
from bisect import bisect_right
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

SESSION = "start long, last long, state string, n long"
WAITING = f"at array<long>, tie array<long>, state array<string>, open struct<{SESSION.replace(' ', ':').replace(',:', ',')}>"
NEVER = -(1 << 62)
PLACE = itemgetter(0, 1)
#: Rows that are packed at once.
PACKED = 1 << 18


class Sessions(StatefulProcessor):
    """Rows wait until the watermark has passed them, so that they are taken in order; a session is put out and forgotten
    once the watermark is `gap` past its last row, or as soon as a row of another state follows it.

    What waits is one entry, with the open session before it; a session before which nothing waits is in `open`. The one
    timer of a key is at its first waiting row or at the end of its session, so it is known from them."""

    def __init__(self, gap_us: int):
        self.gap = gap_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", WAITING)
        self.open = handle.getValueState("open", SESSION)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        return self._advance(key, sorted((r[2], r[3], r[4]) for r in rows), timerValues.getCurrentWatermarkInMs(), False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        return self._advance(key, [], timerValues.getCurrentWatermarkInMs(), True)

    def _wake(self, rows: list[tuple], session: tuple | None) -> int | None:
        times = [r[0] for r in rows[:1]] + ([session[1] + self.gap] if session else [])
        return -(-min(times) // 1000) if times else None

    def _advance(self, key, fresh: list[tuple], watermark_ms: int, fired: bool) -> Iterator[Row]:
        entry = next(iter(self.waiting.get()), None)
        rows, before = (list(zip(*entry[:3], strict=True)), tuple(entry[3]) if entry[3] else None) if entry else ([], self.open.get())
        timer, session, out = self._wake(rows, before), before, []
        rows = sorted(rows + fresh)
        passed = watermark_ms * 1000
        n = bisect_right(rows, passed, key=lambda r: r[0])
        for at, _, state in rows[:n]:
            if session is not None and (at - session[1] > self.gap or state != session[2]):
                out.append(session)
                session = None
            session = (at, at, state, 1) if session is None else (session[0], at, state, session[3] + 1)
        if session is not None and session[1] + self.gap <= passed:
            out.append(session)
            session = None
        later = rows[n:]
        if later:
            self.waiting.put([(*map(list, zip(*later, strict=True)), session)])
        elif entry:
            self.waiting.clear()
        held, now = None if entry else before, None if later else session
        if now is not None and now != held:
            self.open.update(now)
        elif now is None and held is not None:
            self.open.clear()
        wake = self._wake(later, session)
        if wake != timer:
            if timer is not None and not fired:  # one that has fired is deleted by Spark
                self.handle.deleteTimer(timer)
            if wake is not None:
                self.handle.registerTimer(wake)
        if out:
            yield Row(key=key[0], **dict(zip(("start", "last", "state", "n"), map(list, zip(*out, strict=True)), strict=True)))

    def close(self) -> None:
        pass


def stream_state_sessions(events: DataFrame, key: str, time: str, tie: str, state: Column, gap_seconds: int, late: str = "0 seconds") -> DataFrame:
    """key, start, last, state, n of each session of a key: rows of one state, none more than the gap after the one before.

    Append mode. Rows may come out of order within `late`; later ones are dropped by the watermark, and null keys or times
    with them. A key without an open session keeps no state. What is open when a stream stops comes out when it goes on.
    """
    kind = events.schema[key].dataType.simpleString()
    rows = events.where(F.col(key).isNotNull() & F.col(time).isNotNull()).withWatermark(time, late)
    rows = rows.select(key, time, F.unix_micros(time).alias("s_at"), F.col(tie).cast("long").alias("s_tie"), F.coalesce(state.cast("string"), F.lit("")).alias("s_state"))
    out = rows.groupBy(key).transformWithState(Sessions(gap_seconds * 1_000_000), f"key {kind}, start array<long>, last array<long>, state array<string>, n array<long>", "Append", "EventTime")
    out = out.select("key", F.inline(F.arrays_zip("start", "last", "state", "n")))
    return out.select(F.col("key").alias(key), F.timestamp_micros("start").alias("start"), F.timestamp_micros("last").alias("last"), "state", "n")


class Ordered(StatefulProcessor):
    """Rows of a key in ascending (s_a, s_b); those that come behind a later one of another batch are late and not taken in.

    They come packed (_packed), and all that a key keeps is one entry: the place of its last row, and `state`."""

    columns: tuple[str, ...] = ()
    #: Whether late rows come out, with nulls.
    shows_late = True
    #: What a key keeps besides its last place, and what that is at first.
    state: str
    empty: tuple

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getValueState("kept", f"a long, b long, {self.state}")

    def take(self, held: tuple, rows: list[tuple]) -> tuple[tuple, list[tuple]]:
        """What is kept after rows (s_a, s_b, more) in their order, and what comes out for them: (s_b, columns)."""
        raise NotImplementedError

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        kept = self.kept.get() or (NEVER, NEVER, *self.empty)
        placed, out = [], []
        for pack in rows:
            for r in zip(*pickle.loads(pack[1]), strict=True):
                if r[0] is not None and r[1] is not None:
                    placed.append(r)
                else:
                    out.append(r)
        placed.sort(key=PLACE)
        late = bisect_right(placed, tuple(kept[:2]), key=PLACE)
        out = [(r[1], *(None for _ in self.columns)) for r in out + placed[:late]] if self.shows_late else []
        if good := placed[late:]:
            held, taken = self.take(tuple(kept[2:]), good)
            out += taken
            self.kept.update((*PLACE(good[-1]), *held))
        if out:
            yield Row(key=key[0], **dict(zip(("s_b", *self.columns), zip(*out, strict=True), strict=True)))

    def close(self) -> None:
        pass


class Histories(Ordered):
    """The last `size` values since the last gap or change of identity: a row comes out once there are that many."""

    columns = ("history",)
    shows_late = False
    state, empty = "at long, identity string, held array<long>", (NEVER, None, [])

    def __init__(self, size: int, max_gap: int):
        self.size, self.max_gap = size, max_gap

    def take(self, held: tuple, rows: list[tuple]) -> tuple[tuple, list[tuple]]:
        at, identity, values = held
        values, out = list(values), []
        for a, b, own, value in rows:
            if a - at > self.max_gap or own != identity:
                values = []
            at, identity, values = a, own, [*values[-self.size + 1 :], value] if self.size > 1 else [value]
            if len(values) == self.size:
                out.append((b, values))
        return (at, identity, values), out


class RecentKeys(Ordered):
    """Whether a row's key was among the `back` rows before it; the ring holds those keys, and how often each is there."""

    columns = ("duplicate",)
    state, empty = "items array<string>", ([],)

    def __init__(self, back: int):
        self.back = back

    def take(self, held: tuple, rows: list[tuple]) -> tuple[tuple, list[tuple]]:
        seen = list(held[0])
        counts: dict[str, int] = {}
        for item in seen:
            counts[item] = counts.get(item, 0) + 1
        out = []
        for _, b, item in rows:
            out.append((b, counts.get(item, 0) > 0))
            seen.append(item)
            counts[item] = counts.get(item, 0) + 1
            if len(seen) > self.back:
                gone = seen[len(seen) - self.back - 1]
                counts[gone] -= 1
                if not counts[gone]:
                    del counts[gone]
        return (seen[-self.back :],), out


class Epochs(Ordered):
    """Rules by kind: a row of kind `reset` begins an epoch; the maximum of an epoch starts anew with it, that of the
    lifetime doesn't; rows of kind `ignored` count in neither."""

    columns = ("epoch", "in_epoch", "lifetime")
    state, empty = "epoch long, in_epoch long, lifetime long", (0, None, None)

    def take(self, held: tuple, rows: list[tuple]) -> tuple[tuple, list[tuple]]:
        epoch, own, ever = held
        out = []
        for _, b, kind, value in rows:
            if kind == "reset":
                epoch, own = epoch + 1, None
            if kind != "ignored" and value is not None:
                own = value if own is None or value > own else own
                ever = value if ever is None or value > ever else ever
            out.append((b, epoch, own, ever))
        return (epoch, own, ever), out


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, s_a, s_b, more), of longs and strings but for the key (not nested), as one row for each key and PACKED rows
    or so: the lists of its columns, pickled, in the order of (s_a, s_b)."""

    def listed(c: pa.Array) -> list:
        if not c.null_count or not pa.types.is_integer(c.type):
            return c.to_numpy(zero_copy_only=False).tolist()
        values = c.fill_null(0).to_numpy().astype(object)  # else they would be doubles
        values[c.is_null().to_numpy(zero_copy_only=False)] = None
        return values.tolist()

    def pack(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held)
        for part in rows.sort_by([(c, "ascending") for c in rows.column_names[:3]]).combine_chunks().to_batches():
            key, *more = part.columns
            starts = np.flatnonzero(np.append(True, pc.not_equal(key[1:], key[:-1]).to_numpy(zero_copy_only=False)))
            lists, ends = [listed(c) for c in more], [*starts[1:].tolist(), len(key)]
            packs = [pickle.dumps([x[i:j] for x in lists]) for i, j in zip(starts.tolist(), ends, strict=True)]
            yield pa.RecordBatch.from_arrays([key.take(pa.array(starts)), pa.array(packs, pa.binary())], ["s_key", "s_rows"])

    held, n = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
        if n >= PACKED:
            yield from pack(held)
            held, n = [], 0
    if held:
        yield from pack(held)


def _streamed(rows: DataFrame, key: str, a: Column, b: str, more: dict[str, Column], processor: Ordered, out: dict[str, str]) -> DataFrame:
    """What the processor puts out. Each value of a row or an array that goes into the state's worker is converted on its
    own, which costs more than all else, so a key's rows of a batch are brought together and packed first."""
    kinds = {f: rows.schema[f].dataType.simpleString() for f in (key, b)}
    ordered = rows.where(F.col(key).isNotNull()).select(F.col(key).alias("s_key"), a.cast("long").alias("s_a"), F.col(b).cast("long").alias("s_b"), *(c.alias(n) for n, c in more.items()))
    ordered = ordered.repartition("s_key").mapInArrow(_packed, f"s_key {kinds[key]}, s_rows binary")
    arrays = ", ".join(f"{c} array<{kind}>" for c, kind in ({"s_b": "long"} | out).items())
    done = ordered.groupBy("s_key").transformWithState(processor, f"key {kinds[key]}, {arrays}", "Append", "None")
    done = done.select("key", F.inline(F.arrays_zip("s_b", *out)))
    return done.select(F.col("key").alias(key), F.col("s_b").cast(kinds[b]).alias(b), *out)


def stream_histories(rows: DataFrame, key: str, at: str, tie: str, identity: Column, value: str, size: int, max_gap: int) -> DataFrame:
    """key, tie, history: the last `size` values of each row that has so many since the last step of `at` over max_gap and
    the last change of identity. The buffer holds `size` rows; late rows are left out."""
    more = {"s_identity": F.coalesce(identity.cast("string"), F.lit("")), "s_value": F.col(value).cast("long")}
    return _streamed(rows, key, F.col(at), tie, more, Histories(size, max_gap), {"history": "array<long>"})


def stream_repeated_within(rows: DataFrame, key: str, at: str, tie: str, item: Column, back: int) -> DataFrame:
    """key, tie, duplicate: the row's item was among the key's `back` rows before it; null for late rows. The ring holds
    `back` items."""
    return _streamed(rows, key, F.col(at), tie, {"s_item": F.coalesce(item.cast("string"), F.lit("\u0000"))}, RecentKeys(back), {"duplicate": "boolean"})


def stream_epochs(rows: DataFrame, key: str, at: str, tie: str, resets: Column, ignored: Column, value: str) -> DataFrame:
    """key, tie, epoch, in_epoch, lifetime of each row: how many epochs have begun, and the largest values of this one and
    of all so far that aren't `ignored`; null for late rows. A key keeps three numbers."""
    kind = F.when(F.coalesce(resets, F.lit(False)), "reset").when(F.coalesce(ignored, F.lit(False)) | F.col(value).isNull(), "ignored").otherwise("value")
    return _streamed(rows, key, F.col(at), tie, {"s_kind": kind, "s_value": F.col(value).cast("long")}, Epochs(), {"epoch": "long", "in_epoch": "long", "lifetime": "long"})
