"""Structured Streaming: one pass over ordered commands, with one small state for each slot."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tideline.sources.sinks import CommitLog

PREVIOUS = "row_id long, tick long, number long"


class Transition(StatefulProcessor):
    """The reason why a command does not follow the one before it in its slot; a command out of order is an error row.

    Within a batch the shuffle keeps no order, so a slot's rows of one batch are sorted together; the trigger bounds them.
    """

    def __init__(self, max_gap: int):
        self.max_gap = max_gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", PREVIOUS)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        last = self.last.get() if self.last.exists() else None
        f = pd.concat(list(rows)).sort_values("row_id", kind="stable").reset_index(drop=True)
        fresh = ~f["row_id"].duplicated() & (True if last is None else f["row_id"] > last[0])
        good = f[fresh]
        before = good[["tick", "number"]].shift(1)
        if last is not None and len(good):
            before.iloc[0] = last[1:]
        step = good["tick"] - before["tick"]
        reason = pd.Series(None, index=f.index, dtype=object)
        reason[~fresh] = "out_of_order"
        reason[good.index[good["number"] != before["number"] + 1]] = "command_number_discontinuity"
        reason[good.index[~step.between(0, self.max_gap)]] = "demo_tick_discontinuity"
        reason[good.index[before["tick"].isna()]] = "first_command"
        if len(good):
            last = tuple(int(x) for x in good.iloc[-1][["row_id", "tick", "number"]])
        yield pd.DataFrame({"slot": int(key[0]), "row_id": f["row_id"], "reset_reason": reason})
        if last is not None:
            self.last.update(last)

    def close(self) -> None:
        pass


def stream_transitions(commands: DataFrame, max_gap: int = 16) -> DataFrame:
    """Needs the RocksDB state store (spark.sql.streaming.stateStore.providerClass)."""
    return commands.groupBy("slot").transformWithStateInPandas(Transition(max_gap), "slot int, row_id long, reset_reason string", "Append", "None")


def stream_sessions(events: DataFrame, key: str, time: str, gap: str, late: str = "0 seconds") -> DataFrame:
    """Sessions of a key that end after `gap` without an event."""
    return events.withWatermark(time, late).groupBy(key, F.session_window(time, gap).alias("w")).agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def stream_chunks(events: DataFrame, key: str, time: str, width: str, late: str = "0 seconds") -> DataFrame:
    """Counts of a key in fixed windows."""
    return events.withWatermark(time, late).groupBy(key, F.window(time, width).alias("w")).agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def stream_first_of_key(events: DataFrame, keys: list[str], time: str, within: str) -> DataFrame:
    """The first event of each key, as long as its repeats come within the watermark."""
    return events.withWatermark(time, within).dropDuplicatesWithinWatermark(keys)


def resumable(df: DataFrame, checkpoint: str, path: str):
    """Append accepted rows batch by batch, each a commit of the log at `path`: one that is tried twice is there once, and
    readers (sinks.CommitLog.read) never see half of one."""

    def write(batch: DataFrame, number: int) -> None:
        CommitLog(batch.sparkSession, path).append(batch, f"batch-{number:010d}")

    return df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
