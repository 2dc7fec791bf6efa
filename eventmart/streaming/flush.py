"""Batches of N rows, or of what has come after T seconds, whichever is first.

Rows go to lanes, as messages go to workers. Each lane keeps the rows that wait for their batch in list
state and the time by which they must leave as a timer, both in the state store, so a restart finds them as they were.
A batch leaves as one row. Lanes are even by a hash, and hold fewer than N rows each.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# Rows and longest wait of a landing file, of a consumer's batch, of a row-message batch.
LANDING = (100, 30_000)
CONSUMER = (100, 5_000)
ROW_MESSAGES = (10, 1_000)

BATCH = "lane int, number long, reason string, first_at timestamp, n int, rows array<string>"
_HELD = "value string, at long"
_FACTS = "number long, due long"


class RowsOrTime(StatefulProcessor):
    """Rows (lane, at, value) -> batches. ``at`` is a row's arrival in milliseconds; null: now.

    Rows are taken in the order of (at, value). A batch leaves with its N-th row, with the first
    row that arrives ``wait_ms`` or more after the batch's first one, or when its timer expires.
    """

    def __init__(self, rows: int, wait_ms: int):
        self.most, self.wait = rows, wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", _HELD)
        self.facts = handle.getValueState("facts", _FACTS)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        number, due = self.facts.get() if self.facts.exists() else (0, None)
        waiting = [(r[0], r[1]) for r in self.held.get()] if due is not None else []
        before, now, out = due, timerValues.getCurrentProcessingTimeInMs(), []
        new = pd.concat(list(rows))
        arrived = [now if pd.isna(a) else int(a) for a in new["at"]]
        for at, value in sorted(zip(arrived, new["value"])):
            if waiting and at >= due:
                out.append(self._batch(key, number, "time", waiting))
                number, waiting = number + 1, []
            if not waiting:
                due = at + self.wait
            waiting.append((value, at))
            if len(waiting) == self.most:
                out.append(self._batch(key, number, "rows", waiting))
                number, waiting = number + 1, []
        self._keep(number, waiting, due if waiting else None, before)
        yield self._frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        number, due = self.facts.get() if self.facts.exists() else (0, None)
        if due is None or expiredTimerInfo.getExpiryTimeInMs() != due:
            yield self._frame([])
            return
        waiting = [(r[0], r[1]) for r in self.held.get()]
        self.held.clear()
        self.facts.update((number + 1, None))
        yield self._frame([self._batch(key, number, "time", waiting)])

    def close(self) -> None:
        pass

    def _keep(self, number: int, waiting: list, due: int | None, before: int | None) -> None:
        if waiting:
            self.held.put(waiting)
        elif self.held.exists():
            self.held.clear()
        if before is not None and before != due:
            self.handle.deleteTimer(before)
        if due is not None and before != due:
            self.handle.registerTimer(due)
        self.facts.update((number, due))

    @staticmethod
    def _batch(key, number: int, reason: str, waiting: list) -> tuple:
        return key[0], number, reason, pd.Timestamp(waiting[0][1], unit="ms"), len(waiting), [v for v, _ in waiting]

    @staticmethod
    def _frame(batches: list) -> pd.DataFrame:
        frame = pd.DataFrame(batches, columns=["lane", "number", "reason", "first_at", "n", "rows"])
        return frame.astype({"lane": "int32", "number": "int64", "first_at": "datetime64[ns]", "n": "int32"})


def batches(
    lines: DataFrame, rows: int, wait_ms: int, lanes: int = 16, lane: Column | None = None, arrival: Column | None = None,
    delay: str = "0 seconds",
) -> DataFrame:
    """The batches of a stream with a ``value`` column: lane, number, reason (``rows`` or ``time``), first_at, n, rows.
    ``lane`` tells the lanes of rows that must stay together; else they are dealt to ``lanes`` lanes.

    Without ``arrival`` the clock tells when a row comes, and every row leaves at last. With it, a timestamp column says
    so, and timers follow the watermark, which is ``delay`` behind it: rows later than that are dropped by
    Spark, and the last batch of each lane waits for the watermark.
    """
    value = F.coalesce(F.col("value"), F.lit(""))
    lane = (F.pmod(F.xxhash64(value), F.lit(lanes)).cast("int") if lane is None else lane).alias("lane")
    mode = "ProcessingTime"
    if arrival is None:
        keyed = lines.select(lane, F.lit(None).cast("long").alias("at"), value.alias("value"))
    else:
        mode = "EventTime"
        timed = lines.withColumn("__at", arrival.cast("timestamp")).withWatermark("__at", delay)
        keyed = timed.select(lane, F.unix_millis("__at").alias("at"), value.alias("value"), "__at")
    return keyed.groupBy("lane").transformWithStateInPandas(
        statefulProcessor=RowsOrTime(rows, wait_ms), outputStructType=BATCH, outputMode="Append", timeMode=mode
    )


def write_batches(batched: DataFrame, path: str, checkpoint: str, interval: str | None = None):
    """Start writing batches as Parquet rows; ``interval`` (None: what is there, then stop)."""
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return (
        batched.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(**trigger).start()
    )


def land_batches(batched: DataFrame, path: str, checkpoint: str, interval: str = "1 second"):
    """Start landing batches as text, a file for each. A timer is looked at every ``interval``."""
    return (
        batched.select(F.array_join("rows", "\n").alias("value"))
        .writeStream.format("text").option("path", path).option("checkpointLocation", checkpoint)
        .option("maxRecordsPerFile", 1).outputMode("append").trigger(processingTime=interval).start()
    )
