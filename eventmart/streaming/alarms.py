"""Threshold alarms on a stream of metric samples.

Samples become one row per metric and period in a windowed aggregation, so a metric with many samples is
combined before it is shuffled. A row leaves once the watermark has passed its period. Behind it, keyed state holds
per metric how long the present run of breaches is, over batches and restarts.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PERIODS = "metric string, period_start timestamp, stat double, breach boolean, alarm boolean, raised boolean"


class BreachRuns(StatefulProcessor):
    """Periods (number, stat) of a metric -> the same with breach, alarm and raised.

    The state is the number of the last period and the length of the run that it ends.
    """

    def __init__(self, period: int, periods: int, threshold: float):
        self.period, self.periods, self.threshold = period, periods, threshold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.run = handle.getValueState("run", "last long, length long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last, length = self.run.get() if self.run.exists() else (None, 0)
        out = pd.concat(list(rows)).sort_values("number", ignore_index=True)
        lengths = []
        for number, stat in zip(out["number"].tolist(), out["stat"].tolist()):
            length = (length if last == number - 1 else 0) + 1 if stat > self.threshold else 0
            last = number
            lengths.append(length)
        self.run.update((last, length))
        run = pd.Series(lengths, dtype="int64")
        yield pd.DataFrame({
            "metric": key[0], "period_start": pd.to_datetime(out["number"] * self.period, unit="s"), "stat": out["stat"],
            "breach": run > 0, "alarm": run >= self.periods, "raised": run == self.periods,
        })

    def close(self) -> None:
        pass


def threshold_alarm(
    samples: DataFrame, statistic: str, period: int, periods: int, threshold: float, delay: str = "0 seconds"
) -> DataFrame:
    """The rows of :func:`eventmart.operators.opsmetrics.threshold_alarm` for a stream of (metric, ts, value), with
    ``raised``: true for the one period of each run of breaches in which the alarm goes off.

    A period is judged when the watermark, ``delay`` behind the latest sample of any metric, has passed its end; samples that come
    later than that are dropped. A period without samples, or with null values only, breaks the run.
    """
    of = {"avg": F.avg, "max": F.max}[statistic]
    timed = samples.select("metric", F.col("ts").cast("timestamp").alias("ts"), F.col("value").cast("double").alias("value"))
    per_period = (
        timed.withWatermark("ts", delay)
        .groupBy("metric", F.window("ts", f"{period} seconds").alias("w"))
        .agg(of("value").alias("stat"))
        .where(F.col("stat").isNotNull())
        .select("metric", F.floor(F.unix_seconds("w.start") / period).alias("number"), "stat")
    )
    return per_period.groupBy("metric").transformWithStateInPandas(
        statefulProcessor=BreachRuns(period, periods, threshold), outputStructType=PERIODS, outputMode="Append", timeMode="None"
    )
