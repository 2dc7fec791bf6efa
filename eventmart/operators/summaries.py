"""Daily summaries of a batch table, kept beside it, so that reports over many days need not read events.

One set of rows per published batch: counts and revenue by day and dimensions, and a sketch of the distinct users. Sketches
merge, so distinct users over any days come from them; their relative standard error is about 1.04 / sqrt(2 ** LG_K), 0.8 %.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.operators.tables import BatchTable

LG_K = 14
ERROR = 3 * 1.04 / 2 ** (LG_K / 2)  # three standard errors: all but some 0.3 % of estimates are nearer
DIMENSIONS = ("event_name", "media_source", "campaign", "platform")


class DailySummaries:
    """``<table>/daily/batch_id=<id>/``: day, dimensions, events, revenue_events, revenue, users (a sketch), attempt.

    A summary names the attempt it was made from and counts only while the ledger names the same one, so
    neither a replay nor a corrected load counts twice.
    """

    def __init__(self, table: BatchTable, time: str = "event_time", user: str = "customer_user_id", revenue: str = "event_revenue_usd",
                 dimensions: tuple[str, ...] = DIMENSIONS):
        self.table, self.time, self.user, self.revenue, self.dimensions = table, time, user, revenue, list(dimensions)
        names = [T.StructField("day", T.DateType()), *(table.schema[d] for d in dimensions)]
        self._stored = T.StructType([*names, *T._parse_datatype_string(
            "events long, revenue_events long, revenue decimal(28,6), users binary, attempt string, batch_id string").fields])

    def _all(self) -> DataFrame:
        return self.table.side(f"{self.table.root}/daily", self._stored)

    def refresh(self) -> None:
        """Summarise the published batches that have no summary of their attempt, all in one job."""
        loaded = self.table.published()
        todo = loaded.join(self._all().select("batch_id", "attempt").distinct(), ["batch_id", "attempt"], "left_anti")
        rows = self.table.rows_of(todo)
        user = F.coalesce(F.col(self.user).cast("string"), F.lit(""))
        made = rows.groupBy(F.to_date(self.time).alias("day"), *self.dimensions, "batch_id", "attempt").agg(
            F.count("*").alias("events"), F.count(self.revenue).alias("revenue_events"),
            F.sum(F.col(self.revenue).cast("decimal(18,6)")).alias("revenue"),
            F.hll_sketch_agg(F.when(user != "", user), LG_K).alias("users"),
        )
        (
            made.select(*[F.col(f.name).cast(f.dataType) for f in self._stored.fields]).repartition("batch_id")
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{self.table.root}/daily")
        )

    def read(self) -> DataFrame:
        """Summaries of the published attempts."""
        return self._all().join(self.table.published(), ["batch_id", "attempt"], "left_semi").drop("attempt")

    def report(self, by: list[str], first_day=None, last_day=None, where=None) -> DataFrame:
        """Whole days from ``first_day`` to ``last_day``: ``by``, events, revenue_events, revenue, users (estimated)."""
        rows = self.read()
        if first_day is not None:
            rows = rows.where(F.col("day") >= F.lit(first_day).cast("date"))
        if last_day is not None:
            rows = rows.where(F.col("day") <= F.lit(last_day).cast("date"))
        if where is not None:
            rows = rows.where(where)
        return rows.groupBy(*by).agg(
            F.sum("events").alias("events"), F.sum("revenue_events").alias("revenue_events"), F.sum("revenue").alias("revenue"),
            F.hll_sketch_estimate(F.hll_union_agg("users")).alias("users"),
        )
