"""Reports over the ingest log, the ledger and metric samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.operators.analytics import since

# Fixed values.
LOAD_MESSAGE = "inserted into.*Redshift"
BIN = "5 minutes"
OUTCOMES = ["processed", "missing", "failed", "invalid"]


def _seconds():
    return F.timestamp_diff("SECOND", F.col("started_at"), F.col("ended_at"))


def _millis():
    return F.timestamp_diff("MILLISECOND", F.col("started_at"), F.col("ended_at"))


def load_durations(log: DataFrame, as_of=None, hours: int = 1) -> DataFrame:
    return since(log, as_of, f"{hours} HOURS", "started_at", strict=True).agg(
        F.avg(_seconds()).alias("avg_duration_sec"),
        F.max(_seconds()).alias("max_duration_sec"),
        F.count("*").alias("query_count"),
    )


def load_counts(log: DataFrame, pattern: str = LOAD_MESSAGE, bin_size: str = BIN) -> DataFrame:
    """Loads per target and time bin; the same for a stream once it has a watermark."""
    return (
        log.where(F.col("msg").rlike(pattern))
        .groupBy(F.window("started_at", bin_size).alias("w"), "target")
        .agg(F.count("*").alias("load_count"))
        .select(F.col("w.start").cast("timestamp_ntz").alias("bin_start"), "target", "load_count")
    )


def worker_throughput(log: DataFrame) -> DataFrame:
    """Processed, failed and rates per worker over its uptime."""
    totals = log.groupBy("worker_id").agg(
        F.sum("processed").alias("messages_processed"),
        F.sum("failed").alias("messages_failed"),
        (
            F.timestamp_diff("MILLISECOND", F.min("started_at"), F.max("ended_at")) / F.lit(1000.0)
        ).alias("uptime"),
    )
    rate = F.col("messages_processed") / F.nullif(F.col("uptime"), F.lit(0.0))
    return totals.select(
        "worker_id",
        "messages_processed",
        "messages_failed",
        F.floor("uptime").alias("uptime_seconds"),
        rate.alias("per_second"),
        (rate * 3600).alias("per_hour"),
        (rate * 86400).alias("per_day"),
    )


def fleet(workers: DataFrame) -> DataFrame:
    return workers.agg(
        F.sum("per_hour").alias("total_per_hour"),
        F.avg("per_second").alias("avg_per_second"),
        (F.sum("messages_failed") / F.nullif(F.sum("messages_processed"), F.lit(0)) * 100).alias(
            "failure_rate"
        ),
    )


def target_health(log: DataFrame) -> DataFrame:
    ok = F.col("error").isNull()
    return log.groupBy("target").agg(
        (F.avg(F.when(ok, 1.0).otherwise(0.0)) * 100).alias("success_pct"),
        F.avg(_millis()).alias("avg_latency_ms"),
        F.count_if(~ok).alias("failure_count"),
    )


def error_types(log: DataFrame) -> DataFrame:
    return log.where("error IS NOT NULL").groupBy("target", "error").agg(F.count("*").alias("n"))


def batch_outcomes(messages: DataFrame) -> DataFrame:
    """One row per batch with a column per outcome."""
    return messages.groupBy("batch_id").agg(
        F.count("*").alias("total"), *[F.count_if(F.col("status") == s).alias(s) for s in OUTCOMES]
    )


def sync_progress(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Expected against processed files."""
    done = ledger.where(F.col("status") == "loaded").select("path").distinct()
    seen = files.join(done.withColumn("done", F.lit(True)), "path", "left")
    counted = seen.agg(
        F.count("*").alias("expected"), F.count_if(F.col("done").isNotNull()).alias("processed")
    )
    return counted.withColumns(
        {
            "pct": F.col("processed") / F.nullif(F.col("expected"), F.lit(0)) * 100,
            "matches": F.col("processed") == F.col("expected"),
        }
    )


def recent_loads(log: DataFrame, rows: int = 20, prefix: int = 50) -> DataFrame:
    return (
        log.select(
            "batch_id",
            F.left("msg", F.lit(prefix)).alias("query_start"),
            "started_at",
            "ended_at",
            _millis().alias("duration_ms"),
        )
        .orderBy(F.desc("started_at"), "batch_id")
        .limit(rows)
    )


# -- threshold alarms -----------------------------------------------------------------------
# Statistic, period in seconds, consecutive periods, threshold.
QUEUE_DEPTH_ALARM = ("avg", 300, 2, 1000000)
MESSAGE_AGE_ALARM = ("max", 60, 3, 300)


def threshold_alarm(
    samples: DataFrame, statistic: str, period: int, periods: int, threshold: float
) -> DataFrame:
    """Per metric and period: the statistic, whether it is above the threshold, and whether it
    has been for ``periods`` periods in a row. A period without samples breaks the run.

    Samples shrink to one row per period first. Each period then reports to itself and to the
    next ``periods - 1``, so runs are found by grouping and no metric's history has to pass
    through one task.
    """
    of = {"avg": F.avg, "max": F.max}[statistic]
    number = F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / period)
    per_period = (
        samples.groupBy("metric", number.alias("p"))
        .agg(of("value").alias("stat"))
        .withColumn("breach", F.col("stat") > threshold)
    )
    reports = per_period.withColumn("ahead", F.explode(F.sequence(F.lit(0), F.lit(periods - 1))))
    own = F.col("ahead") == 0
    return (
        reports.groupBy("metric", (F.col("p") + F.col("ahead")).alias("p"))
        .agg(
            F.max(F.when(own, F.col("stat"))).alias("stat"),
            F.max(F.when(own, F.col("breach"))).alias("breach"),
            F.count_if("breach").alias("breaches"),
        )
        .where(F.col("breach").isNotNull())
        .select(
            "metric",
            F.timestamp_seconds(F.col("p") * period).cast("timestamp_ntz").alias("period_start"),
            "stat",
            "breach",
            (F.col("breaches") == periods).alias("alarm"),
        )
    )
