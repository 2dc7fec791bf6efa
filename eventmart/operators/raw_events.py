"""Raw documents -> canonical engagement events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.functions.identity import numeric_user_id
from eventmart.functions.times import parse_compact
from eventmart.operators.load import REASON
from eventmart.sources.ndjson import RAW, SOURCE


def with_time(docs: DataFrame) -> DataFrame:
    """Documents that are there and have a ``ts``."""
    return docs.where(
        F.col("doc").isNotNull() & F.try_variant_get("doc", "$.ts", "string").isNotNull()
    )


def to_events(docs: DataFrame, keep_source: bool = False) -> DataFrame:
    """Canonical events with the load's reject reason. Lines that are not JSON and documents
    whose ``ts`` is no time are rejects; documents without ``ts`` are left out. ``source_file``
    is empty unless ``keep_source``; the ledger gets the file either way."""
    ts = F.col("event_ts")
    stamped = F.try_variant_get("doc", "$.ts", "string")
    return (
        docs.where(F.col("doc").isNull() | stamped.isNotNull())
        .withColumn("event_ts", parse_compact(stamped))
        .select(
            ts.cast("date").alias("event_date"),
            ts,
            numeric_user_id(F.col("doc")).alias("user_id"),
            F.try_variant_get("doc", "$.eventName", "string").alias("event_name"),
            (F.col("source_path") if keep_source else F.lit("")).alias("source_file"),
            F.col("doc").alias("attributes"),
            F.when(F.col("doc").isNull(), "not JSON")
            .when(ts.isNull(), "event_ts: not a timestamp_ntz")
            .alias(REASON),
            F.when(F.col("doc").isNull() | ts.isNull(), F.col("raw")).alias(RAW),
            F.col("source_path").alias(SOURCE),
        )
    )
