"""Received payloads -> landed NDJSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.operators.load import REASON, check_required
from eventmart.schemas import ATTRIBUTION, REQUIRED
from eventmart.sources.ndjson import parse_ndjson

# Fixed values.
ROWS_PER_FILE = 100
FLUSH_INTERVAL = "30 seconds"


def payload_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Text payloads as they arrive in a folder."""
    return (
        spark.readStream.option("maxFilesPerTrigger", files_per_batch)
        .option("recursiveFileLookup", "true")
        .text(path)
    )


def accepted(payloads: DataFrame) -> DataFrame:
    """Payload texts that pass the receiving check."""
    wanted = T.StructType([ATTRIBUTION[c] for c in REQUIRED])  # only these are parsed
    parsed = parse_ndjson(payloads.select("value", F.col("value").alias("payload")), wanted)
    passed = check_required(parsed, "payload").where(F.col(REASON).isNull())
    return passed.select(F.col("payload").alias("value"))


def land(
    payloads: DataFrame,
    path: str,
    checkpoint: str,
    rows_per_file: int = ROWS_PER_FILE,
    interval: str | None = FLUSH_INTERVAL,
):
    """Start landing accepted payloads: files of at most ``rows_per_file`` lines, written every
    ``interval`` (None: whatever is there, then stop). A failed batch is replayed from the
    checkpoint and its partial files are never listed."""
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return (
        accepted(payloads)
        .writeStream.format("text")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .option("maxRecordsPerFile", rows_per_file)
        .outputMode("append")
        .trigger(**trigger)
        .start()
    )
