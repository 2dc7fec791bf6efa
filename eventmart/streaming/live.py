"""Live counts over the ingest log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.operators.opsmetrics import BIN, LOAD_MESSAGE, load_counts


def live_load_counts(
    log: DataFrame, delay: str = "10 minutes", pattern: str = LOAD_MESSAGE, bin_size: str = BIN
) -> DataFrame:
    """Loads per target and bin of a log stream; a bin is final once the watermark passes it."""
    # watermarks are kept on zoned timestamps
    stamped = log.withColumn("started_at", F.col("started_at").cast("timestamp"))
    return load_counts(stamped.withWatermark("started_at", delay), pattern, bin_size)
