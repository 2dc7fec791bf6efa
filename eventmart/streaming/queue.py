"""Message streams: envelopes, row batches, path messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.schemas import CANONICAL
from eventmart.sources.envelopes import explode_rows, path_messages, unwrap


def body_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Message bodies, one per line. With a Kafka source the value column takes this place."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path)
    return lines.select(F.col("value").alias("body"))


def engagement_rows(bodies: DataFrame) -> DataFrame:
    """Bodies -> canonical columns as text, ready for the typed load. Works on batch and stream."""
    rows = explode_rows(unwrap(bodies))
    return rows.select(
        "id",
        *[
            F.try_variant_get(
                "row",
                f"$.{f.name}",
                "variant" if isinstance(f.dataType, T.VariantType) else "string",
            ).alias(f.name)
            for f in CANONICAL.fields
        ],
    )


def invalid_bodies(bodies: DataFrame) -> DataFrame:
    return unwrap(bodies).where("NOT valid").select("raw")


def distinct_path_stream(bodies: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Pending path messages, each path once within the watermark."""
    pending = path_messages(unwrap(bodies)).where(F.col("status") == "pending")
    return (
        pending.withColumn("sent_at", F.try_to_timestamp("timestamp"))
        .withWatermark("sent_at", delay)
        .dropDuplicatesWithinWatermark(["s3_path"])
    )
