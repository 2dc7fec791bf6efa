"""Message envelopes ``{id, timestamp, data}``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"  # fixed value


def wrap(df: DataFrame, data: Column, source: str, *, at: Column | None = None) -> DataFrame:
    """Add ``body`` (fresh id, time, payload) and the ``source`` message attribute."""
    stamp = F.date_format(F.current_timestamp() if at is None else at, ISO_MILLIS)
    body = F.struct(F.uuid().alias("id"), stamp.alias("timestamp"), data.alias("data"))
    return df.withColumns(
        {
            "body": F.to_json(body, {"ignoreNullFields": "false"}),
            "message_source": F.lit(source),
        }
    )


def unwrap(bodies: DataFrame, column: str = "body") -> DataFrame:
    """Bodies as (id, timestamp, data); ``valid`` is false for a body that is not JSON."""
    doc = F.try_parse_json(F.col(column))
    kept = [c for c in bodies.columns if c != column]
    return bodies.withColumn("_doc", doc).select(
        *kept,
        F.col(column).alias("raw"),
        F.try_variant_get("_doc", "$.id", "string").alias("id"),
        F.try_variant_get("_doc", "$.timestamp", "string").alias("timestamp"),
        F.try_variant_get("_doc", "$.data", "variant").alias("data"),
        F.col("_doc").isNotNull().alias("valid"),
    )


def explode_rows(envelopes: DataFrame, column: str = "data") -> DataFrame:
    """One row per event: the entries of ``data.rows``, or ``data`` itself when there are none."""
    rows = F.coalesce(
        F.try_variant_get(column, "$.rows", "array<variant>"), F.array(F.col(column))
    )
    return envelopes.where("valid").withColumn("row", F.explode(rows))


def path_messages(envelopes: DataFrame) -> DataFrame:
    """Path messages with ``status``: ``invalid`` when the body does not parse or names no
    path, else ``pending``."""
    path = F.nullif(F.try_variant_get("data", "$.s3_path", "string"), F.lit(""))
    own = ("id", "timestamp", "raw", "data", "valid")
    return envelopes.select(
        *[c for c in envelopes.columns if c not in own],
        "id",
        "timestamp",
        "raw",
        path.alias("s3_path"),
        F.try_variant_get("data", "$.source_file", "string").alias("source_file"),
        F.coalesce(F.try_variant_get("data", "$.row_count", "bigint"), F.lit(0)).alias("row_count"),
        F.when(F.col("valid") & path.isNotNull(), "pending").otherwise("invalid").alias("status"),
    )


def distinct_paths(messages: DataFrame) -> DataFrame:
    """The earliest message of each path; repeated messages are processed once."""
    first = F.min_by(F.struct(*messages.columns), F.struct("timestamp", "id")).alias("m")
    return (
        messages.where(F.col("status") == "pending")
        .groupBy(F.col("s3_path").alias("_path"))
        .agg(first)
        .select("m.*")
    )
