"""Newline-delimited JSON events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.functions.values import replace_invalid_bytes
from eventmart.schemas import landing_schema

RAW = "_raw"
SOURCE = "_source"


def read_ndjson(
    spark: SparkSession,
    paths: str | list[str],
    table: T.StructType,
    *,
    accept_invalid_bytes: bool = False,
) -> DataFrame:
    """One JSON object per line, matched to columns by name; unknown keys are ignored and
    missing ones null. Columns arrive as text (see ``landing_schema``); a line that is not
    JSON arrives in ``_raw`` with all columns null. ``_source`` is the file."""
    if accept_invalid_bytes:
        lines = spark.read.option("recursiveFileLookup", "true").text(paths)
        fixed = lines.select(
            replace_invalid_bytes(F.col("value")).alias("value"),
            F.col("_metadata.file_path").alias(SOURCE),
        )
        return parse_ndjson(fixed, table)
    schema = T.StructType(landing_schema(table).fields + [T.StructField(RAW, T.StringType())])
    return (
        spark.read.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", RAW)
        .option("recursiveFileLookup", "true")
        .json(paths)
        .select("*", F.col("_metadata.file_path").alias(SOURCE))
    )


def parse_ndjson(lines: DataFrame, table: T.StructType, column: str = "value") -> DataFrame:
    """The same for lines that are already a column, batch or stream."""
    schema = T.StructType(landing_schema(table).fields + [T.StructField(RAW, T.StringType())])
    parsed = F.from_json(
        F.col(column), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RAW}
    )
    kept = [c for c in lines.columns if c != column]
    return lines.where(F.col(column) != "").select(*kept, parsed.alias("r")).select(*kept, "r.*")
