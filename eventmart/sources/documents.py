"""Raw JSON documents, each kept whole as one semi-structured value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_documents(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(raw, doc, source_path): the line, its value, and the file. ``doc`` is null for a line
    that is not JSON. Gzip is read by suffix."""
    return (
        spark.read.option("recursiveFileLookup", "true")
        .text(paths)
        .where(F.col("value") != "")
        .select(
            F.col("value").alias("raw"),
            F.try_parse_json("value").alias("doc"),
            F.col("_metadata.file_path").alias("source_path"),
        )
    )


def project_paths(df: DataFrame, paths: dict[str, str], column: str = "doc") -> DataFrame:
    """JSON paths of a document as columns: ``{"user_id": "$.profile.identity", ...}``.
    ``$`` is the whole document; anything else is text."""

    def one(path: str) -> Column:
        return F.col(column) if path == "$" else F.try_variant_get(F.col(column), path, "string")

    return df.select(*[one(p).alias(name) for name, p in paths.items()])


# The path list of the documents' table.
DOCUMENT_PATHS = {
    "event_date": "$.ts",
    "event_ts": "$.ts",
    "user_id": "$.profile.identity",
    "event_name": "$.eventName",
    "attributes": "$",
    "source_file": "$",
}
SAMPLE_ROWS = 3


def profile(docs: DataFrame, column: str = "doc") -> DataFrame:
    """One row: number of parsable documents and the merged schema of all of them."""
    return docs.where(F.col(column).isNotNull()).agg(
        F.count("*").alias("documents"), F.schema_of_variant_agg(column).alias("schema")
    )


def sample(docs: DataFrame, rows: int = SAMPLE_ROWS, column: str = "doc") -> DataFrame:
    """The first parsable documents with their top-level keys."""
    keys = F.json_object_keys(F.to_json(column))
    return docs.where(F.col(column).isNotNull()).limit(rows).select(column, keys.alias("keys"))
