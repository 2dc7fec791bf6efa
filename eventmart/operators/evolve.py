"""Schema evolution: headers of new files become columns of the table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.functions.csvtext import split_fields
from eventmart.functions.values import safe_column_name
from eventmart.sources.csvlines import read_headers


def header_names(headers: DataFrame) -> DataFrame:
    """Distinct header names with the column name each one gets; names without a usable one
    are left out."""
    names = headers.select(F.explode(split_fields(F.col("header"))).alias("header")).distinct()
    return names.withColumn("column", safe_column_name(F.col("header"))).where(
        F.col("column").isNotNull()
    )


def missing_columns(headers: DataFrame, existing: list[str]) -> list[str]:
    """Column names the headers need and the table lacks, ignoring case, in name order.

    Column names only: the list is as long as a table is wide.
    """
    known = [c.lower() for c in existing]
    names = header_names(headers).select("column").distinct()
    return [r["column"] for r in names.where(~F.col("column").isin(known)).orderBy("column").collect()]


def add_columns(spark: SparkSession, table: str, columns: list[str]) -> int:
    """Add text columns in one statement; columns that exist by now are skipped."""
    present = {c.lower() for c in spark.table(table).columns}
    new = [c for c in dict.fromkeys(columns) if c.lower() not in present]
    if new:
        listing = ", ".join(f"`{c}` STRING" for c in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({listing})")
    return len(new)


def sync_schema(spark: SparkSession, table: str, sample: str | list[str]) -> int:
    """Read the sample's headers and add what the table lacks. Returns the number added."""
    headers = read_headers(spark, sample)
    return add_columns(spark, table, missing_columns(headers, spark.table(table).columns))


def combine(batches: list[DataFrame]) -> DataFrame:
    """Batches with different columns as one frame, missing columns null."""
    out = batches[0]
    for other in batches[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out
