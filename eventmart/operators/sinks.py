"""Writers: partitioned JSON, flat NDJSON, row-batch messages, catalog tables, layouts."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.operators.csv_events import without_profile_updates
from eventmart.sources.csvlines import row_map

EVENT_TYPE_FOLDER = "events"  # fixed value
ROWS_PER_MESSAGE = 5  # fixed value
MESSAGE_BYTES = 200 * 1024  # fixed value
JSON_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss",
    "dateFormat": "yyyy-MM-dd",
}


# -- structured landing ---------------------------------------------------------------------
def write_structured_json(events: DataFrame, root: str, rows_per_file: int = 1_000_000) -> None:
    """Append events as ``date=D/type=events/name=N/*.json``, without profile updates.

    The rows keep their date and name. One shuffle gathers a (date, name) pair into few files;
    a pair that dominates is split by size, and no file exceeds ``rows_per_file``.
    """
    laid_out = without_profile_updates(events).withColumns(
        {
            "date": F.col("event_date"),
            "type": F.lit(EVENT_TYPE_FOLDER),
            "name": F.col("event_name"),
        }
    )
    (
        laid_out.hint("rebalance", "date", "name")
        .write.mode("append")
        .options(**JSON_OPTIONS)
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy("date", "type", "name")
        .json(root)
    )


def path_messages(spark: SparkSession, root: str) -> DataFrame:
    """One row per written file and source file, with the file's own row count."""
    rows = spark.read.schema("source_file STRING").json(root)
    return rows.groupBy(F.col("_metadata.file_path").alias("s3_path"), "source_file").agg(
        F.count("*").alias("row_count")
    )


def write_flat_ndjson(rows: DataFrame, path: str) -> None:
    """CSV rows as flat JSON lines with every header as a key and empty values null."""
    flat_json(rows).write.mode("append").text(path)


def flat_json(rows: DataFrame) -> DataFrame:
    return rows.select(F.to_json(row_map(), {"ignoreNullFields": "false"}).alias("value"))


# -- row-batch messages ---------------------------------------------------------------------
def pack_rows(
    events: DataFrame,
    source: str,
    rows_per_message: int = ROWS_PER_MESSAGE,
    max_bytes: int = MESSAGE_BYTES,
) -> DataFrame:
    """Events with ``line_no`` -> (source_file, chunk, part, data) of at most
    ``rows_per_message`` rows and, where single rows allow it, ``max_bytes`` of rows.

    Groups are as small as a message, so one large file spreads over all tasks.
    """
    columns = [c for c in events.columns if c != "line_no"]
    text = F.to_json(F.struct(*columns), JSON_OPTIONS)
    # data lines start at line 2
    chunk = F.floor((F.col("line_no") - 2) / rows_per_message)
    ordered = F.array_sort(F.collect_list(F.struct("line_no", "row")))
    start = F.struct(
        F.array().cast("array<array<string>>").alias("parts"), F.lit(0).cast("bigint").alias("size")
    )

    def put(acc: Column, item: Column) -> Column:
        row = item["row"]
        size = F.octet_length(row).cast("bigint") + 1
        last = F.element_at(acc["parts"], -1)
        joins = (F.size(acc["parts"]) > 0) & (acc["size"] + size <= max_bytes)
        grown = F.concat(
            F.slice(acc["parts"], 1, F.size(acc["parts"]) - 1),
            F.array(F.array_append(last, row)),
        )
        opened = F.array_append(acc["parts"], F.array(row))
        return F.when(joins, F.struct(grown.alias("parts"), (acc["size"] + size).alias("size"))).otherwise(
            F.struct(opened.alias("parts"), size.alias("size"))
        )

    packed = (
        events.select("source_file", "line_no", chunk.alias("chunk"), text.alias("row"))
        .groupBy("source_file", "chunk")
        .agg(ordered.alias("rows"))
        .withColumn("parts", F.aggregate("rows", start, put)["parts"])
    )
    rows = F.transform("part_rows", lambda r: F.parse_json(r))
    return packed.select(
        "source_file", "chunk", F.posexplode("parts").alias("part", "part_rows")
    ).select(
        "source_file",
        "chunk",
        "part",
        F.size("part_rows").alias("row_count"),
        F.struct(
            F.lit(source).alias("source"), F.col("source_file").alias("sourceFile"), rows.alias("rows")
        ).alias("data"),
    )


def conversion_counts(messages: DataFrame) -> DataFrame:
    """Rows and messages per file, and in total (null file)."""
    return messages.rollup("source_file").agg(
        F.sum("row_count").alias("total_rows"), F.count("*").alias("total_messages")
    )


# -- catalog tables -------------------------------------------------------------------------
def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in schema.fields)


def create_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    location: str | None = None,
    partition_by: list[str] | None = None,
) -> None:
    """Create a Parquet table unless it exists."""
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({_ddl(schema)}) USING parquet{parts}{where}")


STAGING = T.StructType([T.StructField("raw_data", T.VariantType())])  # fixed value


def create_document_tables(spark: SparkSession, name: str, schema: T.StructType, location: str) -> None:
    """The documents' staging and final table."""
    create_table(spark, f"{name}_staging", STAGING, f"{location}/staging")
    create_table(spark, name, schema, f"{location}/final")


def truncate_table(spark: SparkSession, name: str) -> None:
    """Empty a table by overwriting it with no rows, which external tables allow too."""
    nothing = spark.createDataFrame([], spark.table(name).schema)
    nothing.write.mode("overwrite").option("partitionOverwriteMode", "static").insertInto(name)


# -- layouts --------------------------------------------------------------------------------
def write_clustered(
    df: DataFrame,
    name: str,
    location: str,
    by: str = "customer_user_id",
    sort: tuple[str, ...] = ("event_time", "appsflyer_id"),
    buckets: int = 64,
) -> None:
    """A table bucketed by customer and sorted by time and id.

    The shuffle uses the bucket function, so a task writes whole buckets. A bucket that
    dominates (one customer, or no customer) is split by size into several files of that
    bucket instead of going through one task.
    """
    (
        df.hint("rebalance", buckets, by)
        .write.mode("overwrite")
        .option("path", location)
        .bucketBy(buckets, by)
        .sortBy(*sort)
        .saveAsTable(name)
    )


def write_by_month(
    df: DataFrame,
    path: str,
    time: str = "event_time",
    sort: tuple[str, ...] = ("event_time", "appsflyer_id"),
) -> None:
    """Parquet partitioned by ``event_month`` (yyyyMM), sorted inside for row-group skipping."""
    months = df.withColumn("event_month", F.date_format(time, "yyyyMM"))
    (
        months.hint("rebalance", "event_month")
        .sortWithinPartitions("event_month", *sort)
        .write.mode("overwrite")
        .partitionBy("event_month")
        .parquet(path)
    )


def read_months(spark: SparkSession, path: str, schema: T.StructType, months: list[str]) -> DataFrame:
    """Rows of some months; other months' folders are not listed for the scan."""
    full = T.StructType(schema.fields + [T.StructField("event_month", T.StringType())])
    return spark.read.schema(full).parquet(path).where(F.col("event_month").isin(months))


def new_batch_id() -> str:
    return uuid.uuid4().hex


