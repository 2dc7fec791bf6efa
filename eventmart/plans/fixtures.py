"""Inputs derived from the driver tables, at whatever size those have.

Each derivation is one SELECT that Spark and DuckDB both run. File inputs are written by Spark
to the shared folder, once per application and data directory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.operators.sinks import JSON_OPTIONS
from eventmart.session import scratch_path

AS_OF = "2024-01-31 00:00:00"
LOADED_AT = "2024-02-01 00:00:00"
NOT_JSON = "not json {"

# -- attribution events ---------------------------------------------------------------------
ATTRIBUTION_SQL = """
SELECT 'e' || CAST(event_id AS STRING) AS appsflyer_id,
       CASE event_type WHEN 'signup' THEN 'install' WHEN 'purchase' THEN 'af_purchase'
            ELSE event_type END AS event_name,
       ts AS event_time,
       CAST(user_id AS STRING) AS customer_user_id,
       CASE event_id % 3 WHEN 0 THEN 'ios' WHEN 1 THEN 'android' END AS platform,
       CASE event_id % 4 WHEN 0 THEN 'organic' WHEN 1 THEN 'search' WHEN 2 THEN 'social'
            ELSE 'referral' END AS media_source,
       'c' || CAST(event_id % 7 AS STRING) AS campaign,
       CASE WHEN event_type = 'purchase' AND event_id % 10 <> 0
            THEN CAST(value AS DECIMAL(18,6)) END AS event_revenue_usd,
       props AS event_value,
       event_id
FROM events"""

# -- canonical engagement events ------------------------------------------------------------
CANONICAL_SQL = """
SELECT CAST(ts AS DATE) AS event_date,
       date_trunc('second', ts) AS event_ts,
       CAST(user_id AS STRING) AS user_id,
       event_type AS event_name,
       'f' || CAST(event_id % 4 AS STRING) AS source_file,
       props AS attributes,
       event_id
FROM events"""

# -- ingest log -----------------------------------------------------------------------------
LOG_SQL = """
SELECT 'b' || CAST(event_id AS STRING) AS batch_id,
       'w' || CAST(event_id % 500 // 100 AS STRING) AS worker_id,
       CASE WHEN event_id % 200 = 0 THEN 'primary' ELSE 'secondary' END AS target,
       CASE WHEN event_id % 700 = 0 THEN 'poll idle' ELSE 'Batch of rows inserted into '
            || CASE WHEN event_id % 200 = 0 THEN 'primary' ELSE 'secondary' END
            || ' Redshift cluster' END AS msg,
       ts AS started_at,
       ts + (event_id % 9) * INTERVAL '1' SECOND AS ended_at,
       CAST(user_id % 50 + 1 AS BIGINT) AS processed,
       CAST(event_id % 3 AS BIGINT) AS failed,
       CASE WHEN event_id % 3 = 2 THEN CASE WHEN event_id % 2 = 0 THEN 'Timeout' ELSE 'Denied' END
            END AS error
FROM events"""

# -- metric samples -------------------------------------------------------------------------
METRIC_SQL = """
SELECT ts, 'queue_depth' AS metric, value * 5000 AS value FROM events
UNION ALL
SELECT ts, 'message_age' AS metric, value AS value FROM events"""


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def derive(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run a derivation over the events of ``sf_dir`` without registering a view."""
    text = sql.replace("event_id % 500 // 100", "event_id % 500 div 100")
    text = text.replace("{", "{{").replace("}", "}}").replace("FROM events", "FROM {events}")
    return spark.sql(text, events=events(spark, sf_dir))


def attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, ATTRIBUTION_SQL)


def canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed canonical events, attributes as a document."""
    df = derive(spark, sf_dir, CANONICAL_SQL)
    return df.withColumns(
        {
            "event_ts": F.col("event_ts").cast("timestamp_ntz"),
            "attributes": F.parse_json("attributes"),
        }
    )


def ingest_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, LOG_SQL)


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, METRIC_SQL)


# -- files ----------------------------------------------------------------------------------
_written: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, sf_dir: str, label: str, write) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _written:
        path = scratch_path(spark, label)
        write(path)
        _written[key] = path
    return _written[key]


def _text_time(column: str) -> str:
    return f"date_format({column}, 'yyyy-MM-dd HH:mm:ss.SSSSSS')"


def attribution_ndjson(spark: SparkSession, sf_dir: str) -> str:
    """The attribution events as NDJSON, null columns left out, with one key too many."""

    def write(path: str) -> None:
        df = attribution(spark, sf_dir).withColumn("event_time", F.expr(_text_time("event_time")))
        df.withColumn("unknown_key", F.col("event_id")).drop("event_id").write.json(path)

    return _once(spark, sf_dir, "attribution-ndjson", write)


def dirty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attribution lines with defects: 80 n + 1 lines that are not JSON, 90 n with an empty
    name, 110 n + 5 an impossible time, 130 n + 7 text in a number, 150 n + 11 nothing at all."""
    df = attribution(spark, sf_dir)
    e = F.col("event_id")
    df = df.withColumns(
        {
            "event_time": F.when(e % 110 == 5, "2024-13-45 99:00:00").otherwise(
                F.expr(_text_time("event_time"))
            ),
            "event_name": F.when(e % 90 == 0, "").otherwise(F.col("event_name")),
            "event_revenue_usd": F.when(e % 130 == 7, "a lot").otherwise(
                F.col("event_revenue_usd").cast("string")
            ),
        }
    )
    text = F.to_json(F.struct(*[c for c in df.columns if c != "event_id"]))
    return df.select(
        F.when(e % 80 == 1, NOT_JSON).when(e % 150 == 11, "{}").otherwise(text).alias("value")
    )


def dirty_ndjson(spark: SparkSession, sf_dir: str) -> str:
    return _once(
        spark, sf_dir, "dirty-ndjson", lambda path: dirty_lines(spark, sf_dir).write.text(path)
    )


FEW_DEFECTS = "event_id NOT IN (1, 5, 7)"  # the lines without a defect in ``nearly_clean_lines``


def nearly_clean_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attribution lines of which three, whatever their number, are defective: as many rejects as
    a load takes."""
    df = attribution(spark, sf_dir).withColumn("event_time", F.expr(_text_time("event_time")))
    e = F.col("event_id")
    df = df.withColumns(
        {
            "event_time": F.when(e == 5, "2024-13-45 99:00:00").otherwise(F.col("event_time")),
            "event_revenue_usd": F.when(e == 7, "a lot").otherwise(F.col("event_revenue_usd").cast("string")),
        }
    )
    text = F.to_json(F.struct(*[c for c in df.columns if c != "event_id"]))
    return df.select(F.when(e == 1, NOT_JSON).otherwise(text).alias("value"))


def nearly_clean_halves(spark: SparkSession, sf_dir: str) -> list[str]:
    """Those lines in two folders."""
    halves = nearly_clean_lines(spark, sf_dir).randomSplit([0.5, 0.5], seed=7)
    return [_once(spark, sf_dir, f"half{k}", half.write.text) for k, half in enumerate(halves)]


BLOCK = 250_000  # ids per export file
EXPORT_HEADER = "ts,event_time,eventName,profile.identity,note,Extra Col"
EXPORT_SQL = """
SELECT event_id,
  concat_ws(',',
    CASE event_id % 4 WHEN 0 THEN date_format(ts, 'yyyyMMddHHmmss')
      WHEN 1 THEN CAST(unix_millis(CAST(ts AS TIMESTAMP)) AS STRING)
      WHEN 2 THEN '"' || date_format(ts, 'MMM d, yyyy') || '"' ELSE '' END,
    CAST(unix_millis(CAST(ts AS TIMESTAMP)) AS STRING),
    CASE WHEN event_id % 40 = 0 THEN '' ELSE event_type END,
    CASE WHEN event_id % 25 = 0 THEN '  ' ELSE concat(' ', user_id, ' ') END,
    '"a, ""b"" ' || event_id || '"',
    CASE WHEN event_id % 3 = 0 THEN '' ELSE CAST(CAST(value AS DECIMAL(18,2)) AS STRING) END
  ) AS line
FROM events"""


def _write_export(
    rows: DataFrame, root: str, name: str, header: str, compressed: bool
) -> None:
    """CSV files whose names start with ``name`` and whose first line is ``header``, one per
    block of ``BLOCK`` ids and in id order. The lines are complete already, so the writer's own
    quoting is off."""
    (
        rows.withColumn("block", F.floor(F.col("event_id") / BLOCK))
        .repartition("block")
        .sortWithinPartitions("block", "event_id")
        .select(F.col("line").alias(header), "block")
        .write.mode("append")
        .partitionBy("block")
        .option("header", "true")
        .option("sep", "\x01")
        .option("quote", "")
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .option("compression", "gzip" if compressed else "none")
        .option("mapreduce.output.basename", name)
        .csv(root)
    )


def csv_exports(spark: SparkSession, sf_dir: str) -> str:
    """Engagement CSV exports: four event files (two gzip, one with a column more, one with a
    repeated header), one dated too early, and gzip profile files from the customers."""

    def write(root: str) -> None:
        rows = derive(spark, sf_dir, EXPORT_SQL)
        for k in range(4):
            part = rows.where(F.col("event_id") % 4 == k)
            header = EXPORT_HEADER
            if k == 2:
                header += ",extra_tail"
                part = part.withColumn("line", F.concat("line", F.lit(",tail")))
            if k == 3:
                header += ",note"
                last = F.concat(F.lit(",last "), F.col("event_id").cast("string"))
                part = part.withColumn("line", F.concat("line", last))
            _write_export(part, root, f"1730000000-173000001{k}-Push_Sent", header, k % 2 == 1)
        early = rows.where(F.col("event_id") % 97 == 0)
        _write_export(early, root, "1700000000-1700000001-Push_Sent", EXPORT_HEADER, False)
        people = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
            F.expr(
                """concat_ws(',',
                  CASE WHEN c_custkey % 3 = 0 THEN '' ELSE CAST(c_custkey AS STRING) END,
                  CASE WHEN c_custkey % 6 = 0 THEN '' ELSE concat('+91', c_custkey) END,
                  concat('ct', c_custkey), CAST(900000000 + c_custkey AS STRING),
                  c_mktsegment)"""
            ).alias("line"),
            F.col("c_custkey").alias("event_id"),
        )
        header = "identity,phone,cleverTapId,profileattr.created_time,segment"
        _write_export(people, root, "1730000000-1730000020-profiles", header, True)

    return _once(spark, sf_dir, "csv-exports", write)


def repeated_export(spark: SparkSession, sf_dir: str) -> str:
    """A plain export in which the header line comes again after every fifth row."""

    def write(root: str) -> None:
        rows = derive(spark, sf_dir, EXPORT_SQL).where(F.col("event_id") % 4 == 0)
        lines = F.when(F.col("event_id") % 20 == 0, F.array("line", F.lit(EXPORT_HEADER))).otherwise(F.array("line"))
        rows = rows.select((F.col("event_id") * 2).alias("event_id"), F.posexplode(lines).alias("at", "line"))
        rows = rows.select((F.col("event_id") + F.col("at")).alias("event_id"), "line")
        _write_export(rows, root, "1730000000-1730000030-Push_Sent", EXPORT_HEADER, False)

    return _once(spark, sf_dir, "repeated-export", write)


# The same rows, as the exports should be read.
EXPORT_ROWS_SQL = """
SELECT event_id, event_id % 4 AS k, event_id // 250000 AS block,
  CASE event_id % 4 WHEN 2 THEN date_trunc('day', ts) ELSE date_trunc('second', ts) END AS event_ts,
  CASE WHEN event_id % 25 <> 0 THEN CAST(user_id AS VARCHAR) END AS user_id,
  CASE WHEN event_id % 40 = 0 THEN 'Push_Sent' ELSE event_type END AS event_name,
  '1730000000-173000001' || (event_id % 4) || '-Push_Sent' AS file_label,
  CASE WHEN event_id % 4 = 3 THEN 'last ' || event_id ELSE 'a, "b" ' || event_id END AS note,
  CASE WHEN event_id % 3 <> 0 THEN CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS extra_col,
  CASE WHEN event_id % 4 = 2 THEN 'tail' END AS extra_tail
FROM events"""

# Identities and times of the profile files.
PROFILE_ROWS_SQL = """
SELECT c_custkey,
  CASE WHEN c_custkey % 3 <> 0 THEN CAST(c_custkey AS VARCHAR)
       WHEN c_custkey % 6 <> 0 THEN '+91' || c_custkey ELSE 'ct' || c_custkey END AS user_id,
  make_timestamp((900000000 + c_custkey) * 1000000) AS event_ts,
  'profile_update' AS event_name,
  '1730000000-1730000020-profiles' AS file_label, c_custkey // 250000 AS block
FROM customer"""


def file_label(column: str = "source_file"):
    """The part of a fixture's file name that was asked for; the rest is the writer's."""
    base = F.element_at(F.split(column, "/"), -1)
    return F.regexp_extract(base, r"^([0-9]+-[0-9]+-[A-Za-z_]+)", 1)


DOCUMENT_SQL = """
SELECT event_id, CASE WHEN event_id % 100 = 0 THEN 'not json {' ELSE
  '{' || CASE WHEN event_id % 30 = 0 THEN '' ELSE '"ts":' || date_format(ts, 'yyyyMMddHHmmss') || ','
         END || '"eventName":"' || event_type || '","profile":{' ||
  CASE event_id % 5
    WHEN 0 THEN '"identity":"' || user_id || '"'
    WHEN 1 THEN '"identity":"+91' || user_id || '","all_identities":["+91' || user_id || '","77"]'
    WHEN 2 THEN '"identity":"u@example.com","all_identities":["u@example.com"]'
    WHEN 3 THEN '"all_identities":["a@x.io","b@x.io","c@x.io","d@x.io","e@x.io","f@x.io","g@x.io","h@x.io","i@x.io","j@x.io","88"]'
    ELSE '"all_identities":["x@example.com","' || user_id || '"]' END ||
  '},"props":' || props || '}' END AS value
FROM events"""

# The same documents, as they should be read.
DOCUMENT_ROWS_SQL = """
SELECT event_id, date_trunc('second', ts) AS event_ts, CAST(ts AS DATE) AS event_date,
  CASE event_id % 5 WHEN 0 THEN CAST(user_id AS VARCHAR) WHEN 1 THEN '77'
    WHEN 4 THEN CAST(user_id AS VARCHAR) END AS user_id,
  event_type AS event_name, props
FROM events WHERE event_id % 100 <> 0 AND event_id % 30 <> 0"""


def documents(spark: SparkSession, sf_dir: str) -> str:
    """Raw documents as gzip JSON lines, beside a manifest folder that is not data."""

    def write(root: str) -> None:
        docs = derive(spark, sf_dir, DOCUMENT_SQL)
        for k in range(2):
            (
                docs.where(F.col("event_id") % 2 == k)
                .select("value")
                .write.mode("append")
                .option("compression", "gzip" if k else "none")
                .option("mapreduce.output.basename", f"export{k}.json")
                .text(f"{root}/day={k}")
            )

    return _once(spark, sf_dir, "documents", write)


def loadable_documents(spark: SparkSession, sf_dir: str) -> str:
    """The raw documents, of which nine lines, whatever their number, are not JSON or have no time."""

    def write(root: str) -> None:
        spoiled = "event_id % 100 = 0 OR event_id % 30 = 0"
        docs = derive(spark, sf_dir, DOCUMENT_SQL)
        first = docs.where(spoiled).orderBy("event_id").limit(9)
        docs.where(f"NOT ({spoiled})").unionByName(first).select("value").write.text(root)

    return _once(spark, sf_dir, "loadable-documents", write)


# Envelopes: groups of five rows, single rows, and bodies that are not JSON.
ENVELOPE_SQL = """
SELECT CASE WHEN g % 100 = 3 THEN '{"id": broken'
       WHEN g % 100 = 7 THEN '{"id":"m' || g || '","timestamp":"2024-01-31T00:00:00.000Z","data":'
                             || first_row || '}'
       ELSE '{"id":"m' || g || '","timestamp":"2024-01-31T00:00:00.000Z","data":{"source":"engagement",'
            || '"sourceFile":"f","rows":[' || rows || ']}}' END AS body
FROM (
  SELECT g, array_join(array_sort(collect_list(row)), ',') AS rows, min(row) AS first_row FROM (
    SELECT event_id div 5 AS g,
      '{"event_date":"' || date_format(ts, 'yyyy-MM-dd') || '","event_ts":"'
      || date_format(ts, 'yyyy-MM-dd HH:mm:ss') || '","user_id":"' || user_id
      || '","event_name":"' || event_type || '","source_file":"f' || event_id % 4
      || '","attributes":' || props || '}' AS row
    FROM events) GROUP BY g)"""

# The rows those envelopes carry. A single-row body carries the first row as text.
ENVELOPE_ROWS_SQL = """
SELECT g, event_date, event_ts, user_id, event_name, source_file, attributes FROM (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY line) AS rn FROM (
    SELECT event_id // 5 AS g, CAST(ts AS DATE) AS event_date, date_trunc('second', ts) AS event_ts,
      CAST(user_id AS VARCHAR) AS user_id, event_type AS event_name,
      'f' || (event_id % 4) AS source_file, replace(props, ' ', '') AS attributes,
      strftime(ts, '%Y-%m-%d %H:%M:%S') || '","user_id":"' || user_id || '","event_name":"'
      || event_type || '","source_file":"f' || (event_id % 4) || '","attributes":' || props AS line
    FROM events))
WHERE g % 100 <> 3 AND (g % 100 <> 7 OR rn = 1)"""


def envelopes(spark: SparkSession, sf_dir: str) -> str:
    def write(path: str) -> None:
        derive(spark, sf_dir, ENVELOPE_SQL).write.text(path)

    return _once(spark, sf_dir, "envelopes", write)


def structured_events(spark: SparkSession, sf_dir: str) -> str:
    """The exports, normalised and landed by date and name."""
    from eventmart.operators.csv_events import to_events
    from eventmart.operators.sinks import write_structured_json
    from eventmart.sources.csvlines import csv_rows
    from eventmart.sources.files import started_by

    def write(path: str) -> None:
        rows = csv_rows(spark, csv_exports(spark, sf_dir), started_by)
        write_structured_json(to_events(rows, F.lit(AS_OF).cast("timestamp")), path)

    return _once(spark, sf_dir, "structured", write)


def log_parquet(spark: SparkSession, sf_dir: str) -> str:
    return _once(
        spark, sf_dir, "ingest-log", lambda path: ingest_log(spark, sf_dir).write.parquet(path)
    )


def canonical_json(spark: SparkSession, sf_dir: str) -> str:
    """Canonical events as NDJSON, one folder per source file."""

    def write(path: str) -> None:
        rows = canonical(spark, sf_dir).withColumn("f", F.col("source_file"))
        rows.drop("event_id").write.options(**JSON_OPTIONS).partitionBy("f").json(path)

    return _once(spark, sf_dir, "canonical-ndjson", write)
