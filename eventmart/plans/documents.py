"""Raw documents and message envelopes."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from eventmart.functions.identity import numeric_user_id
from eventmart.functions.times import parse_compact
from eventmart.functions.values import json_text
from eventmart.operators import load as ld
from eventmart.operators import opsmetrics as om
from eventmart.operators import raw_events as rw
from eventmart.operators.tables import BatchTable
from eventmart.plans import fixtures as fx
from eventmart.plans.fixtures import DOCUMENT_ROWS_SQL, ENVELOPE_ROWS_SQL
from eventmart.plans.registry import query
from eventmart.schemas import CANONICAL
from eventmart.session import scratch_path
from eventmart.sources import documents as dc
from eventmart.sources import envelopes as ev
from eventmart.streaming import queue

LOADED = datetime(2024, 2, 1)
D = f"({DOCUMENT_ROWS_SQL}) d"
PROFILE = """CASE event_id % 5 WHEN 0 THEN '{"identity":"' || d.uid || '"}'
  WHEN 1 THEN '{"all_identities":["+91' || d.uid || '","77"],"identity":"+91' || d.uid || '"}'
  WHEN 2 THEN '{"all_identities":["u@example.com"],"identity":"u@example.com"}'
  WHEN 3 THEN '{"all_identities":["a@x.io","b@x.io","c@x.io","d@x.io","e@x.io","f@x.io","g@x.io","h@x.io","i@x.io","j@x.io","88"]}'
  ELSE '{"all_identities":["x@example.com","' || d.uid || '"]}' END"""
DOC_TEXT = f"""SELECT event_id, '{{"eventName":"' || event_type || '","profile":' || {PROFILE} || ',"props":'
  || replace(props, ' ', '') || CASE WHEN event_id % 30 = 0 THEN '' ELSE ',"ts":' || strftime(ts, '%Y%m%d%H%M%S') END
  || '}}' AS doc FROM (SELECT *, user_id AS uid FROM events) d WHERE event_id % 100 <> 0"""


def docs(spark, sf_dir):
    return dc.read_documents(spark, fx.documents(spark, sf_dir))


@query("s3_document_scan", f"""SELECT doc, 0 AS broken FROM ({DOC_TEXT})
UNION ALL SELECT NULL, 1 FROM events WHERE event_id % 100 = 0""")
def s3(spark, sf_dir):
    d = docs(spark, sf_dir)
    return d.select(json_text(F.col("doc")).alias("doc"), F.col("doc").isNull().cast("int").alias("broken"))


@query("s10_sample_profile", """
SELECT 'profile' AS part, count(*) AS n,
  'OBJECT<eventName: STRING, profile: OBJECT<all_identities: ARRAY<STRING>, identity: STRING>, props: OBJECT<k: BIGINT>, ts: BIGINT>' AS content
FROM events WHERE event_id % 100 <> 0
UNION ALL SELECT 'sample', CAST(least(count(*), 3) AS BIGINT), 'eventName,profile,props' FROM events WHERE event_id % 100 <> 0""")
def s10(spark, sf_dir):
    """Schema of all documents, and the keys that the samples share."""
    d = docs(spark, sf_dir)
    keys = F.array_join(F.array_sort(F.array_remove("keys", "ts")), ",")
    shown = dc.sample(d).agg(F.count("*").alias("n"), F.min(keys).alias("content"))
    whole = dc.profile(d).select(F.col("documents").alias("n"), F.col("schema").alias("content"))
    return whole.withColumn("part", F.lit("profile")).unionByName(
        shown.withColumn("part", F.lit("sample"))
    )


@query("f3_documents_with_time", f"SELECT event_id % 5 AS kind, count(*) AS n FROM {D} GROUP BY 1")
def f3(spark, sf_dir):
    kept = rw.with_time(docs(spark, sf_dir))
    first = F.try_variant_get("doc", "$.profile.all_identities[0]", "string")
    own = F.try_variant_get("doc", "$.profile.identity", "string")
    kind = (
        F.when(first.isNull(), 0).when(own.startswith("+"), 1).when(own.isNotNull(), 2)
        .when(first.startswith("a@"), 3).otherwise(4)
    )
    return kept.groupBy(kind.cast("bigint").alias("kind")).agg(F.count("*").alias("n"))


@query("p9_numeric_user_id", f"SELECT user_id, event_name, event_ts FROM {D}")
def p9(spark, sf_dir):
    d = rw.with_time(docs(spark, sf_dir))
    return d.select(
        numeric_user_id(F.col("doc")).alias("user_id"),
        F.try_variant_get("doc", "$.eventName", "string").alias("event_name"),
        parse_compact(F.try_variant_get("doc", "$.ts", "string")).alias("event_ts"),
    )


@query("p10_document_time", """
SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN date_trunc('second', ts) END AS event_ts,
  CASE WHEN event_id % 3 <> 0 THEN CAST(ts AS DATE) END AS event_date FROM events""")
def p10(spark, sf_dir):
    """Month 13 is no time."""
    e = fx.events(spark, sf_dir)
    text = F.expr(
        """'{"ts":' || CASE event_id % 3 WHEN 0 THEN '20241301000000'
        ELSE date_format(ts, 'yyyyMMddHHmmss') END || '}'"""
    )
    ts = parse_compact(F.try_variant_get(F.parse_json(text), "$.ts", "string"))
    return e.select("event_id", ts.alias("event_ts"), ts.cast("date").alias("event_date"))


@query("p11_path_text", "SELECT event_type AS name, count(*) AS n FROM events WHERE event_id % 100 <> 0 GROUP BY event_type")
def p11(spark, sf_dir):
    name = F.try_variant_get("doc", "$.eventName", "string").alias("name")
    return docs(spark, sf_dir).where("doc IS NOT NULL").groupBy(name).agg(F.count("*").alias("n"))


@query("p12_path_projection", f"""
SELECT doc AS attributes, CASE WHEN e.event_id % 30 <> 0 THEN strftime(ts, '%Y%m%d%H%M%S') END AS event_ts, event_type AS event_name,
  CASE e.event_id % 5 WHEN 0 THEN CAST(user_id AS VARCHAR) WHEN 1 THEN '+91' || user_id
  WHEN 2 THEN 'u@example.com' END AS user_id
FROM ({DOC_TEXT}) t JOIN events e USING (event_id)""")
def p12(spark, sf_dir):
    p = dc.project_paths(docs(spark, sf_dir).where("doc IS NOT NULL"), dc.DOCUMENT_PATHS)
    return p.select(json_text(F.col("attributes")).alias("attributes"), "event_ts", "event_name", "user_id")


@query("k7_document_load", f"""
SELECT event_date, event_ts, user_id, event_name, '' AS source_file, t.doc AS attributes
FROM {D} JOIN ({DOC_TEXT}) t USING (event_id)""")
def k7(spark, sf_dir):
    """Staged, transformed and published as one batch, with as many rejects as the load takes."""
    table = BatchTable(spark, scratch_path(spark, "k7"), CANONICAL, partition_by=("event_date",))
    loadable = dc.read_documents(spark, fx.loadable_documents(spark, sf_dir))
    table.load(rw.to_events(loadable), "b1", ld.DOCUMENT_LOAD, LOADED)
    return table.read().withColumn("attributes", json_text(F.col("attributes")))


# -- envelopes ------------------------------------------------------------------------------
ROWS = f"""SELECT event_date, event_ts, user_id, event_name, source_file, attributes FROM ({ENVELOPE_ROWS_SQL})"""


def bodies(spark, sf_dir):
    return spark.read.text(fx.envelopes(spark, sf_dir)).withColumnRenamed("value", "body")


@query("s7_queue_source", """
SELECT CASE WHEN g % 100 <> 3 THEN 'm' || g END AS id, g % 100 <> 3 AS valid FROM (SELECT DISTINCT event_id // 5 AS g FROM events)""")
def s7(spark, sf_dir):
    return ev.unwrap(bodies(spark, sf_dir)).select("id", "valid")


@query("e1_row_explode", ROWS)
def e1(spark, sf_dir):
    rows = queue.engagement_rows(bodies(spark, sf_dir))
    typed = ld.good(ld.cast_rows(rows, CANONICAL, ld.CANONICAL_LOAD))
    return typed.withColumn("attributes", json_text(F.col("attributes")))


@query("k11_envelope_wrap", """
SELECT replace(props, ' ', '') AS attributes, CAST(user_id AS VARCHAR) AS user_id, 36 AS id_length,
  'engagement' AS message_source, true AS stamped FROM events""")
def k11(spark, sf_dir):
    """Ids and times are fresh on every run, so their shape is compared."""
    df = fx.canonical(spark, sf_dir).drop("event_id")
    sent = ev.wrap(df, F.struct(*CANONICAL.names), "engagement").select("body", "message_source")
    path = scratch_path(spark, "k11")
    sent.write.parquet(path)
    back = ev.unwrap(spark.read.parquet(path))
    return back.select(
        json_text(F.try_variant_get("data", "$.attributes", "variant")).alias("attributes"),
        F.try_variant_get("data", "$.user_id", "string").alias("user_id"),
        F.length("id").alias("id_length"),
        "message_source",
        F.col("timestamp").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{3}Z$").alias("stamped"),
    )


# Path messages: per event one, of which some repeat a path, name none, or do not parse.
MESSAGES = """
SELECT event_id, CASE event_id % 50 WHEN 0 THEN 'invalid' WHEN 1 THEN 'invalid' ELSE 'pending' END AS status,
  CASE WHEN event_id % 50 > 1 THEN 's3://b/f' || (event_id // 3) || '.json' END AS s3_path FROM events"""


def path_bodies(spark, sf_dir):
    body = F.expr(
        """CASE event_id % 50 WHEN 0 THEN 'broken' WHEN 1 THEN '{"id":"' || event_id || '","data":{}}'
        ELSE '{"id":"' || event_id || '","timestamp":"' || date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
        || '","data":{"s3_path":"s3://b/f' || (event_id div 3) || '.json","source_file":"x","row_count":'
        || event_id % 9 || '}}' END"""
    )
    return fx.events(spark, sf_dir).select(body.alias("body"), "event_id")


@query("f5_message_validity", "SELECT status, s3_path, count(*) AS n FROM (" + MESSAGES + ") GROUP BY ALL")
def f5(spark, sf_dir):
    m = ev.path_messages(ev.unwrap(path_bodies(spark, sf_dir)))
    return m.groupBy("status", "s3_path").agg(F.count("*").alias("n"))


@query("d3_distinct_paths", f"""
SELECT s3_path, CAST(arg_min(event_id, event_id) AS VARCHAR) AS id FROM ({MESSAGES}) WHERE status = 'pending' GROUP BY s3_path""")
def d3(spark, sf_dir):
    m = ev.path_messages(ev.unwrap(path_bodies(spark, sf_dir)))
    return ev.distinct_paths(m).select("s3_path", "id")


@query("a12_batch_outcomes", f"""
SELECT event_id // 1000 AS batch_id, count(*) AS total,
  count(*) FILTER (status = 'pending' AND CAST(regexp_extract(s3_path, '([0-9]+)', 1) AS BIGINT) % 4 > 1) AS processed,
  count(*) FILTER (status = 'pending' AND CAST(regexp_extract(s3_path, '([0-9]+)', 1) AS BIGINT) % 4 = 0) AS missing,
  count(*) FILTER (status = 'pending' AND CAST(regexp_extract(s3_path, '([0-9]+)', 1) AS BIGINT) % 4 = 1) AS failed,
  count(*) FILTER (status = 'invalid') AS invalid
FROM (SELECT event_id, status, regexp_extract(s3_path, 'f[0-9]+', 0) AS s3_path FROM ({MESSAGES})) GROUP BY 1""")
def a12(spark, sf_dir):
    """Of the paths, a quarter is missing and a quarter fails."""
    m = ev.path_messages(ev.unwrap(path_bodies(spark, sf_dir)))
    number = F.regexp_extract("s3_path", "f([0-9]+)", 1).try_cast("bigint")
    status = (
        F.when(F.col("status") == "invalid", "invalid").when(number % 4 == 0, "missing")
        .when(number % 4 == 1, "failed").otherwise("processed")
    )
    return om.batch_outcomes(
        m.select(F.expr("event_id div 1000").alias("batch_id"), status.alias("status"))
    )
