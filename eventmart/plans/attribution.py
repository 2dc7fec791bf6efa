"""Attribution events: scan, checks, typed load, analytics."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from eventmart.functions.values import (
    as_variant, json_text, replace_invalid_bytes, scalar_text, truncate_bytes_sql,
)
from eventmart.functions import times
from eventmart.operators import analytics as an
from eventmart.operators import load as ld
from eventmart.operators import summaries
from eventmart.operators.load import REASON
from eventmart.operators.tables import BatchTable
from eventmart.plans import fixtures as fx
from eventmart.plans.fixtures import AS_OF, ATTRIBUTION_SQL
from eventmart.plans.registry import query
from eventmart.schemas import ATTRIBUTION, ATTRIBUTION_TABLE, CANONICAL
from eventmart.session import scratch_path
from eventmart.sources.ndjson import read_ndjson

LOADED = datetime(2024, 2, 1)
A = f"({ATTRIBUTION_SQL}) a"
TYPED = [
    "appsflyer_id", "event_name", "event_time", "customer_user_id", "platform", "media_source",
    "campaign", "event_revenue_usd",
]


def typed_events(spark, sf_dir):
    """NDJSON scan, receiving check, casts: the good rows."""
    rows = read_ndjson(spark, fx.attribution_ndjson(spark, sf_dir), ATTRIBUTION)
    return ld.good(ld.cast_rows(ld.check_required(rows), ATTRIBUTION, ld.ATTRIBUTION_LOAD))


def loaded_events(spark, sf_dir):
    """The attribution events in their table, loaded once."""

    def write(path):
        rows = read_ndjson(spark, fx.attribution_ndjson(spark, sf_dir), ATTRIBUTION)
        typed = ld.cast_rows(ld.check_required(rows), ATTRIBUTION, ld.ATTRIBUTION_LOAD)
        stamped = ld.stamp(typed, F.lit(LOADED).cast("timestamp_ntz"))
        BatchTable(spark, path, ATTRIBUTION_TABLE).load(stamped, "b1", ld.ATTRIBUTION_LOAD, LOADED)

    return BatchTable(spark, fx._once(spark, sf_dir, "loaded-attribution", write), ATTRIBUTION_TABLE).read()


def _revenue(df):
    return df.withColumn("event_revenue_usd", F.col("event_revenue_usd").cast("decimal(28,6)"))


@query("s1_ndjson_scan", f"SELECT {', '.join(TYPED[:7])}, CAST(event_revenue_usd AS DECIMAL(28,6)) AS event_revenue_usd FROM {A}")
def s1(spark, sf_dir):
    return _revenue(typed_events(spark, sf_dir).select(*TYPED))


DIRTY_SQL = f"""
SELECT event_id, appsflyer_id, event_name, event_time, customer_user_id, event_revenue_usd,
  CASE WHEN event_id % 80 = 1 THEN 'not JSON'
       WHEN event_id % 150 = 11 THEN 'Empty payload'
       WHEN event_id % 90 = 0 THEN 'Missing required fields'
       WHEN event_id % 110 = 5 THEN 'event_time: not a timestamp_ntz'
       WHEN event_id % 130 = 7 THEN 'event_revenue_usd: not a decimal(18,6)' END AS reason
FROM {A}"""


def dirty_rows(spark, sf_dir):
    rows = read_ndjson(spark, fx.dirty_ndjson(spark, sf_dir), ATTRIBUTION)
    return ld.cast_rows(ld.check_required(rows), ATTRIBUTION, ld.ATTRIBUTION_LOAD)


@query("f1_required_fields", f"""
SELECT reason, count(*) AS n FROM (
  SELECT CASE WHEN event_id % 150 = 11 OR event_id % 80 = 1 THEN 'Empty payload'
              WHEN event_id % 90 = 0 THEN 'Missing required fields' END AS reason FROM {A})
GROUP BY reason""")
def f1(spark, sf_dir):
    rows = read_ndjson(spark, fx.dirty_ndjson(spark, sf_dir), ATTRIBUTION)
    return ld.check_required(rows).groupBy(F.col(ld.REASON).alias("reason")).agg(
        F.count("*").alias("n")
    )


@query("l1_typed_cast", f"""
SELECT appsflyer_id, event_time, CAST(event_revenue_usd AS DECIMAL(28,6)) AS event_revenue_usd
FROM ({DIRTY_SQL}) WHERE reason IS NULL""")
def l1(spark, sf_dir):
    return _revenue(
        ld.good(dirty_rows(spark, sf_dir)).select("appsflyer_id", "event_time", "event_revenue_usd")
    )


@query("l5_rejects", f"SELECT reason, count(*) AS n FROM ({DIRTY_SQL}) WHERE reason IS NOT NULL GROUP BY reason")
def l5(spark, sf_dir):
    """A load with more rejects than it tolerates fails and publishes nothing; its rejects are
    in the quarantine."""
    table = BatchTable(spark, scratch_path(spark, "l5"), ATTRIBUTION_TABLE)
    rows = ld.stamp(dirty_rows(spark, sf_dir), F.lit(LOADED))
    try:
        table.load(rows, "b1", ld.ATTRIBUTION_LOAD, LOADED)
        raise AssertionError("the load should have failed")
    except ld.LoadFailed:
        pass
    visible = table.read().select(F.lit("published").alias("reason"))
    held = table.rejects().select(F.col(ld.REASON).alias("reason"))
    return held.unionByName(visible).groupBy("reason").agg(F.count("*").alias("n"))


@query("l2_truncate_bytes", """
SELECT c_custkey, 'ä€' || substr(c_name, 1, 15) AS cut FROM customer""")
def l2(spark, sf_dir):
    """20 bytes: a two-byte and a three-byte character and 15 more. What follows is cut, also
    where the cut would fall inside a character."""
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    text = F.concat(F.lit("ä€"), F.substring("c_name", 1, 15), F.lit("€ tail"))
    cuts = [truncate_bytes_sql("text", 20 + k) for k in range(3)]
    return c.withColumn("text", text).selectExpr(
        "c_custkey",
        f"CASE c_custkey % 3 WHEN 0 THEN {cuts[0]} WHEN 1 THEN {cuts[1]} ELSE {cuts[2]} END AS cut",
    )


def _blanks(c):
    return F.when(F.col("event_id") % 3 == 0, F.lit(" \t ")).when(
        F.col("event_id") % 3 == 1, F.lit("")
    ).otherwise(c)


@query("l3_blanks_as_null", "SELECT event_id, CASE WHEN event_id % 3 = 2 THEN event_type END AS v FROM events")
def l3(spark, sf_dir):
    policy = ld.LoadPolicy(blanks_as_null=True)
    e = fx.events(spark, sf_dir).withColumn("event_type", _blanks(F.col("event_type")))
    return _cast_one(e, policy)


@query("l4_empty_as_null", """SELECT event_id,
CASE event_id % 3 WHEN 0 THEN ' ' || chr(9) || ' ' WHEN 2 THEN event_type END AS v FROM events""")
def l4(spark, sf_dir):
    policy = ld.LoadPolicy(blanks_as_null=False)
    e = fx.events(spark, sf_dir).withColumn("event_type", _blanks(F.col("event_type")))
    return _cast_one(e, policy)


def _cast_one(df, policy):
    from pyspark.sql import types as T

    table = T.StructType([T.StructField("event_id", T.LongType()), ATTRIBUTION["event_type"]])
    return ld.cast_rows(df.select("event_id", "event_type"), table, policy).select(
        "event_id", F.col("event_type").alias("v")
    )


@query("l6_invalid_bytes", "SELECT event_id, event_type || '?ü??' || user_id AS v FROM events")
def l6(spark, sf_dir):
    """One stray byte before a good character, and a cut three-byte character after it."""
    e = fx.events(spark, sf_dir)
    broken = F.concat(
        F.col("event_type").cast("binary"), F.unhex(F.lit("FF")), F.lit("ü").cast("binary"),
        F.unhex(F.lit("E282")), F.col("user_id").cast("string").cast("binary"),
    )
    return e.select("event_id", replace_invalid_bytes(broken.cast("string")).alias("v"))


# -- analytics ------------------------------------------------------------------------------
NOW = f"TIMESTAMP '{AS_OF}'"


@query("a2_row_count", "SELECT count(*) AS row_count FROM events")
def a2(spark, sf_dir):
    return an.row_count(loaded_events(spark, sf_dir))


@query("a3_events_by_name", f"""
SELECT event_name, count(*) AS event_count FROM {A}
WHERE event_time >= {NOW} - INTERVAL 7 DAY GROUP BY event_name ORDER BY event_count DESC, event_name""")
def a3(spark, sf_dir):
    return an.events_by_name(fx.attribution(spark, sf_dir), AS_OF)


ATTRIBUTION_ORACLE = f"""
SELECT media_source, campaign, count(*) AS installs, count(DISTINCT customer_user_id) AS unique_users
FROM {A} WHERE event_name = 'install' AND event_time >= {NOW} - INTERVAL 30 DAY
GROUP BY media_source, campaign ORDER BY installs DESC, media_source, campaign"""


@query("a4_attribution", ATTRIBUTION_ORACLE)
def a4(spark, sf_dir):
    """From the loaded table, of which the report reads five columns."""
    return an.attribution(loaded_events(spark, sf_dir), AS_OF)


@query("a5_revenue_by_device", f"""
SELECT platform, count(*) AS purchase_count, CAST(sum(event_revenue_usd) AS DECIMAL(28,6)) AS total_revenue_usd
FROM {A} WHERE event_name IN ('af_purchase', 'purchase') AND event_revenue_usd IS NOT NULL
AND event_time >= {NOW} - INTERVAL 7 DAY GROUP BY platform""")
def a5(spark, sf_dir):
    return an.revenue_by_device(fx.attribution(spark, sf_dir), AS_OF)


@query("a6_freshness", f"""
SELECT count(*) AS event_count, max(event_time) AS latest_event_time FROM {A}
WHERE event_time > TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 5 MINUTE""")
def a6(spark, sf_dir):
    return an.freshness(fx.attribution(spark, sf_dir), "2024-01-30 12:00:00")


@query("f6_analytics_predicates", f"""
SELECT appsflyer_id, event_name, platform FROM {A}
WHERE event_name IN ('install', 'af_purchase') AND platform IS NOT NULL AND media_source = 'organic'
AND event_time >= {NOW} - INTERVAL 14 DAY AND regexp_matches(campaign, 'c[0-3]')""")
def f6(spark, sf_dir):
    df = an.since(fx.attribution(spark, sf_dir), AS_OF, "14 DAYS")
    return df.where(
        F.col("event_name").isin("install", "af_purchase")
        & F.col("platform").isNotNull()
        & (F.col("media_source") == "organic")
        & F.col("campaign").rlike("c[0-3]")
    ).select("appsflyer_id", "event_name", "platform")


@query("t1_recent_events", f"""
SELECT {', '.join(TYPED[:7])} FROM {A} ORDER BY event_time DESC, appsflyer_id LIMIT 100""")
def t1(spark, sf_dir):
    return an.recent_events(fx.attribution(spark, sf_dir))


@query("t2_latest_loaded", f"""
SELECT {', '.join(TYPED[:6])} FROM {A} WHERE event_id % 2 = 1
ORDER BY event_time DESC, appsflyer_id LIMIT 10""")
def t2(spark, sf_dir):
    """Odd events were loaded a day after the even ones."""
    df = fx.attribution(spark, sf_dir)
    loaded = F.lit(LOADED).cast("timestamp_ntz")
    later = loaded + F.expr("INTERVAL 1 DAY")
    return an.latest_loaded(
        df.withColumn("created_at", F.when(F.col("event_id") % 2 == 1, later).otherwise(loaded))
    )


@query("t3_point_lookup", f"""
SELECT {', '.join(TYPED[:7])} FROM {A} WHERE appsflyer_id = 'e42' ORDER BY event_time DESC LIMIT 1""")
def t3(spark, sf_dir):
    return an.lookup(fx.attribution(spark, sf_dir), "e42", only_latest=True).select(*TYPED[:7])


@query("a4_daily_summaries", f"""
SELECT media_source, campaign, count(*) AS installs, true AS users_near FROM {A}
WHERE event_name = 'install' AND CAST(event_time AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-31' GROUP BY ALL""")
def a4_summaries(spark, sf_dir):
    """Installs and users from the daily summaries of three loads, one of which is corrected and loaded again; users are
    within the stated error of their exact number."""
    table = BatchTable(spark, scratch_path(spark, "a4-daily"), ATTRIBUTION_TABLE)
    daily = summaries.DailySummaries(table)
    rows = fx.attribution(spark, sf_dir).withColumn(REASON, F.lit(None).cast("string"))
    part = F.col("event_id") % 3
    for batch, some in (("b0", rows.where(part == 0)), ("b1", rows.where(part == 1)), ("b2", rows.where(part == 2).withColumn(REASON, F.lit("held back")))):
        try:
            table.load(some.drop("event_id"), batch, ld.ATTRIBUTION_LOAD, LOADED)
        except ld.LoadFailed:
            pass
        daily.refresh()
    table.load(rows.where(part == 2).drop("event_id"), "b2", ld.ATTRIBUTION_LOAD, LOADED)
    daily.refresh()
    daily.refresh()
    installs = F.col("event_name") == "install"
    found = daily.report(["media_source", "campaign"], "2024-01-05", "2024-01-31", installs)
    days = F.to_date("event_time").between("2024-01-05", "2024-01-31")
    exact = table.read().where(installs & days).groupBy("media_source", "campaign").agg(F.count_distinct("customer_user_id").alias("exact"))
    near = F.abs(F.col("users") - F.col("exact")) <= F.col("exact") * summaries.ERROR + 1
    return found.join(exact, ["media_source", "campaign"]).select("media_source", "campaign", F.col("events").alias("installs"), near.alias("users_near"))


@query("t3_lookup_files", f"""
SELECT {', '.join(TYPED[:7])}, 1 AS files, true AS skipped FROM {A} WHERE appsflyer_id = 'e42'""")
def t3_files(spark, sf_dir):
    """The same id in a table of three loads, each with ids of its own range and cut by id: one file can hold it, and no
    other one is opened."""
    table = BatchTable(spark, scratch_path(spark, "t3"), ATTRIBUTION_TABLE, cluster_by="appsflyer_id")
    rows = fx.attribution(spark, sf_dir).drop("event_id").withColumn(REASON, F.lit(None).cast("string"))
    third = F.floor(F.coalesce(F.substring("appsflyer_id", 2, 1).cast("int"), F.lit(0)) / 4)
    for k in range(3):
        table.load(rows.where(third == k), f"b{k}", ld.ATTRIBUTION_LOAD, LOADED)
    found = table.lookup("e42")
    opened, every = len(found.inputFiles()), len(table.read().inputFiles())
    return found.select(*TYPED[:7]).withColumn("files", F.lit(opened)).withColumn("skipped", F.lit(opened < every))


# -- scalar functions -----------------------------------------------------------------------
@query("p13_scalar_text", """
SELECT event_id, CASE event_id % 6 WHEN 1 THEN 'true' WHEN 2 THEN CAST(event_id AS VARCHAR)
  WHEN 3 THEN replace(props, ' ', '') WHEN 5 THEN event_type END AS v FROM events""")
def p13(spark, sf_dir):
    """Null, boolean, number, object, empty and plain text in one document field."""
    text = F.expr(
        """CASE event_id % 6 WHEN 0 THEN '{"v":null}' WHEN 1 THEN '{"v":true}'
        WHEN 2 THEN '{"v":' || event_id || '}' WHEN 3 THEN '{"v":' || props || '}'
        WHEN 4 THEN '{"v":""}' ELSE '{"v":"' || event_type || '"}' END"""
    )
    v = F.try_variant_get(F.parse_json(text), "$.v", "variant")
    return fx.events(spark, sf_dir).select("event_id", scalar_text(v).alias("v"))


@query("p14_variant_coercion", """
SELECT event_id, CASE event_id % 4 WHEN 0 THEN replace(props, ' ', '') WHEN 1 THEN '"' || event_type || '"'
  WHEN 2 THEN CAST(event_id AS VARCHAR) END AS v FROM events""")
def p14(spark, sf_dir):
    text = F.expr(
        """CASE event_id % 4 WHEN 0 THEN props WHEN 1 THEN event_type
        WHEN 2 THEN CAST(event_id AS STRING) ELSE '' END"""
    )
    return fx.events(spark, sf_dir).select("event_id", json_text(as_variant(text)).alias("v"))


@query("p15_strict_date", "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN CAST(ts AS DATE) END AS d FROM events")
def p15(spark, sf_dir):
    text = F.expr("CASE event_id % 2 WHEN 0 THEN CAST(ts AS STRING) ELSE date_format(ts, 'yyyy/MM/dd') END")
    return fx.events(spark, sf_dir).select("event_id", times.strict_date(text).alias("d"))


@query("p16_strict_timestamp", """
SELECT event_id, CASE WHEN event_id % 2 = 0 THEN date_trunc('second', ts) END AS t FROM events""")
def p16(spark, sf_dir):
    """A ``T`` between date and time is not accepted."""
    text = F.expr(
        """CASE event_id % 2 WHEN 0 THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSS')
        ELSE date_format(ts, "yyyy-MM-dd'T'HH:mm:ss") END"""
    )
    return fx.events(spark, sf_dir).select("event_id", times.strict_timestamp(text).alias("t"))


@query("p17_passthrough_timestamp", """
SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN date_trunc('millisecond', ts) END AS t FROM events""")
def p17(spark, sf_dir):
    text = F.expr("CASE event_id % 3 WHEN 0 THEN '' ELSE date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSS') END")
    return fx.events(spark, sf_dir).select("event_id", times.passthrough_timestamp(text).alias("t"))


@query("p21_load_time_defaults", f"""
SELECT appsflyer_id, TIMESTAMP '2024-02-01 00:00:00' AS created_at,
  TIMESTAMP '2024-02-01 00:00:00' AS updated_at FROM {A}""")
def p21(spark, sf_dir):
    rows = ld.stamp(typed_events(spark, sf_dir), F.lit(LOADED))
    return rows.select("appsflyer_id", "created_at", "updated_at")


# -- loads ----------------------------------------------------------------------------------
@query("k3_typed_load", f"""
SELECT {', '.join(TYPED[:7])}, CAST(event_revenue_usd AS DECIMAL(28,6)) AS event_revenue_usd,
  CAST(to_json(props_text) AS VARCHAR) AS event_value, TIMESTAMP '2024-02-01 00:00:00' AS created_at
FROM (SELECT *, event_value AS props_text FROM {A})""")
def k3(spark, sf_dir):
    """NDJSON into the table and back. The event value was sent as text and stays text."""
    table = BatchTable(spark, scratch_path(spark, "k3"), ATTRIBUTION_TABLE)
    rows = read_ndjson(spark, fx.attribution_ndjson(spark, sf_dir), ATTRIBUTION)
    typed = ld.cast_rows(ld.check_required(rows), ATTRIBUTION, ld.ATTRIBUTION_LOAD)
    table.load(ld.stamp(typed, F.lit(LOADED)), "b1", ld.ATTRIBUTION_LOAD, LOADED)
    return _revenue(table.read()).select(
        *TYPED, json_text(F.col("event_value")).alias("event_value"), "created_at"
    )


@query("k4_fixed_projection", f"""
SELECT appsflyer_id, event_time, CAST(NULL AS VARCHAR) AS idfa, CAST(NULL AS BOOLEAN) AS wifi,
  CAST(event_revenue_usd AS DECIMAL(28,6)) AS event_revenue_usd, 124 AS columns FROM {A}""")
def k4(spark, sf_dir):
    df = fx.attribution(spark, sf_dir).withColumn("event_value", as_variant(F.col("event_value")))
    wide = ld.project_to(df, ATTRIBUTION)
    return _revenue(wide).select(
        "appsflyer_id", "event_time", "idfa", "wifi", "event_revenue_usd",
        F.lit(len(wide.columns)).alias("columns"),
    )


CANONICAL_ORACLE = """
SELECT CAST(ts AS DATE) AS event_date, date_trunc('second', ts) AS event_ts,
  CAST(user_id AS VARCHAR) AS user_id, event_type AS event_name,
  'f' || (event_id % 4) AS source_file, replace(props, ' ', '') AS attributes FROM events"""


def _text_attributes(df):
    return df.withColumn("attributes", json_text(F.col("attributes")))


@query("k5_canonical_load", f"SELECT *, (SELECT count(*) FROM events) AS loaded FROM ({CANONICAL_ORACLE})")
def k5(spark, sf_dir):
    table = BatchTable(
        spark, scratch_path(spark, "k5"), CANONICAL, partition_by=("event_date",),
        sort_by=("event_name",),
    )
    rows = fx.canonical(spark, sf_dir).drop("event_id")
    counts = table.load(ld.cast_rows(rows, CANONICAL, ld.CANONICAL_LOAD), "b1", ld.CANONICAL_LOAD, LOADED)
    return _text_attributes(table.read()).withColumn("loaded", F.lit(counts["ok"]).cast("bigint"))


@query("s4_canonical_scan", CANONICAL_ORACLE)
def s4(spark, sf_dir):
    rows = read_ndjson(spark, fx.canonical_json(spark, sf_dir), CANONICAL, accept_invalid_bytes=True)
    return _text_attributes(ld.good(ld.cast_rows(rows, CANONICAL, ld.PATH_LOAD)))


