"""Table maintenance, de-duplication, two targets, ledgers and reports."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from eventmart.operators import dedupe, dualwrite, sinks
from eventmart.operators import load as ld
from eventmart.operators import opsmetrics as om
from eventmart.operators.tables import BatchTable
from eventmart.plans import fixtures as fx
from eventmart.plans.engagement import KEYED, _ledger
from eventmart.plans.fixtures import ATTRIBUTION_SQL, LOG_SQL, METRIC_SQL
from eventmart.plans.registry import query
from eventmart.schemas import CANONICAL
from eventmart.session import scratch_path
from eventmart.sources import files as fl

LOADED = datetime(2024, 2, 1)
A = f"({ATTRIBUTION_SQL}) a"
L = f"({LOG_SQL}) l"
KEPT = ["appsflyer_id", "event_time", "event_name", "customer_user_id", "platform"]
COLS = ", ".join(KEPT)
# Updates come twice, the later one counts; new ids come once.
UPDATES_SQL = f"""
SELECT appsflyer_id, event_time + INTERVAL '1' HOUR AS event_time, event_name, customer_user_id, 'web' AS platform
  FROM {A} WHERE event_id % 50 = 0
UNION ALL SELECT appsflyer_id, event_time + INTERVAL '2' HOUR, event_name, customer_user_id, 'tv'
  FROM {A} WHERE event_id % 50 = 0
UNION ALL SELECT 'n' || appsflyer_id, event_time, event_name, customer_user_id, platform
  FROM {A} WHERE event_id % 60 = 0"""
REPEATED_SQL = f"""
SELECT {COLS} FROM {A} UNION ALL SELECT {COLS} FROM {A} WHERE event_id % 70 = 0
UNION ALL SELECT appsflyer_id, event_time + INTERVAL '1' HOUR, event_name, customer_user_id, platform
  FROM {A} WHERE event_id % 50 = 0"""
UPSERTED = f"""
SELECT {COLS} FROM {A} WHERE event_id % 50 <> 0
UNION ALL SELECT {COLS} FROM ({UPDATES_SQL}) WHERE platform = 'tv' OR appsflyer_id LIKE 'n%'"""


def base(spark, sf_dir):
    return fx.attribution(spark, sf_dir).select(*KEPT)


# -- de-duplication and upsert --------------------------------------------------------------
@query("d1_upsert", UPSERTED)
def d1(spark, sf_dir):
    updates = fx.derive(spark, sf_dir, UPDATES_SQL)
    return dedupe.upsert(base(spark, sf_dir), updates, "appsflyer_id", ["event_time"])


@query("d1_upsert_partitions", f"SELECT *, strftime(event_time, '%Y%m%d') AS day FROM ({UPSERTED})")
def d1_partitions(spark, sf_dir):
    """Into a table partitioned by day; an update may move a row to the next day."""
    day = F.date_format("event_time", "yyyyMMdd")
    rows = base(spark, sf_dir).withColumn("day", day)
    table = dedupe.PartitionedTable(spark, scratch_path(spark, "d1"), rows.schema, "day")
    table.replace(rows, rows.select("day"))
    table.upsert(fx.derive(spark, sf_dir, UPDATES_SQL).withColumn("day", day), "appsflyer_id", ["event_time"])
    return table.read()


@query("d2_unique", f"SELECT DISTINCT * FROM ({REPEATED_SQL})")
def d2(spark, sf_dir):
    return dedupe.unique(fx.derive(spark, sf_dir, REPEATED_SQL), ["appsflyer_id", "event_time"])


@query("w3_latest_per_key", f"""
SELECT {COLS} FROM (SELECT *, row_number() OVER (PARTITION BY appsflyer_id ORDER BY event_time DESC) AS rn
  FROM ({REPEATED_SQL})) WHERE rn = 1""")
def w3(spark, sf_dir):
    return dedupe.latest(fx.derive(spark, sf_dir, REPEATED_SQL), ["appsflyer_id"], ["event_time"])


def two_targets(spark, sf_dir):
    """The primary lacks every 11th event and the secondary every 13th; the secondary holds
    every 17th twice and another platform for every 19th."""
    df = fx.attribution(spark, sf_dir)
    e = F.col("event_id")
    primary = df.where(e % 11 != 0).select(*KEPT)
    other = df.where(e % 13 != 0).withColumn(
        "platform", F.when(e % 19 == 0, "other").otherwise(F.col("platform"))
    )
    copies = F.when(e % 17 == 0, F.sequence(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    secondary = other.withColumn("copy", F.explode(copies)).select(*KEPT)
    return primary, secondary


PARITY = """
SELECT 'e' || event_id AS appsflyer_id, CAST(event_id % 11 <> 0 AS BIGINT) AS primary_rows,
  CASE WHEN event_id % 13 = 0 THEN 0 WHEN event_id % 17 = 0 THEN 2 ELSE 1 END::BIGINT AS secondary_rows,
  CASE WHEN event_id % 13 = 0 THEN 'only_primary' WHEN event_id % 11 = 0 THEN 'only_secondary' ELSE 'differs' END AS status
FROM events WHERE (event_id % 13 = 0 AND event_id % 11 <> 0) OR (event_id % 11 = 0 AND event_id % 13 <> 0)
  OR (event_id % 13 <> 0 AND (event_id % 17 = 0 OR event_id % 19 = 0))"""


@query("j4_target_parity", PARITY)
def j4(spark, sf_dir):
    return dedupe.parity(*two_targets(spark, sf_dir), "appsflyer_id")


@query("j4_parity_by_digests", PARITY)
def j4_digests(spark, sf_dir):
    """The same targets, of which only the buckets that differ are compared by key."""
    return dedupe.parity_by_digests(*two_targets(spark, sf_dir), "appsflyer_id", buckets=64)


# -- tables ---------------------------------------------------------------------------------
def _name(path):
    return "t_" + path[-12:]


@query("k12_create_tables", """
SELECT 'staging' AS table_name, 1 AS columns, count(*) AS rows FROM events
UNION ALL SELECT 'final', 6, count(*) FROM events""")
def k12(spark, sf_dir):
    """Created twice, filled from the events, and created again without effect."""
    path = scratch_path(spark, "k12")
    name = _name(path)
    for _ in range(2):
        sinks.create_document_tables(spark, name, CANONICAL, path)
    fx.canonical(spark, sf_dir).select(*CANONICAL.names).write.insertInto(name)
    fx.events(spark, sf_dir).select(F.parse_json("props")).write.insertInto(f"{name}_staging")
    sinks.create_document_tables(spark, name, CANONICAL, path)

    def counted(label, table):
        df = spark.table(table)
        return df.agg(
            F.lit(label).alias("table_name"), F.lit(len(df.columns)).alias("columns"),
            F.count("*").alias("rows"),
        )

    return counted("staging", f"{name}_staging").unionByName(counted("final", name))


@query("k13_truncate", "SELECT count(*) AS before, CAST(0 AS BIGINT) AS after FROM events")
def k13(spark, sf_dir):
    path = scratch_path(spark, "k13")
    name = _name(path)
    sinks.create_table(spark, name, CANONICAL, path)
    fx.canonical(spark, sf_dir).select(*CANONICAL.names).write.insertInto(name)
    before = spark.table(name).count()
    sinks.truncate_table(spark, name)
    spark.catalog.refreshTable(name)
    return spark.table(name).agg(F.lit(before).cast("bigint").alias("before"), F.count("*").alias("after"))


@query("k16_clustered_table", f"SELECT customer_user_id, count(*) AS n, max(event_time) AS last FROM {A} GROUP BY 1")
def k16(spark, sf_dir):
    """Grouping by the bucket column needs no shuffle."""
    path = scratch_path(spark, "k16")
    sinks.write_clustered(base(spark, sf_dir), _name(path), path, buckets=8)
    return spark.table(_name(path)).groupBy("customer_user_id").agg(
        F.count("*").alias("n"), F.max("event_time").alias("last")
    )


@query("k17_month_partitions", f"SELECT {COLS}, strftime(event_time, '%Y%m') AS event_month FROM ({REPEATED_SQL}) WHERE strftime(event_time, '%Y%m') = '202401'")
def k17(spark, sf_dir):
    path = scratch_path(spark, "k17")
    df = fx.derive(spark, sf_dir, REPEATED_SQL)
    sinks.write_by_month(df, path)
    return sinks.read_months(spark, path, df.schema, ["202401"])


# -- two targets ----------------------------------------------------------------------------
@query("k6_dual_write", """
SELECT target, batch_id, n FROM (VALUES ('primary', 'b1', 1), ('primary', 'b2', 1), ('secondary', 'b2', 1)) t(target, batch_id, f)
CROSS JOIN (SELECT event_id % 2 AS h, count(*) AS n FROM events GROUP BY 1) c WHERE (batch_id = 'b1') = (h = 0)""")
def k6(spark, sf_dir):
    """The secondary rejects the first batch; the second one reaches both, also when retried."""
    root = scratch_path(spark, "k6")
    df = fx.canonical(spark, sf_dir)
    primary = BatchTable(spark, f"{root}/primary", CANONICAL)
    secondary = BatchTable(spark, f"{root}/secondary", CANONICAL)
    broken = BatchTable(spark, "nowhere://secondary", CANONICAL)

    def half(h):
        return ld.cast_rows(df.where(F.col("event_id") % 2 == h), CANONICAL, ld.CANONICAL_LOAD)

    log = f"{root}/log"
    dualwrite.dual_write(half(0), primary, broken, "b1", ld.CANONICAL_LOAD, LOADED, log)
    for _ in range(2):
        dualwrite.dual_write(half(1), primary, secondary, "b2", ld.CANONICAL_LOAD, LOADED, log)
    loaded = spark.read.parquet(log).where("error IS NULL")
    return loaded.select("target", "batch_id", F.col("processed").alias("n"))


# -- ledger ---------------------------------------------------------------------------------
@query("k15_retention", "SELECT event_id FROM events WHERE ts + INTERVAL 24 HOUR <= TIMESTAMP '2024-01-16 00:00:00' AND event_id % 3 <> 0")
def k15(spark, sf_dir):
    """One ledger entry per event; every third was not loaded."""
    path = scratch_path(spark, "k15")
    entries = fx.events(spark, sf_dir).select(
        F.concat(F.lit("f"), "event_id").alias("path"),
        F.when(F.col("event_id") % 3 == 0, "failed").otherwise("loaded").alias("status"),
        F.lit(1).alias("attempts"), F.col("ts").alias("loaded_at"), F.lit("b1").alias("batch_id"),
    )
    entries.write.partitionBy("batch_id").parquet(f"{path}/ledger")
    table = BatchTable(spark, path, CANONICAL)
    gone = table.deletable("2024-01-16 00:00:00")
    return gone.select(F.substring("path", 2, 20).cast("bigint").alias("event_id"))


@query("a13_sync_progress", f"""
WITH f AS (SELECT DISTINCT file_label, block FROM {KEYED}
  UNION ALL SELECT DISTINCT 'early', event_id // {fx.BLOCK} FROM events WHERE event_id % 97 = 0),
d AS (SELECT regexp_matches(file_label, '-173000001[02]-') AS done FROM f)
SELECT count(*) AS expected, count(*) FILTER (done) AS processed,
  count(*) FILTER (done) / count(*) * 100 AS pct, false AS matches FROM d""")
def a13(spark, sf_dir):
    files = fl.list_files(spark, fx.csv_exports(spark, sf_dir), "csv")
    return om.sync_progress(files, _ledger(files))


# -- load log -------------------------------------------------------------------------------
@query("a7_load_durations", f"""
SELECT avg(date_diff('second', started_at, ended_at)) AS avg_duration_sec,
  max(date_diff('second', started_at, ended_at)) AS max_duration_sec, count(*) AS query_count
FROM {L} WHERE started_at > TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 1 HOUR""")
def a7(spark, sf_dir):
    return om.load_durations(fx.ingest_log(spark, sf_dir), "2024-01-20 00:00:00")


LOAD_COUNTS = f"""
SELECT time_bucket(INTERVAL 5 MINUTE, started_at) AS bin_start, target, count(*) AS load_count
FROM {L} WHERE regexp_matches(msg, 'inserted into.*Redshift') GROUP BY ALL"""


@query("a8_load_counts", LOAD_COUNTS)
def a8(spark, sf_dir):
    return om.load_counts(fx.ingest_log(spark, sf_dir))


WORKERS = f"""
SELECT worker_id, CAST(sum(processed) AS BIGINT) AS messages_processed, CAST(sum(failed) AS BIGINT) AS messages_failed,
  date_diff('millisecond', min(started_at), max(ended_at)) AS ms FROM {L} GROUP BY worker_id"""
# date_diff counts borders crossed, the report counts whole milliseconds elapsed
WORKERS = WORKERS.replace(
    "date_diff('millisecond', min(started_at), max(ended_at))",
    "(epoch_us(max(ended_at)) - epoch_us(min(started_at))) // 1000",
)


@query("a9_worker_throughput", f"""
SELECT worker_id, messages_processed, messages_failed, CAST(floor(ms / 1000.0) AS BIGINT) AS uptime_seconds,
  round(messages_processed / (ms / 1000.0::DOUBLE), 6) AS per_second, round(messages_processed / (ms / 1000.0::DOUBLE) * 3600, 6) AS per_hour,
  round(messages_processed / (ms / 1000.0::DOUBLE) * 86400, 6) AS per_day FROM ({WORKERS})""")
def a9(spark, sf_dir):
    df = om.worker_throughput(fx.ingest_log(spark, sf_dir))
    return df.withColumns({c: F.round(c, 6) for c in ("per_second", "per_hour", "per_day")})


@query("a10_fleet", f"""
SELECT round(sum(messages_processed / (ms / 1000.0::DOUBLE) * 3600), 6) AS total_per_hour,
  round(avg(messages_processed / (ms / 1000.0::DOUBLE)), 6) AS avg_per_second,
  round(sum(messages_failed)::DOUBLE / sum(messages_processed)::DOUBLE * 100, 6) AS failure_rate FROM ({WORKERS})""")
def a10(spark, sf_dir):
    df = om.fleet(om.worker_throughput(fx.ingest_log(spark, sf_dir)))
    return df.select(*[F.round(c, 6).alias(c) for c in df.columns])


@query("a11_target_health", f"""
SELECT target, round(avg(CASE WHEN error IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 100, 6) AS success_pct,
  round(avg((epoch_us(ended_at) - epoch_us(started_at)) // 1000), 6) AS avg_latency_ms,
  count(*) FILTER (error IS NOT NULL) AS failure_count FROM {L} GROUP BY target""")
def a11(spark, sf_dir):
    df = om.target_health(fx.ingest_log(spark, sf_dir))
    return df.withColumns({c: F.round(c, 6) for c in ("success_pct", "avg_latency_ms")}).withColumn(
        "success_pct", F.col("success_pct").cast("double")
    )


@query("a11_error_types", f"SELECT target, error, count(*) AS n FROM {L} WHERE error IS NOT NULL GROUP BY ALL")
def a11_errors(spark, sf_dir):
    return om.error_types(fx.ingest_log(spark, sf_dir))


@query("t4_recent_loads", f"""
SELECT batch_id, substr(msg, 1, 50) AS query_start, started_at, ended_at,
  (epoch_us(ended_at) - epoch_us(started_at)) // 1000 AS duration_ms FROM {L} ORDER BY started_at DESC, batch_id LIMIT 20""")
def t4(spark, sf_dir):
    return om.recent_loads(fx.ingest_log(spark, sf_dir))


def alarm_sql(metric, statistic, period, periods, threshold, stream=False):
    """SQL of a threshold alarm; of a stream also when it goes off, for the periods before the watermark only."""
    samples = f"({METRIC_SQL}) WHERE metric = '{metric}'"
    if stream:
        judged = alarm_sql(metric, statistic, period, periods, threshold)
        return f"""
    SELECT metric, period_start, stat, breach, alarm,
      alarm AND NOT coalesce(lag(alarm) OVER w AND period_start - lag(period_start) OVER w = INTERVAL {period} SECOND, false) AS raised
    FROM ({judged}) WHERE epoch_ms(period_start) + {period} * 1000 <= (SELECT epoch_ms(max(ts)) FROM {samples})
    WINDOW w AS (PARTITION BY metric ORDER BY period_start)"""
    runs = " AND ".join(
        f"coalesce(lag(breach, {i}) OVER w AND p - lag(p, {i}) OVER w = {i}, false)"
        for i in range(1, periods)
    )
    return f"""
    SELECT metric, make_timestamp(p * {period} * 1000000) AS period_start, round(stat, 6) AS stat, breach,
      breach AND {runs} AS alarm FROM (
      SELECT metric, p, stat, stat > {threshold} AS breach FROM (
        SELECT metric, epoch_us(ts) // 1000000 // {period} AS p, {statistic}(value) AS stat
        FROM {samples} GROUP BY ALL))
    WINDOW w AS (PARTITION BY metric ORDER BY p)"""


def _alarm(spark, sf_dir, metric, rule):
    samples = fx.metrics(spark, sf_dir).where(F.col("metric") == metric)
    return om.threshold_alarm(samples, *rule).withColumn("stat", F.round("stat", 6))


@query("w1_queue_depth_alarm", alarm_sql("queue_depth", "avg", 300, 2, 1000000))
def w1(spark, sf_dir):
    return _alarm(spark, sf_dir, "queue_depth", om.QUEUE_DEPTH_ALARM)


@query("w2_message_age_alarm", alarm_sql("message_age", "max", 60, 3, 300))
def w2(spark, sf_dir):
    return _alarm(spark, sf_dir, "message_age", om.MESSAGE_AGE_ALARM)


@query("w2_hourly_alarm", alarm_sql("message_age", "max", 3600, 3, 100))
def w2_hourly(spark, sf_dir):
    """The same rule with hourly periods, which the samples fill."""
    return _alarm(spark, sf_dir, "message_age", ("max", 3600, 3, 100))


