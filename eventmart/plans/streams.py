"""Streaming jobs, each run to the end of its input so that the result is a table."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from eventmart.functions.values import json_text
from eventmart.operators import load as ld
from eventmart.operators import opsmetrics as om
from eventmart.operators.tables import BatchTable
from eventmart.plans import fixtures as fx
from eventmart.plans.documents import D, DOC_TEXT, MESSAGES, ROWS, path_bodies
from eventmart.plans.fixtures import ATTRIBUTION_SQL
from eventmart.plans.registry import query
from eventmart.plans.tables import L, LOAD_COUNTS, alarm_sql
from eventmart.schemas import ATTRIBUTION, ATTRIBUTION_TABLE, CANONICAL
from eventmart.session import scratch_path
from eventmart.sources import files as fl
from eventmart.sources.ndjson import SOURCE
from eventmart.streaming import alarms, flush, landing, live, loads, queue

A = f"({ATTRIBUTION_SQL}) a"
DIRTY_OK = "event_id % 80 <> 1 AND event_id % 150 <> 11 AND event_id % 90 <> 0"
TYPED_OK = fx.FEW_DEFECTS


def _spread(spark, df, label, least=6):
    """Text lines as at least ``least`` files, more if the data comes in more partitions."""
    path = scratch_path(spark, label)
    files = max(least, df.rdd.getNumPartitions())
    df.repartition(files).write.text(path)
    return path, files


def _wait(started):
    started.awaitTermination()
    if started.exception() is not None:
        raise started.exception()


@query("k1_landing", f"SELECT appsflyer_id, event_name FROM {A} WHERE {DIRTY_OK}")
def k1(spark, sf_dir):
    """Payloads with defects are left out; the rest lands in files of at most 100 rows."""
    payloads = landing.payload_stream(spark, fx.dirty_ndjson(spark, sf_dir))
    out = scratch_path(spark, "k1")
    _wait(landing.land(payloads, out, scratch_path(spark, "k1-checkpoint"), interval=None))
    landed = spark.read.text(out).withColumn("file", F.col("_metadata.file_path"))
    if landed.groupBy("file").count().agg(F.max("count")).first()[0] > landing.ROWS_PER_FILE:
        raise AssertionError("a landed file is too long")
    return landed.select(
        F.get_json_object("value", "$.appsflyer_id").alias("appsflyer_id"),
        F.get_json_object("value", "$.event_name").alias("event_name"),
    )


def _attribution_sync(spark, path, table, checkpoint, files_per_batch):
    lines = loads.line_stream(spark, path, files_per_batch)
    rows = loads.ndjson_rows(ATTRIBUTION, ld.ATTRIBUTION_LOAD, required=True)
    return loads.sync(lines, rows, table, ld.ATTRIBUTION_LOAD, checkpoint, "sync")


@query("x1_micro_batches", f"SELECT event_name, count(*) AS n, 3 AS batches FROM {A} WHERE {TYPED_OK} GROUP BY event_name")
def x1(spark, sf_dir):
    """A third of the files per batch."""
    path, files = _spread(spark, fx.nearly_clean_lines(spark, sf_dir), "x1")
    table = BatchTable(spark, scratch_path(spark, "x1"), ATTRIBUTION_TABLE)
    third = -(-files // 3)
    _wait(_attribution_sync(spark, path, table, scratch_path(spark, "x1-checkpoint"), third))
    batches = table.ledger().select("batch_id").distinct().count()
    return (
        table.read().groupBy("event_name").agg(F.count("*").alias("n"))
        .withColumn("batches", F.lit(batches))
    )


ROWS_MOST, LANES = 20, 4
WAIT_MS = 6 * 3_600_000
FLUSHED = f"""
WITH RECURSIVE r AS (
  SELECT CAST(event_id % {LANES} AS INTEGER) AS lane, (epoch_us(ts) // 1000) AS ms, CAST(event_id AS VARCHAR) AS value,
    row_number() OVER w AS i FROM events WINDOW w AS (PARTITION BY event_id % {LANES} ORDER BY (epoch_us(ts) // 1000), CAST(event_id AS VARCHAR))
), e AS MATERIALIZED (
  SELECT *, count(*) OVER (PARTITION BY lane ORDER BY ms RANGE BETWEEN UNBOUNDED PRECEDING AND {WAIT_MS - 1} FOLLOWING) AS last_in,
    count(*) OVER (PARTITION BY lane) AS total FROM r
), b AS (
  SELECT lane, CAST(0 AS BIGINT) AS number, CAST(1 AS BIGINT) AS first FROM e WHERE i = 1
  UNION ALL
  SELECT b.lane, b.number + 1, least(b.first + {ROWS_MOST}, e.last_in + 1) FROM b JOIN e ON e.lane = b.lane AND e.i = b.first
  WHERE least(b.first + {ROWS_MOST}, e.last_in + 1) <= e.total
), s AS (SELECT b.lane, b.number, e.ms, e.value, least({ROWS_MOST}, e.last_in + 1 - b.first) AS n FROM b JOIN e ON e.lane = b.lane AND e.i = b.first)
SELECT lane, number, CASE WHEN n = {ROWS_MOST} THEN 'rows' ELSE 'time' END AS reason, CAST(n AS INTEGER) AS n, ms AS first_at, value AS first_value
FROM s WHERE n = {ROWS_MOST} OR ms + {WAIT_MS} <= (SELECT max((epoch_us(ts) // 1000)) FROM events)"""


@query("x1_rows_or_time", FLUSHED)
def x1_rows_or_time(spark, sf_dir):
    """Batches of 20 rows, or of six hours from a batch's first row, by the rows' own times. The events arrive in two halves,
    each read by a run of its own, so batches that are open in between lie in the state store."""
    rows = fx.events(spark, sf_dir).select(F.col("event_id").cast("string").alias("value"), F.col("ts").cast("timestamp").alias("ts"))
    middle = rows.agg(F.percentile_approx(F.unix_millis("ts"), 0.5)).first()[0]
    path, out, checkpoint = (scratch_path(spark, f"x1-{k}") for k in ("in", "out", "checkpoint"))
    for half in (F.unix_millis("ts") < middle, F.unix_millis("ts") >= middle):
        rows.where(half).write.mode("append").parquet(path)
        lines = spark.readStream.schema(rows.schema).parquet(path)
        batched = flush.batches(lines, ROWS_MOST, WAIT_MS, lane=(F.col("value").cast("long") % LANES).cast("int"), arrival=F.col("ts"))
        _wait(flush.write_batches(batched, out, checkpoint))
    found = spark.read.schema(flush.BATCH).parquet(out)
    return found.select(
        "lane", "number", "reason", "n", F.unix_millis("first_at").alias("first_at"), F.col("rows")[0].alias("first_value")
    )


def _alarm_stream(spark, sf_dir, metric, rule):
    """The samples of a metric arrive in two halves, each read by a run of its own, so the run of breaches and the period that
    are open in between lie in the state store."""
    samples = fx.metrics(spark, sf_dir).where(F.col("metric") == metric)
    middle = samples.agg(F.percentile_approx(F.unix_micros(F.col("ts").cast("timestamp")), 0.5)).first()[0]
    path, out, checkpoint = (scratch_path(spark, f"{metric}-{k}") for k in ("in", "out", "checkpoint"))
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    for half in (at < middle, at >= middle):
        samples.where(half).write.mode("append").parquet(path)
        judged = alarms.threshold_alarm(spark.readStream.schema(samples.schema).parquet(path), *rule)
        started = (
            judged.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(availableNow=True).start()
        )
        _wait(started)
    found = spark.read.schema(alarms.PERIODS).parquet(out)
    return found.withColumns({"period_start": F.col("period_start").cast("timestamp_ntz"), "stat": F.round("stat", 6)})


@query("w1_queue_depth_stream", alarm_sql("queue_depth", *om.QUEUE_DEPTH_ALARM, stream=True))
def w1_stream(spark, sf_dir):
    """Periods that the watermark has passed; the others are still open."""
    return _alarm_stream(spark, sf_dir, "queue_depth", om.QUEUE_DEPTH_ALARM)


@query("w2_hourly_stream", alarm_sql("message_age", "max", 3600, 3, 100, stream=True))
def w2_stream(spark, sf_dir):
    """The same for the hourly rule, in which runs of breaches are common."""
    return _alarm_stream(spark, sf_dir, "message_age", ("max", 3600, 3, 100))


@query("x2_interval_sync", f"SELECT appsflyer_id, event_name, event_time FROM {A} WHERE {TYPED_OK}")
def x2(spark, sf_dir):
    """Two runs: the second one finds the files that arrived in between."""
    path = scratch_path(spark, "x2")
    table = BatchTable(spark, scratch_path(spark, "x2-table"), ATTRIBUTION_TABLE)
    checkpoint = scratch_path(spark, "x2-checkpoint")
    for half in fx.nearly_clean_halves(spark, sf_dir):
        _arrive(spark, half, f"{path}/{half.rpartition('/')[2]}")
        _wait(_attribution_sync(spark, path, table, checkpoint, 1000))
    return table.read().select("appsflyer_id", "event_name", "event_time")


def _arrive(spark, source, target):
    """Copy a folder of the fixtures to where a stream looks."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    old, new = (jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    jvm.org.apache.hadoop.fs.FileUtil.copy(old.getFileSystem(conf), old, new.getFileSystem(conf), new, False, conf)


@query("x3_replay_safe", f"SELECT count(*) AS n, count(DISTINCT appsflyer_id) AS ids FROM {A} WHERE {TYPED_OK}")
def x3(spark, sf_dir):
    """The first run dies after its batch is written and before the checkpoint knows; the
    second one replays the batch, and no row counts twice."""

    class DiesOnce(BatchTable):
        alive = False

        def load(self, *args, **kwargs):
            counts = super().load(*args, **kwargs)
            if not self.alive:
                self.alive = True
                raise ConnectionError("lost after the write")
            return counts

    path = scratch_path(spark, "x3-lines")
    fx.nearly_clean_lines(spark, sf_dir).write.text(path)
    table = DiesOnce(spark, scratch_path(spark, "x3"), ATTRIBUTION_TABLE)
    checkpoint = scratch_path(spark, "x3-checkpoint")
    try:
        _wait(_attribution_sync(spark, path, table, checkpoint, 1000))
        raise AssertionError("the first run should have failed")
    except StreamingQueryException:
        pass
    _wait(_attribution_sync(spark, path, table, checkpoint, 1000))
    return table.read().agg(
        F.count("*").alias("n"), F.count_distinct("appsflyer_id").alias("ids")
    )


@query("x4_resume", f"""
SELECT event_date, event_ts, user_id, event_name, t.doc AS attributes FROM {D} JOIN ({DOC_TEXT}) t USING (event_id)""")
def x4(spark, sf_dir):
    """Raw documents, one file per batch, run twice on one checkpoint."""
    table = BatchTable(spark, scratch_path(spark, "x4"), CANONICAL)
    checkpoint = scratch_path(spark, "x4-checkpoint")
    for _ in range(2):
        lines = loads.line_stream(spark, fx.loadable_documents(spark, sf_dir), 1)
        _wait(loads.sync(lines, loads.document_rows(), table, ld.DOCUMENT_LOAD, checkpoint, "docs"))
    return table.read().select(
        "event_date", "event_ts", "user_id", "event_name",
        json_text(F.col("attributes")).alias("attributes"),
    )


@query("x5_failed_batch", f"""
SELECT event_name, 3 * count(*) AS n, 'loaded failed loaded, then loaded after 2 attempts; 1 given up' AS runs FROM {A}
GROUP BY event_name""")
def x5(spark, sf_dir):
    """Arrivals on one checkpoint; those with too many rejects do not stop the next. One of them is
    corrected and loads when it is tried again, the other one fails until it is given up."""
    path = scratch_path(spark, "x5")
    clean = fx.attribution(spark, sf_dir).drop("event_id")
    text = F.to_json(F.struct(*clean.columns), {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"})
    good = clean.select(text.alias("value"))
    bad = fx.events(spark, sf_dir).select(F.lit(fx.NOT_JSON).alias("value"))
    table = BatchTable(spark, scratch_path(spark, "x5-table"), ATTRIBUTION_TABLE)
    rows = loads.ndjson_rows(ATTRIBUTION, ld.ATTRIBUTION_LOAD, required=True)
    checkpoint = scratch_path(spark, "x5-checkpoint")

    def arrive(part, folder):
        part.write.text(f"{path}/{folder}")
        lines = loads.line_stream(spark, path)
        _wait(loads.sync(lines, rows, table, ld.ATTRIBUTION_LOAD, checkpoint, "x5"))

    for folder, part in (("a", good), ("b", bad), ("c", good)):
        arrive(part, folder)
    states = table.ledger().where("path IS NULL").orderBy("loaded_at").select("status").collect()
    runs = " ".join(r["status"] for r in states)
    failed = [r["batch_id"] for r in table.failed_batches(loads.MAX_ATTEMPTS).collect()]
    good.limit(0).write.mode("overwrite").text(f"{path}/b")
    _overwrite_files(spark, table.batch_files(failed[0]), good)
    arrive(bad, "d")
    while loads.retry_failed(table, rows, ld.ATTRIBUTION_LOAD):
        pass
    own = table.ledger().where("path IS NULL")
    again = own.where(F.col("batch_id") == failed[0]).first()
    lost = own.where("status = 'failed'").select("attempts").collect()
    runs += f", then {again['status']} after {again['attempts']} attempts; {len(lost)} given up"
    if [r["attempts"] for r in lost] != [loads.MAX_ATTEMPTS]:
        raise AssertionError("a failed batch was not tried as often as it should")
    counts = table.read().groupBy("event_name").agg(F.count("*").alias("n"))
    return counts.withColumn("runs", F.lit(runs))


def _overwrite_files(spark, paths, rows):
    """Give the files of a batch new content: the rows, written by as many tasks as there are files, and nothing in files
    for which a task had no rows."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    new = scratch_path(spark, "corrected")
    rows.coalesce(len(paths)).write.text(new)
    parts = [r["path"] for r in fl.list_any(spark, new).select("path").orderBy("path").collect()]  # at most as many as the paths
    target = [jvm.org.apache.hadoop.fs.Path(p) for p in paths]
    fs = target[0].getFileSystem(conf)
    for n, path in enumerate(target):
        fs.delete(path, False)
        if n < len(parts):
            fs.rename(jvm.org.apache.hadoop.fs.Path(parts[n]), path)
        else:
            fs.create(path).close()


@query("x6_envelope_stream", ROWS)
def x6(spark, sf_dir):
    table = BatchTable(spark, scratch_path(spark, "x6"), CANONICAL)
    bodies = queue.body_stream(spark, fx.envelopes(spark, sf_dir))

    def rows(batch):
        return ld.cast_rows(queue.engagement_rows(batch), CANONICAL, ld.CANONICAL_LOAD)

    _wait(loads.sync(bodies, rows, table, ld.CANONICAL_LOAD, scratch_path(spark, "x6-checkpoint"), "x6"))
    return table.read().withColumn("attributes", json_text(F.col("attributes")))


@query("x7_live_load_counts", f"""
SELECT * FROM ({LOAD_COUNTS}) WHERE bin_start + INTERVAL 5 MINUTE <= (SELECT max(started_at) FROM {L}) - INTERVAL 10 MINUTE""")
def x7(spark, sf_dir):
    """Bins behind the watermark are final."""
    path = fx.log_parquet(spark, sf_dir)
    out = scratch_path(spark, "x7")
    log = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    counts = live.live_load_counts(log)
    _wait(
        counts.writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", scratch_path(spark, "x7-checkpoint"))
        .outputMode("append").trigger(availableNow=True).start()
    )
    return spark.read.schema(counts.schema).parquet(out)


@query("d3_distinct_path_stream", f"SELECT DISTINCT s3_path FROM ({MESSAGES}) WHERE status = 'pending'")
def d3_stream(spark, sf_dir):
    """Repeats lie within the watermark; the bodies of one path arrive together."""
    path = scratch_path(spark, "d3")
    # files in time order, each with a range of the events
    path_bodies(spark, sf_dir).repartitionByRange(4, "event_id").select("body").write.text(path)
    out = scratch_path(spark, "d3-out")
    unique = queue.distinct_path_stream(queue.body_stream(spark, path), "10 minutes").select("s3_path")
    _wait(
        unique.writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", scratch_path(spark, "d3-checkpoint"))
        .outputMode("append").trigger(availableNow=True).start()
    )
    return spark.read.schema(unique.schema).parquet(out)


@query("x5_many_batches", f"""
SELECT 'm' || k AS batch_id, CASE k WHEN 7 THEN 'failed' ELSE 'loaded' END AS status, n AS ok,
  CASE k WHEN 7 THEN 10 ELSE 0 END::BIGINT AS reject, CASE k WHEN 7 THEN 0 ELSE n END AS published
FROM (SELECT event_id % 50 AS k, count(*) AS n FROM events GROUP BY 1)""")
def x5_many_batches(spark, sf_dir):
    """Fifty batches, named by their manifests, in one group; one has too many rejects, and the others are published with it."""
    root = scratch_path(spark, "x5-many")
    rows = fx.attribution(spark, sf_dir).withColumn("k", F.col("event_id") % 50)
    text = F.to_json(F.struct(*[c for c in rows.columns if c not in ("event_id", "k")]), {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"})
    bad = fx.events(spark, sf_dir).orderBy("event_id").limit(10).select(F.lit(fx.NOT_JSON).alias("value"), F.lit(7).cast("long").alias("k"))
    rows.select(text.alias("value"), "k").unionByName(bad).repartition("k").write.partitionBy("k").text(root)
    files = fl.list_any(spark, root).select("path")
    manifests = files.groupBy(F.regexp_extract("path", "/k=([0-9]+)/", 1).alias("k")).agg(
        F.collect_list(F.struct(F.col("path").alias("url"), F.lit(True).alias("mandatory"))).alias("entries")
    )
    entries = manifests.select(F.concat(F.lit("m"), "k").alias("manifest"), F.explode("entries.url").alias("path"), F.lit(True).alias("mandatory"))
    batches = fl.manifest_batches(entries, files).select(F.col("manifest").alias("batch_id"), "path")
    table = BatchTable(spark, scratch_path(spark, "x5-many-table"), ATTRIBUTION_TABLE)
    transform = loads.ndjson_rows(ATTRIBUTION, ld.ATTRIBUTION_LOAD, required=True)
    state = loads.load_batches(batches, transform, table, ld.ATTRIBUTION_LOAD)
    kept = table.read().groupBy(F.concat(F.lit("m"), F.substring("appsflyer_id", 2, 20).cast("long") % 50).alias("batch_id")).agg(F.count("*").alias("published"))
    return state.join(kept, "batch_id", "left").withColumn("published", F.coalesce("published", F.lit(0).cast("long")))


@query("k15_sweep", f"""
SELECT event_name, count(*) AS n, 'early deleted; second sweep rested; third deleted the rest' AS sweeps FROM {A} WHERE event_id % 3 = 2
GROUP BY event_name""")
def k15_sweep(spark, sf_dir):
    """Files of three loads, two of them a day apart; the third one failed, so its files stay whatever their age."""
    root = scratch_path(spark, "k15")
    rows = fx.attribution(spark, sf_dir).withColumn("k", F.col("event_id") % 3)
    text = F.to_json(F.struct(*[c for c in rows.columns if c not in ("event_id", "k")]), {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"})
    rows.select(text.alias("value"), "k").write.partitionBy("k").text(root)
    table = BatchTable(spark, scratch_path(spark, "k15-table"), ATTRIBUTION_TABLE)
    first, day = datetime(2024, 2, 1), timedelta(days=1)
    files = fl.list_any(spark, root).select("path").withColumn("batch_id", F.regexp_extract("path", "/k=([0-9]+)/", 1))
    good = loads.ndjson_rows(ATTRIBUTION, ld.ATTRIBUTION_LOAD)
    spoiled = lambda lines: good(lines.withColumn("value", F.lit(fx.NOT_JSON)))
    for k, transform in (("0", good), ("1", good), ("2", spoiled)):
        loads.load_batches(files.where(F.col("batch_id") == k), transform, table, ld.ATTRIBUTION_LOAD, first + int(k) * day)
    n = {r["batch_id"]: r["n"] for r in files.groupBy("batch_id").agg(F.count("*").alias("n")).collect()}
    hours = (24, 47, 72)
    gone = [loads.sweep(table, first + timedelta(hours=h)) for h in hours]
    said = "early deleted; second sweep rested; third deleted the rest" if gone == [n["0"], None, n["1"]] else str(gone)
    left = good(spark.read.text(root).select("value", F.col("_metadata.file_path").alias(SOURCE)))
    return left.groupBy("event_name").agg(F.count("*").alias("n")).withColumn("sweeps", F.lit(said))


@query("k14_archive", f"""
SELECT appsflyer_id, event_name, 'loaded files archived, failed files kept' AS files FROM {A} WHERE {TYPED_OK}""")
def k14(spark, sf_dir):
    """Files of loaded batches move to the archive, those of a failed one stay for the retry."""
    path, archive = scratch_path(spark, "k14"), scratch_path(spark, "k14-archive")
    table = BatchTable(spark, scratch_path(spark, "k14-table"), ATTRIBUTION_TABLE)
    checkpoint = scratch_path(spark, "k14-checkpoint")
    rows = loads.ndjson_rows(ATTRIBUTION, ld.ATTRIBUTION_LOAD, required=True)
    halves = fx.nearly_clean_lines(spark, sf_dir).randomSplit([0.5, 0.5], seed=7)
    bad = fx.events(spark, sf_dir).select(F.lit(fx.NOT_JSON).alias("value"))
    for part in (halves[0], bad, halves[1]):
        part.write.mode("append").text(path)
        lines = loads.line_stream(spark, path, 1000)
        _wait(loads.sync(lines, rows, table, ld.ATTRIBUTION_LOAD, checkpoint, "k14"))
        loads.archive_loaded(table, archive)
    name = F.element_at(F.split("path", "/"), -1).alias("name")
    here, there = (fl.list_any(spark, root).select(name) for root in (path, archive))
    entries = table.ledger().where("path IS NOT NULL").select(name, "status")
    done, failed = (entries.where(F.col("status") == s).select("name") for s in ("loaded", "failed"))
    wrong = [done.join(there, "name", "left_anti"), done.join(here, "name"), failed.join(here, "name", "left_anti"), failed.join(there, "name")]
    right = not any(not w.isEmpty() for w in wrong) and not failed.isEmpty()
    files = "loaded files archived, failed files kept" if right else "wrong files moved"
    return table.read().select("appsflyer_id", "event_name", F.lit(files).alias("files"))
