"""Loads, ledgers, targets, skew and replay on small inputs."""

import json
import time
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.functions.values import safe_column_name
from eventmart.operators import csv_events, dedupe, dualwrite, evolve, sinks, summaries, tables
from eventmart.operators import opsmetrics as om
from eventmart.operators.joins import join_small, measured_bytes
from eventmart.operators.load import (
    ATTRIBUTION_LOAD, REASON, LoadFailed, LoadPolicy, cast_rows, check_required, good, stamp,
)
from eventmart.operators.tables import BatchTable
from eventmart.plans import streams
from eventmart.schemas import ATTRIBUTION, ATTRIBUTION_TABLE, CANONICAL, INGEST_LOG
from eventmart.session import setting
from eventmart.sources import csvlines as cl
from eventmart.sources import files as fl
from eventmart.sources.ndjson import parse_ndjson, read_ndjson
from eventmart.streaming import alarms, flush, loads

NOW = datetime(2024, 2, 1)


def write_lines(spark, path, lines, name="part", header=None, gz=False, files=1):
    """Lines as text files whose names start with ``name``."""
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i INT, line STRING")
    w = df.repartition(files).sortWithinPartitions("i").select(F.col("line").alias(header or "line"))
    (
        w.write.mode("append").option("header", bool(header)).option("sep", "\x01").option("quote", "")
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .option("compression", "gzip" if gz else "none").option("mapreduce.output.basename", name).csv(path)
    )


def test_schema_counts():
    assert len(ATTRIBUTION.fields) == 124
    assert len(ATTRIBUTION_TABLE.fields) == 126
    kinds = [f.dataType.simpleString() for f in ATTRIBUTION_TABLE.fields]
    assert (kinds.count("timestamp_ntz"), kinds.count("boolean"), kinds.count("decimal(18,6)")) == (15, 9, 5)


# -- CSV ------------------------------------------------------------------------------------
def test_headers_differ_per_file_and_split(spark, scratch):
    """Files with different headers, plain and gzip, cut into many small splits."""
    path = scratch()
    for k in range(3):
        header = ["ts", "eventName", "v"][: 3 - k % 2] + [f"extra{k}"]
        lines = [",".join([f"2024010100000{i % 10}", "Click"] + ["x"] * (len(header) - 2)) for i in range(500)]
        write_lines(spark, path, lines, f"1730000000-173000000{k}-Kind", ",".join(header), gz=k == 2)
    session = spark.newSession()
    for key, value in {"spark.sql.files.maxPartitionBytes": "256", "spark.sql.session.timeZone": "UTC"}.items():
        session.conf.set(key, value)
    for limit in (cl.BROADCAST_LIMIT, 0):
        rows = cl.csv_rows(session, path, broadcast_limit=limit)
        events = csv_events.to_events(rows)
        assert events.count() == 1500
        keys = events.select(F.explode(F.json_object_keys(F.to_json("attributes")))).distinct()
        assert {r[0] for r in keys.collect()} == {"v", "extra0", "extra1", "extra2"}


def test_numbered_lines_across_splits(spark, scratch):
    path = scratch()
    write_lines(spark, path, [f"{i},x" for i in range(1, 1001)], "a", "n,y")
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", "200")
    numbered = cl.numbered_lines(session, path).where("line_no > 1")
    wrong = numbered.where(F.split("line", ",")[0].cast("bigint") != F.col("line_no") - 1)
    assert numbered.count() == 1000
    assert wrong.count() == 0
    for rows in (10, 998, 999, 5000):  # ranked and numbered
        head = cl.first_rows(session, path, rows)
        assert head.agg(F.count("*"), F.max("line_no")).first() == (min(rows, 1000) + 1,) * 2


def test_header_pass_leaves_session_alone(spark, scratch):
    path = scratch()
    write_lines(spark, path, ["1,2"], "a", "x,y")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    assert cl.read_headers(spark, path).collect()[0]["header"] == "x,y"
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def test_headers_of_many_large_files(spark, scratch, monkeypatch):
    """Jobs that read large files side by side do not take away one another's rows."""
    monkeypatch.setattr(cl, "SMALL_FILE", 64)
    monkeypatch.setattr(cl, "FILES_PER_JOB", 1)
    path = scratch()
    rows = spark.createDataFrame([(k, i, f"x,y{k}" if i == 0 else f"{i},2") for k in range(24) for i in range(40)], "k INT, i INT, line STRING")
    rows.repartition(4, "k").sortWithinPartitions("k", "i").drop("i").write.partitionBy("k").text(path)
    write_lines(spark, f"{path}/k=24", ["1,2"], "a", "x,y24")  # a small one
    for larger_than in (-1, 64):
        found = cl.first_lines(spark, path, 2, larger_than=larger_than).groupBy("file_path").agg(F.array_sort(F.collect_list("line_no")).alias("n"), F.min_by("line", "line_no").alias("header"))
        assert sorted(r["header"] for r in found.collect()) == sorted(f"x,y{k}" for k in range(25 if larger_than < 0 else 24))
        assert found.where("n <> array(1, 2)").isEmpty()
    session = spark.newSession()
    for key in ("maxPartitionBytes", "openCostInBytes"):
        session.conf.set(f"spark.sql.files.{key}", "64")
    assert cl.csv_rows(session, path).count() == 24 * 39 + 1


def test_landing_of_many_split_files(spark, scratch, monkeypatch):
    """Exports of several splits, whose headers several jobs read, land whole under the names that their headers tell."""
    monkeypatch.setattr(cl, "SMALL_FILE", 64)
    monkeypatch.setattr(cl, "FILES_PER_JOB", 1)
    path, landed = scratch(), scratch()
    line = F.concat(F.lit("2024010100000"), F.col("i") % 10, F.when(F.col("k") % 2 == 0, ",Click,").otherwise(",,View"))
    rows = spark.range(20 * 60).select(F.floor(F.col("id") / 60).alias("k"), (F.col("id") % 60).alias("i"))
    rows = rows.select("k", "i", F.when(F.col("i") > 0, line).otherwise("ts,eventName,event_name").alias("line"))
    rows.repartition(4, "k").sortWithinPartitions("k", "i").drop("i").write.partitionBy("k").option(
        "mapreduce.output.basename", "1730000000-1730000000-Seen"
    ).text(path)
    session = spark.newSession()
    for key in ("maxPartitionBytes", "openCostInBytes"):
        session.conf.set(f"spark.sql.files.{key}", "512")
    sinks.write_structured_json(csv_events.to_events(cl.csv_rows(session, path, fl.started_by)), landed)
    names = read_ndjson(spark, landed, CANONICAL).groupBy("event_name").count()
    assert {tuple(r) for r in names.collect()} == {("Click", 590), ("View", 590)}


def test_row_map_under_column_names(spark, scratch):
    """The names that a layout carries are those that each row's map would get; others stay as written."""
    path = scratch()
    write_lines(spark, path, ["a,b,,d,e,f", "1,,3,4,5"], "a", "Extra  Col,7th,--,ts,\u00e9,profile.id")
    rows = cl.csv_rows(spark, path)
    each = F.transform_keys(cl.row_map(), lambda k, _: F.coalesce(safe_column_name(k), k))
    found = rows.select(cl.row_map("safe_names").alias("by_layout"), each.alias("by_row")).collect()
    assert [r["by_layout"] for r in found] == [r["by_row"] for r in found]
    names = ["extra_col", "_7th", "--", "ts", "\u00e9", "profile_id"]
    assert [r["by_layout"] for r in found] == [dict(zip(names, ["a", "b", None, "d", "e", "f"])), dict(zip(names, ["1", None, "3", "4", "5", None]))]
    write_lines(spark, path, ["1,2"], "b", "Extra Col,extra_col")
    with pytest.raises(Exception, match="DUPLICATED_MAP_KEY"):  # as with a map made row by row
        cl.csv_rows(spark, path).select(cl.row_map("safe_names")).collect()


def test_repeated_header_lines(spark, scratch):
    path = scratch()
    write_lines(spark, path, ["1,2", "x,y", "x,y", "3,4"], "a", "x,y")
    write_lines(spark, path, ["1,2"], "b", "x,y")
    kept = cl.csv_rows(spark, path)
    assert kept.count() == 5 and kept.where(F.get("fields", F.lit(0)) == "x").count() == 2


def test_filter_of_events_splits_no_line(spark, scratch):
    path = scratch()
    write_lines(spark, path, ['click,"a, b",1', "profile_update,x,2", "", ",c,3"], "1730000000-1730000000-App_Launched", "event_name,note,n")
    events = csv_events.to_events(cl.csv_rows(spark, path), F.lit("2024-01-31").cast("timestamp"))
    kept = csv_events.without_profile_updates(events)
    got = {r["event_name"]: json.loads(r["a"]) for r in kept.withColumn("a", F.to_json("attributes")).collect()}
    assert got["click"] == {"note": "a, b", "n": "1"} and set(got) == {"click", "App_Launched"} and kept.count() == 3
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    # the line is split in one place and the header in one; a split names its pattern twice
    assert plan.count("regexp_extract_all(") == 4


def test_lone_columns_are_cast_without_arrays(spark):
    table = T.StructType([T.StructField("d", T.DateType()), T.StructField("n", T.IntegerType()), T.StructField("t", T.StringType())])
    rows = [("2024-01-05", "7", "x"), ("2024-01-05", "seven", "x"), ("never", "seven", " "), (None, " ", None), ("01/05/2024", "", "y")]
    df = cast_rows(spark.createDataFrame(rows, "d string, n string, t string"), table, LoadPolicy())
    day = datetime(2024, 1, 5).date()
    assert [tuple(r) for r in df.collect()] == [
        (day, 7, "x", None), (day, None, "x", "n: not a int"), (None, None, None, "d: not a date"), (None, None, None, None),
        (day, None, "y", None),
    ]
    assert "zip_with" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_event_file_rules(spark, scratch):
    path = scratch()
    header = "TS,eventName,Profile.Identity,event,note,note,User_ID"
    write_lines(
        spark, path,
        ["20240101000000,,  9 ,fallback,first,last,x", "20241301000000,Named,,,,,", "short"],
        "1730000000-1730000000-App_Launched", header,
    )
    events = csv_events.to_events(cl.csv_rows(spark, path), F.lit("2024-01-31").cast("timestamp"))
    got = {
        r["event_name"]: (r["event_ts"], r["user_id"], json.loads(r["a"]))
        for r in events.withColumn("a", F.to_json("attributes")).collect()
    }
    assert got == {
        "fallback": (datetime(2024, 1, 1), "9", {"note": "last"}),
        "Named": (None, None, {"note": None}),
        "App_Launched": (datetime(2024, 1, 31), None, {"note": None}),
    }
    # the time that cannot be stored is a reject of the load
    rejected = cast_rows(events, CANONICAL, LoadPolicy())
    assert rejected.count() == 3


def test_message_packing(spark):
    rows = [("f", i + 2, "x" * (300 if i == 3 else 10)) for i in range(12)]
    events = spark.createDataFrame(rows, "source_file STRING, line_no BIGINT, text STRING")
    packed = sinks.pack_rows(events, "s", max_bytes=160).orderBy("chunk", "part").collect()
    # rows of 39 bytes: the long row stands alone, nothing is lost or reordered
    assert [r["row_count"] for r in packed] == [3, 1, 1, 4, 1, 2]
    unlimited = sinks.pack_rows(events, "s").orderBy("chunk").collect()
    assert [r["row_count"] for r in unlimited] == [5, 5, 2]


def test_schema_sync(spark, scratch):
    path, location = scratch(), scratch()
    table = "sync_" + location[-12:]
    sinks.create_table(spark, table, CANONICAL, location)
    write_lines(spark, path, ["1,2,3,4,5"], "a", "User_ID,1st Col,1st--Col,$$,Über")
    assert evolve.sync_schema(spark, table, path) == 2
    assert spark.table(table).columns[-2:] == ["_1st_col", "_ber"]
    assert evolve.sync_schema(spark, table, path) == 0


# -- files ----------------------------------------------------------------------------------
def test_listing_manifest_and_ledger(spark, scratch):
    root = scratch()
    for name in ("a.json", "b.json"):
        write = spark.range(1).select(F.lit('{"x":1}').alias("value")).write.mode("append")
        write.option("mapreduce.output.basename", name).json(f"{root}/day=1")
    spark.range(1).write.json(f"{root}/manifests")
    spark.range(1).write.csv(f"{root}/other")
    files = fl.list_files(spark, root, "documents")
    paths = sorted(r["path"] for r in files.collect())
    assert len(paths) == 2 and files.where("key LIKE 'day=1/%'").count() == 2
    assert fl.list_files(spark, root, "json").count() == 3

    manifest = scratch()
    fl.manifest_of(files, batch_size=1).select("value").write.text(manifest)
    entries = fl.read_manifest_lines(spark, manifest)
    loads_ = fl.manifest_loads(entries, files).collect()
    assert sorted(r["paths"] for r in loads_) == [[paths[0]], [paths[1]]] and {r["batch"] for r in loads_} == {0}
    with pytest.raises(FileNotFoundError):
        fl.manifest_loads(entries, files.where(F.col("path") == paths[0]))

    def ledger(status, attempts):
        return spark.createDataFrame([(paths[0], "b", status, attempts, NOW)],
                                     "path STRING, batch_id STRING, status STRING, attempts INT, loaded_at TIMESTAMP_NTZ")

    assert fl.next_batch(fl.unprocessed(files, ledger("loaded", 1))) == [paths[1]]
    assert fl.next_batch(fl.unprocessed(files, ledger("failed", 2), max_attempts=3)) == paths
    assert fl.next_batch(fl.unprocessed(files, ledger("failed", 3), max_attempts=3)) == [paths[1]]


def test_start_date_prunes_files(spark, scratch):
    path = scratch()
    write_lines(spark, path, ["1"], "1700000000-1700000000-x", "h")
    write_lines(spark, path, ["2"], "1730000000-1730000000-x", "h")
    lines = cl.text_lines(spark, path).where(fl.started_by(F.col("file_name")))
    assert lines.rdd.getNumPartitions() == 1
    assert [r["line"] for r in lines.collect()] == ["h", "2"]


# -- load -----------------------------------------------------------------------------------
def attribution_rows(spark, *payloads):
    lines = spark.createDataFrame([(p if isinstance(p, str) else json.dumps(p),) for p in payloads], "value STRING")
    return parse_ndjson(lines, ATTRIBUTION)


def event(**more):
    return {"appsflyer_id": "1", "event_name": "install", "event_time": "2024-01-01 00:00:00", **more}


def test_cast_and_reject_reasons(spark):
    rows = attribution_rows(
        spark,
        event(event_revenue="1.23456789", wifi="yes", language="x" * 60, campaign="  "),
        event(event_revenue="1e3", install_time="", is_lat=False, af_sub1=12, event_value={"a": [1]}),
        event(wifi="maybe"),
        event(event_revenue="9" * 13),
        event(install_time="2024-02-30 00:00:00"),
        "{oops",
        {"appsflyer_id": "1"},
        "{}",
    )
    out = cast_rows(check_required(rows), ATTRIBUTION, ATTRIBUTION_LOAD).collect()
    assert [r[REASON] for r in out] == [
        None, None, "wifi: not a boolean", "event_revenue: not a decimal(18,6)",
        "install_time: not a timestamp_ntz", "not JSON", "Missing required fields", "Empty payload",
    ]
    assert str(out[0]["event_revenue"]) == "1.234567"  # cut, not rounded
    assert (out[0]["wifi"], out[0]["language"], out[0]["campaign"]) == (True, "x" * 50, None)
    assert (str(out[1]["event_revenue"]), out[1]["install_time"]) == ("1000.000000", None)
    assert (out[1]["is_lat"], out[1]["af_sub1"], out[1]["event_value"].toJson()) == (False, "12", '{"a":[1]}')


def test_required_fields_with_payload_text(spark):
    lines = spark.createDataFrame([("{}",), ('{"unknown":1}',)], "value STRING")
    rows = parse_ndjson(lines.withColumn("payload", F.col("value")), ATTRIBUTION)
    got = check_required(rows, "payload").select(REASON).collect()
    assert [r[0] for r in got] == ["Empty payload", "Missing required fields"]


def test_load_publishes_all_or_nothing(spark, scratch):
    table = BatchTable(spark, scratch(), ATTRIBUTION_TABLE)
    ok = stamp(cast_rows(attribution_rows(spark, event(), event(wifi="no")), ATTRIBUTION, ATTRIBUTION_LOAD), F.lit(NOW))
    bad = stamp(cast_rows(attribution_rows(spark, event(), event(wifi="?")), ATTRIBUTION, ATTRIBUTION_LOAD), F.lit(NOW))
    strict = LoadPolicy()
    with pytest.raises(LoadFailed):
        table.load(bad, "b1", strict, NOW)
    assert table.read().count() == 0 and table.rejects().count() == 1
    with pytest.raises(LoadFailed):
        table.load(bad, "b1", strict, NOW)
    assert table.batch_state("b1")["attempts"] == 2
    assert table.load(ok, "b2", strict, NOW) == {"ok": 2, "reject": 0}
    assert table.load(ok, "b2", strict, NOW) == {"ok": 2, "reject": 0}
    assert table.read().count() == 2
    assert table.load(bad, "b3", LoadPolicy(max_errors=2), NOW) == {"ok": 1, "reject": 1}
    assert table.read().count() == 3


def test_load_records_files_and_retention(spark, scratch):
    root, table = scratch(), BatchTable(spark, scratch(), ATTRIBUTION_TABLE)
    for n in range(2):
        spark.createDataFrame([(json.dumps(event()),)], "value STRING").write.mode("append").text(root)
    rows = stamp(cast_rows(read_ndjson(spark, root, ATTRIBUTION), ATTRIBUTION, ATTRIBUTION_LOAD), F.lit(NOW))
    table.load(rows, "b1", ATTRIBUTION_LOAD, NOW)
    assert table.ledger().where("path IS NOT NULL").count() == 2
    assert table.deletable("2024-02-01 23:59:59").count() == 0
    assert table.deletable("2024-02-02 00:00:00").count() == 2


def test_partitioned_load(spark, scratch):
    table = BatchTable(spark, scratch(), CANONICAL, partition_by=("event_date",), sort_by=("event_name",))
    rows = spark.createDataFrame(
        [("2024-01-0%d" % d, f"2024-01-0{d} 00:00:00", "u", "n", "f", '{"a":1}') for d in (1, 2, 3)],
        "event_date STRING, event_ts STRING, user_id STRING, event_name STRING, source_file STRING, attributes STRING",
    ).withColumn("attributes", F.parse_json("attributes"))
    table.load(cast_rows(rows, CANONICAL, LoadPolicy()), "b1", LoadPolicy(), NOW)
    assert table.read().columns == CANONICAL.names
    assert table.read().where("event_date = DATE '2024-01-02'").count() == 1


def test_secondary_failure_is_logged_only(spark, scratch):
    rows = cast_rows(attribution_rows(spark, event()), ATTRIBUTION, ATTRIBUTION_LOAD)
    rows = stamp(rows, F.lit(NOW))
    root = scratch()
    primary = BatchTable(spark, f"{root}/p", ATTRIBUTION_TABLE)
    secondary = BatchTable(spark, f"{root}/s", ATTRIBUTION_TABLE)
    broken = BatchTable(spark, "nowhere://x", ATTRIBUTION_TABLE)
    log = f"{root}/log"
    assert dualwrite.dual_write(rows, primary, broken, "b1", ATTRIBUTION_LOAD, NOW, log)["ok"] == 1
    with pytest.raises(Exception):
        dualwrite.dual_write(rows, broken, secondary, "b2", ATTRIBUTION_LOAD, NOW, log)
    assert secondary.read().count() == 1
    gap = dedupe.parity(primary.read(), secondary.read().limit(0), "appsflyer_id").collect()
    assert [(r["status"], r["primary_rows"]) for r in gap] == [("only_primary", 1)]
    entries = spark.read.parquet(log)
    assert set(entries.columns) == set(INGEST_LOG.names)
    assert entries.where("error IS NOT NULL").count() == 2


# -- skew -----------------------------------------------------------------------------------
def skewed(spark, n=30_000):
    """A third of all rows has one key."""
    e = F.col("id")
    return spark.range(n).select(
        F.when(e % 3 == 0, "hot").otherwise(e.cast("string")).alias("k"), (e % 1000).alias("t"), e.alias("v")
    )


def test_latest_keeps_one_row_per_key_before_the_shuffle(spark):
    df = dedupe.latest(skewed(spark), ["k"], ["t"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    hot = df.where("k = 'hot'").collect()
    assert len(hot) == 1 and hot[0]["t"] == 999
    assert df.count() == 20_001


def test_parity_does_not_pair_rows_of_a_hot_key(spark):
    a = skewed(spark)
    b = a.withColumn("v", F.when(F.col("v") == 3, -1).otherwise(F.col("v")))
    out = dedupe.parity(a, b, "k")
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert [(r["k"], r["status"]) for r in out.collect()] == [("hot", "differs")]


def test_clustered_write_splits_a_hot_bucket(spark, scratch):
    location = scratch()
    table = "clu_" + location[-12:]
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16KB")
    try:
        wide = skewed(spark).withColumn("pad", F.sha2(F.col("v").cast("string"), 256))
        sinks.write_clustered(wide, table, location, by="k", sort=("t", "v"), buckets=4)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128MB")
    back = spark.table(table)
    assert back.count() == 30_000
    assert back.where("k = 'hot'").select(F.col("_metadata.file_path")).distinct().count() > 1
    grouped = back.groupBy("k").agg(F.count("*").alias("n"))
    assert "hashpartitioning" not in grouped._jdf.queryExecution().executedPlan().toString()
    assert grouped.where("k = 'hot'").first()["n"] == 10_000


def test_structured_json_keeps_all_rows_of_a_hot_name(spark, scratch):
    root = scratch()
    events = skewed(spark, 3000).select(
        F.lit("2024-01-01").cast("date").alias("event_date"), F.lit(NOW).cast("timestamp_ntz").alias("event_ts"),
        F.col("v").cast("string").alias("user_id"),
        F.when(F.col("k") == "hot", "a|b/c").when(F.col("v") % 3 == 1, "profile_update").otherwise("x").alias("event_name"),
        F.lit("f").alias("source_file"), F.parse_json(F.lit("{}")).alias("attributes"),
    )
    sinks.write_structured_json(events, root, rows_per_file=300)
    sinks.write_structured_json(events, root, rows_per_file=300)  # appends
    back = spark.read.schema("event_name STRING, date DATE, name STRING").json(root)
    counts = {(r["name"], r["event_name"]): r["count"] for r in back.groupBy("name", "event_name").count().collect()}
    assert counts == {("a|b/c", "a|b/c"): 2000, ("x", "x"): 2000}
    assert sinks.path_messages(spark, root).agg(F.max("row_count")).first()[0] <= 300


def test_join_small_measures_first(spark):
    side = spark.range(100).select(F.col("id").alias("k"), F.lit("x" * 100).alias("pad"))
    assert measured_bytes(side) > 10_000
    big = spark.range(1000).select((F.col("id") % 100).alias("k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = join_small(big, side, "k", 1 << 20)
        large = join_small(big, side, "k", 1000)
        assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in large._jdf.queryExecution().executedPlan().toString()
        assert small.count() == large.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# -- reports --------------------------------------------------------------------------------
def test_alarm_needs_consecutive_periods(spark):
    def at(minute, value):
        return (datetime(2024, 1, 1, 0, minute), "q", float(value))

    # breaches in minutes 0, 1, 2, 4, 5 with nothing in minute 3
    rows = [at(0, 9), at(1, 9), at(1, 1), at(2, 9), at(4, 9), at(5, 9), at(6, 1)]
    samples = spark.createDataFrame(rows, "ts TIMESTAMP_NTZ, metric STRING, value DOUBLE")
    out = om.threshold_alarm(samples, "max", 60, 3, 5).orderBy("period_start").collect()
    assert [(r["period_start"].minute, r["breach"], r["alarm"]) for r in out] == [
        (0, True, False), (1, True, False), (2, True, True), (4, True, False), (5, True, False), (6, False, False),
    ]


def test_upsert_partitions_moves_rows(spark, scratch):
    schema = T.StructType.fromDDL("k STRING, t INT, part STRING")
    table = dedupe.PartitionedTable(spark, scratch(), schema, "part")
    assert table.read().count() == 0 and not table.recover()
    rows = lambda: sorted(tuple(r) for r in table.read().collect())
    table.upsert(spark.createDataFrame([("a", 1, "0:1"), ("b", 1, "02"), ("c", 1, "03"), ("n", 1, None)], schema), "k", ["t"])
    assert len(rows()) == 4
    table.upsert(spark.createDataFrame([("a", 2, "02"), ("a", 3, "04"), ("d", 1, "03")], schema), "k", ["t"])
    after = [("a", 3, "04"), ("b", 1, "02"), ("c", 1, "03"), ("d", 1, "03")]
    assert [r for r in rows() if r[2]] == after and len(rows()) == 5  # the partition that lost its row is empty
    # a writer that dies before the staged rows are whole changes nothing
    spark.createDataFrame([("z", 9, "02", True)], "k STRING, t INT, part STRING, _live BOOLEAN").write.mode("overwrite").partitionBy(
        "part").parquet(f"{table.root}/_staged/rows")
    assert [r for r in rows() if r[2]] == after and not table.recover()
    # one that dies while publishing is finished by the next writer
    gone = spark.createDataFrame([("03",), ("09",)], "part STRING")
    table.stage(spark.createDataFrame([("y", 1, "09")], schema), gone)
    assert [r for r in rows() if r[2]] == after
    table.upsert(spark.createDataFrame([("n", 2, "05")], schema), "k", ["t"])
    assert rows() == [("a", 3, "04"), ("b", 1, "02"), ("n", 2, "05"), ("y", 1, "09")]


# -- streams --------------------------------------------------------------------------------
def test_stream_batches_carry_the_checkpoint_id(spark, scratch):
    source, table = scratch(), BatchTable(spark, scratch(), CANONICAL)
    doc = '{"ts":20240101000000,"eventName":"n","profile":{"identity":"1"}}'
    spark.createDataFrame([(doc,), ("oops",)], "value STRING").write.text(source)
    started = loads.sync(
        loads.line_stream(spark, source), loads.document_rows(True), table, LoadPolicy(max_errors=2), scratch(), "s"
    )
    started.awaitTermination()
    ids = {r["batch_id"] for r in table.ledger().collect()}
    assert ids == {f"s-{started.id}-0"}
    row = table.read().first()
    assert (row["user_id"], row["event_ts"]) == ("1", datetime(2024, 1, 1)) and row["source_file"].startswith("file:")
    assert table.rejects().select("_raw").first()[0] == "oops"


def test_good_drops_helper_columns(spark):
    rows = cast_rows(attribution_rows(spark, event()), ATTRIBUTION, ATTRIBUTION_LOAD)
    assert T.StructType(good(rows).schema.fields).names == ATTRIBUTION.names


# -- attempts, retries, archive, manifests ---------------------------------------------------
def canonical_rows(spark, *days, reject=False):
    rows = spark.createDataFrame(
        [(d, f"{d} 00:00:00", "u", f"n{i}", "f", '{"a":1}') for i, d in enumerate(days)]
        + ([("2024-99-99", "x", "u", "bad", "f", "{}")] if reject else []),
        "event_date STRING, event_ts STRING, user_id STRING, event_name STRING, source_file STRING, attributes STRING",
    ).withColumn("attributes", F.parse_json("attributes"))
    return cast_rows(rows, CANONICAL, LoadPolicy())


def test_corrected_batch_loads(spark, scratch):
    """The rejects of an earlier attempt do not count again, and its rows are not published."""
    table = BatchTable(spark, scratch(), CANONICAL, partition_by=("event_date",))
    with pytest.raises(LoadFailed):
        table.load(canonical_rows(spark, "2024-01-01", reject=True), "b", LoadPolicy(), NOW)
    assert table.rejects().count() == 1
    assert table.load(canonical_rows(spark, "2024-01-02"), "b", LoadPolicy(), NOW) == {"ok": 1, "reject": 0}
    assert [r["event_date"].isoformat() for r in table.read().collect()] == ["2024-01-02"]
    assert table.rejects().count() == 0 and table.batch_state("b")["attempts"] == 2


def test_crash_between_stage_and_ledger(spark, scratch):
    """The next attempt may put the rows into other partitions; each row is read once."""
    table = BatchTable(spark, scratch(), CANONICAL, partition_by=("event_date",))
    table.stage(canonical_rows(spark, "2024-01-01"), "b")
    assert table.read().count() == 0
    table.load(canonical_rows(spark, "2024-01-02"), "b", LoadPolicy(), NOW)
    assert [r["event_date"].isoformat() for r in table.read().collect()] == ["2024-01-02"]
    assert table.load(canonical_rows(spark, "2024-01-03"), "b", LoadPolicy(), NOW) == {"ok": 1, "reject": 0}
    assert table.read().count() == 1


def test_csv_scan_keeps_every_line_at_any_split(spark, scratch):
    path = scratch()
    lines = []
    for i in range(2000):
        lines.append(f"{i},{'v' * (i % 50)}")
        if i % 100 == 0:
            lines += ["x,y", ""]
    Path(path).mkdir(parents=True)
    Path(path, "a.csv").write_text("\n".join(["x,y", *lines]) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("8k", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            rows = cl.csv_rows(spark, path)
            first = F.get("fields", F.lit(0))
            assert rows.count() == 2040
            assert rows.where(first == "x").count() == 20 and rows.where(first == "").count() == 20
            numbered = cl.numbered_lines(spark, path).where("line_no > 1").orderBy("line_no").collect()
            assert [r["line"] for r in numbered] == lines
            assert [r["line"] for r in cl.first_rows(spark, path, 300).orderBy("line_no").collect()][1:] == lines[:300]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_manifests_of_any_length(spark, scratch):
    files = spark.range(2500).select(F.format_string("file:/d/%05d.json", "id").alias("path"))
    root = scratch()
    entry = lambda i: {"url": f"file:/d/{i:05d}.json", "mandatory": i != 2600}
    long, short = ([entry(i) for i in r] for r in (range(0, 2501), (0, 7, 7, 2600)))
    long[-1]["mandatory"] = False
    for name, entries in (("a", long), ("b", short)):  # both begin with the same file
        spark.createDataFrame([(json.dumps({"entries": entries}),)], "value STRING").coalesce(1).write.text(f"{root}/{name}")
    for read in (fl.read_manifest, fl.read_manifest_lines):
        got = {}
        for r in fl.manifest_loads(read(spark, f"{root}/*"), files).collect():
            got.setdefault(r["manifest"], {})[r["batch"]] = r["paths"]
        sizes = sorted([len(p) for _, p in sorted(m.items())] for m in got.values())
        assert sizes == [[2], [1000, 1000, 500]]
    seen = fl.run_loads(fl.manifest_loads(fl.read_manifest(spark, f"{root}/*"), files), lambda m, b, p: len(p))
    assert sorted(seen) == [2, 500, 1000, 1000]


def test_retry_gives_up(spark, scratch):
    source, table = scratch(), BatchTable(spark, scratch(), CANONICAL)
    spark.createDataFrame([("oops",)], "value STRING").write.text(source)
    loads.sync(loads.line_stream(spark, source), loads.document_rows(), table, LoadPolicy(), scratch(), "s").awaitTermination()
    tried = [loads.retry_failed(table, loads.document_rows(), LoadPolicy(), 3) for _ in range(4)]
    assert [list(t.values()) for t in tried] == [[False], [False], [], []]
    assert loads.archive_loaded(table, scratch()) == 0


def test_alarm_on_a_stream_over_restarts(spark, scratch):
    """Runs go on over restarts, an alarm is raised once per run, late samples and null values count for nothing."""
    source, out, checkpoint = scratch(), scratch(), scratch()
    schema = "ts TIMESTAMP_NTZ, metric STRING, value DOUBLE"

    def run(*samples):
        rows = [(datetime(2024, 1, 1, 0, m, s), k, v) for m, s, k, v in samples]
        spark.createDataFrame(rows, schema).write.mode("append").parquet(source)
        judged = alarms.threshold_alarm(spark.readStream.schema(schema).parquet(source), "max", 60, 3, 5.0, "60 seconds")
        started = (
            judged.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start()
        )
        started.awaitTermination()
        found = spark.read.schema(alarms.PERIODS).parquet(out).where("metric = 'q'")
        return [(r["period_start"].minute, r["alarm"], r["raised"]) for r in found.orderBy("period_start").collect()]

    # the watermark is 60 s behind the latest sample of any metric
    first = run((0, 0, "q", 9.0), (1, 0, "q", 1.0), (1, 1, "q", 9.0), (2, 0, "q", 2.0), (4, 0, "other", 1.0))
    assert first == [(0, False, False), (1, False, False), (2, False, False)]
    # minute 3 is still open; minute 1 is too late to count
    second = run((3, 0, "q", 9.0), (4, 0, "q", 9.0), (1, 30, "q", 99.0), (6, 0, "other", None))
    assert second == [*first, (3, False, False), (4, False, False)]
    # the run of minutes 3 to 6 goes on; minute 7 has only a null, so the next run starts in minute 8
    third = run((5, 0, "q", 9.0), (6, 0, "q", 9.0), (7, 0, "q", None), (8, 0, "q", 9.0), (9, 0, "q", 9.0), (10, 0, "q", 9.0), (12, 0, "q", 1.0))
    assert third == [
        *second, (5, True, True), (6, True, False), (8, False, False), (9, False, False), (10, True, True),
    ]


# -- rows or time, many batches, moves, lookups, one-pass scan ---------------------------------
def test_batches_by_rows_or_time_over_a_restart(spark, scratch):
    """By the clock: full batches leave at once, what is left waits, over a restart too, and leaves together."""
    source, out, checkpoint = scratch(), scratch(), scratch()

    def run(until, seconds):
        lines = spark.readStream.schema("value STRING").text(source)
        started = flush.write_batches(flush.batches(lines, 100, 15_000, lanes=1), out, checkpoint, "200 milliseconds")
        end = time.time() + seconds
        while time.time() < end and not until():
            if started.exception() is not None:
                raise started.exception()
            time.sleep(0.3)
        started.stop()

    def got():
        try:
            return sorted((r["number"], r["reason"], r["n"]) for r in spark.read.schema(flush.BATCH).parquet(out).collect())
        except AnalysisException:
            return []

    spark.range(250).select(F.col("id").cast("string")).write.text(source)
    run(lambda: len(got()) == 2, 60)
    assert got() == [(0, "rows", 100), (1, "rows", 100)]
    spark.range(250, 280).select(F.col("id").cast("string")).write.mode("append").text(source)
    run(lambda: sum(n for _, _, n in got()) == 280, 90)
    assert [n for _, reason, n in got() if reason == "rows"] == [100, 100]
    rest = [n for _, reason, n in got() if reason == "time"]
    assert sum(rest) == 80 and len(rest) <= 2
    rows = spark.read.schema(flush.BATCH).parquet(out).select(F.explode("rows").alias("v"))
    assert rows.distinct().count() == rows.count() == 280


def test_landed_batches_are_files(spark, scratch):
    source, out = scratch(), scratch()
    spark.range(50).select(F.concat(F.lit("x"), "id")).write.text(source)
    lines = spark.readStream.schema("value STRING").text(source)
    started = flush.land_batches(flush.batches(lines, 10, 60_000, lanes=1), out, scratch(), "200 milliseconds")
    end = time.time() + 60
    sizes = lambda: [n for p in Path(out).glob("*.txt") if (n := len(p.read_text().split()))]
    while time.time() < end and sum(sizes()) < 50:
        time.sleep(0.3)
    started.stop()
    assert sizes() == [10] * 5


def test_many_batches_load_together(spark, scratch):
    source = scratch()
    doc = '{"ts":20240101000000,"eventName":"n","profile":{"identity":"1"}}'
    rows = [(k, doc) for k in range(50) for _ in range(3)] + [(7, "oops")] * 2
    spark.createDataFrame(rows, "k INT, value STRING").repartition("k").write.partitionBy("k").text(source)
    batches = fl.list_any(spark, source).select(F.regexp_extract("path", "/k=([0-9]+)/", 1).alias("batch_id"), "path")
    table = BatchTable(spark, scratch(), CANONICAL)
    policy = LoadPolicy(max_errors=2)
    calls = []
    original = BatchTable.stage
    BatchTable.stage = lambda self, *a: calls.append(1) or original(self, *a)
    try:
        state = {r["batch_id"]: (r["status"], r["ok"], r["reject"]) for r in loads.load_batches(batches, loads.document_rows(), table, policy, NOW).collect()}
    finally:
        BatchTable.stage = original
    assert len(calls) == 1 and len(state) == 50
    assert state["7"] == ("failed", 3, 2) and state["8"] == ("loaded", 3, 0)
    assert table.read().count() == 147 and table.rejects().count() == 2
    again = loads.load_batches(batches, loads.document_rows(), table, LoadPolicy(max_errors=3), NOW).collect()
    assert [(r["batch_id"], r["status"]) for r in again] == [("7", "loaded")] and table.read().count() == 150
    assert table.batch_state("7")["attempts"] == 2
    archive, n = scratch(), batches.count()
    assert loads.archive_loaded(table, archive) == n == fl.list_any(spark, archive).count()
    assert loads.archive_loaded(table, archive) == 0 and table.deletable("2030-01-01").count() == 0


def test_wide_rows_are_staged_without_a_sort(spark, scratch, monkeypatch):
    """A task keeps the files of its folders open, up to a number of them; beyond it all rows are written too."""
    asked = []
    monkeypatch.setattr(tables, "setting", lambda session, key, value: asked.append((key, value)) or setting(session, key, value))
    names = spark.range(60).select(F.concat(F.lit("n"), F.col("id") % 20).alias("event_name"), F.concat(F.lit("b"), F.col("id") % 20).alias("batch_id"))
    rows = names.withColumn(REASON, F.when(F.col("event_name") == "n3", "bad")).coalesce(1)
    table = BatchTable(spark, scratch(), CANONICAL)
    attempt = table.stage(rows, None)
    key = "spark.sql.maxConcurrentOutputFileWriters"
    assert asked == [(key, str(tables.OPEN_FILES))] and spark.conf.get(key, "0") == "0"
    got = {(r["batch_id"], r["load_status"]): r["count"] for r in table._data().where(F.col("attempt") == attempt).groupBy("batch_id", "load_status").count().collect()}
    assert got == {(f"b{k}", "reject" if k == 3 else "ok"): 3 for k in range(20)}
    BatchTable(spark, scratch(), CANONICAL, sort_by=("event_name",)).stage(rows, "b")
    assert asked[1:] == [(key, "0")]


def test_batch_loads_split_short_lines(spark, scratch, monkeypatch):
    """Tasks read a bounded number of bytes, and the session's own setting is back afterwards."""
    source, table, before = scratch(), BatchTable(spark, scratch(), CANONICAL), spark.conf.get(loads.SPLIT)
    spark.range(400).select(F.lit("oops").alias("value")).coalesce(1).write.text(source)
    monkeypatch.setattr(loads, "SPLIT_BYTES", 250)
    batches = fl.list_any(spark, source).select(F.lit("b").alias("batch_id"), "path")
    state = loads.load_batches(batches, loads.document_rows(True), table, LoadPolicy(), NOW).collect()
    assert [(r["status"], r["ok"], r["reject"]) for r in state] == [("failed", 0, 400)]
    assert table._data().select("_metadata.file_path").distinct().count() == 8
    assert spark.conf.get(loads.SPLIT) == before


def test_corrected_files_share_the_rows(spark, scratch):
    path = scratch()
    spark.range(4).select(F.lit("old").alias("value")).repartition(3).write.text(path)
    paths = sorted(r["path"] for r in fl.list_any(spark, path).collect())
    streams._overwrite_files(spark, paths, spark.range(0, 100, 1, 2).select(F.col("id").cast("string").alias("value")))
    now = spark.read.text(path).groupBy(F.col("_metadata.file_path").alias("p")).agg(F.count("*").alias("n")).collect()
    assert [r["n"] for r in now] == [50, 50] and spark.read.text(path).distinct().count() == 100


def test_sweep_rests(spark, scratch):
    source = scratch()
    spark.createDataFrame([("{}",)], "value STRING").write.text(source)
    table = BatchTable(spark, scratch(), CANONICAL)
    files = fl.list_any(spark, source).select(F.lit("b").alias("batch_id"), "path")
    loads.load_batches(files, loads.document_rows(), table, LoadPolicy(max_errors=9), NOW)
    n = table.loaded_files().count()
    assert [loads.sweep(table, NOW + timedelta(hours=h)) for h in (1, 24, 24.9, 25)] == [0, None, None, n] and n > 0
    left = {p.name for p in Path(source).glob("part-*")}
    assert not left & {r["path"].rpartition("/")[2] for r in table.ledger().where("path IS NOT NULL").collect()}


def test_lookup_opens_few_files(spark, scratch):
    table = BatchTable(spark, scratch(), CANONICAL, cluster_by="user_id")
    rows = lambda lo, hi: cast_rows(
        spark.range(lo, hi).select(F.lit("2024-01-01").alias("event_date"), F.lit("2024-01-01 00:00:00").alias("event_ts"),
                                   F.format_string("%05d", "id").alias("user_id"), F.lit("n").alias("event_name")), CANONICAL, LoadPolicy())
    adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table.load(rows(0, 4000), "a", LoadPolicy(), NOW)
        table.load(rows(3000, 6000), "b", LoadPolicy(), NOW)
        table.stage(rows(0, 100), "never published")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)
    every = len(table.read().inputFiles())
    for key, n in (("00042", 1), ("03500", 2), ("05999", 1), ("07000", 0)):
        found = table.lookup(key)
        assert found.count() == n and len(found.inputFiles()) == n < every
    assert table.lookup(None).count() == 0


def test_thousands_of_small_exports_in_few_tasks(spark, scratch):
    """One read of the text, no join, far fewer tasks than files."""
    path = Path(scratch())
    path.mkdir(parents=True)
    for i in range(3000):
        (path / f"f{i}.csv").write_text(f"ts,eventName,c{i % 3}\n20240101000000,e,{i}\n")
    rows = cl.csv_rows(spark, str(path))
    assert rows.rdd.getNumPartitions() < 300
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1 and "Join" not in plan and "Exchange" not in plan
    names = rows.select(F.element_at("headers", -1).alias("h")).groupBy("h").count().collect()
    assert {r["h"]: r["count"] for r in names} == {"c0": 1000, "c1": 1000, "c2": 1000}


def test_beginning_of_a_large_file(spark, scratch):
    """A file of several splits: its header reaches all of them, its first lines come without reading it."""
    path = Path(scratch())
    path.mkdir(parents=True)
    with open(path / "big.csv", "w") as f:
        f.write("ts,eventName,n\n")
        f.writelines(f"20240101000000,e,{i}\n" for i in range(400_000))
    (path / "small.csv").write_text("a,b\n1,2\n")
    heads = cl.first_rows(spark, str(path), 2).orderBy("file_name", "line_no").collect()
    assert [(r["file_name"], r["line_no"], r["line"]) for r in heads] == [
        ("big.csv", 1, "ts,eventName,n"), ("big.csv", 2, "20240101000000,e,0"), ("big.csv", 3, "20240101000000,e,1"),
        ("small.csv", 1, "a,b"), ("small.csv", 2, "1,2"),
    ]
    rows = cl.csv_rows(spark, str(path))
    assert rows.rdd.getNumPartitions() > 1
    counts = rows.groupBy("headers").agg(F.count("*").alias("n"), F.count_distinct("fields").alias("d")).collect()
    assert sorted((r["headers"], r["n"], r["d"]) for r in counts) == [(["a", "b"], 1, 1), (["ts", "eventName", "n"], 400_000, 400_000)]


def test_equal_targets_are_not_compared_by_key(spark, monkeypatch):
    rows = spark.range(500).select(F.concat(F.lit("k"), F.col("id") % 100).alias("k"), F.col("id").alias("v"))
    shuffled = rows.orderBy(F.rand(3)).select("v", "k")
    compared = []
    original = dedupe.parity
    monkeypatch.setattr(dedupe, "parity", lambda a, b, key: compared.append(a.count() + b.count()) or original(a, b, key))
    assert dedupe.parity_by_digests(rows, shuffled, "k").count() == 0 and compared == [0]
    other = rows.where("v != 7").unionByName(rows.where("v = 8"))
    found = dedupe.parity_by_digests(rows, other, "k").orderBy("k").collect()
    assert [tuple(r) for r in found] == [("k7", 5, 4, "differs"), ("k8", 5, 6, "differs")]
    assert compared[1] < 100
    assert dedupe.parity_by_digests(rows, rows.limit(0), "k", buckets=8).count() == 100
    assert dedupe.parity_by_digests(rows.limit(0), rows.limit(0), "k").count() == 0


def test_summaries_count_a_replay_once(spark, scratch):
    table = BatchTable(spark, scratch(), ATTRIBUTION_TABLE)
    daily = summaries.DailySummaries(table)
    assert daily.report(["platform"]).count() == 0

    def load(batch, users, platform="ios"):
        rows = spark.range(users).select(
            F.concat(F.lit("e"), "id").alias("appsflyer_id"), F.lit("install").alias("event_name"), F.lit("2024-01-02 03:04:05").alias("event_time"),
            F.concat(F.lit("u"), "id").alias("customer_user_id"), F.lit(platform).alias("platform"), F.lit("1.5").alias("event_revenue_usd"),
        )
        table.load(cast_rows(rows, ATTRIBUTION, LoadPolicy()), batch, LoadPolicy(), NOW)
        daily.refresh()

    load("a", 20_000)
    load("a", 20_000)
    load("b", 30_000)
    load("c", 10, "web")
    got = {r["platform"]: r for r in daily.report(["platform"], "2024-01-02", "2024-01-02").collect()}
    assert (got["ios"]["events"], got["ios"]["revenue_events"], float(got["ios"]["revenue"])) == (50_000, 50_000, 75_000.0)
    assert abs(got["ios"]["users"] - 30_000) <= summaries.ERROR * 30_000 and got["web"]["users"] == 10
    assert daily.report(["platform"], "2024-01-03").count() == 0
