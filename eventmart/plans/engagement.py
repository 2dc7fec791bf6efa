"""CSV exports: listing, headers, parsing, normalisation, landing, messages, schema sync."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from eventmart.functions.csvtext import split_fields
from eventmart.functions.values import (
    file_name_numbers, json_text, leading_integer, safe_column_name, url_parts,
)
from eventmart.operators import csv_events as ce
from eventmart.operators import evolve, sinks
from eventmart.operators import load as ld
from eventmart.operators.analytics import daily_counts
from eventmart.operators.tables import BatchTable
from eventmart.plans import fixtures as fx
from eventmart.plans.fixtures import AS_OF, EXPORT_ROWS_SQL, PROFILE_ROWS_SQL, file_label
from eventmart.plans.registry import query
from eventmart.schemas import CANONICAL
from eventmart.session import scratch_path
from eventmart.sources import csvlines as cl
from eventmart.sources import files as fl
from eventmart.sources.ndjson import read_ndjson
from eventmart.streaming import loads

R = f"({EXPORT_ROWS_SQL}) r"
P = f"({PROFILE_ROWS_SQL}) p"
LOADED = datetime(2024, 2, 1)
ATTRIBUTES = """'{"Extra Col":' || coalesce('"' || extra_col || '"', 'null')
  || CASE WHEN extra_tail IS NOT NULL THEN ',"extra_tail":"tail"' ELSE '' END
  || ',"note":' || CAST(to_json(note) AS VARCHAR) || '}'"""
PROFILE_ATTRIBUTES = """'{"cleverTapId":"ct' || c_custkey || '","phone":' ||
  CASE WHEN c_custkey % 6 = 0 THEN 'null' ELSE '"+91' || c_custkey || '"' END
  || ',"profileattr.created_time":"' || (900000000 + c_custkey) || '","segment":"'
  || c.c_mktsegment || '"}'"""
BOTH = f"""
SELECT event_id, user_id, event_ts, event_name, file_label FROM {R}
UNION ALL SELECT NULL, user_id, event_ts, event_name, file_label FROM {P}"""


def rows(spark, sf_dir):
    """Parsed rows of the exports from the start date on."""
    return cl.csv_rows(spark, fx.csv_exports(spark, sf_dir), fl.started_by)


def now():
    return F.lit(AS_OF).cast("timestamp")


def events(spark, sf_dir):
    return ce.to_events(rows(spark, sf_dir), now())


def labelled(df):
    return df.withColumn("file_label", file_label())


# -- scans ----------------------------------------------------------------------------------
EVENT_COLUMNS = f"""
SELECT CAST(event_ts AS DATE) AS event_date, event_ts, user_id, event_name, file_label,
  {ATTRIBUTES} AS attributes FROM {R}"""


@query("s2_csv_scan", f"""
{EVENT_COLUMNS} UNION ALL
SELECT CAST(event_ts AS DATE), event_ts, p.user_id, event_name, file_label,
  {PROFILE_ATTRIBUTES} FROM {P} JOIN customer c USING (c_custkey)
UNION ALL SELECT event_date, event_ts, user_id, CASE WHEN event_name = 'Push_Sent' THEN 'Push_Sent' ELSE event_name END,
  '1730000000-1730000030-Push_Sent', attributes FROM ({EVENT_COLUMNS} WHERE event_id % 4 = 0)
UNION ALL SELECT DATE '2024-01-31', TIMESTAMP '2024-01-31 00:00:00', 'profile.identity', 'eventName',
  '1730000000-1730000030-Push_Sent', '{{"Extra Col":"Extra Col","note":"note"}}' FROM events WHERE event_id % 20 = 0""")
def s2(spark, sf_dir):
    """Plain and gzip files with four different headers, normalised whole; in one of them the header
    line comes again and again, and is data."""
    repeated = cl.csv_rows(spark, fx.repeated_export(spark, sf_dir), fl.started_by)
    both = events(spark, sf_dir).unionByName(ce.to_events(repeated, now()))
    df = labelled(both).drop("source_file")
    return df.withColumn("attributes", json_text(F.col("attributes")))


@query("s5_file_listing", f"""
SELECT DISTINCT file_label, 'csv' AS kind FROM ({BOTH})
UNION ALL SELECT '1700000000-1700000001-Push_Sent', 'csv' UNION ALL SELECT '', 'json'""")
def s5(spark, sf_dir):
    csv = fl.list_files(spark, fx.csv_exports(spark, sf_dir), "csv")
    json = fl.list_files(spark, fx.attribution_ndjson(spark, sf_dir), "json")
    return (
        csv.withColumn("kind", F.lit("csv"))
        .unionByName(json.withColumn("kind", F.lit("json")))
        .where("length > 0")
        .select(file_label("path").alias("file_label"), "kind")
        .distinct()
    )


HEADERS = f"""SELECT file_label, CASE k WHEN 2 THEN '{fx.EXPORT_HEADER},extra_tail'
  WHEN 3 THEN '{fx.EXPORT_HEADER},note' ELSE '{fx.EXPORT_HEADER}' END AS header
  FROM (SELECT DISTINCT file_label, k FROM {R})
UNION ALL SELECT '1700000000-1700000001-Push_Sent', '{fx.EXPORT_HEADER}'
UNION ALL SELECT '1730000000-1730000020-profiles', 'identity,phone,cleverTapId,profileattr.created_time,segment'"""


@query("s6_header_discovery", HEADERS)
def s6(spark, sf_dir):
    headers = cl.read_headers(spark, fx.csv_exports(spark, sf_dir))
    return headers.select(file_label("file_path").alias("file_label"), "header").distinct()


@query("s9_gzip_lines", f"""
SELECT gzip, count(*) AS n FROM (SELECT k % 2 = 1 AS gzip FROM {R} UNION ALL SELECT true FROM {P}) GROUP BY gzip""")
def s9(spark, sf_dir):
    found = rows(spark, sf_dir)
    return found.groupBy(F.col("source_file").endswith(".gz").alias("gzip")).agg(
        F.count("*").alias("n")
    )


KEYED = f"""(SELECT file_label, block, event_id AS key, CAST(event_id AS VARCHAR) AS id, user_id, event_name, event_ts FROM {R}
UNION ALL SELECT file_label, block, c_custkey, 'ct' || c_custkey, user_id, event_name, event_ts FROM {P})"""


def row_id(note, clevertap_id):
    """What tells the rows of all exports apart: the number in the note, or the profile's id."""
    return F.coalesce(F.nullif(F.regexp_extract(note, r"(\d+)$", 1), F.lit("")), clevertap_id)


@query("s11_bounded_scan", f"""
SELECT file_label, id FROM (SELECT *, row_number() OVER (PARTITION BY file_label, block ORDER BY key) AS rn FROM {KEYED})
WHERE rn <= 20""")
def s11(spark, sf_dir):
    """The first 20 rows of every file."""
    root = fx.csv_exports(spark, sf_dir)
    lines = cl.first_rows(spark, root, 20, fl.started_by)
    parsed = cl.parse_lines(cl.with_layout(lines, cl.read_headers(spark, root, fl.started_by)))
    return parsed.select(
        file_label().alias("file_label"), row_id(cl.lookup("note"), cl.lookup("clevertapid")).alias("id")
    )


# -- parsing and normalisation --------------------------------------------------------------
@query("p1_csv_fields", """
SELECT event_id, 'a, "b" ' || event_id AS f1, event_type AS f2, '' AS f3, 'x,y' || user_id AS f4,
  4 AS n FROM events""")
def p1(spark, sf_dir):
    """Quotes in the middle of a field, doubled quotes, white space, an open quote."""
    e = fx.events(spark, sf_dir)
    line = F.concat(
        F.lit('"a, ""b"" '), F.col("event_id"), F.lit('", '), F.col("event_type"),
        F.lit('\t, ,x","y'), F.col("user_id"),
    )
    f = split_fields(line)
    return e.select("event_id", f.alias("f")).select(
        "event_id", *[F.get("f", F.lit(i)).alias(f"f{i + 1}") for i in range(4)],
        F.size("f").alias("n"),
    )


@query("p2_header_lookup", f"""
SELECT file_label, CASE WHEN event_id % 40 <> 0 THEN event_name END AS name, note FROM {R}
UNION ALL SELECT file_label, NULL, NULL FROM {P}""")
def p2(spark, sf_dir):
    return rows(spark, sf_dir).select(
        file_label().alias("file_label"), cl.lookup("EventName").alias("name"),
        cl.lookup("NOTE").alias("note"),
    )


def _key(df):
    return df.withColumn(
        "event_id",
        F.regexp_extract(F.try_variant_get("attributes", "$.note", "string"), r"(\d+)$", 1).try_cast("bigint"),
    )


@query("p3_event_time", f"SELECT event_id, user_id, event_ts FROM ({BOTH})")
def p3(spark, sf_dir):
    return _key(events(spark, sf_dir)).select("event_id", "user_id", "event_ts")


@query("p4_event_date", f"SELECT event_id, user_id, CAST(event_ts AS DATE) AS event_date FROM ({BOTH})")
def p4(spark, sf_dir):
    return _key(events(spark, sf_dir)).select("event_id", "user_id", "event_date")


@query("p5_file_kind", f"SELECT DISTINCT file_label, file_label LIKE '%Push%' AS is_event_file FROM ({BOTH})")
def p5(spark, sf_dir):
    headers = cl.read_headers(spark, fx.csv_exports(spark, sf_dir), fl.started_by)
    return cl.layouts(headers).select(
        file_label("file_path").alias("file_label"), "is_event_file"
    ).distinct()


@query("p6_user_id", f"SELECT file_label, user_id, count(*) AS n FROM ({BOTH}) GROUP BY ALL")
def p6(spark, sf_dir):
    return labelled(events(spark, sf_dir)).groupBy("file_label", "user_id").agg(F.count("*").alias("n"))


@query("p7_event_name", f"SELECT file_label, event_name, count(*) AS n FROM ({BOTH}) GROUP BY ALL")
def p7(spark, sf_dir):
    return labelled(events(spark, sf_dir)).groupBy("file_label", "event_name").agg(F.count("*").alias("n"))


@query("p8_attributes", f"""SELECT event_id, {ATTRIBUTES} AS attributes FROM {R}
UNION ALL SELECT NULL, {PROFILE_ATTRIBUTES} FROM {P} JOIN customer c USING (c_custkey)""")
def p8(spark, sf_dir):
    df = _key(events(spark, sf_dir))
    return df.select("event_id", json_text(F.col("attributes")).alias("attributes"))


@query("p18_column_names", """
SELECT DISTINCT v, CASE WHEN event_id % 7 <> 6 THEN '_' || user_id || '_extra_col_' END AS name FROM (
  SELECT event_id, user_id, CASE WHEN event_id % 7 = 6 THEN '--' ELSE user_id || '. Extra--Col!' END AS v FROM events)""")
def p18(spark, sf_dir):
    v = F.expr("CASE WHEN event_id % 7 = 6 THEN '--' ELSE user_id || '. Extra--Col!' END")
    names = fx.events(spark, sf_dir).select(v.alias("v")).distinct()
    return names.select("v", safe_column_name(F.col("v")).alias("name"))


@query("p19_url_split", """
SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN 'bucket' || event_id % 5 END AS bucket,
  CASE WHEN event_id % 3 <> 0 THEN 'a/b/' || event_id || '.json' END AS key FROM events""")
def p19(spark, sf_dir):
    url = F.expr(
        """CASE event_id % 3 WHEN 0 THEN 'no url ' || event_id
        ELSE 's3://bucket' || event_id % 5 || '/a/b/' || event_id || '.json' END"""
    )
    bucket, key = url_parts(url)
    return fx.events(spark, sf_dir).select("event_id", bucket.alias("bucket"), key.alias("key"))


FILE_NAMES = """CASE event_id % 4 WHEN 0 THEN 'in/' || (1727740000 + event_id) || '-' || (1727740700 + event_id) || '-x.csv.gz'
  WHEN 1 THEN 'in/' || (1727740000 + event_id) || '-x.csv' WHEN 2 THEN 'in/1700000000-' || (1727740700 + event_id) || 'abc-x.csv'
  ELSE 'in/x-y.csv' END"""


@query("p20_file_name_numbers", """
SELECT event_id, CASE WHEN event_id % 4 < 2 THEN 1727740000 + event_id WHEN event_id % 4 = 2 THEN 1700000000 END AS first,
  CASE WHEN event_id % 2 = 0 THEN 1727740700 + event_id END AS second FROM events""")
def p20(spark, sf_dir):
    first, second = file_name_numbers(F.expr(FILE_NAMES))
    return fx.events(spark, sf_dir).select("event_id", first.alias("first"), second.alias("second"))


# 2024-10-01 00:00:00 UTC is 1727740800
@query("f4_start_date", """
SELECT event_id FROM events WHERE CASE WHEN event_id % 2 = 0 THEN 1727740700 + event_id >= 1727740800 ELSE false END
OR CASE WHEN event_id % 4 < 2 THEN 1727740000 + event_id >= 1727740800 ELSE false END""")
def f4(spark, sf_dir):
    return fx.events(spark, sf_dir).where(fl.started_by(F.expr(FILE_NAMES))).select("event_id")


@query("f2_profile_updates", f"SELECT event_name, count(*) AS n FROM {R} GROUP BY event_name")
def f2(spark, sf_dir):
    kept = ce.without_profile_updates(events(spark, sf_dir))
    return kept.groupBy("event_name").agg(F.count("*").alias("n"))


# -- landing --------------------------------------------------------------------------------
@query("k2_structured_json", f"""
SELECT CAST(event_ts AS DATE) AS date, 'events' AS type, event_name AS name, user_id, event_ts,
  file_label FROM {R}""")
def k2(spark, sf_dir):
    """Landed by date and name, then read back through the folder layout."""
    root = fx.structured_events(spark, sf_dir)
    schema = "user_id STRING, event_ts TIMESTAMP_NTZ, source_file STRING, date DATE, type STRING, name STRING"
    back = spark.read.schema(schema).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").json(root)
    return labelled(back).drop("source_file")


@query("k10_path_messages", f"""
SELECT CAST(CAST(event_ts AS DATE) AS VARCHAR) AS date, event_name AS name, file_label, count(*) AS row_count
FROM {R} GROUP BY ALL""")
def k10(spark, sf_dir):
    """Row counts of the messages, added up per folder and source."""
    m = sinks.path_messages(spark, fx.structured_events(spark, sf_dir))
    return labelled(
        m.select(
            F.regexp_extract("s3_path", "date=([^/]+)/", 1).alias("date"),
            F.regexp_extract("s3_path", "name=([^/]+)/", 1).alias("name"),
            "source_file", "row_count",
        )
    ).groupBy("date", "name", "file_label").agg(F.sum("row_count").alias("row_count"))


@query("s8_path_scan", f"""
SELECT event_name, count(*) AS n, count(user_id) AS users FROM {R} GROUP BY event_name
UNION ALL SELECT event_name || ' again', count(*), count(user_id) FROM {R} GROUP BY event_name""")
def s8(spark, sf_dir):
    """Manifests name the landed files, and a second set names them all once more in one manifest;
    all are resolved in one join, and their batches of files are loaded together."""
    files = fl.list_files(spark, fx.structured_events(spark, sf_dir), "json")
    out = []
    for label, size in (("", 3), (" again", 1 << 30)):
        root = scratch_path(spark, "manifests")
        fl.manifest_of(files, size).select("value").write.text(root)
        named = fl.manifest_batches(fl.read_manifest_lines(spark, root), files, 20)
        batches = named.select(F.concat_ws("-", F.substring_index("manifest", "#", -1), "batch").alias("batch_id"), "path")
        table = BatchTable(spark, scratch_path(spark, "s8"), CANONICAL)
        loads.load_batches(batches, loads.ndjson_rows(CANONICAL, ld.PATH_LOAD), table, ld.PATH_LOAD, LOADED)
        counts = table.read().groupBy("event_name").agg(F.count("*").alias("n"), F.count("user_id").alias("users"))
        out.append(counts.withColumn("event_name", F.concat("event_name", F.lit(label))))
    return out[0].unionByName(out[1])


@query("k8_flat_ndjson", f"""
SELECT CAST(event_id AS VARCHAR) AS id, CASE event_id % 25 WHEN 0 THEN NULL ELSE user_id END AS identity, note, extra_col,
  CASE event_id % 4 WHEN 3 THEN 6 WHEN 2 THEN 7 ELSE 6 END AS keys FROM {R}
UNION ALL SELECT 'ct' || c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN CAST(c_custkey AS VARCHAR) END, NULL, NULL, 5 FROM {P}""")
def k8(spark, sf_dir):
    path = scratch_path(spark, "flat")
    sinks.write_flat_ndjson(rows(spark, sf_dir), path)
    doc = F.parse_json("value")

    def text(name):
        return F.try_variant_get(doc, f"$['{name}']", "string")

    return spark.read.text(path).select(
        row_id(text("note"), text("cleverTapId")).alias("id"),
        F.coalesce(text("profile.identity"), text("identity")).alias("identity"),
        text("note").alias("note"),
        text("Extra Col").alias("extra_col"),
        F.size(F.json_object_keys("value")).alias("keys"),
    )


def messages(spark, sf_dir):
    """All exports packed into row-batch messages."""
    root = fx.csv_exports(spark, sf_dir)
    lines = cl.numbered_lines(spark, root, fl.started_by)
    parsed = cl.parse_lines(cl.with_layout(lines, cl.read_headers(spark, root, fl.started_by)))
    return sinks.pack_rows(ce.to_events(parsed, now(), keep=("line_no",)), "engagement")


CHUNKS = f"""(SELECT *, (row_number() OVER (PARTITION BY file_label, block ORDER BY key) - 1) // 5 AS chunk FROM {KEYED}) c"""


@query("k9_row_batches", f"""
SELECT file_label, chunk, id, user_id, event_name, CAST(event_ts AS VARCHAR) AS event_ts FROM {CHUNKS}""")
def k9(spark, sf_dir):
    m = messages(spark, sf_dir).withColumn(
        "row", F.explode("data.rows")
    )
    text = [F.try_variant_get("row", f"$.{c}", "string").alias(c) for c in ("user_id", "event_name", "event_ts")]
    note = F.try_variant_get("row", "$.attributes.note", "string")
    person = F.try_variant_get("row", "$.attributes.cleverTapId", "string")
    return m.select(file_label().alias("file_label"), "chunk", row_id(note, person).alias("id"), *text)


@query("a14_conversion_counts", f"""
WITH m AS (SELECT file_label, block, chunk, count(*) AS n FROM {CHUNKS} GROUP BY ALL)
SELECT file_label, CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS total_messages FROM m GROUP BY ROLLUP (file_label)""")
def a14(spark, sf_dir):
    m = labelled(messages(spark, sf_dir)).select(F.col("file_label").alias("source_file"), "row_count")
    return sinks.conversion_counts(m).withColumnRenamed("source_file", "file_label")


@query("a1_daily_counts", f"""
SELECT CAST(event_ts AS DATE) AS event_date, event_name, count(*) AS event_count FROM {R} GROUP BY ALL""")
def a1(spark, sf_dir):
    typed = read_ndjson(spark, fx.structured_events(spark, sf_dir), CANONICAL)
    return daily_counts(ld.good(ld.cast_rows(typed, CANONICAL, ld.PATH_LOAD)))


@query("p22_ndjson_lines", """
SELECT event_id, '{"event_date":"' || strftime(ts, '%Y-%m-%d') || '","event_ts":"' || strftime(ts, '%Y-%m-%d %H:%M:%S')
  || '","user_id":' || CASE event_id % 2 WHEN 0 THEN 'null' ELSE '"' || user_id || '"' END || ',"event_name":"' || event_type
  || '","source_file":"f' || (event_id % 4) || '","attributes":' || replace(props, ' ', '') || '}' AS line FROM events""")
def p22(spark, sf_dir):
    path = scratch_path(spark, "lines")
    df = fx.canonical(spark, sf_dir)
    df = df.withColumn("user_id", F.when(F.col("event_id") % 2 == 1, F.col("user_id")))
    line = F.to_json(F.struct(*CANONICAL.names), sinks.JSON_OPTIONS)
    df.select("event_id", line.alias("line")).write.parquet(path)
    return spark.read.parquet(path)


# -- files ----------------------------------------------------------------------------------
def _ledger(files):
    """Every second event file was loaded."""
    return files.where(file_label("path").rlike("-173000001[02]-")).select(
        "path", F.lit("b1").alias("batch_id"), F.lit("loaded").alias("status"),
        F.lit(1).alias("attempts"), F.lit(LOADED).cast("timestamp_ntz").alias("loaded_at"),
    )


ALL_LABELS = f"SELECT DISTINCT file_label, block FROM {KEYED}"


@query("j1_unprocessed_files", f"""
SELECT file_label, count(*) AS files FROM ({ALL_LABELS}) WHERE NOT regexp_matches(file_label, '-173000001[02]-')
GROUP BY file_label""")
def j1(spark, sf_dir):
    files = fl.list_files(spark, fx.csv_exports(spark, sf_dir), "csv").where(fl.started_by(F.col("path")))
    todo = fl.unprocessed(files, _ledger(files))
    return todo.groupBy(file_label("path").alias("file_label")).agg(F.count("*").alias("files"))


@query("j2_attach_header", f"SELECT file_label, header, count(*) AS n FROM {KEYED} r JOIN ({HEADERS}) h USING (file_label) GROUP BY ALL")
def j2(spark, sf_dir):
    """Each row with its file's header, which travels with the pieces of the file."""
    pieces = cl.lines_with_headers(spark, fx.csv_exports(spark, sf_dir), fl.started_by)
    return (
        pieces.groupBy(file_label("file_path").alias("file_label"), "header")
        .agg(F.sum(F.size("lines")).cast("long").alias("n"))
    )


@query("j3_existence_check", f"""
SELECT file_label, block % 2 = 0 AS present FROM ({ALL_LABELS})
UNION ALL SELECT file_label || 'x', false FROM ({ALL_LABELS})""")
def j3(spark, sf_dir):
    """Named files against the listing; the listing lacks odd blocks, the names have extras."""
    files = fl.list_files(spark, fx.csv_exports(spark, sf_dir), "csv").where(fl.started_by(F.col("path")))
    block = F.regexp_extract("path", "block=([0-9]+)", 1).cast("bigint")
    wanted = files.select("path").unionByName(
        files.select(F.regexp_replace("path", "(Push_Sent|profiles)", "$1x").alias("path"))
    )
    present, missing = fl.check_exists(wanted, files.where(block % 2 == 0))
    marked = present.withColumn("present", F.lit(True)).unionByName(
        missing.withColumn("present", F.lit(False))
    )
    return marked.select(file_label("path").alias("file_label"), "present")


# -- schema evolution -----------------------------------------------------------------------
def _wide_table(spark, name):
    location = scratch_path(spark, name)
    table = f"{name}_{location[-12:]}"
    sinks.create_table(spark, table, CANONICAL, location)
    return table


@query("d4_missing_columns", """
SELECT unnest(['clevertapid', 'eventname', 'extra_col', 'extra_tail', 'event_time', 'identity', 'note', 'phone',
  'profile_identity', 'profileattr_created_time', 'segment', 'ts']) AS missing WHERE (SELECT count(*) FROM events) > 0
UNION SELECT lower(regexp_replace(name, '[^A-Za-z0-9_]+', '_', 'g')) FROM (
  SELECT n_name AS name FROM nation UNION SELECT c_mktsegment FROM customer
  UNION SELECT 'day ' || CAST(CAST(ts AS DATE) AS VARCHAR) FROM events)""")
def d4(spark, sf_dir):
    """Headers of the exports, and of one whose columns are the nations, segments and days that the tables hold."""
    names = spark.read.parquet(f"{sf_dir}/nation.parquet").select(F.col("n_name").alias("name"))
    names = names.union(spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_mktsegment"))
    names = names.union(fx.events(spark, sf_dir).select(F.concat(F.lit("day "), F.to_date("ts").cast("string")))).distinct()
    wide = scratch_path(spark, "d4")
    names.agg(F.array_join(F.sort_array(F.collect_list("name")), ",").alias("value")).write.text(wide)
    headers = cl.read_headers(spark, fx.csv_exports(spark, sf_dir)).unionByName(cl.read_headers(spark, wide))
    found = evolve.missing_columns(headers, CANONICAL.names)
    return spark.createDataFrame([(c,) for c in found], "missing STRING")


@query("d6_schema_sync", """
SELECT segment, clevertapid, count(*) AS n, CAST(18 AS BIGINT) AS columns, CAST(0 AS BIGINT) AS added_again FROM (
  SELECT c_mktsegment AS segment, 'ct' || c_custkey AS clevertapid FROM customer
  UNION ALL SELECT NULL, NULL FROM events) GROUP BY ALL""")
def d6(spark, sf_dir):
    """Headers of all exports become columns of the table, which then takes the rows; a second
    run adds none."""
    table = _wide_table(spark, "d6")
    root = fx.csv_exports(spark, sf_dir)
    evolve.sync_schema(spark, table, root)
    again = evolve.sync_schema(spark, table, root)
    found = rows(spark, sf_dir)
    flat = {c: F.element_at(cl.row_map("safe_names"), c) for c in ("segment", "clevertapid")}
    target = spark.table(table)
    found = found.select(*[v.alias(c) for c, v in flat.items()])
    ld.project_to(found, target.schema).write.insertInto(table)
    return spark.table(table).groupBy("segment", "clevertapid").agg(
        F.count("*").alias("n"),
        F.lit(len(target.columns)).cast("bigint").alias("columns"),
        F.lit(again).cast("bigint").alias("added_again"),
    )


@query("d5_add_columns", """
SELECT event_id, user_id, CASE WHEN event_id % 2 = 1 THEN 'x' || event_id END AS extra_col FROM (
  SELECT event_id, CAST(user_id AS VARCHAR) AS user_id FROM events)""")
def d5(spark, sf_dir):
    """Rows written before the column was added read as null."""
    location = scratch_path(spark, "d5")
    table = f"d5_{location[-12:]}"
    e = fx.canonical(spark, sf_dir).select("event_id", "user_id")
    sinks.create_table(spark, table, e.schema, location)
    e.where("event_id % 2 = 0").write.insertInto(table)
    evolve.add_columns(spark, table, ["extra_col", "USER_ID", "extra_col"])
    later = e.where("event_id % 2 = 1").withColumn("extra_col", F.concat(F.lit("x"), "event_id"))
    later.write.insertInto(table)
    return spark.table(table)


@query("d7_combine_batches", """
SELECT event_id, CASE WHEN event_id % 2 = 0 THEN event_type END AS a, CASE WHEN event_id % 2 = 1 THEN user_id END AS b FROM events""")
def d7(spark, sf_dir):
    e = fx.events(spark, sf_dir)
    return evolve.combine(
        [
            e.where("event_id % 2 = 0").select("event_id", F.col("event_type").alias("a")),
            e.where("event_id % 2 = 1").select("event_id", F.col("user_id").alias("b")),
        ]
    )
