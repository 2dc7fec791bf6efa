"""Headered CSV exports whose columns differ from file to file.

The scan is a plain text read. Headers become *layouts* (column positions), and data lines only
index into their fields.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventmart.functions.csvtext import split_fields
from eventmart.functions.values import empty_as_null, safe_column_name
from eventmart.operators.joins import join_small
from eventmart.session import materialize, scratch_path

# ---- fixed values -----------------------------------------------------------------------
TIME_COLUMNS = ["ts", "timestamp", "event_time", "time", "event_ts", "profileattr.created_time"]
EVENT_FILE_MARKS = ["ts", "eventname", "event_name"]
EVENT_FILE_IDENTITY = ["profile.identity"]
PROFILE_FILE_IDENTITY = ["identity", "phone", "clevertapid"]
NAME_COLUMNS = ["event_name", "eventname", "event", "name"]
RESERVED_COLUMNS = [
    "event_date", "eventdate", "ts", "timestamp", "event_time", "event_ts", "time",
    "user_id", "userid", "identity", "user", "customer_user_id", "profile.identity",
    "event_name", "eventname", "event", "name",
]
# -----------------------------------------------------------------------------------------

BROADCAST_LIMIT = 256 << 20  # bytes of layout rows that may be broadcast
SMALL_FILE = 1 << 20  # bytes; to read them costs about as much as to open the file
PIECE_LINES = 256  # lines that share one copy of their layout
FILES_PER_JOB, FILE_JOBS = 32, 4  # large files whose beginning one job reads, and jobs at a time
FIRST_LINE_FILES = 16  # files that first lines are stored in

LAYOUT_COLUMNS = [
    "headers", "lower_headers", "is_event_file", "time_slots", "identity_slots", "name_slots",
    "attr_names", "attr_slots", "all_names", "all_slots", "safe_names",
]


def text_lines(spark: SparkSession, paths: str | list[str], *more: str) -> DataFrame:
    """Raw lines with the file and split they come from, and ``more`` facts of the file. Gzip is read by suffix."""
    return (
        spark.read.option("recursiveFileLookup", "true")
        .text(paths)
        .select(
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_name").alias("file_name"),
            F.col("_metadata.file_block_start").alias("block_start"),
            F.col("value").alias("line"),
            *(F.col(f"_metadata.{m}").alias(m) for m in more),
        )
    )


def first_lines(spark: SparkSession, paths: str | list[str], n: int, file_filter=None, larger_than: int = -1) -> DataFrame:
    """(file_path, file_name, block_start, line, line_no) of the first ``n`` lines of every file, written once and read back.

    Files of up to ``SMALL_FILE`` bytes are read whole, many to a task. Larger ones are read under a limit
    each, some dozen to a job, so no more of them is read than that. Files of at most ``larger_than`` bytes are left out.
    Every job writes a folder of its own: jobs run side by side, and the commit of one removes what others hold ready in the same folder.
    """
    target = scratch_path(spark, "first-lines")
    schema = "file_path string, file_name string, block_start long, line string, line_no long"
    columns = ["file_path", "file_name", "block_start", "line"]
    keep = (lambda name: F.lit(True)) if file_filter is None else file_filter
    if larger_than < SMALL_FILE:
        size = F.col("file_size")
        small = text_lines(_sibling(spark, 64 * SMALL_FILE, SMALL_FILE), paths, "file_size").where((size <= SMALL_FILE) & (size > larger_than)).where(keep(F.col("file_name")))
        heads = small.select(*columns).mapInArrow(_heads(n), schema)
        # many tasks in, few files out; the shuffle keeps the tasks
        heads.repartition(FIRST_LINE_FILES, "file_path").write.parquet(f"{target}/small")
    else:
        spark.createDataFrame([], schema).write.parquet(f"{target}/small")

    sibling = _sibling(spark, 1 << 50, 1 << 50)  # a file is one split, so a limit takes its first lines

    def begin(job: int, group: list[str]) -> None:
        heads = None
        for path in group:
            some = text_lines(sibling, re.sub(r"([{}\[\]*?\\])", r"\\\1", path)).select(*columns).withColumn("line_no", F.monotonically_increasing_id() + 1).limit(n)
            heads = some if heads is None else heads.unionByName(some)
        heads.coalesce(1).write.parquet(f"{target}/large-{job}")

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)  # its content is not read
    name = F.element_at(F.split("path", "/"), -1)
    large = files.where(F.col("length") > max(SMALL_FILE, larger_than)).where(keep(name)).select("path")
    with ThreadPoolExecutor(FILE_JOBS) as pool:
        running, group, jobs = [], [], count()
        for row in large.toLocalIterator():
            group.append(row["path"])
            if len(group) == FILES_PER_JOB:
                running.append(pool.submit(begin, next(jobs), group))
                group = []
                if len(running) >= 2 * FILE_JOBS:  # no more is read ahead
                    running.pop(0).result()
        if group:
            running.append(pool.submit(begin, next(jobs), group))
        for job in running:
            job.result()
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(target)


def _sibling(spark: SparkSession, partition: int, opening: int) -> SparkSession:
    """A session with split settings of its own; the caller's stays as it is. Files of up to ``opening`` bytes are one split."""
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", "UTC")
    session.conf.set("spark.sql.files.maxPartitionBytes", str(partition))
    session.conf.set("spark.sql.files.openCostInBytes", str(opening))
    return session


def _heads(n: int):
    """The first ``n`` lines of each file of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, seen = None, 0
        for batch in batches:
            kept, number = [], []
            for lo, hi, file, _ in _runs(batch):
                if file != path:
                    path, seen = file, 0
                take = max(0, min(hi - lo, n - seen))
                kept.append(np.arange(lo, lo + take))
                number.append(np.arange(seen + 1, seen + take + 1))
                seen += hi - lo
            if sum(map(len, kept)):
                rows = batch.take(pa.array(np.concatenate(kept)))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(np.concatenate(number))], names=[*batch.schema.names, "line_no"])

    return run


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, int, str, int]]:
    """(first row, end, file, block start) of the file splits in a batch of ``file_path``, ``block_start``."""
    if not batch.num_rows:
        return
    file = batch.column("file_path").dictionary_encode()
    code, start = file.indices.to_numpy(), batch.column("block_start").to_numpy()
    edge = np.flatnonzero((code[1:] != code[:-1]) | (start[1:] != start[:-1])) + 1
    for lo, hi in zip([0, *edge.tolist()], [*edge.tolist(), batch.num_rows]):
        yield lo, hi, file.dictionary[int(code[lo])].as_py(), int(start[lo])


def read_headers(spark: SparkSession, paths: str | list[str], file_filter=None, larger_than: int = -1) -> DataFrame:
    """(file_path, header) with the first line of every file."""
    return first_lines(spark, paths, 1, file_filter, larger_than).select("file_path", F.col("line").alias("header"))


def _last_slot(names: Column, name: Column) -> Column:
    """0-based position of the last header of that name, or null."""
    from_end = F.array_position(F.reverse(names), name)
    return F.when(from_end > 0, (F.size(names) - from_end).cast("int"))


def layouts(headers: DataFrame) -> DataFrame:
    """Where times, identities, names and attributes stand, one row per input row."""
    kept = headers.columns
    headers = headers.withColumn("headers", split_fields(F.col("header")))
    headers = headers.withColumn("lower_headers", F.transform("headers", F.lower))
    lower, names = F.col("lower_headers"), F.col("headers")

    def slots(wanted: list[str]) -> Column:
        return F.array_compact(F.array(*[_last_slot(lower, F.lit(w)) for w in wanted]))

    def positions(of: Column) -> Column:
        return F.transform(of, lambda n: _last_slot(names, n))

    reserved = F.array(*[F.lit(r) for r in RESERVED_COLUMNS])
    is_event = F.arrays_overlap(lower, F.array(*[F.lit(m) for m in EVENT_FILE_MARKS]))
    attrs = F.array_distinct(
        F.filter(names, lambda n: ~F.array_contains(reserved, F.lower(n)))
    )
    every = F.array_distinct(names)
    return headers.select(
        *kept,
        "headers",
        "lower_headers",
        is_event.alias("is_event_file"),
        slots(TIME_COLUMNS).alias("time_slots"),
        F.when(is_event, slots(EVENT_FILE_IDENTITY))
        .otherwise(slots(PROFILE_FILE_IDENTITY))
        .alias("identity_slots"),
        slots(NAME_COLUMNS).alias("name_slots"),
        attrs.alias("attr_names"),
        positions(attrs).alias("attr_slots"),
        every.alias("all_names"),
        positions(every).alias("all_slots"),
        F.transform(every, lambda n: F.coalesce(safe_column_name(n), n)).alias("safe_names"),
    )


def with_layout(
    lines: DataFrame, headers: DataFrame, broadcast_limit: int = BROADCAST_LIMIT
) -> DataFrame:
    """Give every line its file's layout.

    Files share few distinct headers, so there are two tables: file -> header id, and header
    id -> layout, one row per distinct header. Both are measured in one pass over the headers,
    and each is broadcast only when it is small enough. Beyond that the join shuffles, and
    adaptive execution splits a file that dominates.
    """
    by_header = headers.groupBy("header").agg(
        F.sum(F.octet_length("file_path") + 32).alias("map_bytes"),
        # names in five forms, and a few positions per name
        (F.max(F.octet_length("header")) * 8 + 1024).alias("layout_bytes"),
    )
    sizes = by_header.agg(
        F.sum("map_bytes").alias("map"),
        F.sum("layout_bytes").alias("layout"),
        F.count("*").alias("headers"),
        F.count_distinct(F.xxhash64("header")).alias("ids"),
    ).first()
    if sizes["headers"] != sizes["ids"]:
        raise ValueError("two headers have one id")
    header_id = F.xxhash64("header").alias("header_id")
    dictionary = layouts(headers.select("header").distinct().select("header", header_id))
    file_map = headers.select("file_path", header_id)
    if (sizes["map"] or 0) <= broadcast_limit:
        file_map = F.broadcast(file_map)
    if (sizes["layout"] or 0) <= broadcast_limit:
        dictionary = F.broadcast(dictionary)
    return lines.join(file_map, "file_path").join(dictionary, "header_id")


def data_lines(lines: DataFrame) -> DataFrame:
    """Numbered lines without the first of each file."""
    return lines.where(F.col("line_no") > 1)


def csv_rows(
    spark: SparkSession,
    paths: str | list[str],
    file_filter=None,
    broadcast_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Parsed data rows of CSV files: source file, fields and the layout columns, in one read of the text.

    ``file_filter`` takes the file-name column; files it rejects are never opened. Every line but
    the first of a file is a row, blank lines and repeats of the header too.
    """
    rows = layouts(lines_with_headers(spark, paths, file_filter, broadcast_limit))
    return _fields_of(rows.select("file_path", F.explode("lines").alias("line"), *LAYOUT_COLUMNS))


def lines_with_headers(
    spark: SparkSession, paths: str | list[str], file_filter=None, broadcast_limit: int = BROADCAST_LIMIT
) -> DataFrame:
    """(file_path, header, lines): the data lines of CSV files in pieces of up to ``PIECE_LINES``.

    A task meets a file's header as it reads the file's first split and hands it on with the lines, some
    hundred at a time, so a layout is worked out once for each such piece and no line is joined or shuffled.
    Only files that are cut into several splits need their headers beforehand, for the later splits: their
    first lines alone are read, and joined to pieces, not lines.
    """
    lines = text_lines(spark, paths)
    if file_filter is not None:
        lines = lines.where(file_filter(F.col("file_name")))
    pieces = lines.select("file_path", "block_start", "line").mapInArrow(_pieces, "file_path string, header string, lines array<string>")
    splittable, whole = _splittable(file_filter), _never_split(spark)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)  # its content is not read
    if files.where(F.col("length") > whole).where(splittable(F.element_at(F.split("path", "/"), -1))).select("path").isEmpty():
        return pieces.select("file_path", "header", "lines")
    late = read_headers(spark, paths, splittable, whole)
    size = late.agg(F.sum(F.octet_length("file_path") + F.octet_length("header") + 32)).first()[0]
    if size:
        late = late.withColumnRenamed("header", "late")
        late = F.broadcast(late) if size <= broadcast_limit else late
        pieces = pieces.join(late, "file_path", "left").withColumn("header", F.coalesce("header", "late"))
    return pieces.select("file_path", "header", "lines")


def _splittable(file_filter):
    """``file_filter``, and not gzip: those are read by one task each."""
    plain = lambda name: ~name.endswith(".gz")
    return plain if file_filter is None else lambda name: plain(name) & file_filter(name)


def _never_split(spark: SparkSession) -> int:
    """Files of up to so many bytes are one split under this session's settings."""
    return min(to_bytes(spark, spark.conf.get(f"spark.sql.files.{k}")) for k in ("maxPartitionBytes", "openCostInBytes"))


def to_bytes(spark: SparkSession, text: str) -> int:
    """A size setting such as ``128MB``."""
    return spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines in pieces of one file each, with its header; null where a task did not read the file's start."""
    at, header = (None, -1), None
    for batch in batches:
        line = batch.column("line")
        files, headers, kept, size = [], [], [], []
        for lo, hi, file, start in _runs(batch):
            if (file, start) != at:
                if start == 0:
                    header, lo = line[lo].as_py(), lo + 1
                elif file != at[0]:
                    header = None
                at = file, start
            for a in range(lo, hi, PIECE_LINES):
                b = min(a + PIECE_LINES, hi)
                files.append(file)
                headers.append(header)
                size.append(b - a)
            kept.append(np.arange(lo, hi))
        if size:
            every = pa.array(np.concatenate(kept))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), line.take(every))
            yield pa.RecordBatch.from_arrays([pa.array(files, pa.string()), pa.array(headers, pa.string()), lists], names=["file_path", "header", "lines"])


def parse_lines(lines: DataFrame) -> DataFrame:
    """Lines with a layout -> rows with ``fields``."""
    return _fields_of(data_lines(lines))


def _fields_of(data: DataFrame) -> DataFrame:
    keep = [c for c in ("line_no",) if c in data.columns]
    # a generator: a filter on the fields stays behind it, where it would else split each line again, once for each slot
    fields = F.explode(F.array(split_fields(F.col("line")))).alias("fields")
    return data.select(F.col("file_path").alias("source_file"), *keep, fields, *LAYOUT_COLUMNS)


def values_at(slots: Column, fields: Column = None) -> Column:
    """Field values at the given positions; empty or absent values are null."""
    fields = F.col("fields") if fields is None else fields
    return F.transform(slots, lambda p: empty_as_null(F.get(fields, p)))


def lookup(name: str) -> Column:
    """The value under a header, ignoring case; of two equal headers the last counts."""
    slot = _last_slot(F.col("lower_headers"), F.lit(name.lower()))
    return empty_as_null(F.get(F.col("fields"), slot))


def row_map(names: str = "all_names") -> Column:
    """All columns of a row as ``map<header, value>``, empty values null. With ``safe_names`` the headers are column names, where
    they have one; those are worked out with the layout, not row by row."""
    return F.map_from_arrays(names, values_at(F.col("all_slots")))


def numbered_lines(spark: SparkSession, paths: str | list[str], file_filter=None) -> DataFrame:
    """Lines with their exact 1-based number in the file (the header is line 1).

    Two reads of the same files with the same splits: the first counts the lines of each split and
    keeps no text, the second adds to a line's place in its split the sizes of the file's earlier
    splits. Nothing is copied, no line is shuffled, and no task ever holds a whole file.
    """
    lines = text_lines(spark, paths)
    if file_filter is not None:
        lines = lines.where(file_filter(F.col("file_name")))
    lines = lines.withColumn("row_id", F.monotonically_increasing_id())
    splits = lines.groupBy("file_path", "block_start").agg(
        F.min("row_id").alias("first_id"), F.count("*").alias("n")
    )  # one row per split
    earlier = (
        Window.partitionBy("file_path")
        .orderBy("block_start")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = splits.select(
        "file_path",
        "block_start",
        (F.coalesce(F.sum("n").over(earlier), F.lit(0)) + 1 - F.col("first_id")).alias("shift"),
    )
    joined = join_small(lines, materialize(offsets, "splits"), ["file_path", "block_start"], BROADCAST_LIMIT)
    return joined.select(
        "file_path",
        "file_name",
        "block_start",
        "line",
        (F.col("row_id") + F.col("shift")).alias("line_no"),
    )


def first_rows(
    spark: SparkSession, paths: str | list[str], rows: int, file_filter=None
) -> DataFrame:
    """Header plus the first ``rows`` data lines of each file; of large files no more is read than that."""
    return first_lines(spark, paths, rows + 1, file_filter)
