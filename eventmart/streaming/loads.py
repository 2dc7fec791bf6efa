"""Incremental loads: new files of a folder into a batch table."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from typing import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.operators import raw_events
from eventmart.operators.load import LoadFailed, LoadPolicy, cast_rows, check_required, stamp
from eventmart.operators.tables import BatchTable
from eventmart.schemas import LOAD_TIME_COLUMNS
from eventmart.session import materialize, setting
from eventmart.sources.csvlines import to_bytes
from eventmart.sources.ndjson import SOURCE, parse_ndjson

FILES_PER_BATCH = 1000  # fixed value
KEEP_HOURS, SWEEP_HOURS = 24, 24  # fixed values: a loaded file is kept so long; sweeps run at most so often
MAX_ATTEMPTS = 3
GROUP_FILES = 50_000  # files of the batches that are loaded together
SPLIT_BYTES = 16 << 20  # that one task reads of them: a short line costs a wide table as much as a long one
SPLIT = "spark.sql.files.maxPartitionBytes"
MOVE_TASKS = 16
TASK_SCHEMES = ("file", "hdfs", "s3", "s3a", "gs", "abfss")  # that tasks reach without the driver's file systems


def line_stream(
    spark: SparkSession,
    path: str,
    files_per_batch: int = FILES_PER_BATCH,
    bytes_per_batch: str | None = None,
) -> DataFrame:
    """Lines of new files with their file. A batch ends at ``files_per_batch`` files, or at about
    ``bytes_per_batch`` (such as ``"10g"``) if that is given."""
    reader = spark.readStream.option("recursiveFileLookup", "true")
    if bytes_per_batch is None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    else:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    return reader.text(path).select("value", F.col("_metadata.file_path").alias(SOURCE))


def ndjson_rows(table: T.StructType, policy: LoadPolicy, required: bool = False):
    """Lines -> typed rows with reject reasons."""

    def transform(lines: DataFrame) -> DataFrame:
        rows = parse_ndjson(lines, table)
        return cast_rows(check_required(rows) if required else rows, table, policy)

    return transform


def document_rows(keep_source: bool = False):
    """Lines -> canonical events of raw documents."""

    def transform(lines: DataFrame) -> DataFrame:
        docs = lines.where("value <> ''").select(
            F.col("value").alias("raw"),
            F.try_parse_json("value").alias("doc"),
            F.col(SOURCE).alias("source_path"),
        )
        return raw_events.to_events(docs, keep_source)

    return transform


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def _load(rows: DataFrame, table: BatchTable, batch_id: str, policy: LoadPolicy) -> bool:
    now = _now()
    if set(LOAD_TIME_COLUMNS) <= set(table.schema.names):
        rows = stamp(rows, F.lit(now))
    try:
        table.load(rows, batch_id, policy, now)
    except LoadFailed:
        return False  # recorded as failed, with its files and attempts, for ``retry_failed``
    return True


def sync(
    lines: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    table: BatchTable,
    policy: LoadPolicy,
    checkpoint: str,
    name: str,
    interval: str | None = None,
):
    """Start an incremental load: each micro-batch becomes one batch of the table.

    Without ``interval`` it loads what is there and stops; ``"1 hour"`` keeps it running. The
    checkpoint remembers the files, the batch id (the checkpoint's own id and a number) makes a
    replay harmless, and a batch with too many rejects stays unpublished in the ledger while the
    next ones go on. ``retry_failed`` loads such batches again.
    """

    def load(rows: DataFrame, number: int) -> None:
        stream = rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        _load(rows, table, f"{name}-{stream}-{number}", policy)

    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return (
        transform(lines)  # no state: the same plan serves every batch
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def _with_batch(rows: DataFrame, group: list) -> DataFrame:
    """Rows with the batch of their file. A row whose file no batch names fails the job."""
    named = rows.sparkSession.createDataFrame(group, "batch_id string, _path string")  # some more than GROUP_FILES rows at most
    joined = rows.join(F.broadcast(named), F.col(SOURCE) == F.col("_path"), "left").drop("_path")
    lost = F.raise_error(F.concat(F.lit("no batch names "), F.coalesce(SOURCE, F.lit("a row without source")))).cast("string")
    return joined.withColumn("batch_id", F.coalesce("batch_id", lost))


def _groups(batches: DataFrame):
    """The (batch_id, path) of whole batches, up to about GROUP_FILES files at a time."""
    group, batch = [], None
    for r in batches.orderBy("batch_id", "path").toLocalIterator():
        if len(group) >= GROUP_FILES and r["batch_id"] != batch:
            yield group
            group = []
        batch = r["batch_id"]
        group.append((batch, r["path"]))
    if group:
        yield group


def load_batches(
    batches: DataFrame, transform: Callable[[DataFrame], DataFrame], table: BatchTable, policy: LoadPolicy, loaded_at: datetime | None = None
) -> DataFrame:
    """Load batches of files (batch_id, path) many at a time: (batch_id, status, ok, reject) of those tried.

    A group of batches is read, staged, checked and published in a fixed number of jobs, however many batches it
    has. A failed batch does not stop the others of its group. The driver names the files of a group to the reader.
    ``transform`` keeps the source column of its lines, by which rows are told apart.
    """
    spark, out = table.spark, None
    for group in _groups(batches):
        now = _now() if loaded_at is None else loaded_at
        lines = spark.read.text([path for _, path in group]).select("value", F.col("_metadata.file_path").alias(SOURCE))
        rows = _with_batch(transform(lines), group)
        if set(LOAD_TIME_COLUMNS) <= set(table.schema.names):
            rows = stamp(rows, F.lit(now))
        with setting(spark, SPLIT, str(min(SPLIT_BYTES, to_bytes(spark, spark.conf.get(SPLIT))))):
            state = table.load_batches(rows, spark.createDataFrame(group, "batch_id string, path string"), policy, now)
        out = state if out is None else out.unionByName(state)
    return spark.createDataFrame([], "batch_id string, status string, ok long, reject long") if out is None else out


def retry_failed(
    table: BatchTable,
    transform: Callable[[DataFrame], DataFrame],
    policy: LoadPolicy,
    max_attempts: int = MAX_ATTEMPTS,
) -> dict[str, bool]:
    """Load the failed batches again from their files, as they are now, under the same ids.

    Batches that have had ``max_attempts`` attempts are left, and so are those whose transform kept no source, as
    there is nothing to read again. Returns what became of each batch that was tried; files that are gone fail the job.
    """
    again = table.failed_batches(max_attempts).select("batch_id")
    files = table.ledger().where("path IS NOT NULL").join(again, "batch_id", "left_semi").select("batch_id", "path")
    tried = load_batches(materialize(files, "retries"), transform, table, policy)
    return {r["batch_id"]: r["status"] == "loaded" for r in tried.select("batch_id", "status").collect()}  # failures are few


# -- files that are done ----------------------------------------------------------------------
def _file_system(path: str):
    """(file system, path in it) of a URI, for use in tasks."""
    from pyarrow import fs

    if path.startswith(("file:", "/")):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def _settle(source: str, target: str | None) -> bool:
    """Move a file, or delete it where there is no target. True once it is gone from its place, also if an
    earlier attempt of the task did it."""
    from pyarrow import fs

    system, old = _file_system(source)
    if system.get_file_info(old).type == fs.FileType.NotFound:
        return True
    if target is None:
        system.delete_file(old)
    else:
        _, new = _file_system(target)
        system.create_dir(new.rpartition("/")[0])
        system.move(old, new)
    return True


def _settle_all(files: DataFrame, table: BatchTable, what: str, at: datetime) -> int:
    """Move (``target``) or delete the files in tasks, and note those done in the table's ``moved``. Returns their number."""
    schemes = files.select(F.regexp_extract("path", "^([a-z0-9]+):", 1).alias("s")).distinct().limit(20).collect()
    for r in schemes:
        if r["s"] not in ("", *TASK_SCHEMES):
            raise ValueError(f"tasks cannot move files of {r['s']}: ({', '.join(TASK_SCHEMES)})")

    def run(batches):
        for batch in batches:
            done = [_settle(p, t) for p, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield batch.select(["path"]).filter(pa.array(done, pa.bool_()))

    spread = files.select("path", "target").repartition(MOVE_TASKS)
    moved = spread.mapInArrow(run, "path string").select("path", F.lit(what).alias("what"), F.lit(at).cast("timestamp_ntz").alias("at"))
    noted = materialize(moved, "moved")
    noted.write.mode("append").parquet(f"{table.root}/moved")
    return noted.count()


def archive_loaded(table: BatchTable, archive_dir: str) -> int:
    """Move the files of loaded batches to ``archive_dir``, keeping their names under a folder per batch. Files of
    failed batches stay for the retry. Returns the number of files moved.

    Tasks move the files of the ledger that are not among those moved before; no path comes to the driver, and a run
    after a failure takes up what is left.
    """
    target = F.concat_ws("/", F.lit(archive_dir.rstrip("/")), "batch_id", F.element_at(F.split("path", "/"), -1))
    return _settle_all(table.loaded_files().withColumn("target", target), table, "archived", _now())


def sweep(table: BatchTable, as_of: datetime | None = None, keep_hours: int = KEEP_HOURS, every_hours: int = SWEEP_HOURS) -> int | None:
    """Delete the files whose retention is over, unless a sweep ran within ``every_hours``: then None, else their number.

    The time of a sweep is noted when it is over, so one that broke off runs again; files deleted before are not looked at again.
    """
    now = _now() if as_of is None else as_of
    spark, path = table.spark, f"{table.root}/sweeps"
    last = table.side(path, "at timestamp_ntz").agg(F.max("at")).first()[0]
    if last is not None and now < last + timedelta(hours=every_hours):
        return None
    files = table.deletable(now, keep_hours).withColumn("target", F.lit(None).cast("string"))
    gone = _settle_all(files, table, "deleted", now)
    spark.createDataFrame([(now,)], "at timestamp_ntz").coalesce(1).write.mode("append").parquet(path)
    return gone
