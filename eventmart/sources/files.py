"""File listings, ledgers and manifests as DataFrames."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventmart.functions.values import file_name_numbers, url_parts
from eventmart.session import materialize

# Fixed values.
KINDS = {
    "json": r"\.json$",
    "csv": r"\.csv(\.gz)?$",
    "documents": r"\.json(\.gz)?$",
}
SKIPPED_PREFIXES = ["manifests/", "jsonpaths/"]
START_DATE = "2024-10-01"
FILES_PER_BATCH = 1000

RANGE_FILES = 100_000  # paths that one task numbers


def list_files(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """Files under ``root`` of one kind: path, key (relative to root), length, modified time.

    The content column of the binary source is pruned away, so no file is opened.
    """
    root = root.rstrip("/")
    # a plain path compares with the URI form that the source reports
    path_of_root = root.split("://", 1)[-1] if "://" in root else root.removeprefix("file:")
    files = list_any(spark, root)
    tail = F.substring_index(F.col("path"), path_of_root + "/", -1)
    files = files.withColumn("key", tail).where(F.col("path").rlike(KINDS[kind]))
    if kind == "documents":
        for prefix in SKIPPED_PREFIXES:
            files = files.where(~F.col("key").startswith(prefix))
    return files.select("path", "key", "length", "modificationTime")


def list_any(spark: SparkSession, root: str) -> DataFrame:
    """All files under ``root``: path, length, modified time."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return files.select("path", "length", "modificationTime")


def started_by(path: Column, start_date: str = START_DATE) -> Column:
    """True for files whose name carries a data date on or after ``start_date``.

    Over ``_metadata.file_name`` of a scan this prunes files before they are opened.
    """
    first, second = file_name_numbers(path)
    start = F.unix_seconds(F.lit(f"{start_date} 00:00:00").cast("timestamp"))
    return F.coalesce(second >= start, F.lit(False)) | F.coalesce(first >= start, F.lit(False))


def unprocessed(files: DataFrame, ledger: DataFrame, max_attempts: int | None = None) -> DataFrame:
    """Listing minus ledger. Files that failed come back until ``max_attempts`` is reached."""
    done = ledger.where(F.col("status") == "loaded")
    if max_attempts is not None:
        spent = (
            ledger.where(F.col("status") == "failed")
            .groupBy("path")
            .agg(F.max("attempts").alias("attempts"))
            .where(F.col("attempts") >= max_attempts)
        )
        done = done.select("path").unionByName(spent.select("path"))
    return files.join(done.select("path"), "path", "left_anti")


def next_batch(files: DataFrame, size: int = FILES_PER_BATCH) -> list[str]:
    """The next ``size`` paths in name order. The list is bounded by ``size``, whatever the
    backlog; a large backlog is drained batch by batch or by the streaming load."""
    return [r["path"] for r in files.orderBy("path").limit(size).select("path").collect()]


def check_exists(wanted: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(present, missing) rows of ``wanted`` by ``path``."""
    return (
        wanted.join(files.select("path"), "path", "left_semi"),
        wanted.join(files.select("path"), "path", "left_anti"),
    )


_MANIFEST = "entries ARRAY<STRUCT<url: STRING, mandatory: BOOLEAN>>"


def _entries(manifests: DataFrame) -> DataFrame:
    return manifests.select("manifest", F.explode("entries").alias("e")).select(
        "manifest",
        F.col("e.url").alias("path"),
        F.coalesce("e.mandatory", F.lit(False)).alias("mandatory"),
    )


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Manifest files ``{entries:[{url, mandatory}]}``, one document per file, as (manifest, path,
    mandatory). A manifest is known by its own file."""
    files = spark.read.schema(_MANIFEST).option("multiLine", "true").json(path)
    return _entries(files.select(F.col("_metadata.file_path").alias("manifest"), "entries"))


def read_manifest_lines(spark: SparkSession, path: str) -> DataFrame:
    """The same with one manifest per line, known by its file and a hash of its line. Lines that are
    equal are one manifest."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), "value").distinct()
    name = F.concat_ws("#", "file", F.sha2("value", 256))
    return _entries(lines.select(name.alias("manifest"), F.from_json("value", _MANIFEST).entries.alias("entries")))


def manifest_batches(entries: DataFrame, files: DataFrame, batch_size: int = FILES_PER_BATCH) -> DataFrame:
    """(manifest, batch, path): what to load of every manifest, in batches of at most ``batch_size`` files, by path.

    All manifests meet the listing in one join. A missing mandatory file fails the whole call; other
    missing files are left out; a path named twice in a manifest counts once. Places within a manifest
    come from ranges of (manifest, path): each range numbers its own paths, and adds those of earlier ones.
    """
    named = entries.groupBy("manifest", "path").agg(F.max("mandatory").alias("mandatory"))
    lost = named.where("mandatory").join(files.select("path"), "path", "left_anti").limit(5).collect()
    if lost:
        raise FileNotFoundError(f"mandatory files are missing: {[r['path'] for r in lost]}")
    present = materialize(named.join(files.select("path"), "path", "left_semi").select("manifest", "path"), "manifest-paths")
    parts = max(1, -(-present.count() // RANGE_FILES))
    ranged = present.repartitionByRange(parts, "manifest", "path").withColumn("part", F.spark_partition_id())
    ranged = materialize(ranged, "manifest-ranges")
    sizes = ranged.groupBy("manifest", "part").agg(F.count("*").alias("n"))  # a row for each range of a manifest
    before = F.sum("n").over(Window.partitionBy("manifest").orderBy("part")) - F.col("n")
    place = F.row_number().over(Window.partitionBy("manifest", "part").orderBy("path")) - 1
    placed = ranged.withColumn("place", place).join(sizes.select("manifest", "part", before.alias("before")), ["manifest", "part"])
    return placed.select("manifest", F.floor((F.col("place") + F.col("before")) / batch_size).alias("batch"), "path")


def manifest_loads(entries: DataFrame, files: DataFrame, batch_size: int = FILES_PER_BATCH) -> DataFrame:
    """:func:`manifest_batches` with a row for each batch: (manifest, batch, paths)."""
    return (
        manifest_batches(entries, files, batch_size)
        .groupBy("manifest", "batch")
        .agg(F.array_sort(F.collect_list("path")).alias("paths"))
    )


def run_loads(loads: DataFrame, load, parallel: int = 10) -> list:
    """``load(manifest, batch, paths)`` for every row of ``manifest_loads``, several at a time. The path lists of
    at most twice as many batches are on the driver."""
    out, running = [], []
    with ThreadPoolExecutor(parallel) as pool:
        for r in loads.orderBy("manifest", "batch").toLocalIterator():
            running.append(pool.submit(load, r["manifest"], r["batch"], r["paths"]))
            if len(running) >= 2 * parallel:
                out.append(running.pop(0).result())
        return out + [job.result() for job in running]


def manifest_of(files: DataFrame, batch_size: int = FILES_PER_BATCH) -> DataFrame:
    """Manifest documents of at most ``batch_size`` files each.

    The listing is ranged by path into about as many parts as there are manifests, and batches
    are cut inside each part, so no group can grow beyond the limit.
    """
    parts = -(-files.count() // batch_size)
    ranged = files.select("path").repartitionByRange(max(1, parts), "path")
    position = F.col("position")
    inside = position.bitwiseAND(F.lit((1 << 33) - 1))
    entry = F.struct(F.col("path").alias("url"), F.lit(True).alias("mandatory"))
    return (
        ranged.withColumn("position", F.monotonically_increasing_id())
        .groupBy(
            F.shiftright(position, 33).alias("part"),
            F.floor(inside / batch_size).alias("batch"),
        )
        .agg(F.array_sort(F.collect_list(entry)).alias("entries"))
        .select("part", "batch", F.to_json(F.struct("entries")).alias("value"))
    )


def split_url(df: DataFrame, column: str) -> DataFrame:
    """Add ``bucket`` and ``key`` of an object URL; both null when it is not one."""
    bucket, key = url_parts(F.col(column))
    return df.withColumns({"bucket": bucket, "key": key})
