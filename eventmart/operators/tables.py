"""Tables that take whole batches: stage, check, publish.

Layout under the table's root::

    data/load_status=ok|reject/batch_id=<id>/attempt=<token>/[partitions]/   rows
    ranges/attempt=<token>/                                                  first and last key of each file, if clustered
    ledger/batch_id=<id>/                                                    written last

Every attempt at a batch writes folders of its own, and the ledger entry of the batch names the
one attempt that counts. So what a failed or broken attempt left behind is never read, whatever
partitions the next one produces. A batch is visible once its entry says ``loaded``.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.operators.load import REASON, LoadFailed, LoadPolicy, project_to
from eventmart.schemas import LEDGER
from eventmart.session import materialize, setting
from eventmart.sources.ndjson import RAW, SOURCE

LOOKUP_FILES = 10_000  # that a lookup names one by one
OPEN_FILES = 8  # that a task writes side by side


class BatchTable:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: T.StructType,
        *,
        partition_by: tuple[str, ...] = (),
        sort_by: tuple[str, ...] = (),
        cluster_by: str | None = None,
    ):
        """``cluster_by``: a key by which each load is cut into files of its own ranges, with bloom filters and a
        table of ranges, so that :meth:`lookup` opens the files that can hold a value and no others."""
        self.cluster_by = cluster_by
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.partition_by, self.sort_by = list(partition_by), list(sort_by)
        self._stored = T.StructType(
            schema.fields
            + [
                T.StructField(c, T.StringType())
                for c in (REASON, RAW, SOURCE, "load_status", "batch_id", "attempt")
            ]
        )

    # -- writing ------------------------------------------------------------------------
    def stage(self, df: DataFrame, batch_id: str | None) -> str:
        """Write good rows and rejects in one pass over the input, as a new attempt. Without ``batch_id`` the
        rows name their batches in a column of that name. Returns the attempt's token."""
        attempt = uuid.uuid4().hex
        names = T.StructType(self._stored.fields[:-3])
        if batch_id is not None:
            df = project_to(df, names).withColumn("batch_id", F.lit(batch_id))
        else:
            df = project_to(df, T.StructType([*names.fields, T.StructField("batch_id", T.StringType())]))
        status = F.when(F.col(REASON).isNull(), "ok").otherwise("reject")
        rows = df.withColumns({"load_status": status, "attempt": F.lit(attempt)})
        keys = ["load_status", "batch_id", "attempt", *self.partition_by]
        sort_by = self.sort_by
        if self.cluster_by:
            rows = rows.repartitionByRange("load_status", "batch_id", *self.partition_by, self.cluster_by)
            sort_by = [self.cluster_by, *sort_by]
        elif self.partition_by:
            # one shuffle to avoid a file per task and partition; hot partitions are split
            rows = rows.hint("rebalance", *keys)
        if sort_by:
            rows = rows.sortWithinPartitions(*keys, *sort_by)
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys)
        if self.cluster_by:
            writer = writer.option(f"parquet.bloom.filter.enabled#{self.cluster_by}", "true")
        # without partitions a task has rows of few folders, mostly of one: it keeps their files open, where Spark would
        # else sort all its wide rows by folder; beyond so many files it sorts the rest
        open_files = 0 if sort_by or self.partition_by else OPEN_FILES
        with setting(rows.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", str(open_files)):
            writer.parquet(f"{self.root}/data")
        if self.cluster_by:
            self._note_ranges(attempt)
        return attempt

    def _note_ranges(self, attempt: str) -> None:
        """Write the key range of each file of an attempt."""
        key = F.col(self.cluster_by)
        rows = self._data().where((F.col("attempt") == attempt) & (F.col("load_status") == "ok"))
        found = rows.groupBy(F.col("_metadata.file_path").alias("file"), "batch_id").agg(F.min(key).alias("low"), F.max(key).alias("high"))
        found.withColumn("attempt", F.lit(attempt)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("attempt").parquet(f"{self.root}/ranges")

    def counts(self, batch_id: str, attempt: str) -> dict[str, int]:
        """Rows and rejects of a staged attempt, from what is stored: no rerun of the input, and
        nothing counted twice when tasks are retried."""
        rows = self._staged(batch_id, attempt).groupBy("load_status").count()
        found = {r["load_status"]: r["count"] for r in rows.collect()}  # at most two rows
        return {"ok": found.get("ok", 0), "reject": found.get("reject", 0)}

    def record(
        self,
        batch_id: str,
        attempt: str,
        status: str,
        loaded_at: datetime,
        files: DataFrame | None = None,
        attempts: int = 1,
    ) -> None:
        """Write the batch's ledger entries: one per file and one, without a path, for the batch.
        This publishes or fails the attempt. The files are those named, else those the staged
        rows came from."""
        if files is None:
            sources = self._staged(batch_id, attempt).select(F.col(SOURCE).alias("path"))
            files = sources.where("path IS NOT NULL").distinct()
        # the batch's own entry, without a path, is there even if the batch has no rows
        own = self.spark.range(1).select(F.lit(None).cast("string").alias("path"))
        entries = files.select("path").unionByName(own).select(
            "path",
            F.lit(status).alias("status"),
            F.lit(attempts).alias("attempts"),
            F.lit(loaded_at).cast("timestamp_ntz").alias("loaded_at"),
            F.lit(attempt).alias("attempt"),
            F.lit(batch_id).alias("batch_id"),
        )
        (
            entries.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(f"{self.root}/ledger")
        )

    def load(
        self,
        df: DataFrame,
        batch_id: str,
        policy: LoadPolicy,
        loaded_at: datetime,
        files: DataFrame | None = None,
    ) -> dict[str, int]:
        """Stage, check rejects against the policy, publish. Returns the row counts. A batch
        that is already published is left alone."""
        state = self.batch_state(batch_id)
        if state is not None and state["status"] == "loaded":
            return self.counts(batch_id, state["attempt"])
        attempt = self.stage(df, batch_id)
        counts = self.counts(batch_id, attempt)
        attempts = (state["attempts"] if state else 0) + 1
        failed = policy.fails(counts["reject"])
        status = "failed" if failed else "loaded"
        self.record(batch_id, attempt, status, loaded_at, files, attempts)
        if failed:
            raise LoadFailed(f"batch {batch_id}: {counts['reject']} rejected rows")
        return counts

    def load_batches(self, df: DataFrame, batches: DataFrame, policy: LoadPolicy, loaded_at: datetime) -> DataFrame:
        """Load many batches in a fixed number of jobs: one staged write for all of them, rejects counted per
        batch, all ledger entries written at once. A batch with too many rejects fails without stopping the others.

        ``df`` names its batch in ``batch_id``; ``batches`` (batch_id, path) lists the batches and their files, with a
        null path for one without files. Batches that are published are left alone. Returns (batch_id, status, ok, reject).
        """
        known = self.ledger().where("path IS NULL").select("batch_id", "status", "attempts")
        done = materialize(known.where("status = 'loaded'").select("batch_id"), "loaded-batches")
        todo = materialize(batches.select("batch_id", "path").distinct().join(done, "batch_id", "left_anti"), "batches-to-load")
        attempt = self.stage(df.join(done, "batch_id", "left_anti"), None)
        staged = self._data().where(F.col("attempt") == attempt)
        counted = staged.groupBy("batch_id").agg(
            F.count_if(F.col("load_status") == "ok").alias("ok"), F.count_if(F.col("load_status") == "reject").alias("reject")
        )
        zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
        judged = todo.select("batch_id").distinct().join(counted, "batch_id", "left").select("batch_id", zero("ok"), zero("reject"))
        failed = F.col("reject") >= policy.limit
        judged = judged.withColumn("status", F.when(failed, "failed").otherwise("loaded"))
        before = known.select("batch_id", F.col("attempts").alias("before"))
        judged = materialize(judged.join(before, "batch_id", "left"), "judged-batches")
        paths = todo.where("path IS NOT NULL").unionByName(judged.select("batch_id", F.lit(None).cast("string").alias("path")))
        entries = paths.join(judged, "batch_id").select(
            "path", "status", (F.coalesce("before", F.lit(0)) + 1).alias("attempts"),
            F.lit(loaded_at).cast("timestamp_ntz").alias("loaded_at"), F.lit(attempt).alias("attempt"), "batch_id",
        )
        (
            entries.repartition("batch_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id").parquet(f"{self.root}/ledger")
        )
        return judged.select("batch_id", "status", "ok", "reject")

    # -- reading ------------------------------------------------------------------------
    def _stored_schema(self) -> T.StructType:
        return T.StructType(
            [f for f in self._stored.fields if f.name not in self.partition_by]
            + [self.schema[c] for c in self.partition_by]
        )

    def _data(self) -> DataFrame:
        path = f"{self.root}/data"
        return _read_or_empty(self.spark, [path], path, self._stored_schema())

    def _staged(self, batch_id: str, attempt: str) -> DataFrame:
        """One attempt, from its own folders: other batches are not even listed."""
        base = f"{self.root}/data"
        folders = [
            f"{base}/load_status={s}/batch_id={batch_id}/attempt={attempt}" for s in ("ok", "reject")
        ]
        return _read_or_empty(self.spark, folders, base, self._stored_schema())

    def ledger(self) -> DataFrame:
        path = f"{self.root}/ledger"
        return _read_or_empty(self.spark, [path], path, LEDGER).select(*LEDGER.names)

    def batch_state(self, batch_id: str):
        base = f"{self.root}/ledger"
        own = _read_or_empty(self.spark, [f"{base}/batch_id={batch_id}"], base, LEDGER)
        return own.where("path IS NULL").select("status", "attempts", "attempt").first()

    def _recorded(self, statuses: list[str]) -> DataFrame:
        """Rows of the attempts that the ledger names, by the status of their batch."""
        entries = self.ledger().where(F.col("path").isNull() & F.col("status").isin(statuses))
        return self._data().join(entries.select("batch_id", "attempt"), ["batch_id", "attempt"], "left_semi")

    def published(self) -> DataFrame:
        """(batch_id, attempt) of the loaded batches."""
        return self.ledger().where("path IS NULL AND status = 'loaded'").select("batch_id", "attempt")

    def rows_of(self, attempts: DataFrame) -> DataFrame:
        """Good rows of some (batch_id, attempt), with these."""
        rows = self._data().where(F.col("load_status") == "ok").join(attempts, ["batch_id", "attempt"], "left_semi")
        return rows.select("batch_id", "attempt", *self.schema.names)

    def read(self) -> DataFrame:
        rows = self._recorded(["loaded"]).where(F.col("load_status") == "ok")
        return rows.select(*self.schema.names)

    def rejects(self) -> DataFrame:
        """Quarantine: rejects of the last recorded attempt of every batch, published or not."""
        rows = self._recorded(["loaded", "failed"]).where(F.col("load_status") == "reject")
        return rows.select("batch_id", REASON, RAW, *self.schema.names)

    def failed_batches(self, max_attempts: int) -> DataFrame:
        """(batch_id, attempts) of the batches that may be tried again."""
        own = self.ledger().where(F.col("path").isNull() & (F.col("status") == "failed"))
        return own.where(F.col("attempts") < max_attempts).select("batch_id", "attempts")

    def batch_files(self, batch_id: str) -> list[str]:
        """The files of one batch."""
        base = f"{self.root}/ledger"
        own = _read_or_empty(self.spark, [f"{base}/batch_id={batch_id}"], base, LEDGER)
        return sorted(r["path"] for r in own.where("path IS NOT NULL").select("path").collect())

    def lookup(self, value) -> DataFrame:
        """Published rows whose ``cluster_by`` key is ``value``, from the files that can hold it."""
        ranges = _read_or_empty(
            self.spark, [f"{self.root}/ranges"], f"{self.root}/ranges",
            T.StructType.fromDDL(f"file string, batch_id string, low {self._key()}, high {self._key()}, attempt string"),
        )
        wanted = F.lit(value).cast(self._key())
        loaded = self.published()
        hits = ranges.where((F.col("low") <= wanted) & (F.col("high") >= wanted)).join(loaded, ["batch_id", "attempt"], "left_semi")
        files = [r["file"] for r in hits.select("file").limit(LOOKUP_FILES + 1).collect()]
        if len(files) > LOOKUP_FILES:  # a scan with the filter pushed down is as good then
            return self.read().where(F.col(self.cluster_by) == wanted)
        base = f"{self.root}/data"
        rows = _read_or_empty(self.spark, files, base, self._stored_schema(), together=True)
        return rows.where(F.col(self.cluster_by) == wanted).select(*self.schema.names)

    def _key(self) -> str:
        return self.schema[self.cluster_by].dataType.simpleString()

    def moved(self) -> DataFrame:
        """(path, what, at): files that were archived or deleted after their load."""
        return self.side(f"{self.root}/moved", "path string, what string, at timestamp_ntz")

    def side(self, path: str, schema: str | T.StructType) -> DataFrame:
        """A table beside this one; empty if nobody has written to it."""
        schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        return _read_or_empty(self.spark, [path], path, schema)

    def loaded_files(self) -> DataFrame:
        """Ledger entries of the files of loaded batches that were neither archived nor deleted."""
        entries = self.ledger().where((F.col("status") == "loaded") & F.col("path").isNotNull())
        return entries.join(self.moved().select("path"), "path", "left_anti")

    def deletable(self, as_of, keep_hours: int = 24) -> DataFrame:
        """Loaded files whose retention is over and that are still there."""
        age = F.expr(f"INTERVAL {int(keep_hours)} HOURS")
        return (
            self.loaded_files()
            .where(F.col("loaded_at") + age <= F.lit(as_of).cast("timestamp_ntz"))
        )


def _read_or_empty(
    spark: SparkSession, paths: list[str], base: str, schema: T.StructType, together: bool = False
) -> DataFrame:
    """The folders that exist; a table nobody has written to has no rows. ``together``: all of them exist."""
    reader = spark.read.schema(schema).option("basePath", base)
    if together and paths:
        return reader.parquet(*paths)
    found = []
    for path in paths:
        try:
            found.append(reader.parquet(path))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    if not found:
        return spark.createDataFrame([], schema)
    out = found[0]
    for other in found[1:]:
        out = out.unionByName(other)
    return out
