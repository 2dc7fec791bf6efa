"""Latest rows, uniqueness, upsert and parity of two targets."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _comparable(df: DataFrame) -> list[Column]:
    """All columns in a form that can be hashed and compared; documents as JSON text."""
    return [
        F.to_json(f.name) if isinstance(f.dataType, T.VariantType) else F.col(f.name)
        for f in df.schema.fields
    ]


def row_hash(df: DataFrame) -> Column:
    return F.xxhash64(*_comparable(df))


def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The latest row per key, by ``order`` descending; a hash settles ties the same way on
    every run. Each task keeps one row per key before the shuffle, so a hot key costs one row
    per task."""
    ranking = Window.partitionBy(*keys).orderBy(
        *[F.col(c).desc_nulls_last() for c in order], F.col("_h").desc()
    )
    return (
        df.withColumn("_h", row_hash(df))
        .withColumn("_rn", F.row_number().over(ranking))
        .where(F.col("_rn") == 1)
        .drop("_rn", "_h")
    )


def unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key. Which one, when they differ, is settled by a hash."""
    return latest(df, keys, [])


def upsert(target: DataFrame, updates: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Target without the updated keys, plus the latest update of each key."""
    newest = latest(updates, [key], order)
    # the keys alone need no ranking
    kept = target.join(updates.select(key).distinct(), key, "left_anti")
    return kept.select(*target.columns).unionByName(newest.select(*target.columns))


class PartitionedTable:
    """A Parquet table partitioned by one column, whose partitions are replaced by dynamic partition overwrite.

    The new content of the partitions is staged under ``_staged``, which readers of the table do not see, and
    then published by one write. A partition that loses all its rows gets one row that is not ``_live``, as
    an overwrite only touches partitions that it writes. A publish that broke off is repeated from what
    was staged, by ``recover`` or the next writer. One writer at a time.
    """

    def __init__(self, spark, root: str, schema: T.StructType, partition: str):
        self.spark, self.root, self.schema, self.partition = spark, root.rstrip("/"), schema, partition
        self._stored = T.StructType([*schema.fields, T.StructField("_live", T.BooleanType())])

    def _at(self, path: str, schema: T.StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def read(self) -> DataFrame:
        return self._at(self.root, self._stored).where("_live").select(*self.schema.names)

    def _write(self, rows: DataFrame, path: str, how: str, mode: str = "overwrite") -> None:
        rows = rows.select(*self._stored.names).hint("rebalance", self.partition)
        rows.write.mode(mode).option("partitionOverwriteMode", how).partitionBy(self.partition).parquet(path)

    def _mark(self, ready: bool) -> None:
        """Whether what is staged is whole and has yet to be published."""
        self.spark.range(1 if ready else 0).write.mode("overwrite").parquet(f"{self.root}/_staged/ready")

    def recover(self) -> bool:
        """Publish what is staged, if anything is. To do so again changes nothing."""
        if self._at(f"{self.root}/_staged/ready", T.StructType([T.StructField("id", T.LongType())])).isEmpty():
            return False
        self._write(self._at(f"{self.root}/_staged/rows", self._stored), self.root, "dynamic")
        self._mark(False)
        return True

    def stage(self, rows: DataFrame, touched: DataFrame) -> None:
        """Put ``rows`` where the next publish takes them, for the partitions listed in ``touched``."""
        self.recover()
        path = f"{self.root}/_staged/rows"
        self._write(rows.select(*self.schema.names, F.lit(True).alias("_live")), path, "static")
        filled = self._at(path, self._stored).select(F.col(self.partition).alias("_filled")).distinct()
        emptied = touched.select(self.partition).distinct()
        emptied = emptied.join(filled, F.col(self.partition).eqNullSafe(F.col("_filled")), "left_anti")
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema.fields if f.name != self.partition]
        self._write(emptied.select(self.partition, *nothing, F.lit(False).alias("_live")), path, "static", "append")
        self._mark(True)

    def replace(self, rows: DataFrame, touched: DataFrame) -> None:
        """Put ``rows`` in place of the partitions listed in ``touched``; those without rows are empty then."""
        self.stage(rows, touched)
        self.recover()

    def upsert(self, updates: DataFrame, key: str, order: list[str]) -> None:
        """Take the latest update of each key, rewriting only the partitions that hold an updated key or receive one."""
        from eventmart.session import materialize

        self.recover()
        newest = materialize(latest(updates, [key], order), "updates").select(*self.schema.names)
        target = self.read()
        touched = (
            target.join(newest.select(key), key, "left_semi")
            .select(self.partition)
            .union(newest.select(self.partition))
            .distinct()
        )
        touched = materialize(touched, "touched").withColumnRenamed(self.partition, "_touched")
        affected = target.join(touched, target[self.partition].eqNullSafe(touched["_touched"]), "left_semi")
        merged = affected.join(newest.select(key), key, "left_anti").select(*self.schema.names).unionByName(newest)
        self.replace(merged, touched.withColumnRenamed("_touched", self.partition))


def parity(primary: DataFrame, secondary: DataFrame, key: str) -> DataFrame:
    """Keys whose rows differ between two targets, with ``status`` ``only_primary``,
    ``only_secondary`` or ``differs``.

    Both sides shrink to one row per key and side before the shuffle meets, so keys that occur
    many times are never paired row by row. Row order does not matter; repeats do.
    """
    shared = [c for c in primary.columns if c in secondary.columns]

    def tagged(df: DataFrame, side: int) -> DataFrame:
        df = df.select(*shared)
        return df.select(F.col(key), F.lit(side).alias("side"), row_hash(df).alias("h"))

    both = tagged(primary, 0).unionByName(tagged(secondary, 1))
    summed = []
    for side, name in enumerate(("primary", "secondary")):
        mine = F.when(F.col("side") == side, F.col("h"))
        summed += [
            F.count(mine).alias(f"{name}_rows"),
            F.bit_xor(mine).alias(f"{name}_xor"),
            F.sum(mine.bitwiseAND(F.lit(0xFFFFFF))).alias(f"{name}_sum"),
        ]
    status = (
        F.when(F.col("secondary_rows") == 0, "only_primary")
        .when(F.col("primary_rows") == 0, "only_secondary")
        .when(
            (F.col("primary_rows") != F.col("secondary_rows"))
            | (F.col("primary_xor") != F.col("secondary_xor"))
            | (F.col("primary_sum") != F.col("secondary_sum")),
            "differs",
        )
    )
    return (
        both.groupBy(key)
        .agg(*summed)
        .withColumn("status", status)
        .where(F.col("status").isNotNull())
        .select(key, "primary_rows", "secondary_rows", "status")
    )


def digests(df: DataFrame, columns: list[str], key: str, buckets: int) -> DataFrame:
    """(bucket, n, x, s): what the rows whose key falls in a bucket add up to, in any order."""
    h = row_hash(df.select(*columns))
    rows = df.select(F.pmod(F.xxhash64(key), F.lit(buckets)).alias("bucket"), h.alias("h"))
    return rows.groupBy("bucket").agg(
        F.count("*").alias("n"), F.bit_xor("h").alias("x"), F.sum(F.col("h").bitwiseAND(F.lit(0xFFFFFFFF))).alias("s")
    )


def parity_by_digests(primary: DataFrame, secondary: DataFrame, key: str, buckets: int = 4096, levels: int = 2) -> DataFrame:
    """The rows of :func:`parity`, from digests first: each level digests the keys that still may differ into more
    buckets, and only what lies in buckets that differ at the last level is compared by key.

    A level moves at most one row per bucket and task. Equal targets cost two aggregations, one for each side.
    """
    from eventmart.session import materialize

    shared = [c for c in primary.columns if c in secondary.columns]
    for level in range(1, levels + 1):
        n = buckets**level
        first, second = (digests(df, shared, key, n) for df in (primary, secondary))
        both = first.unionByName(second).groupBy("bucket", "n", "x", "s").agg(F.count("*").alias("sides")).where("sides = 1")
        apart = materialize(both.select("bucket").distinct(), "buckets-apart")
        count = apart.count()
        if not count:
            return parity(primary.limit(0), secondary.limit(0), key)
        if count <= 2 * buckets:  # of a fixed number: the side table is small
            apart = F.broadcast(apart)
        bucket = F.pmod(F.xxhash64(key), F.lit(n))
        primary, secondary = (
            df.withColumn("bucket", bucket).join(apart, "bucket", "left_semi").drop("bucket") for df in (primary, secondary)
        )
        if count > buckets // 2:  # most keys differ: further levels would tell nothing
            break
    return parity(primary, secondary, key)
