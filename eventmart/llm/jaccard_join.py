"""N-gram Jaccard join: documents whose sets of word shingles are alike.

Two sets with Jaccard similarity t share an element among the first ``n - ceil(t n) + 1`` of each, in
any order common to all sets. The order here is rare-first, so these prefixes hold few common
elements: frequencies are counted over the whole corpus in a hashed table of fixed size. Prefix
elements are joined by dealing them to shards; length, positional and suffix filters thin the
candidates; each remaining pair is verified once on the full sets.

Shingles and sets are 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm import linking
from eventmart.llm.textbatch import mix, packed, shingles, slices
from eventmart.session import materialize

WIDTH = 5
PERCENT = 75
COUNTERS = 1 << 18  # of the frequency table; its size is fixed, and so is what is broadcast
_BLOCKS = 32  # of the frequency table, summed apart
SHARD_ENTRIES = 1 << 20  # prefix elements a shard holds, about
_SLOTS = 64  # in which the parts that want a class are gathered
_FAN = 1024  # parts that a set is sent to by one row
_FLUSH = 1 << 20  # entries a map task holds before it deals them out


def distinct_shingles(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, sorted distinct shingle hashes of each row) for slices of a batch."""
    data, offsets = packed(batch.column(column))
    for lo, hi in slices(offsets):
        part = data[offsets[lo] : offsets[hi]]
        hashes, at = shingles(part, offsets[lo : hi + 1] - offsets[lo], WIDTH, lower=True)
        yield lo, [_unique(hashes[at[i] : at[i + 1]]) for i in range(hi - lo)]


def _unique(h: np.ndarray) -> np.ndarray:
    h = np.sort(h)
    return h[np.concatenate([[True], h[1:] != h[:-1]])] if len(h) else h


def class_id(grams: np.ndarray) -> int:
    """One 64-bit value per set: equal sets have equal ids."""
    with np.errstate(over="ignore"):
        h = mix(grams ^ np.uint64(0xA5A5A5A5)).sum(dtype=np.uint64) + np.uint64(len(grams)) * np.uint64(0x9E3779B97F4A7C15)
    return int(mix(np.array([h]))[0].astype(np.int64))


def _counter(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(40)).astype(np.int64) % COUNTERS


def describe(docs: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """(one row per document: doc_id, text_hash, n, cls, sketch, fold; the frequency table), in one pass over the texts.

    Every task sends one row with its counts, compressed; they are cut into blocks of cells and each block is
    summed in a task of its own, so the driver gets as many rows as there are blocks.
    """
    id_type = docs.schema["doc_id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    arrow_id = to_arrow_type(id_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.int64)
        names = ["doc_id", "text_hash", "n", "cls", "sketch", "fold", "counts"]
        for batch in batches:
            n, cls, sk = [], [], []
            for _, sets in distinct_shingles(batch, 1):
                for g in sets:
                    n.append(len(g))
                    cls.append(class_id(g))
                    sk.append(linking.sketch(g))
                if sets:
                    counts += np.bincount(_counter(np.concatenate(sets)), minlength=COUNTERS)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(cls, pa.int64()), pa.array(sk, pa.binary()),
                 pa.array([linking.fold(x) for x in sk], pa.binary()), pa.nulls(len(n), pa.binary())], names=names)
        if counts.any():
            blob = zstandard.compress(counts.astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, arrow_id), *[pa.nulls(1, pa.int64())] * 3, *[pa.nulls(1, pa.binary())] * 2,
                 pa.array([blob], pa.binary())], names=names)

    def cut(blobs: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in blobs:
            for b in batch.column(0).to_pylist():
                total += np.frombuffer(zstandard.decompress(b), np.int32)
        if total.any():
            cells = [zstandard.compress(x.tobytes()) for x in np.split(total, _BLOCKS)]
            yield pa.RecordBatch.from_arrays([pa.array(range(_BLOCKS), pa.int32()), pa.array(cells, pa.binary())], names=["block", "cells"])

    def add(blobs: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in blobs:
            for k, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                cells = np.frombuffer(zstandard.decompress(b), np.int64)
                totals[k] = totals[k] + cells if k in totals else cells
        cells = [x.tobytes() for x in totals.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int32()), pa.array(cells, pa.binary())], names=["block", "cells"])

    schema = f"doc_id {id_type.simpleString()}, text_hash long, n long, cls long, sketch binary, fold binary, counts binary"
    stored = materialize(docs.select("doc_id", "text", F.xxhash64("text")).mapInArrow(run, schema), "join-docs")
    partial = stored.where("counts is not null").select("counts").mapInArrow(cut, "block int, cells binary")
    summed = partial.repartitionById(_BLOCKS, F.col("block")).mapInArrow(add, "block int, cells binary")
    frequency = np.zeros((_BLOCKS, COUNTERS // _BLOCKS), np.int64)
    for row in summed.collect():  # a row of fixed size per block
        frequency[row.block] = np.frombuffer(row.cells, np.int64)
    frequency = frequency.ravel()
    return stored.where("counts is null").drop("counts"), frequency


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


def prefix_buckets(docs: DataFrame, frequency: np.ndarray, shards: int) -> DataFrame:
    """(bucket, cls, n, pos) of the prefix elements that several classes have."""
    spark = docs.sparkSession
    rank = spark.sparkContext.broadcast(frequency)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for _, sets in distinct_shingles(batch, 1):
                for g in sets:
                    if len(g):
                        order = np.lexsort((g, rank.value[_counter(g)]))[: prefix_length(len(g))]
                        held.append((g[order], class_id(g), len(g)))
                        size += len(order)
                if size >= _FLUSH:
                    yield _dealt(held, shards)
                    held, size = [], 0
        if held:
            yield _dealt(held, shards)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [_unpack(b) for batch in batches for b in batch.column(1).to_pylist()]
        if not parts:
            return
        gram, cls, n, pos = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((cls, gram))
        gram, cls, n, pos = gram[order], cls[order], n[order], pos[order]
        new = np.concatenate([[True], (gram[1:] != gram[:-1]) | (cls[1:] != cls[:-1])])  # copies meet here
        gram, cls, n, pos = gram[new], cls[new], n[new], pos[new]
        same = gram[1:] == gram[:-1]
        several = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(gram[several].view(np.int64)), pa.array(cls[several]), pa.array(n[several].astype(np.int64)),
             pa.array(pos[several].astype(np.int64))], names=["bucket", "cls", "n", "pos"])

    dealt = docs.select("doc_id", "text").mapInArrow(deal, "shard int, entries binary")
    return dealt.repartitionById(shards, F.col("shard")).mapInArrow(meet, "bucket long, cls long, n long, pos long")


def _dealt(held: list[tuple], shards: int) -> pa.RecordBatch:
    """One row per shard with its entries: the classes met, then element, class number and place."""
    held = list({c: (g, c, n) for g, c, n in held}.values())
    grams = np.concatenate([g for g, _, _ in held])
    length = np.array([len(g) for g, _, _ in held])
    owner = np.repeat(np.arange(len(held), dtype=np.uint32), length)
    pos = (np.arange(len(grams)) - np.repeat(np.cumsum(length) - length, length)).astype(np.uint32)
    cls = np.array([c for _, c, _ in held], np.int64)
    n = np.array([m for _, _, m in held], np.uint32)
    shard = (grams % np.uint64(shards)).astype(np.int64)
    order = np.lexsort((grams, shard)) if len(grams) < 1 << 16 else np.argsort(shard, kind="stable")
    cut = np.searchsorted(shard[order], np.arange(shards + 1))
    rows = []
    for s in range(shards):
        at = order[cut[s] : cut[s + 1]]
        if len(at):
            used, number = np.unique(owner[at], return_inverse=True)
            head = np.array([len(used), len(at)], np.uint32)
            raw = b"".join(x.tobytes() for x in (head, cls[used], n[used], grams[at], number.astype(np.uint32), pos[at]))
            rows.append((s, zstandard.compress(raw, 1)))
    return pa.RecordBatch.from_arrays(
        [pa.array([s for s, _ in rows], pa.int32()), pa.array([b for _, b in rows], pa.binary())], names=["shard", "entries"]
    )


def _unpack(blob: bytes) -> tuple[np.ndarray, ...]:
    raw = zstandard.decompress(blob)
    k, m = np.frombuffer(raw, np.uint32, 2)
    at, out = 8, []
    for dtype, count in ((np.int64, k), (np.uint32, k), (np.uint64, m), (np.uint32, m), (np.uint32, m)):
        out.append(np.frombuffer(raw, dtype, count, at))
        at += out[-1].nbytes
    cls, n, gram, number, pos = out
    return gram, cls[number], n[number], pos


def _keyed(rows: DataFrame) -> DataFrame:
    """``rows`` with the id as a text that is never null."""
    return rows.withColumn("row_id", F.coalesce(F.col("doc_id").cast("string"), F.lit("")))


def classes(described: DataFrame) -> DataFrame:
    """A stored row per class: cls, sketch, fold, and (row_id, text_hash) of its smallest doc_id, nulls last."""
    key = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")
    each = described.groupBy("cls").agg(F.first("sketch").alias("sketch"), F.first("fold").alias("fold"), F.min(key).alias("k"))
    return materialize(_keyed(each.select("cls", "sketch", "fold", "k.doc_id", "k.text_hash")).drop("doc_id"), "join-classes")


def sets_of(docs: DataFrame, each: DataFrame):
    """For :func:`linking.verify`: shingles of one document of each class wanted, for each part that
    wants it. The texts stay where they are as long as the list of wanted rows is small enough to
    be sent to all tasks; beyond that both sides are shuffled. ``each``: as of :func:`classes`.

    The parts that want a class are gathered in slots before they become one row, so a class that all
    parts want is no hot key. A set wanted by many parts leaves its task once for each slot and is
    repeated behind a shuffle by slots.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()  # rows repeated within a task are sent once
        for batch in batches:
            found = []
            parts = batch.column(2).to_pylist()
            for lo, sets in distinct_shingles(batch, 1):
                for i, g in enumerate(sets):
                    cls = class_id(g)
                    if cls not in met:
                        met.add(cls)
                        found += [(some, cls, g.tobytes()) for some in parts[lo + i]]
            cols = list(zip(*found)) or [(), (), ()]
            types = pa.list_(pa.int64()), pa.int64(), pa.binary()
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["parts", "cls", "grams"])

    def of(wanted: DataFrame) -> DataFrame:
        slots = wanted.groupBy("cls", F.pmod(F.col("to"), F.lit(_SLOTS)).alias("slot")).agg(F.collect_set("to").alias("some"))
        parts = slots.groupBy("cls").agg(F.collect_list("some").alias("parts"), F.sum(F.size("some")).alias("many"))
        rows = each.select("cls", "row_id", "text_hash").join(parts, "cls")
        fewer = F.when(F.col("many") <= _FAN, F.array(F.flatten("parts"))).otherwise(F.col("parts"))
        one = materialize(rows.select("row_id", "text_hash", fewer.alias("parts"), "many"), "join-wanted")
        size = F.length("row_id") * 4 + F.col("many") * 8 + 64
        widest, measured = one.agg(F.coalesce(F.max("many"), F.lit(0)), F.coalesce(F.sum(size), F.lit(0))).first()
        texts = _keyed(docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")))
        sent = F.broadcast(one) if measured <= linking.SMALL_BYTES else one
        chosen = texts.join(sent, ["row_id", "text_hash"]).select("row_id", "text", "parts")
        sets = chosen.mapInArrow(run, "parts array<long>, cls long, grams binary")
        if widest > _FAN:
            sets = sets.repartition("cls", F.element_at("parts", 1))
        return sets.select(F.explode("parts").alias("to"), "cls", "grams")

    return of


def _small(rows: DataFrame) -> DataFrame:
    """A stored table of keys, marked to be sent to all tasks if it is small."""
    return linking.small(rows, F.length("__join_id") * 4 + 32)


def join(docs: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(per document: doc_id, text_hash, n_shingles, cls, component, component_id; the verified links).

    Documents with equal sets are one class. ``links`` has (a, b, shared) for every pair that was
    verified; together with the classes they connect every two documents whose sets reach
    ``percent`` Jaccard similarity. ``component_id`` is the smallest doc_id reachable. A null, empty or
    wordless text has no shingles and is linked with nothing; null ids are not counted as smallest;
    repeated rows are rows of one class; other columns are ignored; an empty table gives empty results.
    """
    described, nodes, links = linked(docs, percent)
    return grouped(described, nodes), links


def linked(docs: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(the described documents, (node, component) of linked classes, the links)."""
    described, frequency = describe(docs)
    words = described.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = max(least, -(-words * (100 - percent) // 100 // SHARD_ENTRIES))
    buckets = prefix_buckets(docs, frequency, shards)
    each = classes(described)
    links, nodes = linking.link(materialize(buckets, "join-buckets"), each, sets_of(docs, each), percent)
    return described, nodes, links


def grouped(described: DataFrame, nodes: DataFrame) -> DataFrame:
    """The described documents with the component of their class and its smallest doc_id."""
    classes = (
        described.where("n > 0").groupBy("cls").agg(F.min("doc_id").alias("low"))
        .join(nodes, F.col("cls") == F.col("node"), "left").withColumn("component", F.coalesce("component", "cls"))
    )
    lowest = classes.groupBy("component").agg(F.min("low").alias("component_id"))
    of_class = classes.join(lowest, "component").select("cls", "component", "component_id")
    return described.join(of_class, "cls", "left").select(
        "doc_id", "text_hash", F.col("n").alias("n_shingles"), "cls", "component",
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def dedupe(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row of ``docs`` per component, all columns: that of the smallest doc_id, nulls last.

    Rows that repeat an id and a text count once; documents without words all stay.
    """
    described, nodes, _ = linked(docs, percent)
    placed = _keyed(described.join(nodes, described.cls == nodes.node, "left").withColumn("component", F.coalesce("component", "cls")))
    key = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash", "row_id")
    first = placed.where("n > 0").groupBy("component").agg(F.min(key).alias("k"))
    first = first.select("k.row_id", "k.text_hash", F.lit(True).alias("first"))
    rows = placed.groupBy("row_id", "text_hash").agg(F.count("*").alias("times"), F.max("n").alias("n"))
    judged = rows.join(first, ["row_id", "text_hash"], "left").select(
        F.col("row_id").alias("__join_id"), F.col("text_hash").alias("__join_hash"), "times",
        (F.col("first").isNotNull() | (F.col("n") == 0)).alias("stays"),
    )
    judged = materialize(judged.where("not stays or times > 1"), "join-judged")
    keyed = docs.withColumns({"__join_id": F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "__join_hash": F.xxhash64("text")})
    keys = ["__join_id", "__join_hash"]
    kept = keyed.join(_small(judged.select(*keys)), keys, "left_anti")
    repeated = judged.where("stays").select(*keys)  # rows that stay, but were there more than once
    if not repeated.isEmpty():
        kept = kept.unionByName(keyed.join(_small(materialize(repeated, "join-repeated")), keys, "left_semi").dropDuplicates(keys))
    return kept.select([F.col(f"`{c}`") for c in docs.columns])
