"""Ranked lexical search of many queries at once, with common subexpressions evaluated once.

A query's score of a document is a sum over its terms, so queries that share terms share partial sums. Term
sets shared among queries are mined by merging neighbours in an order that puts terms of the same queries
side by side: a pair that several queries have becomes a node, and nodes merge further. The nodes form a
graph of additions. For a block of documents, every node's accumulator is made once, level by level,
from the accumulators below it, and each query adds up the nodes that cover it.

Queries go in blocks of bounded size; documents stay where they are. Tokens are counted once per block
of queries and stored; only term weights, the graph and the best documents of each task travel.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventmart.llm.textbatch import packed, slices, word_bounds, word_hashes
from eventmart.llm.topk import NO_ID, Best
from eventmart.session import materialize

TOP = 50
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # digits, letters, everything beyond ASCII
BLOCK_TERMS = 1 << 15  # terms of the queries of one block, about: bounds what is broadcast and held
_TASKS = 64  # tasks whose best documents are merged first
_BREAK = np.ones(256, bool)  # bytes that are in no term
_BREAK[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


@dataclass
class Graph:
    """Terms 0..T-1 are leaves; node T+i adds ``left[i]`` and ``right[i]``. Nodes go by level, ``levels``
    holds where each begins. Query q adds ``parts[heads[q]:heads[q + 1]]``."""

    terms: int
    left: np.ndarray
    right: np.ndarray
    levels: np.ndarray
    parts: np.ndarray
    heads: np.ndarray

    def evaluate(self, leaves: np.ndarray) -> np.ndarray:
        """(queries, documents) sums from (terms, documents) values."""
        values = np.empty((self.terms + len(self.left), leaves.shape[1]), np.int64)
        values[: self.terms] = leaves
        for lo, hi in zip(self.levels, self.levels[1:]):
            np.add(values[self.left[lo:hi]], values[self.right[lo:hi]], out=values[self.terms + lo : self.terms + hi])
        return np.add.reduceat(values[self.parts], self.heads[:-1], axis=0)


def mine(queries: list[list[int]], terms: int) -> Graph:
    """The graph of shared term sets of ``queries``, each a non-empty list of distinct terms."""
    users: dict[int, list[int]] = {}
    for q, ts in enumerate(queries):
        for t in ts:
            users.setdefault(t, []).append(q)
    place = {t: (-len(u), tuple(u), t) for t, u in users.items()}  # terms of the same queries are neighbours
    rows = [sorted(ts, key=place.__getitem__) for ts in queries]
    node: dict[tuple[int, int], int] = {}
    while True:
        count = Counter(pair for row in rows for pair in zip(row, row[1:]))
        if not count or max(count.values()) < 2:
            break
        rows = [_merged(row, count, node, terms) for row in rows]
    level, order = [0] * terms, []
    for a, b in node:  # in order of making: what a pair needs comes before it
        level.append(1 + max(level[a], level[b]))
    order = sorted(range(len(node)), key=lambda i: level[terms + i])
    number = np.concatenate([np.arange(terms), terms + np.argsort(order)]).astype(np.int64) if node else np.arange(terms)
    pairs = np.array(list(node), np.int64).reshape(-1, 2)[order] if node else np.zeros((0, 2), np.int64)
    levels = np.array([level[terms + i] for i in order], np.int64)
    starts = np.flatnonzero(np.diff(levels, prepend=0)) if len(levels) else np.zeros(0, np.int64)
    heads = np.concatenate([[0], np.cumsum([len(row) for row in rows])]).astype(np.int64)
    parts = number[np.array([n for row in rows for n in row], np.int64)]
    return Graph(terms, number[pairs[:, 0]], number[pairs[:, 1]], np.append(starts, len(levels)), parts, heads)


def _merged(row: list[int], count: Counter, node: dict, terms: int) -> list[int]:
    """``row`` with pairs of several queries replaced; of two that overlap, the more frequent one."""
    out, i = [], 0
    while i < len(row):
        pair = tuple(row[i : i + 2])
        if len(pair) == 2 and count[pair] > 1 and count[pair] >= count[tuple(row[i + 1 : i + 3])]:
            out.append(node.setdefault(pair, terms + len(node)))
            i += 2
        else:
            out.append(row[i])
            i += 1
    return out


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash, text number) of every term of packed texts."""
    starts, ends = word_bounds(data, offsets, _BREAK)
    return word_hashes(data, starts, ends, lower=True), np.searchsorted(offsets, starts, "right") - 1


def query_terms(texts: list[str]) -> tuple[np.ndarray, list[list[int]]]:
    """(sorted hashes of all distinct terms, term numbers of each text)."""
    data, offsets = packed(pa.array(texts, pa.large_string()))
    hashes, text = _terms(data, offsets)
    known, number = np.unique(hashes, return_inverse=True)
    return known, [sorted(set(number[text == i].tolist())) for i in range(len(texts))]


def term_counts(docs: DataFrame, known: np.ndarray) -> DataFrame:
    """Per document with a term: doc_id, n (its terms), and the numbers and counts of the ``known`` ones."""
    wanted = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = wanted.value
        for batch in batches:
            data, offsets = packed(batch.column(1))
            ids = batch.column(0)
            for lo, hi in slices(offsets):
                hashes, text = _terms(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                n = np.bincount(text, minlength=hi - lo)
                at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                hit = known[at] == hashes
                key, tf = np.unique(text[hit] * len(known) + at[hit], return_counts=True)
                edge = np.searchsorted(key // len(known), np.arange(hi - lo + 1)).astype(np.int32)
                rows = pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), pa.array(n), pa.ListArray.from_arrays(edge, (key % len(known)).astype(np.int32)),
                     pa.ListArray.from_arrays(edge, tf.astype(np.int64))], names=["doc_id", "n", "terms", "tf"])
                yield rows.filter(pa.array(n > 0))

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, n long, terms array<int>, tf array<long>")


def weights(df: np.ndarray, n: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


def _best(counts: DataFrame, graph: Graph, weight: np.ndarray, n: int, words: int, keys: list[str], k: int) -> DataFrame:
    """(key, doc_id, score): what each task finds best."""
    shared = counts.sparkSession.sparkContext.broadcast((graph, weight, keys))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph, weight, keys = shared.value
        best = Best(len(keys), k, 0, -NO_ID)
        every = np.arange(len(keys))
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).fill_null(NO_ID).to_numpy()
            m = 100 - 50 + (50 * batch.column(1).to_numpy() * n) // words
            lists = batch.column(2)
            doc = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
            term, tf = lists.flatten().to_numpy(), batch.column(3).flatten().to_numpy()
            leaves = np.zeros((graph.terms, batch.num_rows), np.int64)
            leaves[term, doc] = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[doc]))
            best.offer(every, graph.evaluate(leaves), ids)
        query, doc, score = best.entries()
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.string()).take(pa.array(query)), pa.array(doc, mask=doc == NO_ID), pa.array(score)],
            names=["key", "doc_id", "score"],
        )

    return counts.mapInArrow(run, "key string, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """The ``k`` best documents of each item: item_id, rank, doc_id, score.

    ``docs``: doc_id, text; ``items``: item_id, text. Equal scores go by ascending doc_id, null ids last; only scores
    above 0 count. Null texts and texts without terms score nothing. Repeated documents rank each;
    repeated items (id and text) count once, items that share an id but differ in text are ranked each.
    Other columns are ignored; empty tables give an empty result. Terms are 64-bit hashes.
    """
    spark = docs.sparkSession
    asked = items.select("item_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("key", F.sha2("text", 256))
    texts = materialize(asked.select("key", "text").dropDuplicates(["key"]).withColumn("size", F.regexp_count("text", F.lit(TERM))), "search-queries")
    total = texts.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    blocks = -(-total // BLOCK_TERMS)
    ranked = spark.createDataFrame([], "key string, rank int, doc_id long, score long")
    for b in range(blocks):
        some = texts.where("size > 0").where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == b)
        ranked = ranked.unionByName(materialize(_block(docs, sorted(map(tuple, some.select("key", "text").collect())), k), "search-ranked"))
    return asked.select("item_id", "key").distinct().join(ranked, "key").select("item_id", "rank", "doc_id", "score")


def _block(docs: DataFrame, queries: list[tuple[str, str]], k: int) -> DataFrame:
    """(key, rank, doc_id, score) for some (key, text)."""
    if not queries:
        return docs.sparkSession.createDataFrame([], "key string, rank int, doc_id long, score long")
    known, numbers = query_terms([t for _, t in queries])
    counts = materialize(term_counts(docs, known), "search-counts")
    n, words = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(known), np.int64)
    for r in counts.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df")).collect():  # a row per term of the block
        df[r.t] = r.df
    found = _best(counts, mine(numbers, len(known)), weights(df, n), n, max(words, 1), [q for q, _ in queries], k)
    by = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    first = W.partitionBy("key", "task").orderBy(*by)
    some = found.withColumn("task", F.floor(F.spark_partition_id() / _TASKS)).withColumn("at", F.row_number().over(first)).where(F.col("at") <= k)
    rank = F.row_number().over(W.partitionBy("key").orderBy(*by))
    return some.withColumn("rank", rank).where(F.col("rank") <= k).select("key", "rank", "doc_id", "score")
