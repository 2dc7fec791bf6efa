"""Exact top-k inner products with a pivot-distance index.

With one more coordinate, ``sqrt(M - |x|^2)`` for a stored vector and 0 for a query (M: the largest squared length),
all stored vectors are equally long, so the largest inner product is the smallest distance. Every vector is keyed by
its nearest pivot and its distance to it. Vectors in key order are cut into runs, each an annulus
around a pivot, and ranges of runs into shards.

A query first goes to the shard whose annuli come nearest; there it expands over the annuli in the order of
their bounds. By the triangle inequality no vector of an annulus is nearer than the difference of
distances to the pivot, so what lies beyond the k-th best is never read. Then it visits only those other
shards that can still hold something better. Shards are bounded; queries travel in packed batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.textbatch import mix, pack_arrays, unpack_arrays
from eventmart.llm.topk import NO_ID, Best
from eventmart.session import materialize

TOP = 20
SCALE = 64
PIVOTS = 64
SAMPLE = 4096  # vectors that pivots are chosen from, at most
RUN = 512  # vectors of one annulus, at most
SHARD_BYTES = 32 << 20  # vectors of one shard, about, as doubles
_LOWEST = -(1 << 63) + 1


@dataclass
class Index:
    """``runs``: shard, pivot, dmin, dmax, packed (ids, vectors). ``pivots`` have the added coordinate last."""

    runs: DataFrame
    pivots: np.ndarray
    shards: int
    longest: float  # squared length
    dim: int
    bounds: tuple[np.ndarray, ...]  # shard, pivot, dmin, dmax: a row for each pivot of a shard


def lattice(rows: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): components times ``scale``, rounded down. Null vectors and those with null or non-finite
    components are left out."""
    x = F.col(f"`{vector_col}`").cast("array<double>")
    finite = F.forall("x", lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)))
    valid = rows.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), x.alias("x")).where(F.col("x").isNotNull() & finite)
    return valid.select("vec_id", F.transform("x", lambda c: F.floor(c * scale)).alias("v"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Vectors as rows, shorter ones with zeros behind."""
    size = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (size == dim).all():
        return flat.reshape(len(size), dim)
    out = np.zeros((len(size), dim), np.int64)
    row = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    out[row[place < dim], place[place < dim]] = flat[place < dim]
    return out


def _distances(v: np.ndarray, added: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """(vectors, pivots) distances; ``added`` is the vectors' added coordinate."""
    x = v.astype(np.float64)
    squared = (x**2).sum(axis=1) + added**2
    cross = x @ pivots[:, :-1].T + added[:, None] * pivots[:, -1]
    return np.sqrt(np.maximum(squared[:, None] + (pivots**2).sum(axis=1) - 2 * cross, 0))


def _choose(sample: np.ndarray, longest: float) -> np.ndarray:
    """Pivots far from each other: each next one is the vector farthest from those chosen."""
    x = np.concatenate([sample, np.sqrt(np.maximum(longest - (sample**2).sum(axis=1), 0))[:, None]], axis=1)
    if not len(x):
        return np.zeros((1, x.shape[1]))
    chosen, far = [0], ((x - x[0]) ** 2).sum(axis=1)
    while len(chosen) < min(PIVOTS, len(x)) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((x - x[chosen[-1]]) ** 2).sum(axis=1))
    return x[chosen]


def build(vectors: DataFrame) -> Index:
    """Index of ``vectors`` (vec_id, v), every row of them. Pivots come from at most SAMPLE rows, taken by a hash of
    the id; vectors shorter than the longest have zeros behind; null ids are kept; an empty table gives an empty index."""
    spark = vectors.sparkSession
    squared = F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))
    stored = materialize(vectors, "index-vectors")
    n, longest, dim = stored.agg(F.count("*"), F.coalesce(F.max(squared), F.lit(0.0)), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    sample = stored.orderBy(F.xxhash64("vec_id", "v")).limit(SAMPLE).select("v").collect()
    rows = [r.v + [0] * (dim - len(r.v)) for r in sample]
    pivots = _choose(np.array(rows, np.float64).reshape(len(rows), dim), longest)
    kind = np.int16 if longest < 2**30 else np.int64
    shared = spark.sparkContext.broadcast(pivots)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column(1), dim)
            added = np.sqrt(np.maximum(longest - (v.astype(np.float64) ** 2).sum(axis=1), 0))
            d = _distances(v, added, shared.value)
            nearest = d.argmin(axis=1) if len(d) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(nearest.astype(np.int32)), pa.array(d[np.arange(len(d)), nearest]),
                 pa.array([r.tobytes() for r in v.astype(kind)], pa.binary())], names=["vec_id", "pivot", "dist", "vec"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            while batch.num_rows:
                pivot = batch.column("pivot").to_numpy()
                if held and (count == RUN or held[0].column("pivot")[0].as_py() != pivot[0]):
                    yield _run(held)
                    held, count = [], 0
                take = min(RUN - count, int(np.argmax(np.append(pivot != pivot[0], True))))
                held.append(batch.slice(0, take))
                count += take
                batch = batch.slice(take)
        if held:
            yield _run(held)

    def _run(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held).combine_chunks()
        ids = t["vec_id"].fill_null(NO_ID).to_numpy()
        vec = np.frombuffer(b"".join(t["vec"].to_pylist()), kind)
        d = t["dist"].to_numpy()
        return pa.RecordBatch.from_arrays(
            [pa.array([t["shard"][0].as_py()], pa.int32()), pa.array([t["pivot"][0].as_py()], pa.int32()), pa.array([d.min()]),
             pa.array([d.max()]), pa.array([pack_arrays(ids, vec)], pa.binary())], names=["shard", "pivot", "dmin", "dmax", "packed"])

    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n * max(dim, 1) * 8 // SHARD_BYTES))
    keyed = materialize(stored.mapInArrow(assign, "vec_id long, pivot int, dist double, vec binary"), "index-keyed")
    by = ["pivot", "dist", "vec_id"]  # the id splits what lies at one distance
    dealt = keyed.repartitionByRange(shards, *by).sortWithinPartitions(*by).withColumn("shard", F.spark_partition_id())
    runs = materialize(dealt.mapInArrow(cut, "shard int, pivot int, dmin double, dmax double, packed binary"), "index-runs")
    # a row for each pivot of a shard: as many as there are shards and pivots, at most
    found = runs.groupBy("shard", "pivot").agg(F.min("dmin"), F.max("dmax")).orderBy("shard", "pivot").collect()
    cols = list(zip(*found)) or [(), (), (), ()]
    bounds = tuple(np.array(c, t) for c, t in zip(cols, (np.int64, np.int64, np.float64, np.float64)))
    return Index(runs, pivots, shards, longest, dim, bounds)


def _ceiling(q: np.ndarray, dq: np.ndarray, pivot, dmin, dmax, longest: float) -> np.ndarray:
    """(queries, annuli): no inner product with a vector of the annulus is larger."""
    away = np.maximum(0, np.maximum(dq[:, pivot] - dmax, dmin - dq[:, pivot]))
    squared = (q.astype(np.float64) ** 2).sum(axis=1)
    room = 1e-9 * (squared + longest) + 1e-6  # for rounding
    return (squared[:, None] + longest - away**2) / 2 + room[:, None]


def _scores(v: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact integer inner products (queries, vectors)."""
    x, y = v.astype(np.float64), q.astype(np.float64)
    if (x**2).sum(axis=1).max() * (y**2).sum(axis=1).max() < 2.0**104:  # all sums on the way are below 2**53
        return (y @ x.T).astype(np.int64)
    return (q.astype(object) @ v.T.astype(object)).astype(np.int64)


def search(index: Index, queries: DataFrame, k: int = TOP) -> DataFrame:
    """The ``k`` stored vectors of largest inner product for each row of ``queries`` (vec_id, v): query_id, rank, vec_id, score.

    Equal scores go by ascending vec_id, null ids last. Stored rows with the query's id are its own and take no part.
    Repeated rows rank each, repeated queries are answered each; a query longer than the stored vectors is cut to
    their length. Components are integers; a score must fit 64 bits. Empty tables give an empty result.
    """
    spark = queries.sparkSession
    dim, longest, pivots, bounds, shards = index.dim, index.longest, index.pivots, index.bounds, index.shards
    asked = queries.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    asked = materialize(asked.repartitionById(shards, F.col("part")).select("part", "vec_id", "v", F.monotonically_increasing_id().alias("q")), "index-queries")

    def batch_row(shard, part, arrays) -> tuple:
        return int(shard), int(part), pack_arrays(*arrays)

    def packed_rows(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.binary()))], names=["shard", "part", "packed"])

    def nearness(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(queries, shards that hold something) best ceilings, and those shards."""
        shard, pivot, dmin, dmax = bounds
        up = _ceiling(v, _distances(v, np.zeros(len(v)), pivots), pivot, dmin, dmax, longest)
        some, first = np.unique(shard, return_index=True)
        return np.maximum.reduceat(up, first, axis=1), some

    def homes(v: np.ndarray, q: np.ndarray) -> np.ndarray:
        up, some = nearness(v)
        spread = mix(q.astype(np.uint64)[:, None] * np.uint64(1 << 20) + some.astype(np.uint64))  # among equally near ones
        return some[np.lexsort((spread, -up), axis=1)[:, 0]]

    def go_home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            part, ids, q = (batch.column(c).cast(pa.int64()).fill_null(NO_ID).to_numpy() for c in ("part", "vec_id", "q"))
            v, rows = _matrix(batch.column("v"), dim), []
            home = homes(v, q)
            for p, s in np.unique(np.stack([part, home], axis=1), axis=0):
                at = np.flatnonzero((part == p) & (home == s))
                rows.append(batch_row(s, p, (q[at], ids[at], v[at].ravel(), np.full(len(at), _LOWEST), np.full(len(at), NO_ID))))
            yield packed_rows(rows)

    def go_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, blob in zip(batch.column("part").to_pylist(), batch.column("packed").to_pylist()):
                q, ids, flat, score, found = unpack_arrays(blob)
                v = flat.reshape(len(q), dim)
                up, some = nearness(v)
                least, least_id = score.reshape(len(q), k)[:, -1], found.reshape(len(q), k)[:, -1]
                visit = (up >= least[:, None]) & (some != homes(v, q)[:, None])
                yield packed_rows(
                    [batch_row(s, part, (q[at], ids[at], v[at].ravel(), least[at], least_id[at])) for s, at in
                     ((s, np.flatnonzero(visit[:, i])) for i, s in enumerate(some)) if len(at)]
                )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, runs = None, []
        for batch in batches:
            for shard, part, blob, pivot, dmin, dmax in zip(*(c.to_pylist() for c in batch.columns)):
                if shard != here:
                    here, runs = shard, []
                if part < 0:
                    ids, vec = unpack_arrays(blob)
                    runs.append((pivot, dmin, dmax, ids, vec.reshape(len(ids), dim)))
                elif runs:
                    yield packed_rows([batch_row(shard, part, expand(runs, *unpack_arrays(blob)))])

    def expand(runs: list, q, ids, flat, least, least_id) -> tuple[np.ndarray, ...]:
        """The batch's best in this shard: annuli go by their ceilings, until none can hold better."""
        v = flat.reshape(len(q), dim)
        best = Best(len(q), k, least, least_id)
        pivot, dmin, dmax = (np.array(x) for x in list(zip(*runs))[:3])
        up = _ceiling(v, _distances(v, np.zeros(len(v)), pivots), pivot, dmin, dmax, longest)
        for r in np.argsort(-up.max(axis=0), kind="stable").tolist():
            if up[:, r].max() < best.least.min():
                break
            at = np.flatnonzero(up[:, r] >= best.least)
            if len(at):
                near, vectors = runs[r][3:]
                scores = _scores(vectors, v[at])
                scores[(near == ids[at, None]) & (near != NO_ID)] = _LOWEST
                best.offer(at, scores, near)
        known = (best.score == least[:, None]) & (best.id == least_id[:, None])  # the floor is an entry of another shard
        return q, ids, v.ravel(), np.where(known, _LOWEST, best.score).ravel(), best.id.ravel()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list] = {}
        for batch in batches:
            for part, blob in zip(batch.column("part").to_pylist(), batch.column("packed").to_pylist()):
                q, ids, _, score, found = unpack_arrays(blob)
                score = score.reshape(len(q), k)
                row, col = np.nonzero(score > _LOWEST)
                parts.setdefault(part, []).append((q[row], ids[row], score[row, col], found.reshape(score.shape)[row, col]))
        for some in parts.values():
            q, ids, score, found = (np.concatenate(x) for x in zip(*some))
            order = np.lexsort((found, -score, q))
            q, ids, score, found = q[order], ids[order], score[order], found[order]
            first = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]])) if len(q) else np.zeros(0, np.int64)
            rank = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q)))) + 1
            keep = rank <= k
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[keep]), pa.array(rank[keep].astype(np.int32)), pa.array(found[keep], mask=found[keep] == NO_ID),
                 pa.array(score[keep])], names=["query_id", "rank", "vec_id", "score"])

    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not len(bounds[0]):
        return empty
    kept = index.runs.select("shard", F.lit(-1).alias("part"), "packed", "pivot", "dmin", "dmax")
    blank = [F.lit(0).alias("pivot"), F.lit(0.0).alias("dmin"), F.lit(0.0).alias("dmax")]

    def visit(batches: DataFrame) -> DataFrame:
        met = kept.unionByName(batches.select("*", *blank)).repartitionById(shards, F.col("shard"))
        return met.sortWithinPartitions("shard", "part").mapInArrow(scan, schema)

    schema = "shard int, part int, packed binary"
    home = materialize(visit(asked.mapInArrow(go_home, schema)), "index-home")
    rest = visit(home.mapInArrow(go_on, schema))
    every = home.unionByName(rest).select("part", "packed").repartitionById(shards, F.col("part"))
    return every.mapInArrow(merge, "query_id long, rank int, vec_id long, score long")
