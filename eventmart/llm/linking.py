"""Verified links between classes of equal documents, and their connected components.

Candidates come as buckets: rows (bucket, cls, n, pos), where documents that may be alike share a bucket.
Pairs inside a bucket are never all listed at once:

1. every member is paired with the bucket's first member;
2. of these pairs, the one with most shared buckets is verified for every class, then the others
   whose ends are still in different components;
3. in buckets that still hold members of different components, the remaining pairs between
   components are verified.

Length, positional and suffix filters thin the pairs before they are verified. So a group of many like
documents costs a star, not a square, and every link that could join two components is checked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.textbatch import mix, pack_arrays, unpack_arrays
from eventmart.session import materialize

_SET_BYTES = 32 << 20  # sets that one verifying task holds, about
_TILE = 1 << 18  # pairs filtered at a time
_PER_SET = 64  # pairs of a class that are verified together
_CHUNK = 1 << 20  # edges that a task joins up at a time
SMALL_BYTES = 32 << 20  # of a table that is sent to all tasks
_NODE_BYTES = 24  # of a node and its component
SKETCH_BITS = 512  # at least; else the power of two from the number of elements on


def components(links: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``links`` (a, b); the component is its smallest node."""
    nodes = _rooted(links)
    return nodes.union(nodes.select("component", "component").distinct())


def _rooted(links: DataFrame) -> DataFrame:
    """As :func:`components`, without the smallest nodes themselves; each other node is there once.

    Tasks join up the edges that they read, then the edges of a node meet in one task and are joined up
    again. As long as a parent has a parent itself, edges go to that one (the large-star step) and
    meet once more. Each round is a written table; the number of rounds grows with the logarithm of
    the longest chain.
    """
    edges = links.select(F.least("a", "b").alias("v"), F.greatest("a", "b").alias("u")).where("u != v")
    edges = materialize(_contracted(_of_nodes(_contracted(edges))), "cc-edges")
    while True:
        below = edges.select(F.col("u").alias("node"), F.col("v").alias("up"), F.lit(False).alias("inner"))
        ends = below.union(edges.select("v", F.lit(None).cast("long"), F.lit(True))).groupBy("node")
        seen = ends.agg(F.max("inner").alias("inner"), F.min("up").alias("x"), F.max("up").alias("y"), F.count("up").alias("times"))
        open_, times = seen.agg(F.count_if(F.expr("x is not null and (inner or x != y)")), F.max("times")).first()
        if not open_:
            stars = edges if (times or 0) <= 1 else materialize(edges.distinct(), "cc-edges")
            return stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
        up = edges.groupBy(F.col("u").alias("v")).agg(F.min("v").alias("w"))
        large = edges.join(up, "v", "left").select(F.coalesce("w", "v").alias("v"), "u")
        edges = materialize(_contracted(_of_nodes(large)), "cc-edges")


def _of_nodes(edges: DataFrame) -> DataFrame:
    """Edges (v, u) with those of one u side by side in one task."""
    return edges.select("v", "u").repartition("u").sortWithinPartitions("u")


def _contracted(edges: DataFrame) -> DataFrame:
    """Edges (v, u) that connect the same nodes: within a chunk of a task, each node and its smallest.
    Edges of one u that follow one another are in one chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(np.stack([c.to_numpy() for c in batch.columns]))
            size += batch.num_rows
            if size >= _CHUNK:
                rows = np.concatenate(held, axis=1)
                last = rows[1] == rows[1, -1]  # more edges of this node may follow
                if not last.all():
                    yield joined([rows[:, ~last]])
                held = [rows[:, last]]
                size = int(last.sum())
        if size:
            yield joined(held)

    def joined(held: list[np.ndarray]) -> pa.RecordBatch:
        nodes, at = np.unique(np.concatenate(held, axis=1), return_inverse=True)
        x, y = at.reshape(2, -1)
        root = np.arange(len(nodes))
        while True:
            low, high = np.minimum(root[x], root[y]), np.maximum(root[x], root[y])
            if (low == high).all():
                break
            np.minimum.at(root, high, low)
            while not np.array_equal(root, root[root]):
                root = root[root]
        moved = np.flatnonzero(root != np.arange(len(nodes)))
        return pa.RecordBatch.from_arrays([pa.array(nodes[root[moved]]), pa.array(nodes[moved])], names=["v", "u"])

    return edges.mapInArrow(run, "v long, u long")


def small(rows: DataFrame, size) -> DataFrame:
    """A stored table, marked to be sent to all tasks if the sum of ``size``, the bytes of a row, is small."""
    measured = rows.agg(F.coalesce(F.sum(F.lit(size)), F.lit(0))).first()[0]
    return F.broadcast(rows) if measured <= SMALL_BYTES else rows


def possible(n_a, n_b, pos_a, pos_b, percent: int):
    """Length and positional filter: can sets of these sizes, with a common element at these places
    of the common order, reach ``percent`` Jaccard similarity?  Works on columns and arrays."""
    least, greatest = (F.least, F.greatest) if not isinstance(n_a, np.ndarray) else (np.minimum, np.maximum)
    most = least(pos_a, pos_b) + 1 + least(n_a - pos_a - 1, n_b - pos_b - 1)
    return (100 * least(n_a, n_b) >= percent * greatest(n_a, n_b)) & ((100 + percent) * most >= percent * (n_a + n_b))


def sketch(grams: np.ndarray) -> bytes:
    """Parity of the number of elements in each hash cell. A sketch of half the size is the
    exclusive or of its halves."""
    bits = max(SKETCH_BITS, 1 << int(max(1, len(grams)) - 1).bit_length())
    cells = np.bincount((grams >> np.uint64(12)).astype(np.int64) & (bits - 1), minlength=bits) & 1
    return np.packbits(cells.astype(np.uint8)).tobytes()


def fold(sketched: bytes) -> bytes:
    """The sketch at its least size."""
    return _folded(np.frombuffer(sketched, np.uint64), SKETCH_BITS // 64).tobytes()


def differing(x: bytes, y: bytes) -> int:
    """Cells in which two sketches differ: at most the number of elements that only one set has."""
    a, b = (np.frombuffer(v, np.uint64) for v in (x, y))
    return int(np.bitwise_count(_folded(a, len(b)) ^ _folded(b, len(a))).sum())


def _folded(a: np.ndarray, size: int) -> np.ndarray:
    while len(a) > size:
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    return a


def suffix_filter(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, n_a, n_b, ...) that their sketches leave possible. The sketches bound how much of
    the sets differs beyond the element they share."""
    first = sketches.select(F.col("cls").alias("a"), F.col("sketch").alias("_x"))
    second = sketches.select(F.col("cls").alias("b"), F.col("sketch").alias("_y"))
    columns = pairs.columns
    both = pairs.join(first, "a").join(second, "b").select(*columns, "_x", "_y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            apart = [differing(x, y) for x, y in zip(batch.column("_x").to_pylist(), batch.column("_y").to_pylist())]
            keep = (100 + percent) * np.array(apart, np.int64) <= (100 - percent) * n
            yield batch.select(columns).filter(pa.array(keep))

    return both.mapInArrow(run, pairs.schema)


def verify(pairs: DataFrame, sets_of, percent: int) -> DataFrame:
    """The pairs (a, b, n_a, n_b), each there once, whose sets reach ``percent`` Jaccard similarity: a, b, shared.

    ``sets_of`` takes (to, cls), with repeats, and gives (to, grams): sorted 64-bit values as bytes, of each class for
    each part that needs it. Parts hold up to some pairs of one class, so one with many is spread.
    """
    spark = pairs.sparkSession
    pairs = materialize(pairs.select("a", "b", "n_a", "n_b"), "link-pairs")
    each = pairs.groupBy("a").agg(F.count("*").alias("_of"), F.sum(F.col("n_a") + F.col("n_b")).alias("_n"))
    room, many = each.agg(F.coalesce(F.sum("_n"), F.lit(0)) * 8, F.count_if(F.col("_of") > _PER_SET)).first()
    if not room:
        return spark.createDataFrame([], "a long, b long, shared long")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), room // _SET_BYTES + 1)
    if many:
        wide = each.where(F.col("_of") > _PER_SET).select("a", F.ceil(F.col("_of") / _PER_SET).alias("_of"))
        salted = pairs.join(F.broadcast(wide) if 16 * many <= SMALL_BYTES else wide, "a", "left")
    else:
        salted = pairs.withColumn("_of", F.lit(1).cast("long"))
    salt = F.pmod(F.xxhash64("b"), F.coalesce("_of", F.lit(1)))
    dealt = salted.select("a", "b", F.pmod(F.xxhash64("a", salt), F.lit(parts)).alias("part"))
    needed = sets_of(dealt.select(F.col("part").alias("to"), F.explode(F.array("a", "b")).alias("cls")))

    def check(left: pa.Table, right: pa.Table) -> pa.Table:
        grams = {c: np.frombuffer(g, np.uint64) for c, g in zip(right["cls"].to_pylist(), right["grams"].to_pylist())}
        found = []
        for a, b in zip(left["a"].to_pylist(), left["b"].to_pylist()):
            x, y = grams[a], grams[b]
            shared = len(np.intersect1d(x, y, assume_unique=True))
            if 100 * shared >= percent * (len(x) + len(y) - shared):
                found.append((a, b, shared))
        cols = list(zip(*found)) or [(), (), ()]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("a", "b", "shared"), cols)})

    return dealt.groupBy("part").cogroup(needed.groupBy("to")).applyInArrow(check, "a long, b long, shared long")


def cross_pairs(buckets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, n_a, n_b) of classes of different components that share a bucket and pass the
    length and positional filters, and the suffix filter on sketches folded to one size.

    ``buckets``: bucket, cls, comp, n, pos, fold. A pair that shares many buckets leaves a task once;
    pairs are dealt by both members, packed, and come out once.
    """
    parts = int(buckets.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)) if batches else None
        if table is None or not table.num_rows:
            return
        col = {c: table[c].combine_chunks().to_numpy(zero_copy_only=False) for c in ("bucket", "cls", "comp", "n", "pos")}
        bits = np.frombuffer(b"".join(table["fold"].to_pylist()), np.uint64).reshape(table.num_rows, -1)
        order = np.lexsort((col["n"], col["bucket"]))
        col = {c: v[order] for c, v in col.items()}
        bits = bits[order]
        edge = np.flatnonzero(np.concatenate([[True], col["bucket"][1:] != col["bucket"][:-1], [True]]))
        end = np.repeat(edge[1:], np.diff(edge))  # of each row's bucket
        # rows go by size within a bucket: the partners of a row are the next ones up to a size
        reach = np.empty(len(order), np.int64)
        for lo, hi in zip(edge, edge[1:]):
            reach[lo:hi] = lo + np.searchsorted(col["n"][lo:hi] * percent, col["n"][lo:hi] * 100, "right")
        reach = np.minimum(reach, end)
        ahead = reach - np.arange(len(order)) - 1
        total = np.concatenate([[0], np.cumsum(ahead)])
        lo, seen = 0, []
        while lo < len(order):
            hi = max(lo + 1, int(np.searchsorted(total, total[lo] + _TILE, "right")) - 1)
            for i, j in _tiles(lo, hi, ahead):
                c = col["comp"][i] != col["comp"][j]
                i, j = i[c], j[c]
                c = possible(col["n"][i], col["n"][j], col["pos"][i], col["pos"][j], percent)
                i, j = i[c], j[c]
                apart = np.bitwise_count(bits[i] ^ bits[j]).sum(axis=1, dtype=np.int64)
                both = col["n"][i] + col["n"][j]
                c = (100 + percent) * apart <= (100 - percent) * both
                a, b = col["cls"][i[c]], col["cls"][j[c]]
                if len(a):
                    swap = a > b
                    na, nb = col["n"][i[c]], col["n"][j[c]]
                    seen.append(np.stack([np.minimum(a, b), np.maximum(a, b), np.where(swap, nb, na), np.where(swap, na, nb)], axis=1))
            if len(seen) > 64:
                seen = [np.unique(np.concatenate(seen), axis=0)]
            lo = hi
        if seen:
            pairs = np.unique(np.concatenate(seen), axis=0)
            to = (mix((pairs[:, 0] ^ mix(pairs[:, 1].view(np.uint64)).view(np.int64)).view(np.uint64)) % np.uint64(parts)).astype(np.int64)
            pairs = pairs[np.argsort(to, kind="stable")]
            cut = np.searchsorted(np.sort(to), np.arange(parts + 1))
            some = np.flatnonzero(np.diff(cut))
            packed = [pack_arrays(*pairs[cut[p] : cut[p + 1]].T) for p in some]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(packed, pa.binary())], names=["part", "packed"])

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [np.stack(unpack_arrays(x), axis=1) for batch in batches for x in batch.column(1).to_pylist()]
        if found:
            pairs = np.unique(np.concatenate(found), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, k]) for k in range(4)], names=["a", "b", "n_a", "n_b"])

    keyed = buckets.withColumn("part", F.pmod(F.xxhash64("bucket"), F.lit(parts)).cast("int"))
    dealt = keyed.repartitionById(parts, F.col("part")).select("bucket", "cls", "comp", "n", "pos", "fold")
    met = dealt.mapInArrow(run, "part int, packed binary").repartitionById(parts, F.col("part"))
    return met.mapInArrow(once, "a long, b long, n_a long, n_b long")


def _tiles(lo: int, hi: int, ahead: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (row, later partner) of rows lo to hi, at most a tile at a time."""
    if hi - lo > 1:
        count = ahead[lo:hi]
        i = np.repeat(np.arange(lo, hi), count)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count)
        yield i, j
        return
    for at in range(0, int(ahead[lo]), _TILE):
        j = lo + 1 + np.arange(at, min(at + _TILE, int(ahead[lo])))
        yield np.full(len(j), lo), j


def link(buckets: DataFrame, sketches: DataFrame, sets_of, percent: int) -> tuple[DataFrame, DataFrame]:
    """(verified links (a, b, shared) that connect every pair of alike classes, directly or by others;
    (node, component) of the classes that have links, without the smallest class of each component).

    ``buckets``: a stored table (bucket, cls, n, pos) of buckets with several classes.
    ``sketches``: a stored table with cls, sketch, fold. ``sets_of`` gives (cls, grams) for a table of classes.
    """
    sketches = small(sketches.select("cls", "sketch", "fold"), F.length("sketch") + F.length("fold") + 24)
    first = buckets.groupBy("bucket").agg(F.min(F.struct("cls", "n", "pos")).alias("c"))
    star = (
        buckets.join(first, "bucket").where("cls != c.cls")
        .where(possible(F.col("n"), F.col("c.n"), F.col("pos"), F.col("c.pos"), percent))
        .groupBy(F.col("c.cls").alias("a"), F.col("cls").alias("b"), F.col("c.n").alias("n_a"), F.col("n").alias("n_b"))
        .agg(F.count("*").alias("together"))
    )
    star = materialize(suffix_filter(star, sketches, percent), "links-star")
    best = star.groupBy("b").agg(F.max_by(F.struct("a", "n_a", "n_b"), F.struct("together", "a")).alias("m"))
    links = materialize(verify(best.select("m.a", "b", "m.n_a", "m.n_b"), sets_of, percent), "links-best")
    comps = small(_rooted(links), _NODE_BYTES)
    links, comps = _more(links, comps, verify(_apart(star, comps), sets_of, percent))
    labelled = buckets.join(comps, buckets.cls == comps.node, "left").withColumn("comp", F.coalesce("component", "cls")).drop("node", "component")
    open_ = labelled.groupBy("bucket").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x != y").select("bucket")
    cross = cross_pairs(labelled.join(open_, "bucket", "left_semi").join(sketches.select("cls", "fold"), "cls"), percent)
    cross = suffix_filter(cross, sketches, percent)
    return _more(links, comps, verify(cross, sets_of, percent))


def _more(links: DataFrame, comps: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links and components with the links found since. Only the components that these links join are
    worked out; the nodes known before take over what becomes of their component."""
    found = materialize(found, "links-more")
    joining = _ends(found, comps).select(F.col("_ca").alias("a"), F.col("_cb").alias("b")).where("a != b")
    joined = _rooted(joining)
    if joined.isEmpty():
        return links.unionByName(found), comps
    joined = small(joined, _NODE_BYTES)
    moved = joined.select(F.col("node").alias("component"), F.col("component").alias("_to"))
    known = comps.join(moved, "component", "left").select("node", F.coalesce("_to", "component").alias("component"))
    return links.unionByName(found), small(materialize(known.unionByName(joined), "links-components"), _NODE_BYTES)


def _ends(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """The pairs with the components of their ends, _ca and _cb; a class without links is its own."""
    x = comps.select(F.col("node").alias("a"), F.col("component").alias("_ca"))
    y = comps.select(F.col("node").alias("b"), F.col("component").alias("_cb"))
    both = pairs.join(x, "a", "left").join(y, "b", "left")
    return both.withColumns({"_ca": F.coalesce("_ca", "a"), "_cb": F.coalesce("_cb", "b")})


def _apart(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """The pairs whose ends are in different components."""
    return _ends(pairs, comps).where("_ca != _cb").drop("_ca", "_cb")
