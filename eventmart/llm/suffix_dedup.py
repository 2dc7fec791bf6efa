"""Byte strings of a given length that repeat across documents, found with suffix arrays.

A string of ``LENGTH`` bytes is dealt by the smallest hash of its 16-byte pieces, so equal strings
meet in one shard. Consecutive strings of a document with the same smallest hash travel as one region.

1. Smallest hashes that occur in one document only are set aside: no string with them repeats.
2. The regions of the others are dealt to shards. Each shard joins its distinct regions to one text,
   builds its suffix array by induced sorting and the permuted common prefixes; a run of suffixes with
   common prefixes of ``LENGTH`` is one string, and its smallest document owns it.
3. Strings that another, smaller document owns are reported as spans, gathered per document.

What many documents have is resolved where it is met: a task sends a region once, with its smallest
document, and reports its other documents itself. Hashes only choose where strings meet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.suffix_array import permuted_lcp, suffix_array
from eventmart.llm.textbatch import mix, pack_arrays, packed, unpack_arrays

LENGTH = 50
_GRAM = 16
_WINDOW = LENGTH - _GRAM + 1
_PIECE = 1 << 19  # strings hashed at a time
_FLUSH_HASHES = 1 << 20  # a map task deals out what it holds beyond this many hashes
_FLUSH_BYTES = 32 << 20  # or bytes of regions
_TEXT_BYTES = 2 << 20  # of one suffix array, about
SHARD_BYTES = 16 << 20  # input bytes per shard
NO_ID = (1 << 63) - 1  # a null id is larger than every id
_SEPARATOR = 0xFF  # never in UTF-8; strings that reach beyond a region do not count anyway
_TABLE = np.random.Generator(np.random.PCG64(50)).integers(1, 1 << 64, 256, dtype=np.uint64)
_MULTIPLIER = 0x9E3779B97F4A7C15


def _smallest_hashes(data: np.ndarray) -> np.ndarray:
    """For each string of LENGTH bytes, the smallest hash of its grams."""
    h, base, span = _TABLE[data], _MULTIPLIER, 1
    while span < _GRAM:
        h = h[:-span] * np.uint64(base) + h[span:]
        base = base * base % (1 << 64)
        span *= 2
    h = mix(h) >> np.uint64(8)
    span = 1
    while 2 * span <= _WINDOW:
        h = np.minimum(h[:-span], h[span:])
        span *= 2
    rest = _WINDOW - span
    return np.minimum(h[:-rest], h[rest:]) if rest else h


def regions(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(hash, first byte, end byte, text number) of runs of strings with one smallest hash."""
    total = len(data) - LENGTH + 1
    for lo in range(0, max(0, total), _PIECE):
        hi = min(lo + _PIECE, total)
        h = _smallest_hashes(data[lo : hi + LENGTH - 1])
        at = np.arange(lo, hi)
        text = np.searchsorted(offsets, at, "right") - 1
        inside = at + LENGTH <= offsets[text + 1]
        new = inside.copy()
        new[1:] &= ~inside[:-1] | (h[1:] != h[:-1]) | (text[1:] != text[:-1])
        first = np.flatnonzero(new)
        if not len(first):
            continue
        # a run ends before the next run or the next string that is not inside
        stop = np.minimum(np.append(first[1:], len(h)), _next_false(inside, first))
        yield h[first], at[first], at[stop - 1] + LENGTH, text[first]


def _next_false(flag: np.ndarray, at: np.ndarray) -> np.ndarray:
    out = np.append(np.flatnonzero(~flag), len(flag))
    return out[np.searchsorted(out, at)]


def _ids(column: pa.Array) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(NO_ID).to_numpy(zero_copy_only=False)


def _starts(*sorted_arrays: np.ndarray) -> np.ndarray:
    """Places where a group of equal values begins."""
    change = np.zeros(max(0, len(sorted_arrays[0]) - 1), bool)
    for a in sorted_arrays:
        change |= a[1:] != a[:-1]
    return np.flatnonzero(np.concatenate([[True], change])) if len(sorted_arrays[0]) else np.zeros(0, np.int64)


def _rows(shard: list[int], blobs: list[bytes], passed: list[bytes]) -> pa.RecordBatch:
    """``passed`` blobs hold finished results; they only need some shard to pass them on."""
    return pa.RecordBatch.from_arrays(
        [
            pa.array(shard, pa.int32()),
            pa.array([False] * len(blobs) + [True] * len(passed), pa.bool_()),
            pa.array(blobs + passed, pa.binary()),
        ],
        names=["shard", "done", "packed"],
    )


def candidates(texts: DataFrame, shards: int) -> DataFrame:
    """(key, hash) of the smallest hashes that occur in several documents. ``texts``: key, text."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, keys, held, salt = [], [], 0, 0
        for batch in batches:
            data, offsets = packed(batch.column(1))
            key = _ids(batch.column(0))
            for h, _, _, text in regions(data, offsets):
                hashes.append(h)
                keys.append(key[text])
                held += len(h)
            if held >= _FLUSH_HASHES:
                yield flush(hashes, keys, salt)
                hashes, keys, held, salt = [], [], 0, salt + 1
        if held:
            yield flush(hashes, keys, salt)

    def flush(hashes: list, keys: list, salt: int) -> pa.RecordBatch:
        h, k = np.concatenate(hashes), np.concatenate(keys)
        order = np.lexsort((k, h))
        h, k = h[order], k[order]
        once = _starts(h, k)
        h, k = h[once], k[once]
        first = _starts(h)
        size = np.diff(np.append(first, len(h)))
        single = np.repeat(size == 1, size)
        several, one_h, one_k = h[first[size > 1]], h[single], k[single]
        to_one, to_several = (one_h % np.uint64(shards)).astype(np.int64), (several % np.uint64(shards)).astype(np.int64)
        a, b = np.argsort(to_one, kind="stable"), np.argsort(to_several, kind="stable")
        cut_a, cut_b = (np.searchsorted(x[o], np.arange(shards + 1)) for x, o in ((to_one, a), (to_several, b)))
        blobs = []
        for s in range(shards):
            i, j = a[cut_a[s] : cut_a[s + 1]], b[cut_b[s] : cut_b[s + 1]]
            blobs.append(pack_arrays(np.diff(one_h[i], prepend=np.uint64(0)), one_k[i], several[j]))
        passed = [pack_arrays(h[~single], k[~single])] if (~single).any() else []
        where = int(mix(np.array([int(h[0]) + salt], np.uint64))[0] % np.uint64(shards))
        return _rows([*range(shards), *[where] * len(passed)], blobs, passed)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, known = [], []
        for batch in batches:
            for done, blob in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if done:
                    h, k = unpack_arrays(blob)
                    yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(h.view(np.int64))], names=["key", "hash"])
                else:
                    steps, k, several = unpack_arrays(blob)
                    parts.append((np.cumsum(steps, dtype=np.uint64), k))
                    known.append(several)
        if parts:
            h, k = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(h, kind="stable")
            h, k = h[order], k[order]
            first = _starts(h)
            size = np.diff(np.append(first, len(h)))
            keep = np.repeat((size > 1) | np.isin(h[first], np.concatenate(known)), size)
            yield pa.RecordBatch.from_arrays([pa.array(k[keep]), pa.array(h[keep].view(np.int64))], names=["key", "hash"])

    dealt = texts.mapInArrow(deal, "shard int, done boolean, packed binary")
    return dealt.repartitionById(shards, F.col("shard")).mapInArrow(meet, "key long, hash long")


def owned_elsewhere(found: DataFrame, shards: int) -> DataFrame:
    """(key, variant, start, end) spans of strings that a smaller document has.

    ``found``: key, variant, text, hashes, and columns that are not looked at."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: dict[bytes, int] = {}
        hashes, rows, held, salt = [], [], 0, 0
        for batch in batches:
            batch = batch.filter(batch.column("hashes").is_valid())
            data, offsets = packed(batch.column("text"))
            key, variant = _ids(batch.column("key")), batch.column("variant").to_numpy()
            lists = batch.column("hashes")
            of = np.repeat(np.arange(len(key)), lists.value_lengths().to_numpy(zero_copy_only=False))
            wanted = np.unique(_tagged(lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64), of))
            raw = data.tobytes()
            for h, start, end, text in regions(data, offsets):
                hit = np.isin(_tagged(h, text), wanted)
                h, start, end, text = h[hit], start[hit], end[hit], text[hit]
                number = np.empty(len(h), np.int64)
                for i, (x, y, z) in enumerate(zip(start.tolist(), end.tolist(), h.tolist())):
                    n = number[i] = table.setdefault(raw[x:y], len(table))
                    if n == len(hashes):
                        hashes.append(z)
                        held += y - x
                rows.append((number, key[text], variant[text], start - offsets[text], end - start))
            if held >= _FLUSH_BYTES:
                yield flush(table, hashes, rows, salt)
                table, hashes, rows, held, salt = {}, [], [], 0, salt + 1
        if table:
            yield flush(table, hashes, rows, salt)

    def flush(table: dict, hashes: list, rows: list, salt: int) -> pa.RecordBatch:
        content, h = list(table), np.array(hashes, np.uint64)
        number, key, variant, start, size = (np.concatenate(x) for x in zip(*rows))
        number, key, variant, start, low, spans = _resolve(number, key, variant, start, size)
        shard = (h % np.uint64(shards)).astype(np.int64)
        part = ((h // np.uint64(shards)) & np.uint64(0xFFFF)).astype(np.uint16)
        by = np.argsort(shard, kind="stable")
        cut = np.searchsorted(shard[by], np.arange(shards + 1))
        first = np.searchsorted(number, np.arange(len(content) + 1))
        to, blobs = [], []
        for s in range(shards):
            some = by[cut[s] : cut[s + 1]]
            if len(some):
                text = np.frombuffer(b"".join(content[i] for i in some), np.uint8)
                length = np.array([len(content[i]) for i in some], np.uint32)
                places = (first[some + 1] - first[some]).astype(np.uint32)
                at = np.concatenate([np.arange(first[i], first[i + 1]) for i in some])
                to.append(s)
                blobs.append(pack_arrays(part[some], length, low[some], places, variant[at], start[at], text))
        passed = [pack_arrays(*spans)] if len(spans[0]) else []
        where = int(mix(np.array([int(h[0]) + salt], np.uint64))[0] % np.uint64(shards))
        return _rows([*to, *[where] * len(passed)], blobs, passed)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            for done, blob in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if done:
                    yield _spans(unpack_arrays(blob))
                else:
                    held.append(blob)
        # equal strings have equal hashes and so one part: groups of parts keep suffix arrays small
        groups = max(1, sum(map(len, held)) * 2 // _TEXT_BYTES)  # compressed by about two
        tables: list[dict[bytes, int]] = [{} for _ in range(groups)]
        rows: list[list[tuple]] = [[] for _ in range(groups)]
        while held:
            part, length, low, places, variant, start, text = unpack_arrays(held.pop())
            end, place, raw = np.cumsum(length, dtype=np.int64), np.cumsum(places, dtype=np.int64), text.tobytes()
            group = (part.astype(np.int64) * groups) >> 16
            number = np.empty(len(part), np.int64)
            for i, (g, y, n) in enumerate(zip(group.tolist(), end.tolist(), length.tolist())):
                number[i] = tables[g].setdefault(raw[y - n : y], len(tables[g]))
            of = np.repeat(np.arange(len(part)), places)
            for g in np.unique(group).tolist():
                mine = np.flatnonzero(group[of] == g)
                r = of[mine]
                rows[g].append((number[r], low[r], variant[mine], start[mine], length[r].astype(np.int64)))
        for g in range(groups):
            if rows[g]:
                yield _spans(_group_spans(list(tables[g]), *(np.concatenate(x) for x in zip(*rows[g]))))
                tables[g], rows[g] = {}, []

    dealt = found.mapInArrow(deal, "shard int, done boolean, packed binary")
    return dealt.repartitionById(shards, F.col("shard")).mapInArrow(meet, "key long, variant int, start long, end long")


def _tagged(hashes: np.ndarray, text: np.ndarray) -> np.ndarray:
    return mix(hashes + text.astype(np.uint64) * np.uint64(_MULTIPLIER))


def _spans(arrays) -> pa.RecordBatch:
    kinds = np.int64, np.int32, np.int64, np.int64
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(a, t)) for a, t in zip(arrays, kinds)], names=["key", "variant", "start", "end"])


def _resolve(number: np.ndarray, key: np.ndarray, variant: np.ndarray, start: np.ndarray, size: np.ndarray):
    """Split the places of regions: those of a region's smallest document stay, the others are spans.

    Returns number, key, variant and start of the places that stay (by region), the smallest document
    of each region, and (key, variant, start, end) of the spans."""
    order = np.lexsort((key, number))
    number, key, variant, start, size = number[order], key[order], variant[order], start[order], size[order]
    first = _starts(number)
    low = key[first]
    other = key != np.repeat(low, np.diff(np.append(first, len(number))))
    spans = key[other], variant[other], start[other], start[other] + size[other]
    return number[~other], key[~other], variant[~other], start[~other], low, spans


def _group_spans(content: list[bytes], number, key, variant, start, size):
    """Spans found among some regions, given with their places."""
    number, key, variant, start, low, spans = _resolve(number, key, variant, start, size)
    region, a, b = foreign_strings(content, low)
    first = np.searchsorted(number, np.arange(len(content) + 1))
    count = (first[1:] - first[:-1])[region]
    at = np.repeat(first[region] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
    found = key[at], variant[at], start[at] + np.repeat(a, count), start[at] + np.repeat(b, count)
    return tuple(np.concatenate(x) for x in zip(spans, found))


def foreign_strings(content: list[bytes], owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(region, first byte, end byte) of runs of strings that a region with a smaller owner has too."""
    length = np.array([len(c) for c in content], np.int64)
    text = np.frombuffer(bytes([_SEPARATOR]).join(content), np.uint8)
    begin = np.cumsum(length + 1) - (length + 1)
    region = np.repeat(np.arange(len(content), dtype=np.int32), length + 1)[: len(text)]
    inside = np.arange(len(text)) + LENGTH <= (begin + length)[region]
    sa = suffix_array(text, 256)
    sa = sa[inside[sa]]
    common = permuted_lcp(text, sa, LENGTH)[sa]
    own = owner[region[sa]]
    group = np.flatnonzero(np.concatenate([[True], common[1:] < LENGTH])) if len(sa) else np.zeros(0, np.int64)
    least = np.repeat(np.minimum.reduceat(own, group), np.diff(np.append(group, len(sa)))) if len(sa) else own
    hit = np.zeros(len(text) + 1, bool)
    hit[sa[least < own]] = True
    at = np.flatnonzero(hit)
    if not len(at):
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    new = np.concatenate([[True], at[1:] != at[:-1] + 1])
    first, last = at[new], at[np.append(new[1:], True)]
    r = region[first].astype(np.int64)
    return r, first - begin[r], last - begin[r] + LENGTH


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text, key (the id, or NO_ID for null) and variant, which tells texts of one id apart."""
    return docs.select(
        "doc_id", "text", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("key"),
        (F.xxhash64("text") % (1 << 31)).cast("int").alias("variant"),
    )


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(key, spans): byte spans (variant, start, end) of documents that a smaller document has, not yet
    merged. Documents without such spans are absent."""
    texts = keyed(docs)
    spark = docs.sparkSession
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD_BYTES))
    hashes = candidates(texts.select("key", "text"), shards).groupBy("key").agg(F.collect_list("hash").alias("hashes"))
    # the same columns and the same side of the same join as in ``remove``: the texts are shuffled once
    spans = owned_elsewhere(texts.join(hashes, "key", "left"), shards)
    return spans.groupBy("key").agg(F.collect_list(F.struct("variant", "start", "end")).alias("spans"))


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def remove(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept (the bytes left).

    Every byte is removed that lies in a string of LENGTH bytes which also starts in a document with
    a smaller id. A null text is empty; rows that repeat an id are one document and remove nothing from
    each other; null ids count as larger than all others; other columns are ignored; an empty
    table gives an empty result.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = packed(batch.column("text"))
            raw, out = data.tobytes(), []
            variants = batch.column("variant").to_pylist()
            for i, spans in enumerate(batch.column("spans").to_pylist()):
                text = raw[offsets[i] : offsets[i + 1]]
                cut = merge([(s["start"], s["end"]) for s in spans or () if s["variant"] == variants[i]])
                edges = [0, *(x for span in cut for x in span), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
                out.append((len(text), len(text) - len(kept), len(cut), kept))
            cols = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    joined = keyed(docs).join(repeated_spans(docs), "key", "left")
    return joined.mapInArrow(run, f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept binary")


def digest(docs: DataFrame) -> DataFrame:
    return remove(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
