"""Arrow text batches as numpy arrays: words and word-shingle hashes without a loop over words.

Words are runs of bytes other than 0x20 and 0x09-0x0D. These bytes never occur inside a
multi-byte UTF-8 sequence, so cutting bytes equals cutting code points.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard

ARROW_ROWS = 256  # rows of one Arrow batch: bounds a Python worker's memory when texts are long
_SLICE = 1 << 20  # bytes hashed at a time: temporaries of 8 bytes a byte stay in cache
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES = np.random.Generator(np.random.PCG64(20240501)).integers(1, 1 << 64, 256, dtype=np.uint64)
_MIX = [np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def prepare(spark):
    """Bound the rows of an Arrow batch for the Python stages of this session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def packed(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    values = column.buffers()[2]
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * _MIX[0]
    h = (h ^ (h >> np.uint64(27))) * _MIX[1]
    return h ^ (h >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base & (1 << 64) - 1))
    out[:1] = 1
    return np.multiply.accumulate(out)


_tables: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_tables.get("up", ())) < n:
        size = 1 << max(20, int(n - 1).bit_length())
        _tables["up"], _tables["down"] = powers(_BASE, size), powers(_BASE_INVERSE, size)
    return _tables["up"][:n], _tables["down"]


def word_bounds(data: np.ndarray, offsets: np.ndarray, blank: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of all words, runs of bytes that are not ``blank``; a word ends with its text."""
    inside = ~blank[data]
    first, last = inside.copy(), inside.copy()
    if len(data):
        cut = np.zeros(len(data) + 1, bool)
        cut[offsets] = True
        first[1:] &= ~inside[:-1] | cut[1:-1]
        last[:-1] &= ~inside[1:] | cut[1:-1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """64-bit polynomial hashes of the words, from prefix sums over slices of whole words."""
    out = np.empty(len(starts), np.uint64)
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + _SLICE, "right")))
        a, b = int(starts[lo]), int(ends[hi - 1])
        part = _LOWER[data[a:b]] if lower else data[a:b]
        up, down = _powers(b - a)
        total = np.zeros(b - a + 1, np.uint64)
        np.cumsum(_BYTES[part] * up, out=total[1:])
        s, e = starts[lo:hi] - a, ends[lo:hi] - a
        out[lo:hi] = mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
        lo = hi
    return out


def shingles(data: np.ndarray, offsets: np.ndarray, width: int, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets per text) of the word shingles in text order.

    A text of fewer words has its whole sequence as one shingle; one without words has none.
    """
    starts, ends = word_bounds(data, offsets)
    words = word_hashes(data, starts, ends, lower)
    first = np.searchsorted(starts, offsets)  # of each text in the words
    n = np.diff(first)
    count = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    at = np.concatenate([[0], np.cumsum(count)])
    begin = np.arange(at[-1]) - np.repeat(at[:-1], count) + np.repeat(first[:-1], count)
    size = np.repeat(np.minimum(n, width), count)
    padded = np.concatenate([words, np.zeros(width, np.uint64)])
    h = size.astype(np.uint64)
    for j, c in enumerate(powers(_BASE ^ 0x5555, width + 1)[1:]):
        h = h + np.where(size > j, padded[begin + j], np.uint64(0)) * c
    return mix(h), at


def slices(offsets: np.ndarray, limit: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or one row."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi
        lo = hi


def pack_arrays(*arrays: np.ndarray) -> bytes:
    """Integer arrays as one compressed value; byte planes are kept together, which compresses well."""
    parts = [struct.pack("<I", len(arrays))]
    for a in arrays:
        parts.append(struct.pack("<4sQ", a.dtype.str[1:].encode(), len(a)))
        parts.append(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T.tobytes() if len(a) else b"")
    return zstandard.compress(b"".join(parts), 1)


def unpack_arrays(blob: bytes) -> list[np.ndarray]:
    raw = zstandard.decompress(blob)
    (n,) = struct.unpack_from("<I", raw)
    at, out = 4, []
    for _ in range(n):
        kind, size = struct.unpack_from("<4sQ", raw, at)
        dtype = np.dtype(kind.rstrip(b"\0").decode())
        at += 12
        planes = np.frombuffer(raw, np.uint8, size * dtype.itemsize, at).reshape(dtype.itemsize, size)
        out.append(np.ascontiguousarray(planes.T).view(dtype).reshape(size))
        at += size * dtype.itemsize
    return out
