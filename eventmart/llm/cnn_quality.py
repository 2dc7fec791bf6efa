"""Quality of texts by a convolutional network over their bytes.

A filter is a table of weights by offset and byte value, so a convolution is a sum of looked-up rows.
Filter outputs are max-pooled over chunks of ``2 * BLOCK`` bytes, which overlap by half and cover the
whole text; the mean and the maximum over a text's chunks go into one logistic unit. The filters
and the unit are trained together by gradient descent, in numpy on the driver, on a bounded sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.textbatch import packed, slices

FILTERS = 24
WIDTH = 6
BLOCK = 256
SAMPLE_PER_CLASS = 1500  # labelled texts of each class that are learned from, at most
STEPS = 450  # of gradient descent, with BATCH texts each
BATCH = 64
THRESHOLD = 0.7


@dataclass
class Model:
    filters: np.ndarray  # (WIDTH, 256, FILTERS)
    bias: np.ndarray  # (FILTERS,)
    unit: np.ndarray  # (2 * FILTERS,)
    offset: float

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features @ self.unit + self.offset, -30, 30).astype(np.float64)))


def convolve(filters: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """(n, FILTERS) outputs at the first n places of ``data``, which has WIDTH - 1 bytes more."""
    out = np.take(filters[0], data[:n], axis=0)
    term = np.empty_like(out)
    for j in range(1, WIDTH):
        np.take(filters[j], data[j : j + n], axis=0, out=term, mode="clip")
        out += term
    return out


def _pool(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts, 2 * FILTERS) features of packed texts; zeros for an empty one.

    Texts are taken with WIDTH - 1 zero bytes after each, so no filter sees two texts.
    """
    size = np.diff(offsets)
    out = np.zeros((len(size), 2 * FILTERS), np.float32)
    full = np.flatnonzero(size)
    if not len(full):
        return out
    size, begin = size[full], offsets[:-1][full]
    padded = np.zeros(int((size + WIDTH - 1).sum()), np.uint8)
    at = np.cumsum(size + WIDTH - 1) - (size + WIDTH - 1)
    shift = np.repeat(at - begin, size)
    source = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    padded[source + shift] = data[source]
    blocks = -(-size // BLOCK)
    first = np.cumsum(blocks) - blocks
    number = np.arange(int(blocks.sum())) - np.repeat(first, blocks)
    start = np.repeat(at, blocks) + number * BLOCK
    stop = np.minimum(start + BLOCK, np.repeat(at + size, blocks))
    pooled = np.empty((len(start), FILTERS), np.float32)
    lo = 0
    while lo < len(start):  # some blocks at a time, so their outputs stay in cache
        hi = max(lo + 1, int(np.searchsorted(stop, start[lo] + (1 << 15), "right")))
        a, b = int(start[lo]), int(stop[hi - 1])
        z = convolve(model.filters, padded[a : b + WIDTH - 1], b - a)
        edges = np.stack([start[lo:hi], stop[lo:hi]], axis=1).ravel() - a
        pooled[lo:hi] = np.maximum.reduceat(z, np.minimum(edges, len(z) - 1)[:-1] if edges[-1] == len(z) else edges, axis=0)[::2]
        lo = hi
    pooled = np.tanh(pooled + model.bias)
    last = number == np.repeat(blocks - 1, blocks)
    single = np.repeat(blocks == 1, blocks)
    chunk = np.where(last[:, None], pooled, np.maximum(pooled, np.roll(pooled, -1, axis=0)))
    keep = ~last | single
    chunk, count = chunk[keep], np.maximum(blocks - 1, 1)
    head = np.cumsum(count) - count
    out[full, :FILTERS] = np.add.reduceat(chunk, head, axis=0) / count[:, None]
    out[full, FILTERS:] = np.maximum.reduceat(chunk, head, axis=0)
    return out


def train(chunks: list[np.ndarray], labels: np.ndarray, prior: float, seed: int = 7) -> Model:
    """Fit on texts given as (chunks, 2 * BLOCK + WIDTH - 1) byte arrays. ``prior``: share of label 1
    among all labelled texts; classes count alike while learning, the offset is then set right."""
    rng = np.random.default_rng(seed)
    p = {
        "filters": rng.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32),
        "bias": np.zeros(FILTERS, np.float32),
        "unit": rng.normal(0, 0.1, 2 * FILTERS).astype(np.float32),
        "offset": np.zeros(1, np.float32),
    }
    logit = float(np.log(max(prior, 1e-3) / max(1 - prior, 1e-3)))
    if len(set(labels.tolist())) < 2:
        return Model(p["filters"], p["bias"], np.zeros(2 * FILTERS, np.float32), logit if len(labels) else 0.0)
    weight = np.where(labels == 1, 0.5 / (labels == 1).mean(), 0.5 / (labels == 0).mean())
    m = {k: np.zeros_like(v) for k, v in p.items()}
    s = {k: np.zeros_like(v) for k, v in p.items()}
    places, order = 2 * BLOCK, np.zeros(0, np.int64)
    for step in range(1, STEPS + 1):
        while len(order) < BATCH:  # the texts go round in ever new order
            order = np.append(order, rng.permutation(len(chunks)))
        batch, order = order[:BATCH], order[BATCH:]
        x = np.concatenate([chunks[i] for i in batch])
        owner = np.repeat(np.arange(len(batch)), [len(chunks[i]) for i in batch])
        count = np.bincount(owner, minlength=len(batch)).astype(np.float32)
        top = np.empty((len(x), FILTERS), np.int64)
        z = np.empty((len(x), FILTERS), np.float32)
        for c in range(0, len(x), 64):
            part = x[c : c + 64]
            flat = convolve(p["filters"], np.append(part.ravel(), np.zeros(WIDTH - 1, np.uint8)), part.size)
            flat = flat.reshape(len(part), -1, FILTERS)[:, :places]
            top[c : c + 64] = flat.argmax(axis=1)
            z[c : c + 64] = flat.max(axis=1)
        pooled = np.tanh(z + p["bias"])
        head = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        mean = np.add.reduceat(pooled, head, axis=0) / count[:, None]
        high = np.maximum.reduceat(pooled, head, axis=0)
        f = np.concatenate([mean, high], axis=1)
        y = 1 / (1 + np.exp(-np.clip(f @ p["unit"] + p["offset"], -30, 30)))
        d = ((y - labels[batch]) * weight[batch] / len(batch)).astype(np.float32)
        df = d[:, None] * p["unit"]
        dp = (df[:, :FILTERS] / count[:, None])[owner] + np.where(pooled == high[owner], df[owner, FILTERS:], 0)
        dz = dp * (1 - pooled**2)
        g = {"unit": f.T @ d + 1e-4 * p["unit"], "offset": d.sum(keepdims=True), "bias": dz.sum(axis=0)}
        g["filters"] = np.zeros_like(p["filters"])
        rows, cols = np.arange(len(x))[:, None], np.broadcast_to(np.arange(FILTERS), top.shape)
        for j in range(WIDTH):
            np.add.at(g["filters"][j], (x[rows, top + j], cols), dz)
        for k in p:
            m[k] += 0.1 * (g[k] - m[k])
            s[k] += 0.01 * (g[k] ** 2 - s[k])
            p[k] -= 0.01 * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.99**step)) + 1e-8)
    return Model(p["filters"], p["bias"], p["unit"], float(p["offset"][0]) + logit)


def chunks_of(data: bytes) -> np.ndarray:
    """All chunks of a text, as scores pool them: 2 * BLOCK bytes from each BLOCK on, zeros behind the end."""
    size, n = 2 * BLOCK + WIDTH - 1, max(1, -(-len(data) // BLOCK) - 1)
    padded = np.frombuffer(data.ljust((n - 1) * BLOCK + size, b"\0"), np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, size)[: (n - 1) * BLOCK + 1 : BLOCK]


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from the whole of at most SAMPLE_PER_CLASS texts of each class, taken by a hash of their id among the
    labelled rows that are not held out. Null labels are left out; of two labels for an id one is used."""
    known = labels.where(~held_out("doc_id") & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    counts = {r.quality: r["count"] for r in known.groupBy("quality").count().collect()}
    chosen = [known.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_PER_CLASS) for q in (0, 1)]
    sample = F.broadcast(chosen[0].union(chosen[1]))  # bounded by the two limits
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(sample, "doc_id")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = [chunks_of((t or "").encode("utf-8", "surrogatepass")).tobytes() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), b.column(2).cast(pa.int32()), pa.array(raw, pa.binary())], names=["doc_id", "quality", "chunks"])

    got = sorted(
        (r.doc_id, r.quality, bytes(r.chunks))
        for r in rows.mapInArrow(cut, "doc_id long, quality int, chunks binary").dropDuplicates(["doc_id"]).collect()
    )
    chunks = [np.frombuffer(c, np.uint8).reshape(-1, 2 * BLOCK + WIDTH - 1) for _, _, c in got]
    total = sum(counts.values())
    return train(chunks, np.array([q for _, q, _ in got]), counts.get(1, 0) / total if total else 0.5)


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted.

    A null or empty text gets the score of no evidence. Repeated rows are scored each, a null id is
    not held out, other columns are ignored, an empty table gives an empty result.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = packed(batch.column(2))
            parts = [shared.value.score(_pool(shared.value, data, offsets[lo : hi + 1])) for lo, hi in slices(offsets, 1 << 20)]
            s = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select("doc_id", held_out("doc_id").alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {id_type}, held_out boolean, score double, predicted int")
