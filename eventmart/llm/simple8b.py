"""Token ids in Simple-8b files.

A 64-bit word holds a 4-bit selector and as many ids as fit at the selector's width. Ids come in
blocks; a block starts at a word, and the footer gives each block's first word and id count, so
blocks are coded and decoded side by side in numpy. An id too wide for any selector takes an
escape word followed by the id itself.

File: magic, blocks of words, then the footer as numpy arrays (document ids, tokens per document,
words per block, ids per block) with their sizes, then the footer's length. A footer is read first.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventmart.llm.textbatch import ARROW_ROWS
from eventmart.session import materialize, scratch_path

MAGIC = b"S8BTOK01"
# (ids in a word, bits of each); the selector is the place in this table, escape comes last
SELECTORS = ((60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
ESCAPE = 15
BLOCK = 256  # ids
GROUP = 1024  # blocks coded at a time
FILE_IDS = 1 << 21  # a file is closed once it has this many
JOINED = 4096  # new words encoded as one string
CUT_CHARS = 1 << 22  # texts cut into words at a time, in characters
CACHED_PIECES = 1_200_000  # words whose ids a worker remembers, before it forgets the rare ones
_COUNT = np.array([c for c, _ in SELECTORS] + [0, 1], np.int64)


_SHORT = np.maximum(np.ceil(np.log2(np.arange(1 << 16) + 1)), 1).astype(np.uint8)  # bits of each 16-bit id


def _bits(v: np.ndarray) -> np.ndarray:
    """Bits of each id, 1 for zero."""
    out = np.zeros(len(v), np.uint8)
    for shift in (0, 16, 32, 48):
        part = (v >> np.uint64(shift)).astype(np.uint16) if shift else v.astype(np.uint16)
        out = np.where(part > 0, _SHORT[part] + np.uint8(shift), out)
        if v.max() >> np.uint64(shift + 16 if shift < 48 else 63) == 0:
            break
    return np.maximum(out, 1)


def encode(ids: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """(words, words per block) of unsigned 64-bit ids."""
    ids = ids.astype(np.uint64)
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    blocks = -(-n // block)
    left = np.minimum(block - np.arange(n) % block, n - np.arange(n)).astype(np.uint16)  # ids up to the block's end
    width = _bits(ids)
    # the selector with the most ids that all fit from here on, within the block
    choice = np.full(n, ESCAPE, np.uint8)
    widest = np.concatenate([width, np.zeros(64, np.uint8)])
    reach, span = widest.copy(), 1  # reach: widest of the next ``span`` ids
    tables = {1: reach}
    while span < 64:
        reach = np.maximum(reach, np.concatenate([reach[span:], np.zeros(span, np.uint8)]))
        span *= 2
        tables[span] = reach
    for s in range(len(SELECTORS) - 1, -1, -1):
        count, bits = SELECTORS[s]
        k = 1 << (count.bit_length() - 1)
        top = tables[k]
        most = np.maximum(top[:n], top[count - k : count - k + n])
        fits = (most <= bits) & (left >= count)
        choice[fits] = s
    step = _COUNT[choice]
    # all blocks advance together, one word each
    at = np.arange(blocks) * block
    stop = np.minimum(at + block, n)
    rows, place = [], []
    live = np.arange(blocks)
    while len(live):
        rows.append(live)
        place.append(at[live])
        at[live] += step[at[live]]
        live = live[at[live] < stop[live]]
    rows, place = np.concatenate(rows), np.concatenate(place)
    place = place[np.argsort(rows, kind="stable")]  # words in order of ids
    chosen = choice[place]
    size = 1 + (chosen == ESCAPE)
    start = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), np.uint64)
    for s, (count, bits) in enumerate(SELECTORS):
        w = np.flatnonzero(chosen == s)
        value = np.full(len(w), s, np.uint64)
        for j in range(count):
            value |= ids[place[w] + j] << np.uint64(4 + j * bits)
        words[start[w]] = value
    w = np.flatnonzero(chosen == ESCAPE)
    words[start[w]] = ESCAPE
    words[start[w] + 1] = ids[place[w]]
    per_block = np.bincount(place // block, weights=size, minlength=blocks).astype(np.int64)
    return words, per_block


def decode(words: np.ndarray) -> np.ndarray:
    """The ids of whole blocks of words, all selectors of a kind at once."""
    selector = (words & np.uint64(15)).astype(np.int64)
    raw = np.zeros(len(words), bool)  # ids behind an escape are no words of their own
    escapes = np.flatnonzero(selector == ESCAPE)
    for e in escapes.tolist():
        if not raw[e]:
            raw[e + 1] = True
    count = np.where(raw, 0, _COUNT[selector])
    start = np.cumsum(count) - count
    out = np.zeros(int(count.sum()), np.uint64)
    for s, (n, bits) in enumerate(SELECTORS):
        w = np.flatnonzero((selector == s) & ~raw)
        if len(w):
            mask = np.uint64((1 << bits) - 1)
            for j in range(n):
                out[start[w] + j] = (words[w] >> np.uint64(4 + j * bits)) & mask
    e = np.flatnonzero((selector == ESCAPE) & ~raw)
    out[start[e]] = words[e + 1]
    return out


def write_file(out, doc_ids: list, ids: list[np.ndarray]) -> int:
    """Write one file; the number of ids."""
    flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
    out.write(MAGIC)
    per_block, n_words = [np.zeros(0, np.int64)], 0
    for lo in range(0, len(flat), BLOCK * GROUP):
        words, lengths = encode(flat[lo : lo + BLOCK * GROUP])
        out.write(words.astype("<u8").tobytes())
        per_block.append(lengths)
        n_words += len(words)
    arrays = [
        np.array([d is not None for d in doc_ids], np.uint8), np.array([d or 0 for d in doc_ids], np.int64),
        np.array([len(x) for x in ids], np.int64), np.concatenate(per_block).astype(np.uint32),
    ]
    footer = struct.pack("<QQ", n_words, len(arrays)) + b"".join(
        a.dtype.str.encode().ljust(8) + struct.pack("<Q", len(a)) + a.tobytes() for a in arrays
    )
    out.write(footer)
    out.write(struct.pack("<Q", len(footer)))
    return len(flat)


def read_file(data: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    """(document ids, tokens of each, all ids)."""
    if data[:8] != MAGIC:
        raise ValueError("not a Simple-8b token file")
    (size,) = struct.unpack("<Q", data[-8:])
    footer = data[-8 - size : -8]
    n_words, n_arrays = struct.unpack_from("<QQ", footer)
    at, arrays = 16, []
    for _ in range(n_arrays):
        dtype = np.dtype(footer[at : at + 8].decode().strip())
        (n,) = struct.unpack_from("<Q", footer, at + 8)
        arrays.append(np.frombuffer(footer, dtype, n, at + 16))
        at += 16 + n * dtype.itemsize
    known, doc_ids, n_tokens, per_block = arrays
    words = np.frombuffer(data, "<u8", n_words, 8)
    cut = np.concatenate([[0], np.cumsum(per_block.astype(np.int64))])  # first word of each block
    parts = [
        decode(words[cut[b] : cut[min(b + GROUP, len(per_block))]]).astype(np.uint32) for b in range(0, len(per_block), GROUP)
    ]
    ids = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
    return [int(d) if k else None for k, d in zip(known, doc_ids)], n_tokens, ids


def _gather(flat: np.ndarray, start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` that begin at ``start`` and have ``n`` ids, one after another."""
    return flat[np.repeat(start - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]


class _Codes(dict):
    """Numbers strings as they come; ``fresh`` holds those not yet encoded."""

    def __init__(self, known=()):
        super().__init__(known)
        self.fresh: list[str] = []

    def __missing__(self, key: str) -> int:
        self.fresh.append(key)
        return self.setdefault(key, len(self))


class Encoder:
    """Ids of whole texts.

    The vocabulary's pattern cuts a text before each single blank and around each single line feed
    that stand between other characters, and merges never cross its cuts. Such texts are cut there
    too, and a part that came before is looked up. Texts with other blanks are encoded whole.
    """

    _ODD = re.compile("[\x00-\x09\x0b-\x1f\x7f-\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u206f\u3000\ufeff]")

    # a word and the marks behind it: the pattern cuts between them
    _TAILED = re.compile(r"(.*[^\W_])([^\w\s]+)", re.DOTALL).fullmatch

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        (self.feed,) = self._whole(["\n"])[0]
        self._clear()

    def _clear(self) -> None:
        self.codes, self.tails = _Codes(), {}
        self.start, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat, self.hits = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def _forget(self) -> None:
        """Drop the parts met least often, at least half of them."""
        often = max(2, int(np.median(self.hits)) + 1)
        keep = np.flatnonzero(self.hits >= often)
        kept = set(keep.tolist())
        words = [k for k, code in self.codes.items() if code in kept]  # in the order of their codes
        n, start = self.length[keep], self.start[keep]
        new = np.cumsum(n) - n
        self.flat, self.tails = _gather(self.flat, start, n), {}
        self.start, self.length, self.hits = new, n, np.zeros(len(keep), np.int64)
        self.codes = _Codes(zip(words, range(len(words))))

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _plain(self, t: str) -> bool:
        return not (
            not t or t[0] in " \n" or t[-1] in " \n" or "  " in t or " \n" in t or "\n " in t or "\n\n" in t or self._ODD.search(t)
            or any(x in t for x in self.added)
        )

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        out, lo, held = [], 0, 0
        for hi, t in enumerate(texts, 1):
            held += len(t)
            if held >= CUT_CHARS or hi == len(texts):
                out += self._encode(texts[lo:hi])
                lo, held = hi, 0
        return out

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.codes) > CACHED_PIECES:
            self._forget()
        plain = [self._plain(t) for t in texts]
        rest = iter(self._whole([t for t, p in zip(texts, plain) if not p]))
        parts = iter(self._look_up([t for t, p in zip(texts, plain) if p]))
        return [next(parts) if p else np.array(next(rest), np.uint32) for p in plain]

    def _look_up(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of texts that are cut; each different part of them is looked up once."""
        if not texts:
            return []
        # each text starts as after a line feed, whose id is then dropped
        rows = pc.split_pattern(pa.array([("\n" + t).replace("\n", " \n")[1:] for t in texts], pa.large_string()), " ")
        parts = rows.flatten().dictionary_encode()
        code = self._numbers(parts.dictionary.to_numpy(zero_copy_only=False).tolist())
        self._learn()
        at = parts.indices.to_numpy()
        self.hits = np.concatenate([self.hits, np.zeros(len(self.start) - len(self.hits), np.int64)])
        self.hits[code] += np.bincount(at)  # times the part was met
        n = self.length[code]
        near = _gather(self.flat, self.start[code], n)  # the ids of these parts alone, side by side
        flat = _gather(near, (np.cumsum(n) - n)[at], n[at])
        cut = np.concatenate([[0], np.cumsum(n[at])])[rows.offsets.to_numpy()].tolist()
        return [flat[a + 1 : b] for a, b in zip(cut[:-1], cut[1:])]

    def _numbers(self, parts: list[str]) -> np.ndarray:
        """The codes of different parts; those not met before are fresh."""
        code = np.array(list(map(self.codes.get, parts, repeat(-1))), np.int64)
        fresh = np.flatnonzero(code < 0)
        code[fresh] = len(self.codes) + np.arange(len(fresh))
        new = [parts[i] for i in fresh.tolist()]
        self.codes.update(zip(new, code[fresh].tolist()))
        self.codes.fresh += new
        return code

    def _learn(self) -> None:
        """Encode the fresh parts: many in one string, each ended (or begun) by a line feed, whose id
        stands in no other place and so marks where the next part begins."""
        get, fresh = self.codes.__getitem__, self.codes.fresh
        first = len(self.start)
        bare, fed, tailed, stems, tails = [], [], [], [], []
        for i, k in enumerate(fresh):  # the list grows by the stems
            if not k[-1].isalnum() and (m := self._TAILED(k)):
                tailed.append(i)
                stems.append(get(m[1]))
                tails.append(m[2])
            else:
                (fed if k[0] == "\n" else bare).append(i)
        self.start = np.concatenate([self.start, np.zeros(len(fresh), np.int64)])
        self.length = np.concatenate([self.length, np.zeros(len(fresh), np.int64)])
        flat, end = [self.flat], len(self.flat)
        for feed, which in ((False, bare), (True, fed)):
            for lo in range(0, len(which), JOINED):
                some = which[lo : lo + JOINED]
                text = "".join([fresh[i] for i in some]) if feed else " " + "\n ".join([fresh[i] for i in some]) + "\n"
                ids = np.array(self._whole([text])[0], np.uint32)
                mark = np.flatnonzero(ids == self.feed)
                if len(mark) != len(some):
                    raise ValueError("this vocabulary does not cut at line feeds")
                cut = np.append(mark, len(ids)) if feed else np.concatenate([[-1], mark]) + 1
                place = first + np.array(some, np.int64)
                self.start[place] = end + cut[:-1]
                self.length[place] = np.diff(cut) - (not feed)
                flat.append(ids)
                end += len(ids)
        unknown = [t for t in dict.fromkeys(tails) if t not in self.tails]
        for tail, ids in zip(unknown, self._whole(unknown)):
            self.tails[tail] = end, len(ids)
            flat.append(np.array(ids, np.uint32))
            end += len(ids)
        if len(flat) > 1:
            self.flat = np.concatenate(flat)
        if tailed:
            behind = np.array([self.tails[t] for t in tails], np.int64)
            start = np.column_stack([self.start[stems], behind[:, 0]])
            n = np.column_stack([self.length[stems], behind[:, 1]])
            self.flat = np.concatenate([self.flat, _gather(self.flat, start.ravel(), n.ravel())])
            place, n = first + np.array(tailed, np.int64), n.sum(axis=1)
            self.start[place], self.length[place] = end + np.cumsum(n) - n, n
        fresh.clear()


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker and vocabulary, kept between batches and tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """(document ids, texts) of as many batches as make CUT_CHARS characters: what is done once a call is done less often."""
    keys, texts, held = [], [], 0
    for batch in batches:
        some = batch.column(1).to_pylist()
        keys += batch.column(0).to_pylist()
        texts += some
        held += sum(map(len, some))
        if held >= CUT_CHARS:
            yield keys, texts
            keys, texts, held = [], [], 0
    if keys:
        yield keys, texts


def write(docs: DataFrame, vocabulary: str, folder: str, end_id: int = 0) -> DataFrame:
    """Write the ids of all texts, ``end_id`` after each, into files under ``folder``.

    Returns the stored manifest, a row per file: part, file, path, n_docs, n_ids; files in the order of
    (part, file) hold the documents in ascending id, nulls first, equal ids by text hash. Null and
    empty texts have the end id only; repeated rows are written each; other columns are ignored; an
    empty table gives no file. Every attempt writes files of its own name, and the manifest lists those of
    the attempts that succeeded.
    """
    spark = docs.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    pafs.FileSystem.from_uri(folder)[0].create_dir(pafs.FileSystem.from_uri(folder)[1], recursive=True)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col("doc_id").asc_nulls_first()]
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order, F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder)
        part, attempt, done = TaskContext.get().partitionId(), uuid.uuid4().hex[:12], []
        encode_texts = encoder(vocabulary).encode
        doc_ids, ids, held = [], [], 0

        def close():
            path = f"{base}/part-{part:06d}-{len(done):05d}-{attempt}.s8b"
            with fs.open_output_stream(path) as out:
                done.append((part, len(done), path, len(doc_ids), write_file(out, doc_ids, ids)))

        end = np.array([end_id], np.uint32)
        for keys, texts in _gathered(batches):
            for i, x in zip(keys, encode_texts(texts)):
                doc_ids.append(i)
                ids.append(np.concatenate([x, end]))
                held += len(x) + 1
                if held >= FILE_IDS:
                    close()
                    doc_ids, ids, held = [], [], 0
        if doc_ids:
            close()
        cols = list(zip(*done)) or [()] * 5
        types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["part", "file", "path", "n_docs", "n_ids"])

    return materialize(dealt.mapInArrow(run, "part long, file long, path string, n_docs long, n_ids long"), "token-manifest")


def _files(manifest: DataFrame) -> DataFrame:
    """(path, base) of the files, with the number of ids in all files before; dealt to tasks."""
    spark = manifest.sparkSession
    files = W.orderBy("part", "file")  # a row per file
    base = manifest.withColumn("base", F.sum("n_ids").over(files.rowsBetween(W.unboundedPreceding, 0)) - F.col("n_ids"))
    return base.select("path", "base").repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def _contents(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[tuple]:
    """(document ids, first id of each, tokens of each, all ids) of one file at a time."""
    fs = pafs.FileSystem.from_uri(folder)[0]
    for batch in batches:
        for path, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            with fs.open_input_stream(path) as f:
                doc_ids, n, ids = read_file(f.read())
            yield doc_ids, first + np.cumsum(n) - n, n, ids


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """Per document of the files: doc_id, start (ids before it), n_tokens, ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, start, n, ids in _contents(batches, folder):
            cut = np.concatenate([[0], np.cumsum(n)])
            for lo in range(0, len(doc_ids), ARROW_ROWS):
                hi = min(lo + ARROW_ROWS, len(doc_ids))
                lists = pa.ListArray.from_arrays(
                    pa.array(cut[lo : hi + 1] - cut[lo], pa.int32()), pa.array(ids[cut[lo] : cut[hi]].astype(np.int64))
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids[lo:hi], pa.int64()), pa.array(start[lo:hi]), pa.array(n[lo:hi]), lists],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    return _files(manifest).mapInArrow(run, "doc_id long, start long, n_tokens long, ids array<long>")


def digest(manifest: DataFrame, folder: str) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens and the CRC-32 of its ids as 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, start, n, ids in _contents(batches, folder):
            raw, cut = ids.astype("<u4"), np.concatenate([[0], np.cumsum(n)])
            crc = [zlib.crc32(raw[a:b].tobytes()) for a, b in zip(cut[:-1], cut[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.array(start), pa.array(n), pa.array(crc, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return _files(manifest).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def new_folder(spark) -> str:
    return scratch_path(spark, "tokens")
