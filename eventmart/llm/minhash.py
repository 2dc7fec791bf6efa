"""Document fingerprints by MinHash over five-word shingles.

Every shingle hash goes through universal hash permutations in vectorised numpy; a signature is the
minimum of each. Signatures are cut into bands; documents that agree in a band are candidates, joined
in Spark, and their exact Jaccard similarity decides.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm import jaccard_join, linking
from eventmart.llm.textbatch import mix, packed, shingles
from eventmart.session import materialize

PERMUTATIONS = 128
BANDS = 32  # of four minima each: two texts of similarity 0.75 share one but for 5 in a million
WIDTH = 5
_STEP = 2048  # shingles at a time: the table of permuted values stays in cache
_random = np.random.Generator(np.random.PCG64(97))
_A = (_random.integers(0, 1 << 32, PERMUTATIONS, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)[:, None]
_B = _random.integers(0, 1 << 32, PERMUTATIONS, dtype=np.uint64).astype(np.uint32)[:, None]


def signatures(texts: list[str]) -> np.ndarray:
    """(texts, PERMUTATIONS) minima of a*x+b modulo 2**32; all ones for a text without words."""
    data, offsets = packed(pa.array(texts, pa.large_string()))
    hashes, at = shingles(data, offsets, WIDTH, lower=True)
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.full((len(texts), PERMUTATIONS), 0xFFFFFFFF, np.uint32)
    for i in range(len(texts)):
        for lo in range(at[i], at[i + 1], _STEP):
            part = x[lo : min(lo + _STEP, at[i + 1])]
            np.minimum(out[i], (_A * part + _B).min(axis=1), out=out[i])
    return out


def fingerprint(signature: np.ndarray) -> str:
    """The low 16 bits of each minimum, as hex."""
    return signature.astype(np.uint16).tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity, row by row: the share of equal cells of the fingerprints."""
    return (a.astype(np.uint16) == b.astype(np.uint16)).mean(axis=-1)


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by as much of the head of ``following``."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def with_next(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (part, look, id, text) dealt so that every row's successor in id order is in its part.

    Parts are ranges of the id, as many as there are shuffle partitions; each part also gets, as a
    ``look`` row, the first row of the next part (the last part: of the first). Only the bounds and
    first ids of the parts come to the driver. Null ids come first.
    """
    spark = df.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    keyed = rows.withColumn("key", F.coalesce(F.col("id").cast("double"), F.lit(float("-inf"))))
    cuts = [] if parts == 1 else keyed.select("key").where("id is not null").approxQuantile("key", [i / parts for i in range(1, parts)], 0.1 / parts)
    splits = [float("-inf"), *sorted(set(cuts) or {0.0}), float("inf")]
    bucketed = Bucketizer(splits=splits, inputCol="key", outputCol="part").transform(keyed).withColumn("part", F.col("part").cast("int"))
    first = sorted((r.part, r.id) for r in bucketed.groupBy("part").agg(F.min_by("id", "key").alias("id")).collect())
    heads = [(p, i, first[k - 1][0]) for k, (p, i) in enumerate(first)]
    id_type = rows.schema["id"].dataType.simpleString()
    table = F.broadcast(spark.createDataFrame(heads, f"part int, head {id_type}, before int"))  # a row per part
    own = F.struct("part", F.lit(False).alias("look"))
    ahead = F.struct(F.col("before").alias("part"), F.lit(True).alias("look"))
    spread = bucketed.join(table, "part").select(
        "id", "text", F.explode(F.when(F.col("id").eqNullSafe(F.col("head")), F.array(own, ahead)).otherwise(F.array(own))).alias("to")
    )
    return (
        spread.select("to.part", "to.look", "id", "text")
        .repartitionById(len(splits) - 1, F.col("part"))
        .sortWithinPartitions("part", "look", F.col("id").asc_nulls_first(), F.xxhash64("text"))
    )


SCHEMA = (
    "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
)


def _compare(ids: list, texts: list[str], schema: pa.Schema) -> pa.RecordBatch:
    """Rows of all but the last text, each against its successor."""
    new = [edited(a, b) for a, b in zip(texts, texts[1:])]
    sig, sig_new = signatures(texts), signatures(new)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids[:-1], schema.field(0).type),
            pa.array([len(t) for t in texts[:-1]], pa.int64()),
            pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in new]),
            pa.array([fingerprint(s) for s in sig[:-1]]),
            pa.array([fingerprint(s) for s in sig_new]),
            pa.array(likeness(sig[:-1], sig_new)),
            pa.array(likeness(sig[:-1], sig[1:])),
        ],
        schema=schema,
    )


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_chars, fingerprints of the text and of the edited text, and their likeness.

    Rows are in ascending id, nulls first, equal ids by text hash. A null text is empty; texts
    without words are like each other (1.0) and like no other (0.0). A single row is its own
    successor. Repeated rows are rows; other columns are ignored; an empty table gives an empty result.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructField, StructType, _parse_datatype_string

    out = StructType([StructField(id_col, df.schema[id_col].dataType), *_parse_datatype_string(SCHEMA).fields])
    schema = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, ids, texts, closed = None, [], [], False
        for batch in batches:
            ready = None
            for p, look, i, t in zip(*(c.to_pylist() for c in batch.columns)):
                if p != part:
                    if len(texts) > 1:
                        yield _compare(ids, texts, schema)
                    part, ids, texts, closed = p, [], [], False
                if not closed:
                    ids.append(i)
                    texts.append(t)
                closed = closed or look
            if len(texts) > 1:
                ready = _compare(ids, texts, schema)
                ids, texts = ids[-1:], texts[-1:]
                yield ready

    return with_next(df, id_col, text_col).mapInArrow(run, out)


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of each signature."""
    rows = signature.reshape(len(signature), BANDS, -1).astype(np.uint64)
    h = np.broadcast_to(np.arange(BANDS, dtype=np.uint64) + np.uint64(1), rows.shape[:2])
    for j in range(rows.shape[2]):
        h = mix(h + rows[:, :, j])
    return h.view(np.int64)


def near_duplicates(docs: DataFrame, percent: int = 75) -> tuple[DataFrame, DataFrame]:
    """Documents grouped as in :func:`jaccard_join.join`, with signature bands as candidates.

    Classes of equal shingle sets that share a band are candidates; their exact similarity decides.
    Texts without words are in no band. Same columns and same handling of nulls and repeats.
    """
    described, _ = jaccard_join.describe(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            keys = band_keys(signatures(texts))
            sets = [g for _, some in jaccard_join.distinct_shingles(batch, 1) for g in some]
            n = np.array([len(g) for g in sets], np.int64)
            cls = np.array([jaccard_join.class_id(g) for g in sets], np.int64)
            keys, n, cls = keys[n > 0], n[n > 0], cls[n > 0]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel()), pa.array(np.repeat(cls, BANDS)), pa.array(np.repeat(n, BANDS))], names=["bucket", "cls", "n"]
            )

    rows = docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, "bucket long, cls long, n long")
    banded = materialize(rows.distinct(), "minhash-bands")
    shared = banded.groupBy("bucket").agg(F.min("cls").alias("x"), F.max("cls").alias("y")).where("x != y").select("bucket")
    each = jaccard_join.classes(described)
    buckets = banded.join(shared, "bucket", "left_semi").withColumn("pos", F.lit(0).cast("long"))
    links, nodes = linking.link(materialize(buckets, "minhash-buckets"), each, jaccard_join.sets_of(docs, each), percent)
    return jaccard_join.grouped(described, nodes), links
