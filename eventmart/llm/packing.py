"""Best-fit packing under conflicts.

Documents are cut into pieces of at most ``capacity`` words and dealt evenly to shards; each shard
packs its pieces, longest first. Bins are kept in order of the room they have left, with one bitmap of
their sources and one of their duplicate clusters. A piece goes to the bin with the least room that is
enough and that holds neither its source nor its cluster; the search goes on from bin to bin until one
fits or none is left. Two copies of a text, or two documents of one source, never share a bin.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.mixing import words
from eventmart.session import materialize

CAPACITY = 2048
SHARD_PIECES = 4096  # about; bounds what one task holds


def pack(sizes: list[int], sources: list[int], clusters: list[int], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) for each piece, given in the order of packing. Clusters below 0 conflict with none."""
    room: list[tuple[int, int]] = []  # (room left, bin), rising
    has_source: list[int] = []
    has_cluster: list[int] = []
    out = []
    for size, source, cluster in zip(sizes, sources, clusters):
        s, c = 1 << source, 1 << cluster if cluster >= 0 else 0
        i = bisect_left(room, (size, -1))
        while i < len(room) and (has_source[room[i][1]] & s or has_cluster[room[i][1]] & c):
            i += 1
        if i < len(room):
            left, b = room.pop(i)
        else:
            left, b = capacity, len(has_source)
            has_source.append(0)
            has_cluster.append(0)
        has_source[b] |= s
        has_cluster[b] |= c
        out.append((b, capacity - left))
        insort(room, (left - size, b))
    return out


def _pack_shard(pdf: pd.DataFrame, capacity: int) -> pd.DataFrame:
    pdf = pdf.sort_values(["n_words", "doc_id", "unit", "piece"], ascending=[False, True, True, True], na_position="last")
    twice = pdf["cluster"].duplicated(keep=False)
    clusters = pd.Series(-1, index=pdf.index)
    clusters[twice] = pd.factorize(pdf.loc[twice, "cluster"])[0]
    sources = pd.factorize(pdf["source"], use_na_sentinel=False)[0]
    spots = pack(pdf["n_words"].tolist(), sources.tolist(), clusters.tolist(), capacity)
    base = int(pdf["shard"].iloc[0]) << 32
    pdf["bin_id"] = [base + b for b, _ in spots]
    pdf["bin_offset"] = [o for _, o in spots]
    return pdf[["doc_id", "source", "piece", "first_word", "n_words", "bin_id", "bin_offset"]]


def best_fit(docs: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """One row per piece: doc_id, source, piece, first_word, n_words, bin_id, bin_offset.

    Pieces of a row cover its words once, in order; a null or wordless text is one empty piece. The
    duplicate cluster is the text in lower case with blanks made single, or ``cluster`` if ``docs`` has
    that column (null: no duplicates). Repeated rows are packed each, in different bins. A null source
    is a source. An empty table gives an empty result.
    """
    text = F.coalesce("text", F.lit(""))
    cluster = (
        F.col("cluster").cast("string") if "cluster" in docs.columns
        else F.sha2(F.regexp_replace(F.trim(F.lower(text)), r"[\x20\x09-\x0D]+", " "), 256)
    )
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.col("source").cast("string").alias("source"), words(F.col("text")).alias("size"), cluster.alias("cluster"))
    units = materialize(rows.withColumn("unit", F.monotonically_increasing_id()), "pack-units")
    whole = F.greatest(F.ceil(F.col("size") / capacity) - 1, F.lit(0)).cast("long")
    n = units.agg(F.coalesce(F.sum(whole + 1), F.lit(0))).first()[0]
    shards = max(1, -(-n // shard_pieces))
    pieces = units.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), whole))).select(
        "doc_id", "source", "unit", "piece", F.coalesce("cluster", F.concat(F.lit("?"), "unit")).alias("cluster"),
        (F.col("piece") * capacity).alias("first_word"),
        F.least(F.lit(capacity), F.col("size") - F.col("piece") * capacity).cast("long").alias("n_words"),
        F.pmod(F.xxhash64("unit", "piece"), F.lit(shards)).alias("shard"),
    )
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return pieces.groupBy("shard").applyInPandas(
        lambda pdf: _pack_shard(pdf, capacity),
        f"doc_id {id_type}, source string, piece long, first_word long, n_words long, bin_id long, bin_offset long",
    )
