"""The registered queries of the subpackage and the SQL they must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.llm import (
    chat, cnn_quality, compression_bands, conversation_repair, jaccard_join, lexical_search, minhash, mixing, packing, pii,
    pivot_index, simple8b, sql, suffix_dedup,
)
from eventmart.llm.textbatch import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op3_chat_formatting", sql.CHAT)
def op3(spark, sf_dir):
    """Each row of ``conversations`` is the event of a whole message of its log, and goes through the fold."""
    log = table(spark, sf_dir, "conversations").select(
        "conv_id", F.col("turn").alias("seq"), F.monotonically_increasing_id().alias("message_id"), F.lit("message").alias("kind"), "role", "text"
    )
    probe = spark.sql(
        "select -1L as conv_id, seq, -1L - seq as message_id, 'message' as kind, role, "
        "'</s>[INST] ok [/INST]' as text from values (0L, 'user'), (1L, 'assistant') as t(seq, role)"
    )
    return chat.digest(chat.render(chat.fold(log.unionByName(probe))))


@query("op4_pii_spans", sql.PII)
def op4(spark, sf_dir):
    return pii.digest(table(spark, sf_dir, "documents"))


@query("op5_compression_bands")
def op5(spark, sf_dir):
    return compression_bands.assess(table(spark, sf_dir, "documents"))


@query("op1_best_fit_packing")
def op1(spark, sf_dir):
    return packing.best_fit(table(spark, sf_dir, "documents"))


@query("op6_minhash_fingerprints")
def op6(spark, sf_dir):
    return minhash.fingerprints(table(spark, sf_dir, "documents"))


@query("op10_source_mixing")
def op10(spark, sf_dir):
    mixed, _ = mixing.mix(mixing.units_of(table(spark, sf_dir, "documents")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query("op7_ngram_jaccard_join", sql.JACCARD)
def op7(spark, sf_dir):
    result, _ = jaccard_join.join(table(spark, sf_dir, "documents"))
    return result.select("doc_id", "n_shingles", "component_id")


@query("op8_simple8b_tokens")
def op8(spark, sf_dir):
    import public_tokenizers

    folder = simple8b.new_folder(spark)
    manifest = simple8b.write(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), folder)
    return simple8b.digest(manifest, folder)


@query("op2_byte_cnn_quality")
def op2(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return cnn_quality.score(docs, cnn_quality.fit(docs, table(spark, sf_dir, "labels")))


@query("op9_suffix_array_dedup", sql.REPEATS)
def op9(spark, sf_dir):
    return suffix_dedup.digest(table(spark, sf_dir, "documents"))


@query("op11_shared_lexical_search", sql.LEXICAL)
def op11(spark, sf_dir):
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op12_auction_repair", sql.REPAIR)
def op12(spark, sf_dir):
    return conversation_repair.audit_damage(table(spark, sf_dir, "conversations"))


@query("op13_pivot_top_k", sql.NEAREST)
def op13(spark, sf_dir):
    vectors = pivot_index.lattice(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return pivot_index.search(pivot_index.build(vectors), vectors.where("vec_id % 20 = 0"))
