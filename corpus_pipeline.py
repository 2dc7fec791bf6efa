"""The corpus pipeline: documents go through quality rules, near-duplicate removal, masking of
personal data, mixing of sources and packing into bins.

Each stage takes (spark, docs, sf_dir), works on all rows of its predecessor and returns a DataFrame.
All but the last return the columns of ``documents``. ``run`` stores the result of each stage in the
shared folder before the next one reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.llm import compression_bands, jaccard_join, mixing, packing, pii
from eventmart.llm.textbatch import prepare
from eventmart.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or a compression band go."""
    prepare(spark)
    return compression_bands.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of alike documents stays."""
    prepare(spark)
    return jaccard_join.dedupe(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked; ``n_chars`` follows the text."""
    masked = pii.mask(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are left out or repeated so that sources come near their targets."""
    return mixing.apply(docs)


def packed_bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies: doc_id, source, piece, first_word, n_words, bin_id, bin_offset."""
    return packing.best_fit(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
    ("packing", packed_bins),
]

# Compression ratios are beyond SQL; tests/llm compares the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
