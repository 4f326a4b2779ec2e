"""Corpus pipeline: documents -> packed token sequences.

Stages, in order: quality rules, MinHash near-dedup, substring dedup, personal data and
best-fit packing. Every stage takes what its predecessor kept (``docs``), applies its
decisions and, but for the last, returns the columns of ``documents``. ``run`` writes each
stage's rows to the shared folder and reads them back as the next stage's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridmart.llm import minhash_dedup, packing, pii, quality_rules, substring_dedup
from gridmart.llm.scratch import bounded_batches, written


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that fail the production policy."""
    bounded_batches(spark)
    return quality_rules.keep_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates."""
    bounded_batches(spark)
    return minhash_dedup.keep_documents(docs)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages of 13 words or more that a smaller doc_id has too."""
    bounded_batches(spark)
    return substring_dedup.remove_repeats(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind."""
    bounded_batches(spark)
    return pii.mask(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokenize and place every document in sequences of 4096 tokens."""
    bounded_batches(spark)
    return packing.pack_documents(docs)


STAGES = [("quality_rules", rules), ("minhash_dedup", near_duplicates), ("substring_dedup", substrings),
          ("personal_data", personal_data), ("best_fit_packing", pack)]

# No DuckDB SQL expresses the tokenizer or the model stages; tests/llm check each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
