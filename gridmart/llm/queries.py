"""Registered queries of the training-data operators (name -> builder, oracle SQL)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridmart.llm import (chat_format, conversation_repair, embedding_dedup, hmm_lm, minhash_dedup, packing, pii,
                          quality_classifier, quality_rules, sentencepiece_viterbi, substring_dedup,
                          token_alignment, token_files)

QueryFn = Callable[[SparkSession, str], DataFrame]


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_substring_dedup(spark, sf_dir):
    spans = substring_dedup.repeated_spans(_read(spark, sf_dir, "documents"))
    return spans.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op2_quality_classifier(spark, sf_dir):
    return quality_classifier.classify(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op3_hmm_lm(spark, sf_dir):
    return hmm_lm.score(_read(spark, sf_dir, "documents"))


def op4_embedding_dedup(spark, sf_dir):
    return embedding_dedup.near_duplicates(_read(spark, sf_dir, "embeddings"))


def op5_pii(spark, sf_dir):
    return pii.find(_read(spark, sf_dir, "documents"))


def op6_quality_rules(spark, sf_dir):
    led = quality_rules.apply_policy(quality_rules.ledger(_read(spark, sf_dir, "documents")))
    return led.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "failed_bits")


def op7_sentencepiece(spark, sf_dir):
    return sentencepiece_viterbi.round_trip(_read(spark, sf_dir, "documents"))


def op8_minhash_dedup(spark, sf_dir):
    return minhash_dedup.near_duplicates(_read(spark, sf_dir, "documents"))


def op9_token_files(spark, sf_dir):
    return token_files.token_file_digest(_read(spark, sf_dir, "documents"))


def op10_best_fit_packing(spark, sf_dir):
    return packing.pack_documents(_read(spark, sf_dir, "documents"))


def op11_chat_format(spark, sf_dir):
    rows = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat_format.read_back(chat_format.windows(rows.unionByName(chat_format.planted(spark))))


def op12_token_alignment(spark, sf_dir):
    return token_alignment.align(_read(spark, sf_dir, "documents"))


def op13_conversation_repair(spark, sf_dir):
    rows = _read(spark, sf_dir, "conversations")
    return conversation_repair.digests(conversation_repair.damaged(rows), rows.select("conv_id"))


QUERIES: dict[str, QueryFn] = {f.__name__: f for f in (
    op1_substring_dedup, op2_quality_classifier, op3_hmm_lm, op4_embedding_dedup, op5_pii,
    op6_quality_rules, op7_sentencepiece, op8_minhash_dedup, op9_token_files, op10_best_fit_packing,
    op11_chat_format, op12_token_alignment, op13_conversation_repair)}

ORACLE_SQL: dict[str, str] = {}
