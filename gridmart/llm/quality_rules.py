"""Operator 6, quality rules: a ledger of failure bits, measured once per document.

Every rule is evaluated once; the ledger row keeps the measurements and one failure bit
per rule. A policy is a named, versioned bit mask: a document passes when it fails none of
the mask's rules. Ablations (how many documents only one rule rejects, what a policy
without a rule would keep) come from the counts per bit pattern, by bitwise operations.

Defined cases: a null or empty text has no words, all measurements are 0 and it fails
``few_words``. Rows are independent, so repeated rows and ties get equal ledgers.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.llm.textops import U64, Words, mix64, rolling_hashes, runs, small_batches, window_index

# Rule names in bit order and the policies built on them.
RULES = ["few_words", "repeated_words", "many_symbols", "many_capitals", "duplicate_lines", "odd_word_length"]
POLICIES = {"base_v1": ["few_words", "repeated_words"],
            "clean_v1": ["few_words", "repeated_words", "many_symbols", "many_capitals"],
            "clean_v2": ["few_words", "repeated_words", "many_symbols", "many_capitals", "duplicate_lines",
                         "odd_word_length"]}
PRODUCTION = "clean_v2"
SYMBOLS = b"#*$%&|<>"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals"]

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True


def mask_of(policy: str) -> int:
    return sum(1 << RULES.index(r) for r in POLICIES[policy])


def _per_doc(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeat_words(words: Words) -> np.ndarray:
    """Words in a three-word window that is found at least twice in the same text."""
    covered = np.zeros(len(words.start) + 1, np.int64)
    at = window_index(words, 3)
    if len(at):
        h = rolling_hashes(words.hashes(), 3)[at]
        doc = np.repeat(np.arange(words.n_docs), np.maximum(words.count - 2, 0))
        h = mix64(h + doc.astype(U64) * U64(0x9E3779B97F4A7C15))
        order = np.argsort(h)
        start = runs(h[order])
        size = np.diff(np.append(start, len(h)))
        again = at[order[np.repeat(size > 1, size)]]
        np.add.at(covered, again, 1)
        np.add.at(covered, again + 3, -1)
    return _per_doc(np.cumsum(covered[:-1]) > 0, words.first)


def _dup_lines(text: str) -> tuple[int, int]:
    seen: set[str] = set()
    lines = repeated = 0
    for line in text.split("\n"):
        if line.strip(" \t\n\x0b\x0c\r"):
            lines += 1
            if line in seen:
                repeated += 1
            else:
                seen.add(line)
    return lines, repeated


def measure(texts) -> dict[str, np.ndarray]:
    """All measurements of a batch of texts."""
    words = Words(texts)
    data, offsets = words.data, words.offsets
    lead = (data & 0xC0) != 0x80
    space = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    lines = [_dup_lines(words.doc_bytes(d).decode()) for d in range(words.n_docs)]
    return {"n_words": words.count, "word_chars": _per_doc(lead & ~space, offsets),
            "n_symbols": _per_doc(_SYMBOL[data], offsets),
            "n_dup_lines": np.array([b for _, b in lines], np.int64),
            "n_repeat_words": _repeat_words(words),
            "n_lines": np.array([a for a, _ in lines], np.int64),
            "n_capitals": _per_doc((data >= 65) & (data <= 90), offsets)}


def _bits(m: dict[str, np.ndarray]) -> np.ndarray:
    """Failure bits in the order of ``RULES``."""
    n, chars = m["n_words"], m["word_chars"]
    failed = [n < 50,
              100 * m["n_repeat_words"] > 50 * n,
              100 * m["n_symbols"] > 10 * chars,
              100 * m["n_capitals"] > 40 * chars,
              100 * m["n_dup_lines"] > 60 * np.maximum(m["n_lines"], 1),
              (100 * chars < 150 * n) | (100 * chars > 2000 * n)]
    return reduce(np.bitwise_or, [f.astype(np.int64) << k for k, f in enumerate(failed)])


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements and ``failed_bits`` (bit k: rule ``RULES[k]`` failed)."""

    def run(batches):
        for b in small_batches(batches):
            m = measure(b["text"])
            yield pa.RecordBatch.from_pydict({"doc_id": b["doc_id"], **m, "failed_bits": _bits(m)})

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in MEASURES) + ", failed_bits long"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def apply_policy(led: DataFrame, policy: str = PRODUCTION) -> DataFrame:
    """The ledger with ``base_failed`` and ``kept`` under a policy."""
    bits = F.col("failed_bits")
    return led.withColumns({"base_failed": bits.bitwiseAND(F.lit(mask_of("base_v1"))) != 0,
                            "kept": bits.bitwiseAND(F.lit(mask_of("base_v1") | mask_of(policy))) == 0})


def ablation(led: DataFrame, policy: str = PRODUCTION) -> DataFrame:
    """Per rule of the policy: documents it rejects, rejects alone, and that the policy would
    keep without it. Works on the counts per bit pattern (at most 2^rules rows)."""
    mask = mask_of(policy)
    patterns = led.groupBy(F.col("failed_bits").bitwiseAND(F.lit(mask)).alias("bits")).agg(F.count("*").alias("n"))
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << RULES.index(r)).alias("bit"))
                      for r in POLICIES[policy]])
    p = patterns.select("bits", "n", F.explode(rules).alias("r")).select("bits", "n", "r.rule", "r.bit")
    without = F.col("bits").bitwiseAND(F.lit(mask) - F.col("bit"))
    hit = F.col("bits").bitwiseAND(F.col("bit")) != 0
    return p.groupBy("rule").agg(F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("rejected"),
                                 F.sum(F.when(hit & (without == 0), F.col("n")).otherwise(0)).alias("rejected_alone"),
                                 F.sum(F.when(without == 0, F.col("n")).otherwise(0)).alias("kept_without"))


def keep_documents(docs: DataFrame, policy: str = PRODUCTION) -> DataFrame:
    """The rows of ``docs`` that pass the policy, columns unchanged. The verdict is made
    where the row is read, so there is no join and repeated rows stay as they are."""
    mask = mask_of("base_v1") | mask_of(policy)

    def run(batches):
        for b in small_batches(batches):
            ok = (_bits(measure(b["text"])) & mask) == 0
            yield b.filter(pa.array(ok))

    return docs.mapInArrow(run, docs.schema)
