"""The training-data pipeline: each stage takes the documents that its predecessor kept.

quality rules (rejected documents go) -> near duplicates (the smallest id of each group stays) -> benchmark decontamination
(documents that hold an item go) -> secret scan (secrets are replaced by a mark) -> byte-level BPE (ids and their round trip).

All stages but the last return the columns of ``documents``, unchanged but for masked texts and their ``n_chars``, whatever
further columns there are and whatever their names.

Null and empty texts have no words, so the quality rules reject them. Texts of any length are read whole. Of linked documents the
smallest doc_id stays, with all rows that repeat it; a row without a doc_id is linked with nothing and stays. Decontamination deletes documents for items
of five words or more. An empty table gives an empty result at each stage. A stage's table is deleted when the next one is written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from statuta.llm import bpe, decontaminate, neardup, quality, queries, secrets
from statuta.llm.common import remove, stage, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    vocab, pattern = queries.tokenizer_ranks()
    return bpe.round_trip(docs, vocab, pattern)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("byte_bpe", byte_bpe),
]

#: Alignment and byte-pair merging have no SQL form; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written and read again."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, step in STAGES[:-1]:
        made: list[str] = []
        docs = stage(step(spark, docs, sf_dir), name, made)
        remove(spark, *before)
        before = made
    return STAGES[-1][1](spark, docs, sf_dir)
