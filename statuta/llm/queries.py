"""The registered queries opN_<name> and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, decontaminate, licenses, neardup, pii, quality, quotes, records, secrets, toxicity
from .common import table


def tokenizer_ranks(path: str | None = None) -> tuple[list[bytes], str]:
    """The rank file (read on the driver, shipped with the tasks: about 1 MB) and its pattern."""
    import public_tokenizers as public

    return bpe.read_ranks(path or public.path("byte_bpe_50k.tiktoken")), public.PATTERN


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scan(table(spark, sf_dir, "documents"))


def op2_quotation_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.conversations(table(spark, sf_dir, "conversations"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab, pattern = tokenizer_ranks()
    return bpe.round_trip(table(spark, sf_dir, "documents"), vocab, pattern)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.detect(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(table(spark, sf_dir, "documents"))


def op9_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as public

    with open(public.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        return records.round_trip(table(spark, sf_dir, "documents"), f.read(), public.PATTERN)


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_quotation_links": op2_quotation_links,
    "op3_bpe": op3_bpe,
    "op4_decontamination": op4_decontamination,
    "op5_license_scan": op5_license_scan,
    "op6_quality_rules": op6_quality_rules,
    "op7_toxicity": op7_toxicity,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_token_records": op9_token_records,
    "op10_secret_scan": op10_secret_scan,
}

SQL: dict[str, str] = {"op6_quality_rules": quality.SQL, "op8_near_duplicates": neardup.SQL}
