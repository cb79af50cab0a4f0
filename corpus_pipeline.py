"""A cleaning pipeline over ``documents``, ending in packed sequences.

Documents without a letter, for which the language stage has no answer, go; of equal texts and of near-duplicates (runs of five
words, similarity 0.8) the one with the smallest id stays; secrets are replaced in the texts that stay; what is left is packed. Each stage's result is written as Parquet
and read again as the next one's documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from alertloom.llm import exact_dedup, lang_id, near_dedup, packing, secret_scan
from alertloom.llm.shared import stored, table


def with_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lang_id.keep_identified(docs)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_duplicates(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", with_language),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("secret_scan", without_secrets),
    ("best_fit_packing", packed),
]

#: A network, registers of hashes and a tokenizer's merges can't be said in SQL; the tests hold the rows against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
