"""From raw documents to packed training sequences, stage by stage.

Every stage gets what its predecessor kept, written as Parquet and read again; all but the last give
the columns of ``documents``, further ones included.

In every stage null and empty texts, repeated rows, rows without doc_id, empty tables and columns with any
other names have a defined result, which the functions' docstrings state.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from candlemill.llm import decontaminate, near_dup, packing, pii, quality
from candlemill.llm.shared import staged, table, tokenizer_file

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the counts or are mostly boilerplate lines go; null and empty texts go, too."""
    return quality.keep_good(docs, quality.learn_chain(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates stays (five words, similarity 0.8).

    Of rows that repeat doc_id and text one stays; rows without doc_id or words stay.
    """
    return near_dup.keep_one(docs, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; without items, or text, all stay."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; no row goes."""
    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences of 2048 tokens; a text without tokens is its end id."""
    return packing.pack(docs, tokenizer_file("word_bpe_49k.json"), 2048)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packed),
]

ORACLE_SQL = None
"""SQL can express none of the stages; tests hold them against brute force."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    *stages, (_, last) = STAGES
    for name, stage in stages:
        docs = staged(stage(spark, docs, sf_dir), name)
    return last(spark, docs, sf_dir)
