"""Corpus pipeline: filter, deduplicate and pack ``documents`` in five stages.

Each stage takes (spark, docs, sf_dir) and works on everything that the one
before it kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from buildlake.llm import near_dedup, packing, quality_classifier, quality_rules, substrings
from buildlake.llm.common import staged
from buildlake.llm.queries import BPE_JSON, BPE_RANKS


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs, _labels(spark, sf_dir))


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts to be good."""
    return quality_classifier.keep_predicted(docs, _labels(spark, sf_dir))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near duplicates (five-word shingles, similarity 0.8)."""
    return near_dedup.without_near_duplicates(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one also has."""
    return substrings.without_repeats(docs, substrings.repeated_passages(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path(BPE_JSON), public_tokenizers.path(BPE_RANKS))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", rules),
    ("quality_classifier", classifier),
    ("near_dedup", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("packing", pack),
]

# trained models and tokenizers: the stages are tested against brute force instead
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's result written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
