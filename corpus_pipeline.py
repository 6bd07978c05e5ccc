"""The corpus pipeline: quality rules, quality classifier, near-duplicate
removal, substring removal, packing. Each stage's result is written as Parquet
to the shared folder and read back as the next stage's documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sftforge.llm import (
    op4_quality_classifier, op5_minhash_dedup, op6_substring_dedup, op7_quality_rules, op9_best_fit_packing,
)
from sftforge.llm.common import documents, stage
from sftforge.sources.tables import table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a rule rejects go."""
    return op7_quality_rules.keep_good(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted to be of low quality go."""
    return op4_quality_classifier.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays."""
    return op5_minhash_dedup.keep_one(docs)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose the words of passages that occur elsewhere too; every document stays."""
    return op6_substring_dedup.keep_unrepeated(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return op9_best_fit_packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier),
    ("MinHash near-dedup", near_duplicates),
    ("substring dedup", substrings),
    ("best-fit packing", packing),
]

#: None: Python text statistics, a fitted model, MinHash and packing have no SQL
#: form; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply every stage to the documents table."""
    docs = documents(spark, sf_dir)
    for name, fn in STAGES[:-1]:
        docs = stage(fn(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
