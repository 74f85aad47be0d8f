"""Corpus pipeline: the text operators as stages, each reading what the one before kept.

Every stage but the last returns the columns of ``documents``; a stage's decisions are in
what it returns (rows gone, texts cut), and ``run`` stores each stage's result as parquet
in the shared folder and rereads it, so a lost executor costs at most one stage's tasks.
``n_chars`` follows the text. An empty table passes through every stage as such.
"""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import jaccard_join, line_dedup, packing, quality_rules, rule_classifier
from strata.llm.common import stored, table


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go; so do documents that fail the base counts or lose too much."""
    return _counted(quality_rules.keep_clean(docs))


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go whose rule-ensemble score is under the threshold; the rules are learnt
    from all labelled documents, those that the stage before rejected included."""
    return rule_classifier.keep_good(docs, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages stay in one document; documents left without a word go."""
    return _counted(line_dedup.with_words(line_dedup.dedup_lines(docs)))


def jaccard_join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate group the document with the smallest id stays."""
    return jaccard_join.keep_one(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of training sequences, with their token ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules_stage),
    ("quality classifier", quality_classifier_stage),
    ("line dedup", line_dedup_stage),
    ("n-gram jaccard join", jaccard_join_stage),
    ("packing", packing_stage),
]

#: No SQL expresses a fitted classifier or packing; tests/llm holds run() against a
#: brute-force version of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{k}")
    return docs
