"""Corpus pipeline: the training-data operators applied to ``documents`` in turn.

Each stage takes (spark, docs, sf_dir) and works on all rows the one before
kept; all but the last return the columns of ``documents``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from postwave.llm.line_dedup import left_over
from postwave.llm.mixing import mixed
from postwave.llm.ngram_join import one_row_of_each
from postwave.llm.packing import pieces
from postwave.llm.rule_ensemble import accept
from postwave.llm.tables import read, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble predicts as good."""
    return accept(docs, read(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of repeated runs of lines; documents that
    consisted of such copies go."""
    return left_over(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts that share 80 % of their shingles, also
    where ids are missing or told for several texts."""
    return one_row_of_each(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mixture of sources takes it."""
    return mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids with their place in windows of 4096."""
    return pieces(docs)


STAGES = [
    ("quality_classifier", quality),
    ("line_dedup", lines),
    ("ngram_jaccard_join", near_copies),
    ("source_mixing", mixture),
    ("packing", packed),
]

# Fitted trees, suffix ranks and token ids have no SQL form; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for all documents of ``sf_dir``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
