"""The corpus pipeline: quality rules, line dedup, SimHash near-dedup, secret scan, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before has kept; its decisions
take effect in what it returns. All but the last return the columns of ``documents``. Each result is
written as Parquet and read again as the next stage's input. Null texts have no word and go in the first
stage; rows that repeat are judged row by row; an empty table stays empty through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import line_dedup, packing, quality, secret_scan, simhash
from tidemark.session import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule or the classifier go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, quality.train(docs, labels))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand earlier, or nearly so, go; a document that loses all its text goes."""
    return line_dedup.without_duplicate_lines(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, likeness 0.8) stays, the one with the smallest id."""
    return simhash.keep_one_of_each(docs)


def secret_scan_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The values of secrets are replaced by a mark; every document stays."""
    return secret_scan.redact_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2,048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("simhash_near_dedup", simhash_near_dedup),
    ("secret_scan", secret_scan_stage),
    ("packing", packing_stage),
]

# SQL expresses neither the classifier nor the tokenizer; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result but the last is written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
