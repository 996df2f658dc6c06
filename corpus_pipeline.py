"""Training-data pipeline: documents to packed sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all that the one before
kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import line_dedup, minhash, mixing, packing, quality_classifier
from tidemark.llm.common import staged, table
from tidemark.llm.queries import TOKENIZER


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels, does not reject."""
    return quality_classifier.drop_rejected(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that equal, or nearly equal, an earlier one."""
    return line_dedup.drop_repeated_lines(docs, max_edits=2, min_chars=1)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return minhash.keep_one(docs, width=5, share=0.8)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the mixed documents in sequences of 1024 tokens."""
    return packing.pack(docs, TOKENIZER, capacity=1024, end_id=2)


STAGES = [
    ("quality_classifier", quality),
    ("line_dedup", lines),
    ("minhash_near_dedup", near_duplicates),
    ("source_mixing", mix),
    ("best_fit_packing", pack),
]

# A classifier, minimum-wise sampling and a tokenizer have no SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written before the next reads them."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
