"""From raw documents to packed training sequences, in stages that each hand a table to the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meterfold.llm.common import table
from meterfold.llm.exact import drop_copies
from meterfold.llm.jaccard import drop_near_copies
from meterfold.llm.packing import pack
from meterfold.llm.toxicity import drop_toxic
from meterfold.session import materialise


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return drop_copies(docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near copies, linked directly or over others, the document with the smallest id."""
    return drop_near_copies(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each remaining document lies in the packed sequences."""
    return pack(docs)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("ngram_jaccard", ngram_jaccard),
    ("best_fit_packing", best_fit_packing),
]

# Training, hashing classes and tokenisation have no SQL; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each stage's result is written to the shared folder and read again.

    Rows without id or text pass through like others, one of each repeated row goes on, columns of
    any name are kept up to the last stage, and an empty table gives no rows.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
