"""The training-corpus pipeline: toxic documents go, one document of each near-duplicate group stays,
documents with benchmark passages go, credentials are masked, and what is left is packed.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor kept. All but the last return the
columns of ``documents``; the last returns the pieces of the packed sequences. Stages are written as Parquet and
read again between each other.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from citylake.llm import decontamination, near_dedup, packing, secret_scan, toxicity
from citylake.llm.common import staged
from citylake.llm.queries import BYTE_BPE, table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5; the network is fitted on labelled rows of the stage's input."""
    return toxicity.drop_toxic(docs, toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels")))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the one with the least id."""
    return near_dedup.deduplicate(docs, width=5, threshold=0.8)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a ten-word window of a benchmark item."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"), window=10)


def secret_scan_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with credentials that aren't widely copied examples masked."""
    return secret_scan.redact(docs, owner_col="source", repository_cols=("source", "lang"), min_owners=3, length_col="n_chars")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path(BYTE_BPE), window=1024, end_id=0, digest=True)


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("secret_scan", secret_scan_stage),
    ("packing", packing_stage),
]

#: The first stage is a trained network, which SQL cannot state; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
