"""Registered queries of the llm operators, with production parameters over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citylake.llm import (centroids, decontamination, fingerprints, html_cut, lexical_search, near_dedup, packing, quality_rules, secret_scan, sharding,
                          token_counts, token_files, toxicity)
from citylake.llm.common import fresh_folder

BYTE_BPE = "byte_bpe_50k.json"
BYTE_BPE_RANKS = "byte_bpe_50k.tiktoken"
WORD_BPE = "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each field and body line of every document, encoded whole."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE_RANKS),
                                     fields=("source", "lang", "text"), rule="middle")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 7 by rendezvous hashing of doc_id; law ``key``."""
    even = {s: 1.0 for s in range(8)}
    slots = sharding.shard_slots(table(spark, sf_dir, "documents"), even, even | {8: 1.0})
    return slots.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document by its highest-scoring window."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.toxicity_report(docs, toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels")))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics, base rules and the trees' verdict of every document."""
    docs = table(spark, sf_dir, "documents")
    return quality_rules.quality_report(docs, quality_rules.fit_quality(docs, table(spark, sf_dir, "labels")))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), window=1024, end_id=0, digest=True)


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document: five-word shingles, similarity of 0.8 or more."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), width=5, threshold=0.8).drop("digest")


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_cut.extract(table(spark, sf_dir, "pages"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents, written in Huffman-coded files by doc_id and read back from them."""
    path = fresh_folder(spark, "token-files")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path(WORD_BPE), end_id=1)
    return token_files.read_tokens(spark, path, digest=True)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside occurrences of ten-word windows of benchmark items."""
    return decontamination.contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Credentials in every document, judged by how many owners hold the same value."""
    return secret_scan.secret_report(table(spark, sf_dir, "documents"), owner_col="source", repository_cols=("source", "lang"), min_owners=3)


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors in 40 clusters after five rounds of exact integer k-means."""
    return centroids.cluster_report(table(spark, sf_dir, "embeddings"), k=40, rounds=5, dims=64, scale=256)


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    return lexical_search.search_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), top=20)


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text, and how alike they are."""
    return fingerprints.fingerprint_report(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_sharding": op2_sharding,
    "op3_toxicity": op3_toxicity,
    "op4_quality_rules": op4_quality_rules,
    "op5_packing": op5_packing,
    "op6_near_dedup": op6_near_dedup,
    "op7_html_extraction": op7_html_extraction,
    "op8_token_files": op8_token_files,
    "op9_decontamination": op9_decontamination,
    "op10_secret_scan": op10_secret_scan,
    "op11_centroids": op11_centroids,
    "op12_lexical_search": op12_lexical_search,
    "op13_fingerprints": op13_fingerprints,
}

ORACLE = {
    "op9_decontamination": decontamination.ORACLE,
    "op11_centroids": centroids.ORACLE,
    "op12_lexical_search": lexical_search.ORACLE,
}
