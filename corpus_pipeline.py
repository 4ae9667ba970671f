"""From raw documents to token ids: quality, exact and near copies, source mix, byte-level BPE.

Each stage takes ``(spark, docs, sf_dir)``. Its rows are written as Parquet and
read again as the next one's ``docs``; all but the last keep the columns of
``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bytebpe, divergence, exact, inverted, mixing
from tidemark.session import settle, ship


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie near their language."""
    return divergence.good_documents(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the one with the smallest id."""
    return exact.without_copies(docs, keep="smallest")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 80 % of its five-word shingles."""
    return inverted.without_near_copies(docs, width=5, percent=80)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of 5:2:1 by source takes them."""
    return mixing.mixed(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian 32-bit, in ``ids``) of every row, their number and digests."""
    out = bytebpe.encoded(docs, RANKS, public_tokenizers.PATTERN, keep=["doc_id", "lang", "source"])
    return out.select("row.doc_id", "row.lang", "row.source", "n_tokens", "ids_sha256", "decoded_sha256", "ids")


#: Rank file of the vocabulary; it must lie there on every executor.
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("source_mix", source_mix),
    ("byte_bpe", byte_bpe),
]

#: SQL has no byte-level BPE; the tests compare the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
