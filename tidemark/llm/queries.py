"""One query per corpus operator, with production settings, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import (
    bytebpe,
    chains,
    divergence,
    exact,
    iceberg,
    inverted,
    licences,
    mixing,
    multiindex,
    secretscan,
    sharding,
    urlrules,
    wavelet,
)
from tidemark.llm.oracles import ORACLES
from tidemark.session import ship

#: Where every machine has the public vocabulary files.
VOCABULARIES = public_tokenizers.path
PATTERN = public_tokenizers.PATTERN

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def on(table: str):
    """Register ``fn(frame)`` as a query over the whole of ``table``."""

    def register(fn: Callable[[DataFrame], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet"))

        run.__doc__ = fn.__doc__
        QUERIES[fn.__name__] = run
        return fn

    return register


@on("documents")
def op1_repeated_passages(docs: DataFrame) -> DataFrame:
    """Fuzzy passages of 50 words and more that repeat in a document with a smaller id, or earlier in their own."""
    return chains.passages(docs, within=True)


@on("documents")
def op2_quality_rules(docs: DataFrame) -> DataFrame:
    """Base counts and the verdict by divergence from the document's language."""
    return divergence.quality_report(docs)


@on("documents")
def op3_mixing(docs: DataFrame) -> DataFrame:
    """Words each document gives to a mix of 5:2:1 by source, half as large again as the corpus."""
    return mixing.mixture(docs).select("doc_id", "size", "source_size", "target", "taken", "copies")


@on("documents")
def op4_sharding(docs: DataFrame) -> DataFrame:
    """Sixteen shards of nearly equal bytes; equal texts stay together."""
    return sharding.shards(docs, 16).withColumns(
        {"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")}
    )


@on("documents")
def op5_exact_dedup(docs: DataFrame) -> DataFrame:
    """Copies after lower-casing A-Z; the largest id stays."""
    return exact.exact_report(docs, keep="largest")


@on("documents")
def op6_byte_bpe(docs: DataFrame) -> DataFrame:
    """Digests of the byte-level BPE ids and of what they decode to."""
    return bytebpe.bpe_report(docs, VOCABULARIES("byte_bpe_50k.tiktoken"), PATTERN)


@on("documents")
def op8_wavelet(docs: DataFrame) -> DataFrame:
    """Token ids written as wavelet matrices and read back."""
    return wavelet.wavelet_report(docs, VOCABULARIES("word_bpe_49k.json"))


@on("documents")
def op9_minhash(docs: DataFrame) -> DataFrame:
    """Components of documents with 85 % of their three-word shingles in common."""
    return inverted.near_groups(docs, width=3, percent=85)


# Fixed values of the URL filter: host, path, verdict.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


@on("pages")
def op7_url_filter(pages: DataFrame) -> DataFrame:
    """The rule that decides on each page's URL, and its verdict."""
    return urlrules.judged(pages, urlrules.rule_table(pages.sparkSession, RULES))


@on("documents")
def op10_secrets(docs: DataFrame) -> DataFrame:
    """Base matches and spans of a learned credential format."""
    return secretscan.secrets(docs)


@on("documents")
def op11_licence_scan(docs: DataFrame) -> DataFrame:
    """Phrases that name a licence, and licence notices found by their rare words."""
    return licences.licence_report(docs)


@on("embeddings")
def op12_hard_negatives(embeddings: DataFrame) -> DataFrame:
    """Rows of other labels that score 30 to 90 % of an anchor's positives."""
    relabel = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return multiindex.hard_negatives(embeddings, F.col("id") % 100 == 0, relabel)


@on("documents")
def op13_source_audit(docs: DataFrame) -> DataFrame:
    """How sources of a language differ from each other, and their terms in excess of the language."""
    return iceberg.source_divergence(docs)


__all__ = ["QUERIES", "ORACLES"]
