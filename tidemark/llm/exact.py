"""Exact duplicates by a 128-bit content hash, with the bytes compared inside each group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import broadcast_checked, lower_ascii, row_of, text_of
from tidemark.session import settle


def copy_groups(
    docs: DataFrame, keep: str = "smallest", digest: Callable[[Column], Column] = F.md5
) -> DataFrame:
    """One row per text that occurs at least twice: ``h, normal, keep_id, group_size, variants``.

    The first read counts the hashes. The second takes only rows whose hash
    repeats and groups them by hash *and* text, so different texts of one hash
    are told apart by their bytes. Equal texts are merged in each task before
    the shuffle: a text copied into a third of all rows is one row per task.
    ``variants`` is the number of different texts under the hash.
    """
    pick = {"smallest": F.min, "largest": F.max}[keep]
    normal = docs.select("doc_id", lower_ascii(text_of()).alias("normal"))
    hashed = normal.withColumn("h", digest(F.col("normal")))
    repeated = hashed.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h")
    repeated = settle(repeated, "exact-hashes")
    texts = (
        hashed.join(broadcast_checked(repeated), "h")
        .groupBy("h", "normal")
        .agg(pick("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    )
    texts = settle(texts, "exact-texts")
    variants = texts.groupBy("h").agg(F.count(F.lit(1)).alias("variants"))
    return settle(texts.join(variants, "h"), "exact-groups")


def with_groups(
    docs: DataFrame, keep: str = "smallest", digest: Callable[[Column], Column] = F.md5
) -> DataFrame:
    """``row`` (all columns of ``docs``), ``normal``, ``keep_id``, ``group_size`` and ``kept``.

    Texts are equal when identical after A-Z become a-z; null counts as empty.
    Of equal texts the row with the smallest (or largest) id stays. A null id
    never wins against one that is set. Rows that share text and id are one
    document stored twice and get the same verdict. An empty table gives none.
    """
    groups = copy_groups(docs, keep, digest)
    hashed = docs.select(row_of(docs), F.col("doc_id").alias("id"), lower_ascii(text_of()).alias("normal"))
    hashed = hashed.withColumn("h", digest(F.col("normal")))
    single = groups.filter((F.col("variants") == 1) & (F.col("group_size") > 1)).select("h", "keep_id", "group_size")
    joined = hashed.join(broadcast_checked(single), "h", "left")
    clashing = groups.filter("variants > 1").drop("variants")
    if not clashing.isEmpty():
        # Different texts under one hash: these rows are matched by their text as well.
        hashes = broadcast_checked(clashing.select("h").distinct())
        matched = hashed.join(hashes, "h", "left_semi").join(clashing, ["h", "normal"])
        joined = joined.join(hashes, "h", "left_anti").unionByName(matched)
    size = F.coalesce(F.col("group_size"), F.lit(1)).cast("long")
    keep_id = F.when(size > 1, F.col("keep_id")).otherwise(F.col("id"))
    return joined.select(
        "row",
        "normal",
        F.col("id").alias("doc_id"),
        keep_id.alias("keep_id"),
        size.alias("group_size"),
        F.col("id").eqNullSafe(keep_id).alias("kept"),
    )


def exact_report(docs: DataFrame, keep: str = "smallest") -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    return with_groups(docs, keep).select(
        "doc_id", "keep_id", "group_size", "kept", F.sha2(F.encode("normal", "UTF-8"), 256).alias("text_sha256")
    )


def without_copies(docs: DataFrame, keep: str = "smallest") -> DataFrame:
    """The rows of ``docs`` that stay, with the same columns."""
    return with_groups(docs, keep).filter("kept").select("row.*")
