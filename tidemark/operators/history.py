"""States of a table from its stored change log: plain aggregates and joins over the changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.operators.joins import latest_by
from tidemark.operators.mutation import change_feed

VERSION = "snapshot_version"
LOGGED = ("_change_type", VERSION, "_operation", "_committed_at")


def logged(feed: DataFrame, operation: str, committed_at: str) -> DataFrame:
    """A change feed with the name and time of its commit, its version as ``snapshot_version``."""
    return feed.withColumnRenamed("_commit_version", VERSION).withColumns(
        {"_operation": F.lit(operation), "_committed_at": F.lit(committed_at).cast("timestamp_ntz")}
    )


def as_load(df: DataFrame, version: int = 0) -> DataFrame:
    """The rows a table starts with, of change type ``load``: they count as rows, not as changes."""
    return df.withColumns({"_change_type": F.lit("load"), "_commit_version": F.lit(version).cast("long")})


def state_at(log: DataFrame, keys: Sequence[str], version: int | None = None, at: str | None = None) -> DataFrame:
    """The rows of the table after ``version``, or at the time ``at``; both null: now.

    The last change of each key decides. The log is filtered before the one
    shuffle, and a log stored by version is read up to that version only. A
    version or time before the first change gives no rows.
    """
    if version is not None:
        log = log.filter(F.col(VERSION) <= version)
    if at is not None:
        log = log.filter(F.col("_committed_at") <= F.lit(at).cast("timestamp_ntz"))
    effect = log.filter(F.col("_change_type") != "update_preimage")
    # A key deleted and inserted in one version ends with the insert.
    late = F.when(F.col("_change_type") == "delete", 0).otherwise(1)
    last = latest_by(effect, keys, [F.desc(VERSION), late.desc()])
    return last.filter(F.col("_change_type") != "delete").drop(*LOGGED)


def changes_back(log: DataFrame, keys: Sequence[str], version: int, as_version: int) -> DataFrame:
    """The changes that bring the table back to ``version``: a join of two states, only unlike rows remain."""
    return change_feed(state_at(log, keys), state_at(log, keys, version), keys, as_version)


def history(log: DataFrame) -> DataFrame:
    """Per version its operation, change counts and the rows of the table after it, from one aggregate."""

    def kind(name: str):
        return F.count_if(F.col("_change_type") == name)

    per_version = log.groupBy(VERSION, F.col("_operation").alias("operation")).agg(
        kind("load").alias("__loaded"),
        kind("insert").alias("inserted"),
        kind("update_postimage").alias("updated"),
        kind("delete").alias("deleted"),
    )
    # One row per version is left.
    upto = Window.orderBy(VERSION)
    gained = F.col("__loaded") + F.col("inserted") - F.col("deleted")
    return per_version.withColumn("rows", F.sum(gained).over(upto)).drop("__loaded")
