"""Helpers that the corpus operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.text import bind
from tidemark.operators.joins import BROADCAST_BYTES
from tidemark.session import settle

#: Bytes of text, or members of lists, worked on together in a task.
SLICE = 4 << 20

#: The white space of the word rule: blank and the five controls from tab to carriage return.
BLANKS = " \t\n\x0b\f\r"
GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def row_of(df: DataFrame) -> Column:
    """All columns in one struct, so that no name of theirs can clash with a working column."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")


def unpacked(df: DataFrame) -> DataFrame:
    return df.select("row.*")


def text_of(name: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(f"`{name}`"), F.lit(""))


def words(text: Column) -> Column:
    """Maximal runs of characters that are not white space; no word gives an empty array."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, GAP))


def count_words(text: Column) -> Column:
    return bind(F.btrim(text, F.lit(BLANKS)), lambda t: F.when(t == "", 0).otherwise(F.size(F.split(t, GAP)))).cast(
        "long"
    )


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else. Plain ``lower`` does that for texts of ASCII only."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, upper, upper.lower())).otherwise(F.lower(text))


def packed_bytes(df: DataFrame) -> int:
    """Bytes of the rows by their JSON text: an upper estimate that counts arrays and structs too."""
    row = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    return int(df.agg(F.coalesce(F.sum(F.length(row).cast("long") + 16), F.lit(0))).first()[0])


def broadcast_checked(df: DataFrame, limit: int = BROADCAST_BYTES // 8) -> DataFrame:
    """Broadcast a stored table when its measured size is within ``limit``.

    Above it the table stays as it is: Catalyst joins by shuffle, and a hot key
    is split by the adaptive skew join.
    """
    return F.broadcast(df) if packed_bytes(df) <= limit else df


def ordered_blocks(df: DataFrame, order: list, label: str, rows_per_block: int = 4_000_000) -> DataFrame:
    """``df`` stored in range blocks of ``order``; column ``block`` rises with the order.

    Rows with equal order keys share a block. With the per-block totals of a
    bounded number of blocks, positions and running sums over the whole order
    need no task that sees all rows.
    """
    spark = df.sparkSession
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(1, min(most, 1 + df.count() // 1000), df.count() // rows_per_block)
    ranged = df.repartitionByRange(blocks, *order)
    return settle(ranged.withColumn("block", F.spark_partition_id()), label)


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts or lists together are about ``most`` long; a longer row is a part of its own."""
    values = batch.column(column)
    length = pc.list_value_length(values) if pa.types.is_list(values.type) else pc.binary_length(values)
    ends = np.cumsum(length.to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(at, end - at)
        at = end
