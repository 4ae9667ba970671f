"""Joins: size-checked broadcast, point in time, lookups."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

from tidemark.operators import segmented

BROADCAST_BYTES = 64 * 1024 * 1024


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows: text and bytes by their length, numbers and times as 16 bytes, all else by its JSON text."""
    width = F.lit(0)
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (StringType, BinaryType)):
            size = F.octet_length(c)
        elif isinstance(f.dataType, (ArrayType, StructType, MapType)):
            size = F.length(F.to_json(F.struct(c)))
        else:
            size = F.lit(16)
        width = width + F.coalesce(size, F.lit(0))
    return int(df.agg(F.coalesce(F.sum(width.cast("long")), F.lit(0))).first()[0])


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``df`` when its measured size is within ``limit``.

    Above it the frame is returned as it is and Catalyst plans a shuffle join,
    with adaptive skew handling.
    """
    return F.broadcast(df) if measured_bytes(df) <= limit else df


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    features: Sequence[str],
    tie: str | None = None,
    segment=segmented.AUTO,
) -> DataFrame:
    """Every left row with the key's latest right row at or before its time.

    Both sides are stacked and the last feature row is carried forward, so
    there is no fan-out and no row pairs. A feature at the same instant counts;
    of several at one instant the one with the highest ``tie`` wins.
    ``segment`` is a function of ``__time``.
    """
    row = F.struct(*[F.col(c) for c in left.columns])
    seen = F.struct(*[F.col(c) for c in features])
    order_tie = F.col(tie).cast("string") if tie else F.lit("")
    l = left.select(
        *keys,
        F.col(left_time).alias("__time"),
        F.lit(1).alias("__side"),
        F.lit("").alias("__tie"),
        row.alias("__row"),
        F.lit(None).cast(right.select(seen.alias("s")).schema["s"].dataType).alias("__seen"),
    )
    r = right.select(
        *keys,
        F.col(right_time).alias("__time"),
        F.lit(0).alias("__side"),
        (F.lpad(order_tie, 20, "0") if tie else order_tie).alias("__tie"),
        F.lit(None).cast(left.select(row.alias("r")).schema["r"].dataType).alias("__row"),
        seen.alias("__seen"),
    )
    both = l.unionByName(r)
    order = ["__time", "__side", "__tie"]
    carried = segmented.last_seen(both, keys, order, "__seen", "__latest", segment)
    return carried.filter(F.col("__side") == 1).select("__row.*", *[f"__latest.{c}" for c in features])


@dataclass(frozen=True)
class Lookup:
    """Columns to fetch from a feature table with one row per key."""

    table: DataFrame
    key: str
    columns: Sequence[str]


def feature_lookup(base: DataFrame, lookups: Sequence[Lookup], fill: float | None = None) -> DataFrame:
    """Left join of each lookup on its key; only the named columns are read."""
    out = base
    for l in lookups:
        out = out.join(l.table.select(l.key, *l.columns), l.key, "left")
    if fill is not None:
        out = out.fillna(fill, [c for l in lookups for c in l.columns])
    return out


def latest_by(df: DataFrame, keys: Sequence[str], newest: Sequence[Column]) -> DataFrame:
    """One row per key: the first in the order ``newest``, which must be total.

    ``row_number() = 1`` is pre-limited before the shuffle, so a hot key sends
    one row per map task.
    """
    from pyspark.sql import Window as W

    first = W.partitionBy(*keys).orderBy(*newest)
    return df.withColumn("__rn", F.row_number().over(first)).filter("__rn = 1").drop("__rn")
