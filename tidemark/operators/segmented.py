"""Ordered windows for keys of any size.

A plain ``Window.partitionBy(key)`` sends all rows of a key to one task. That
is the best plan while the largest key fits a task, and a failure when one key
holds a third of the table. ``plan`` measures the largest key; above
``MAX_ROWS`` the rows are dealt into *segments*, ranges of the whole order:
windows run inside (key, segment), one small summary row per segment is carried
forward along the key, and the two are added. The large side is shuffled once,
on (key, segment), and that partitioning serves both the join with the carried
summary and the window. Without keys all rows are one key, so there the limit
is ``KEYLESS_ROWS``.

Every function takes ``segment``: ``AUTO`` measures, ``None`` is the plain
window, ``Ranges(n)`` deals into n ranges, a column is used as it is and must
not decrease along ``order``. Keys must not be null.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidemark.session import settle

SEG = "__segment"
AUTO = object()
# Rows of one key that a single task may sort, and rows of a frame without keys.
MAX_ROWS = 5_000_000
KEYLESS_ROWS = 1_000_000


@dataclass(frozen=True)
class Ranges:
    """Segments by Spark's range partitioning: any orderable type, all order columns, any number."""

    parts: int


def plan(df: DataFrame, keys: Sequence[str], order: Sequence[str], max_rows: int | None = None) -> Ranges | None:
    """None when every key fits a task, else ranges of about even size over all rows."""
    limit = max_rows or (MAX_ROWS if keys else min(MAX_ROWS, KEYLESS_ROWS))
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    largest, total = sizes.agg(F.coalesce(F.max("n"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    return None if largest <= limit else Ranges(max(2, -(-total // limit)))


def with_segments(df: DataFrame, order: Sequence[str], segment) -> DataFrame:
    """``df`` with its segment, stored when it is the number of a range: a number must not change on a re-run."""
    if not isinstance(segment, Ranges):
        return df.withColumn(SEG, segment)
    return settle(df.repartitionByRange(segment.parts, *order).withColumn(SEG, F.spark_partition_id()), "segments")


def search(c: Column, cuts: Sequence) -> Column:
    """Number of the range of ``cuts`` that holds ``c``, by nested halving."""
    cuts = sorted(set(cuts))

    def half(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        mid = (low + high) // 2
        return F.when(c <= F.lit(cuts[mid]), half(low, mid)).otherwise(half(mid + 1, high))

    return half(0, len(cuts))


def _resolve(df, keys, order, segment):
    return plan(df, keys, order) if segment is AUTO else segment


def _over(keys: Sequence[str]):
    # Without keys this is one partition: a plan made for few rows, or one row per segment.
    return W.partitionBy(*keys) if keys else W.partitionBy(F.lit(0))


def _point(order: Sequence[str]) -> Column:
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    segment=AUTO,
    inclusive: bool = True,
) -> DataFrame:
    """Sum of ``value`` from the first row of the key up to this row."""
    segment = _resolve(df, keys, order, segment)
    last, zero = 0 if inclusive else -1, F.lit(0)
    if segment is None:
        upto = _over(keys).orderBy(*order).rowsBetween(W.unboundedPreceding, last)
        return df.withColumn(out, F.coalesce(F.sum(value).over(upto), zero))
    seg = with_segments(df, order, segment)
    parts = seg.groupBy(*keys, SEG).agg(F.sum(value).alias("__part"))
    earlier = _over(keys).orderBy(SEG).rowsBetween(W.unboundedPreceding, -1)
    carry = parts.withColumn("__carry", F.sum("__part").over(earlier)).drop("__part")
    inside = W.partitionBy(*keys, SEG).orderBy(*order).rowsBetween(W.unboundedPreceding, last)
    return (
        seg.join(carry, [*keys, SEG], "left")
        .withColumn(out, F.coalesce("__carry", zero) + F.coalesce(F.sum(value).over(inside), zero))
        .drop(SEG, "__carry")
    )


def row_position(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str, segment=AUTO) -> DataFrame:
    """1-based position of the row within its key."""
    segment = _resolve(df, keys, order, segment)
    if segment is None:
        return df.withColumn(out, F.row_number().over(_over(keys).orderBy(*order)))
    seg = with_segments(df, order, segment)
    parts = seg.groupBy(*keys, SEG).agg(F.count(F.lit(1)).alias("__part"))
    earlier = _over(keys).orderBy(SEG).rowsBetween(W.unboundedPreceding, -1)
    carry = parts.withColumn("__carry", F.sum("__part").over(earlier)).drop("__part")
    inside = W.partitionBy(*keys, SEG).orderBy(*order)
    return (
        seg.join(carry, [*keys, SEG], "left")
        .withColumn(out, F.coalesce("__carry", F.lit(0)) + F.row_number().over(inside))
        .drop(SEG, "__carry")
    )


def neighbour(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    segment=AUTO,
    following: bool = False,
) -> DataFrame:
    """``value`` of the previous (or following) row of the key.

    ``order`` must be unique within the key.
    """
    segment = _resolve(df, keys, order, segment)
    at_edge, step = (F.min_by, F.lead) if following else (F.max_by, F.lag)
    if segment is None:
        return df.withColumn(out, step(value).over(_over(keys).orderBy(*order)))
    seg = with_segments(df, order, segment)
    ends = seg.groupBy(*keys, SEG).agg(at_edge(F.col(value), _point(order)).alias("__end"))
    carry = ends.withColumn("__carry", step("__end").over(_over(keys).orderBy(SEG))).drop("__end")
    inside = W.partitionBy(*keys, SEG).orderBy(*order)
    edge = step(F.lit(1)).over(inside).isNull()
    return (
        seg.join(carry, [*keys, SEG], "left")
        .withColumn(out, F.when(edge, F.col("__carry")).otherwise(step(value).over(inside)))
        .drop(SEG, "__carry")
    )


def last_seen(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str, segment=AUTO
) -> DataFrame:
    """Latest non-null ``value`` of the key at or before this row."""
    segment = _resolve(df, keys, order, segment)
    if segment is None:
        upto = _over(keys).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
        return df.withColumn(out, F.last(value, ignorenulls=True).over(upto))
    seg = with_segments(df, order, segment)
    # Rows without a value have no point, so they never win.
    known = F.when(F.col(value).isNotNull(), _point(order))
    ends = seg.groupBy(*keys, SEG).agg(F.max_by(F.col(value), known).alias("__end"))
    earlier = _over(keys).orderBy(SEG).rowsBetween(W.unboundedPreceding, -1)
    carry = ends.withColumn("__carry", F.last("__end", ignorenulls=True).over(earlier)).drop("__end")
    inside = W.partitionBy(*keys, SEG).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return (
        seg.join(carry, [*keys, SEG], "left")
        .withColumn(out, F.coalesce(F.last(value, ignorenulls=True).over(inside), "__carry"))
        .drop(SEG, "__carry")
    )


def ranks(
    df: DataFrame,
    keys: Sequence[str],
    measure: str,
    rank: str = "rank",
    dense: str = "dense_rank",
    segment=AUTO,
) -> DataFrame:
    """Rank and dense rank by ``measure``, highest first.

    Ranks are worked out over the distinct values with their counts, so a value
    that fills the table costs one row. ``segment`` is a function of ``measure``.
    """
    levels = df.groupBy(*keys, measure).agg(F.count(F.lit(1)).alias("__n"))
    segment = _resolve(levels, keys, [measure], segment)
    if segment is None:
        down = _over(keys).orderBy(F.desc(measure))
        above = F.coalesce(F.sum("__n").over(down.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        placed = levels.select(*keys, measure, (above + 1).alias(rank), F.row_number().over(down).alias(dense))
        return df.join(placed, [*keys, measure], "left")
    levels = with_segments(levels, [measure], segment)
    parts = levels.groupBy(*keys, SEG).agg(
        F.sum("__n").alias("__rows"), F.count(F.lit(1)).alias("__values")
    )
    higher = _over(keys).orderBy(F.desc(SEG)).rowsBetween(W.unboundedPreceding, -1)
    carry = parts.select(
        *keys,
        SEG,
        F.coalesce(F.sum("__rows").over(higher), F.lit(0)).alias("__rows"),
        F.coalesce(F.sum("__values").over(higher), F.lit(0)).alias("__values"),
    )
    inside = W.partitionBy(*keys, SEG).orderBy(F.desc(measure))
    above = inside.rowsBetween(W.unboundedPreceding, -1)
    placed = levels.join(carry, [*keys, SEG], "left").select(
        *keys,
        measure,
        (F.col("__rows") + F.coalesce(F.sum("__n").over(above), F.lit(0)) + 1).alias(rank),
        (F.col("__values") + F.row_number().over(inside)).alias(dense),
    )
    return df.join(placed, [*keys, measure], "left")
