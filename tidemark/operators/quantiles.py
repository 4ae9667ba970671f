"""Exact quantiles at any size: values are counted, counts are summed along the order."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, Window as W, functions as F

from tidemark.operators import segmented
from tidemark.session import settle


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], column: str, shares: Sequence[str], out: str = "quantiles", segment=segmented.AUTO
) -> DataFrame:
    """Per key an array of the smallest values that at least these shares of the rows do not exceed.

    ``shares`` are decimal texts such as ``"0.95"``, so that a position is never
    off by a rounding error. Nulls in ``column`` are left out; a key without any
    other value has no row (without keys: one row of nulls). Each value costs one
    row. No key has more values than the frame has rows: a frame that fits one
    task is summed by plain windows. In a larger one the counted values are
    stored, and their running sums are cut into ranges where a key has many.
    """
    rows = df.filter(F.col(column).isNotNull())
    if keys:
        # A null key is a key: the struct around it never is.
        rows = rows.select(F.struct(*[F.col(k) for k in keys]).alias("__k"), F.col(column).alias("__v"))
    else:
        rows = rows.select(F.col(column).alias("__v"))
    by = ["__k"] if keys else []
    levels = rows.groupBy(*by, "__v").agg(F.count(F.lit(1)).alias("__n"))
    if segment is segmented.AUTO:
        if df.count() <= (segmented.MAX_ROWS if keys else segmented.KEYLESS_ROWS):
            segment = None
        else:
            levels = settle(levels, "quantile-levels")
            segment = segmented.plan(levels, by, ["__v"])
    if segment is None:  # the counted values are shuffled once, to one task per key
        mine = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
        upto = F.sum("__n").over(mine.orderBy("__v").rowsBetween(W.unboundedPreceding, 0))
        known = levels.withColumns({"__upto": upto, "__total": F.sum("__n").over(mine)})
        return _picked(known, by, keys, shares, out)
    summed = segmented.running_sum(levels, by, ["__v"], "__n", "__upto", segment)
    if by:
        known = summed.join(levels.groupBy("__k").agg(F.sum("__n").alias("__total")), "__k")
    else:
        known = summed.withColumn("__total", levels.agg(F.sum("__n")).scalar())
    return _picked(known, by, keys, shares, out)


def _picked(known: DataFrame, by: list[str], keys: Sequence[str], shares: Sequence[str], out: str) -> DataFrame:
    """The first values whose running count reaches each share of the total."""
    places = [F.greatest(F.lit(1), F.ceil(F.col("__total") * F.lit(Decimal(s)))) for s in shares]
    picked = [F.min(F.when(F.col("__upto") >= p, F.col("__v"))) for p in places]
    found = known.groupBy(*by).agg(F.array(*picked).alias(out))
    return found.select(*[F.col("__k")[k].alias(k) for k in keys], out)


def column_quantiles(df: DataFrame, columns: Sequence[str], shares: Sequence[str], segment=segmented.AUTO) -> DataFrame:
    """``column_name, quantiles`` (doubles) of many numeric columns from one read of the table.

    Every value becomes a row with its column's number, and the columns are the
    keys. A number keeps its place in the order when it is cast to double, so
    the cast of an exact quantile is what comes out. A column of nulls has no row.
    """
    if not columns:
        return df.sparkSession.createDataFrame([], "column_name string, quantiles array<double>")
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("double").alias("v")) for c in columns]
    return exact_quantiles(df.select(F.inline(F.array(*cells))), ["column_name"], "v", shares, segment=segment)
