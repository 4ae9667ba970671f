"""Validity-interval join: by size and shape of the intervals, never rows of a key times rows of a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidemark.operators import segmented
from tidemark.operators.joins import BROADCAST_BYTES, measured_bytes
from tidemark.session import settle

# Intervals of one key that every fact row of the key may be compared with, and rows of a bin.
NEAR_ROWS = 128
BIN_ROWS = 256


def validity_join(
    fact: DataFrame,
    validity: DataFrame,
    on: Sequence[str],
    at: str,
    start: str,
    end: str,
    how: str = "inner",
    segment=segmented.AUTO,
) -> DataFrame:
    """Join each fact row to the rows valid at its time: ``start <= at < end``.

    An open ``end`` (null) never closes; a null key, time or start matches
    nothing; an interval that ends at or before its start is never valid.
    ``how`` is ``inner`` or ``left``. Three ways give equal rows:

    * few intervals per key in a small table: broadcast, compared in place;
    * disjoint intervals: both sides in one order, the last start is carried to the facts;
    * overlapping ones: bins of ``BIN_ROWS`` rows along each key. An interval is
      put down once for each of the bins its ends lie in and for the few blocks of
      bins (halves, quarters, ...) that make up what lies between. Facts compare
      times only in the bins of the ends; a block holds them all.

    Keys of any size are cut into ranges of time (``segment``, see ``segmented``).
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how!r}")
    valid = validity.filter(F.col(start).isNotNull() & (F.col(end).isNull() | (F.col(end) > F.col(start))))
    valid = valid.dropna(subset=list(on))
    most = valid.groupBy(*on).agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    if most <= NEAR_ROWS:
        small = measured_bytes(valid) <= BROADCAST_BYTES
        return _compared(fact, F.broadcast(valid) if small else valid, on, at, start, end, how)
    join = _swept if disjoint(valid, on, start, end, segment) else _binned
    usable = F.lit(True)
    for c in (*on, at):
        usable = usable & F.col(c).isNotNull()
    out = join(fact.filter(usable), valid, on, at, start, end, how, segment)
    if how == "inner":
        return out
    extra = [F.lit(None).cast(f.dataType).alias(f.name) for f in validity.schema.fields if f.name not in on]
    return out.union(fact.filter(~usable).select("*", *extra))


def disjoint(valid: DataFrame, on: Sequence[str], start: str, end: str, segment=segmented.AUTO) -> bool:
    """No interval of a key reaches past the start of the next one."""
    chain = valid.select(*on, F.col(start).alias("__start"), F.col(end).alias("__end"))
    chain = segmented.neighbour(chain, on, ["__start"], "__start", "__next", segment, following=True)
    meets = F.col("__next").isNotNull() & (F.col("__end").isNull() | (F.col("__end") > F.col("__next")))
    return chain.filter(meets).limit(1).count() == 0


def _within(at: Column, start: Column, end: Column) -> Column:
    return (start <= at) & (end.isNull() | (end > at))


def _compared(fact, valid, on, at, start, end, how) -> DataFrame:
    f, v = fact.alias("f"), valid.alias("v")
    cond = _within(F.col(f"f.{at}"), F.col(f"v.{start}"), F.col(f"v.{end}"))
    for k in on:
        cond = cond & (F.col(f"f.{k}") == F.col(f"v.{k}"))
    return f.join(v, cond, how).select("f.*", *[F.col(f"v.{c}") for c in valid.columns if c not in on])


def _nothing(df: DataFrame, packed: Column) -> Column:
    return F.lit(None).cast(df.select(packed.alias("s")).schema["s"].dataType)


def _swept(fact, valid, on, at, start, end, how, segment) -> DataFrame:
    """Starts and facts of a key in one order; the last interval begun is carried forward."""
    row, extra = F.struct("*"), [c for c in valid.columns if c not in on]
    begun = F.struct(*extra)
    facts = fact.select(*on, F.col(at).alias("__time"), F.lit(1).alias("__side"), row.alias("__row"), _nothing(valid, begun).alias("__begun"))
    starts = valid.select(*on, F.col(start).alias("__time"), F.lit(0).alias("__side"), _nothing(fact, row).alias("__row"), begun.alias("__begun"))
    both = facts.unionByName(starts)
    carried = segmented.last_seen(both, on, ["__time", "__side"], "__begun", "__last", segment).filter("__side = 1")
    hit = F.col("__last").isNotNull() & _within(F.col("__time"), F.col(f"__last.{start}"), F.col(f"__last.{end}"))
    if how == "inner":
        return carried.filter(hit).select("__row.*", "__last.*")
    kept = carried.withColumn("__last", F.when(hit, F.col("__last")))
    return kept.select("__row.*", "__last.*")


def _numbered(points: DataFrame, on: Sequence[str], segment) -> DataFrame:
    """Points with their bin, from 0 along the key, and the key's number of bins. Equal times share a bin."""
    if segment is segmented.AUTO:
        segment = segmented.plan(points, on, ["__time"]) or segmented.Ranges(1)
    if segment == segmented.Ranges(1):
        seg = settle(points.withColumn(segmented.SEG, F.lit(0)), "points")
    else:
        seg = segmented.with_segments(points, [*on, "__time"], segment)
    inside = W.partitionBy(*on, segmented.SEG)
    place = F.floor((F.rank().over(inside.orderBy("__time")) - 1) / BIN_ROWS)
    seg = seg.withColumn("__bin", place)
    bins = seg.groupBy(*on, segmented.SEG).agg((F.max("__bin") + 1).alias("__n"))
    earlier = W.partitionBy(*on).orderBy(segmented.SEG).rowsBetween(W.unboundedPreceding, -1)
    carry = bins.select(
        *on,
        segmented.SEG,
        F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"),
        F.sum("__n").over(W.partitionBy(*on)).alias("__bins"),
    )
    out = seg.join(carry, [*on, segmented.SEG]).withColumn("__bin", F.col("__bin") + F.col("__before"))
    return settle(out.drop(segmented.SEG, "__before"), "bins")


# Blocks of bins: level l, number k stands for the bins k * 2^l up to (k + 1) * 2^l. An odd block at an end of
# what is left to cover is taken, the rest goes to the next level.
BLOCKS = """filter(flatten(transform(sequence(0, length(bin(__bins))), l -> array(
  named_struct('level', l, 'block', if(shiftright(__lo + shiftleft(1L, l), l) % 2 = 1
    AND shiftright(__lo + shiftleft(1L, l), l) < shiftright(__hi, l), shiftright(__lo + shiftleft(1L, l), l), NULL)),
  named_struct('level', l, 'block', if(shiftright(__hi, l) % 2 = 1
    AND shiftright(__lo + shiftleft(1L, l), l) < shiftright(__hi, l), shiftright(__hi, l) - 1, NULL))))),
  b -> b.block IS NOT NULL)"""
ENDS = "transform(array_distinct(array(__lo, __hi)), b -> named_struct('level', -1, 'block', b))"
ABOVE = """concat(array(named_struct('level', -1, 'block', __bin)),
  transform(sequence(0, length(bin(__bins))), l -> named_struct('level', l, 'block', shiftright(__bin, l))))"""


def _binned(fact, valid, on, at, start, end, how, segment) -> DataFrame:
    row, interval = F.struct("*"), F.struct(*[c for c in valid.columns if c not in on])
    last = fact.agg(F.max(at)).first()[0]
    # Past the last fact nothing is asked for: an end there, or none, is the last fact's time.
    upto = F.when(F.col(end) < F.lit(last), F.col(end)).otherwise(F.lit(last))
    both_ends = F.array(F.struct(F.lit(1).alias("k"), F.col(start).alias("t")), F.struct(F.lit(2).alias("k"), upto.alias("t")))
    ends = (
        valid.filter(F.col(start) <= F.lit(last))
        .withColumns({"__valid": interval, "__ends": both_ends, "__id": F.monotonically_increasing_id()})
        .select(*on, "__id", "__valid", F.explode("__ends").alias("__e"))
        .select(
            *on, "__id", F.col("__e.k").alias("__kind"), F.col("__e.t").alias("__time"),
            F.when(F.col("__e.k") == 1, F.col("__valid")).alias("__valid"), _nothing(fact, row).alias("__row"),
        )
    )
    facts = fact.select(
        *on, F.monotonically_increasing_id().alias("__id"), F.lit(0).alias("__kind"), F.col(at).alias("__time"),
        _nothing(valid, interval).alias("__valid"), row.alias("__row"),
    )
    points = _numbered(facts.unionByName(ends), on, segment)

    spans = (
        points.filter("__kind > 0")
        .groupBy(*on, "__id")
        .agg(
            F.min("__bin").alias("__lo"), F.max("__bin").alias("__hi"), F.max("__bins").alias("__bins"),
            F.first("__valid", ignorenulls=True).alias("__valid"),
        )
    )
    put = spans.select(*on, "__valid", F.explode(F.concat(F.expr(ENDS), F.expr(BLOCKS))).alias("__at"))
    put = settle(put.select(*on, "__valid", "__at.*"), "blocks")

    rows = points.filter("__kind = 0").select(*on, "__id", "__time", "__row", "__bin", "__bins")
    where = rows.select(*on, "__bin", "__bins").distinct().select(*on, "__bin", F.explode(F.expr(ABOVE)).alias("__at"))
    where = where.select(*on, "__bin", "__at.*").join(put.select(*on, "level", "block").distinct(), [*on, "level", "block"], "left_semi")
    met = rows.join(where, [*on, "__bin"]).join(put, [*on, "level", "block"])
    inside = (F.col("level") >= 0) | _within(F.col("__time"), F.col(f"__valid.{start}"), F.col(f"__valid.{end}"))
    met = met.filter(inside).select("__id", "__row", "__valid")
    if how == "left":
        met = settle(met, "met")
        met = met.unionByName(rows.join(met.select("__id").distinct(), "__id", "left_anti").select("__id", "__row"), allowMissingColumns=True)
    return met.select("__row.*", "__valid.*")
