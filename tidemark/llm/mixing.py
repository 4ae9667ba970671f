"""Mix sources to target weights with hash thresholds found from nested histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import broadcast_checked, count_words, ordered_blocks, row_of, text_of
from tidemark.session import settle

#: Bits of the document hash, and bits that one histogram resolves.
BITS, STEP = 60, 12


def id_hash(doc_id: Column) -> Column:
    """60 bits of MD5 of the id: the same in every run and for every partitioning."""
    hexed = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(hexed, 1, BITS // 4), 16, 10).cast("long")


def ranked_sources(sizes: DataFrame) -> DataFrame:
    """``source, total`` and its position by code point, null last."""
    totals = settle(sizes.groupBy("source").agg(F.sum("size").alias("total")), "mix-totals")
    order = F.col("source").asc_nulls_last()
    blocks = ordered_blocks(totals, [order], "mix-sources")
    counts = blocks.groupBy("block").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inner = F.row_number().over(Window.partitionBy("block").orderBy(order)) - 1
    return blocks.withColumn("inner", inner).join(F.broadcast(starts), "block").select(
        "source", "total", (F.col("start") + F.col("inner")).alias("place")
    )


def targets(sizes: DataFrame, weights: Sequence[int], share: float, most: int) -> DataFrame:
    """``source, total, target``: the budget by weight, no source above ``most`` times its size.

    What a source cannot take goes to the others by weight. Each round takes two
    sums over the sources; sources once full stay full, so it ends.
    """
    ranked = ranked_sources(sizes)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    ranked = settle(ranked.select("source", "total", weight.alias("weight")), "mix-ranked")
    budget = share * float(ranked.agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0])
    full = most * F.col("total")
    level = 0.0
    while True:
        over = full < F.lit(level) * F.col("weight")
        taken, open_weight = ranked.agg(
            F.coalesce(F.sum(F.when(over, full)), F.lit(0)), F.sum(F.when(~over, F.col("weight")))
        ).first()
        if not open_weight:
            break
        found = (budget - float(taken)) / float(open_weight)
        if found <= level:
            break
        level = found
    share_of = F.lit(level) * F.col("weight")
    target = F.when(full < share_of, full.cast("double")).otherwise(share_of)
    return ranked.select("source", "total", target.alias("target"))


def thresholds(sizes: DataFrame, goals: DataFrame) -> DataFrame:
    """``source, total, target, passes, below``: whole passes, then documents with ``h < below`` once more.

    A histogram of ``STEP`` hash bits per source finds the bucket in which the
    rest of the budget ends; only that bucket is resolved further, until it
    holds a single hash. The document in which the budget ends is taken when
    that comes nearer to the target. Nothing is sorted: a histogram has at most
    ``2**STEP`` rows per source, however large the source.
    """
    passes = F.when(F.col("total") > 0, F.floor(F.col("target") / F.col("total"))).otherwise(0).cast("long")
    goals = goals.withColumn("passes", passes)
    goals = settle(goals.withColumn("rest", F.col("target") - F.col("passes") * F.col("total")), "mix-goals")
    edge = goals.select("source", "rest", F.lit(0).cast("long").alias("bucket"), F.lit(0).cast("long").alias("base"))
    done = None
    shift = BITS
    while True:
        inside = sizes.alias("s").join(
            broadcast_checked(edge).alias("e"),
            F.col("s.source").eqNullSafe(F.col("e.source")) & (F.shiftright("s.h", shift) == F.col("e.bucket")),
        )
        shift -= STEP
        histogram = inside.groupBy(
            F.col("e.source").alias("source"), "rest", "base", F.shiftright("s.h", shift).alias("bucket")
        ).agg(F.sum("size").alias("words"), F.min("h").alias("low"), F.max("h").alias("high"))
        upto = F.sum("words").over(Window.partitionBy("source").orderBy("bucket"))
        summed = histogram.withColumn("end", F.col("base") + upto)
        start = F.col("end") - F.col("words")
        ends_here = (start <= F.col("rest")) & (F.col("end") > F.col("rest"))
        hit = settle(
            summed.filter(ends_here).select("source", "rest", "bucket", start.alias("base"), "end", "low", "high"),
            "mix-edge",
        )
        nearer = F.col("end") - F.col("rest") < F.col("rest") - F.col("base")
        single = hit.filter("low = high").select("source", F.when(nearer, F.col("low") + 1).otherwise(F.col("low")).alias("below"))
        done = single if done is None else done.unionByName(single)
        edge = hit.filter("low < high").select("source", "rest", "bucket", "base")
        if shift == 0 or edge.isEmpty():
            break
    plan = goals.alias("g").join(done.alias("d"), F.col("g.source").eqNullSafe(F.col("d.source")), "left")
    below = F.coalesce(F.col("below"), F.lit(0)).cast("long")
    return settle(plan.select("g.source", "total", "target", "passes", below.alias("below")), "mix-plan")


def mixing_plan(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, most: int = 2) -> DataFrame:
    """Per source its size, target, whole passes and hash threshold."""
    sizes = _sizes(docs)
    return thresholds(sizes, targets(sizes, weights, share, most))


def _sizes(docs: DataFrame) -> DataFrame:
    sized = docs.select("doc_id", "source", count_words(text_of()).alias("size"), id_hash(F.col("doc_id")).alias("h"))
    return settle(sized, "mix-sizes")


def mixture(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, most: int = 2) -> DataFrame:
    """One row per document: ``doc_id, size, source, source_size, target, copies, taken``.

    Sizes are words; a null text has none. A null source is a source of its own,
    the last. Rows with the same id share their hash and so their verdict. An
    empty table, or one without a word, gives targets of zero.
    """
    sizes = _sizes(docs)
    plan = thresholds(sizes, targets(sizes, weights, share, most))
    copies = F.col("passes") + (F.col("h") < F.col("below")).cast("long")
    joined = sizes.alias("s").join(
        broadcast_checked(plan).alias("p"), F.col("s.source").eqNullSafe(F.col("p.source"))
    )
    return joined.select(
        "doc_id",
        "size",
        F.col("s.source").alias("source"),
        F.col("total").alias("source_size"),
        "target",
        copies.alias("copies"),
        (F.col("size") * copies).alias("taken"),
    )


def mixed(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, most: int = 2) -> DataFrame:
    """The rows of ``docs`` that the mix takes, each as often as it takes them; same columns."""
    plan = broadcast_checked(mixing_plan(docs, weights, share, most))
    rows = docs.select(row_of(docs), F.col("source").alias("s"), id_hash(F.col("doc_id")).alias("h"))
    copies = (F.col("passes") + (F.col("h") < F.col("below")).cast("long")).cast("int")
    taken = rows.join(plan, F.col("s").eqNullSafe(F.col("source"))).withColumn("copies", copies).filter("copies > 0")
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
