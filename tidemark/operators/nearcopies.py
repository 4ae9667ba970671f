"""Near copies: an exact set-similarity join over rare shingles, and the groups its links form."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidemark.functions import text as tx
from tidemark.operators.joins import broadcast_if_small
from tidemark.session import settle

#: Documents of one shingle that are paired row by row; longer lists are compared in blocks.
LIST = 128
#: Documents, and shingles of all of them together, on each side of a block.
BLOCK_DOCS, BLOCK_SHINGLES = 256, 100_000


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``edges(a, b)``: the smallest node it is connected to.

    Star contraction: every node hands the smallest of its neighbours (and
    itself) to its larger neighbours, then to its smaller ones, until no edge
    changes. Edges then lead straight to the smallest node. Rounds grow with
    the logarithm of the longest path; a node with many neighbours is one
    minimum and one join, never one row, and every round is stored.
    """
    links = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()
    links = settle(links, "stars")

    def mark(df: DataFrame) -> tuple:
        h = F.xxhash64("a", "b")
        return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(h), F.sum(F.pmod(h, F.lit(1 << 31)))).first())

    seen = mark(links)
    while True:
        ends = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        centre = ends.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("m")).withColumnRenamed("a", "c")
        outer = links.withColumnRenamed("b", "c").join(centre, "c")  # larger neighbours of each centre
        large = settle(outer.select("a", F.col("m").alias("b")).distinct(), "stars-large")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        inner = large.join(low, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = settle(inner.unionByName(low.withColumnRenamed("m", "b")).distinct(), "stars")
        now = mark(links)
        if now == seen:
            break
        seen = now
    tops = links.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return settle(links.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(tops), "star-labels")


def similar(common: Column, x: Column, y: Column, percent: int) -> Column:
    return 100 * common >= percent * (x + y - common)


def reachable(x: Column, y: Column) -> Column:
    """Most shingles that two postings' sets can have in common, exactly: up to the shared place, and behind it."""
    rest = F.least(x["known"] - x["place"], y["known"] - y["place"])
    return F.least(x["place"], y["place"]) + rest


def rare_postings(sets: DataFrame, percent: int) -> DataFrame:
    """``h, id, size, known, place``: of each set the rarest shingles, as many as must hit any similar set.

    Two sets of which ``percent`` is common share one of their first
    ``size - ceil(percent * size / 100) + 1`` shingles in any fixed order; the
    order is by documents, rarest first. Shingles of one document have no
    partner: they only count in the order. ``place`` is the place among the
    ``known`` others. Shingles are dealt and counted in one exchange; the rows
    of one are its documents, a small share of all rows.
    """
    each = sets.select("id", F.size("s").alias("size"), F.explode("s").alias("h"))
    counted = each.withColumn("n", F.count(F.lit(1)).over(W.partitionBy("h"))).filter("n > 1")
    mine = W.partitionBy("id")
    ranked = counted.withColumn("known", F.count(F.lit(1)).over(mine)).withColumn("place", F.row_number().over(mine.orderBy("n", "h")))
    reach = F.col("size") - F.ceil(F.col("size") * percent / F.lit(100)) + 1
    return ranked.filter(F.col("size") - F.col("known") + F.col("place") <= reach).select("h", "id", "size", "known", "place")


def _sets_of(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """The rows of ``sets`` whose id is in the column of ``nodes``: only these are shuffled further on."""
    return sets.join(broadcast_if_small(settle(nodes.toDF("id").distinct(), "near-nodes")), "id", "left_semi")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The rows of ``pairs(a, b, ...)`` whose full sets are similar."""
    pairs = settle(pairs, "near-pairs")
    few = _sets_of(pairs.select("a").union(pairs.select("b")), sets)
    left = few.select(F.col("id").alias("a"), F.col("s").alias("s_a"))
    right = few.select(F.col("id").alias("b"), F.col("s").alias("s_b"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("s_a", "s_b"))
    return both.filter(similar(common, F.size("s_a"), F.size("s_b"), percent)).drop("s_a", "s_b")


def _block_links(percent: int):
    """Labels linked by two blocks of one list, from the products of their incidence matrices."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        i, j = int(rows["i"].iloc[0]), int(rows["j"].iloc[0])
        sides = [rows[rows["block"] == k] for k in (i, j)]
        flat = [np.concatenate([np.asarray(s, dtype=np.int64) for s in d["s"]] or [np.zeros(0, np.int64)]) for d in sides]
        shared = np.intersect1d(*flat)
        entries = []
        for d, h in zip(sides, flat):
            doc = np.repeat(np.arange(len(d)), [len(s) for s in d["s"]])
            at = np.minimum(np.searchsorted(shared, h), max(0, len(shared) - 1))
            hit = shared[at] == h if len(shared) else np.zeros(len(h), bool)
            entries.append((doc[hit], at[hit]))
        common = np.zeros((len(sides[0]), len(sides[1])))
        for start in range(0, len(shared), 4096):
            parts = []
            for d, (doc, at) in zip(sides, entries):
                here = (at >= start) & (at < start + 4096)
                m = np.zeros((len(d), min(4096, len(shared) - start)), dtype=np.float32)
                m[doc[here], at[here] - start] = 1
                parts.append(m)
            common += parts[0] @ parts[1].T
        x, y = (d["size"].to_numpy()[:, None] for d in sides)
        p, q = (d["label"].to_numpy()[:, None] for d in sides)
        at = np.nonzero((100 * common >= percent * (x + y.T - common)) & (p != q.T))
        out = pd.DataFrame({"a": p[at[0], 0], "b": q[at[1], 0]})
        return out.drop_duplicates()

    return run


def label_links(postings: DataFrame, sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """``a, b``: components that hold a similar pair sharing a rare shingle.

    Only members of different components meet. Short lists are paired, long
    ones compared block by block, so a list of any length spreads over tasks.
    """
    named = postings.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    lists = named.groupBy("h").agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("total"), F.min("label").alias("low"), F.max("label").alias("high")
    )
    mixed = settle(lists.filter("low < high").select("h", "n", "total"), "near-lists")
    open_ = settle(named.join(mixed, "h"), "near-open")

    short = open_.filter(F.col("n") <= LIST)
    left = short.select("h", F.struct("id", "label", "size", "known", "place").alias("x"))
    right = short.select("h", F.struct("id", "label", "size", "known", "place").alias("y"))
    x, y = F.col("x"), F.col("y")
    fits = (x["id"] < y["id"]) & (x["label"] != y["label"]) & similar(reachable(x, y), x["size"], y["size"], percent)
    ends = x["id"].alias("a"), y["id"].alias("b"), x["label"].alias("la"), y["label"].alias("lb")
    pairs = left.join(right, "h").filter(fits).select(*ends).distinct()
    found = _verified(pairs, sets, percent).select(F.col("la").alias("a"), F.col("lb").alias("b"))

    long = open_.filter(F.col("n") > LIST)
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK_DOCS), F.ceil(F.col("total") / BLOCK_SHINGLES)).cast("int")
    dealt = long.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    met = dealt.withColumn("other", other).select(
        "h", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "id", "label", "size"
    )
    in_blocks = met.join(_sets_of(long.select("id"), sets), "id").groupBy("h", "i", "j").applyInPandas(_block_links(percent), "a long, b long")
    return found.unionByName(in_blocks).distinct()


def near_groups(df: DataFrame, doc_id: str, text: str, percent: int = 70, width: int = 3) -> DataFrame:
    """``(doc_id, keep_id, group_size)`` of every document that is in a group of near copies.

    Documents are linked when ``percent`` of their word shingles are common; a
    group is what links connect, ``keep_id`` its smallest id. No link is
    estimated or left out: candidates come from shingles rare enough that every
    similar pair shares one, and are compared on full sets.

    Equal sets are merged first. All documents of a rare shingle meet the
    list's first document; only what then still lies in different components
    is compared further, so a text edited a thousand times is not a million
    pairs. A null text counts as empty; texts without a word are alike.
    """
    source = df.select(F.col(doc_id).alias("id"), tx.shingles(F.coalesce(F.col(text), F.lit("")), width).alias("s"))
    source = source.select("id", "s", F.md5(F.to_json(F.array_sort("s"))).alias("digest"), F.monotonically_increasing_id().alias("row"))
    source = settle(source, "near-sets")
    least = source.filter("id IS NOT NULL").groupBy("digest").agg(F.min(F.struct("id", "row")).alias("f"))
    first = settle(least.select("digest", F.col("f.id").alias("first"), F.col("f.row").alias("row")), "near-firsts")
    same = source.select("id", "digest").join(first.drop("row"), "digest").select("id", "first")
    # Of equal sets one row is compared. The others are few or, if not, a shuffle of the rest is small.
    chosen = first.groupBy("first").agg(F.min("row").alias("row")).select("row")
    copies = settle(source.select("row").join(chosen, "row", "left_anti"), "near-equal")
    sets = source.join(broadcast_if_small(copies), "row", "left_anti").select("id", "s")
    postings = settle(rare_postings(sets, percent), "near-postings")

    heads = postings.groupBy("h").agg(F.min(F.struct("id", "size", "known", "place")).alias("y"), F.count(F.lit(1)).alias("n"))
    x, y = F.struct("id", "size", "known", "place"), F.col("y")
    near = (F.col("id") != y["id"]) & similar(reachable(x, y), x["size"], y["size"], percent)
    stars = postings.join(heads.filter("n > 1"), "h").filter(near).select(F.col("id").alias("a"), y["id"].alias("b")).distinct()
    labels = components(_verified(stars, sets, percent)).withColumnRenamed("node", "id")
    between = components(label_links(postings, sets, labels, percent)).select(F.col("node").alias("label"), F.col("label").alias("top"))
    merged = same.join(labels.withColumnRenamed("id", "first"), "first", "left")
    merged = merged.select("id", F.coalesce("label", "first").alias("label")).join(between, "label", "left")
    grouped = settle(merged.select("id", F.coalesce("top", "label").alias("keep_id")), "near-groups")
    sizes = grouped.groupBy("keep_id").agg(F.count(F.lit(1)).alias("group_size")).filter("group_size > 1")
    return grouped.join(sizes, "keep_id").select(F.col("id").alias(doc_id), "keep_id", "group_size")
