"""Connected components by rounds of joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.session import settle


def _stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one smaller node only, which hangs on none: then the edges are the answer."""
    ends = edges.select("a", F.lit(1).alias("up")).unionByName(edges.select(F.col("b").alias("a"), F.lit(0).alias("up")))
    seen = ends.groupBy("a").agg(F.sum("up").alias("up"), F.min("up").alias("leaf"))
    return seen.filter("up > 1 OR up = 1 AND leaf = 0").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``edges(a, b)``; the label is the smallest node it can reach.

    Alternating star contraction: each node hangs its larger neighbours, then
    its smaller ones, on the smallest of them, until all edges form stars. The number
    of rounds grows with the logarithm of the component size. Each step is one
    minimum per node and one join on stored edges, so neither a large component
    nor a node with many neighbours meets in one row, and lineage stays short.
    """
    current = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    current = settle(current, "links")
    while not _stars(current):
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        larger = current.select(F.col("b").alias("u"), F.col("a").alias("v"))
        large = larger.join(least.withColumnRenamed("a", "u"), "u")
        large = settle(large.select(F.col("v").alias("a"), F.col("m").alias("b")).distinct(), "links-large")
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(smallest, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = hung.unionByName(smallest.select("a", F.col("m").alias("b"))).distinct()
        current = settle(small, "links")
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return settle(current.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(roots), "links-labels")
