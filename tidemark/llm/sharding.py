"""Contiguous shards of least largest size over groups that stay whole."""

from __future__ import annotations

import bisect
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.common import ordered_blocks, text_of
from tidemark.session import settle

#: Cells of the first grid over the bytes, and parts a cell is split into.
GRID, SPLIT = 4096, 64
#: Capacities tried together in one round.
TRIALS = 15


@dataclass(frozen=True)
class Cell:
    """Group starts inside one cell of a grid level: the first of them and their number."""

    start: int
    level: int
    index: int
    groups: int


class Cuts:
    """Driver side of the search: a bounded number of known group starts, found by histograms.

    ``groups(at, size)`` has one row per group with the bytes before it. The grid
    knows the first start in each cell. With it, the greedy walk for a capacity
    has a lower and an upper track; when they disagree on whether the capacity
    suffices, the cells they ended in are split by one more histogram.
    """

    def __init__(self, groups: DataFrame, shards: int):
        self.groups, self.shards = groups, shards
        total, largest = groups.agg(F.sum("size"), F.max("size")).first()
        self.total, self.largest = int(total or 0), int(largest or 0)
        self.width = max(1, -(-self.total // GRID))
        self.cells = self._histogram(0, None)
        self._index()

    def _cell(self, level: int):
        width = max(1, self.width // SPLIT**level)
        return F.floor(F.col("at") / width).cast("long")

    def _histogram(self, level: int, inside: list[int] | None) -> list[Cell]:
        rows = self.groups
        if inside is not None:
            rows = rows.filter(self._cell(level - 1).isin(inside))
        counted = rows.groupBy(self._cell(level).alias("c")).agg(F.min("at").alias("at"), F.count(F.lit(1)).alias("n"))
        return [Cell(r.at, level, r.c, r.n) for r in counted.collect()]  # at most GRID, or SPLIT + 1 per cell

    def _index(self) -> None:
        self.cells.sort(key=lambda c: c.start)
        self.starts = [c.start for c in self.cells]

    def _floor(self, x: int) -> int:
        return bisect.bisect_right(self.starts, x) - 1

    def walk(self, capacity: int) -> tuple[list[int], bool, bool, set[int]]:
        """Cuts of the lower track, whether it and the upper one reach the end, cells that leave it open."""
        low = high = 0
        cuts, vague = [], set()
        for _ in range(self.shards):
            reach = low + capacity
            if reach >= self.total:
                low = self.total
            else:
                i = self._floor(reach)
                low = self.starts[i]
                if self.cells[i].groups > 1:
                    vague.add(i)
            cuts.append(low)
            reach = high + capacity
            if reach >= self.total:
                high = self.total
            else:
                i = self._floor(reach)
                if self.cells[i].groups > 1:
                    high = reach
                    vague.add(i)
                else:
                    high = self.starts[i]
        return cuts, low >= self.total, high >= self.total, vague

    def _refine(self, vague: set[int]) -> None:
        by_level: dict[int, list[int]] = {}
        for i in vague:
            by_level.setdefault(self.cells[i].level, []).append(self.cells[i].index)
        kept = [c for i, c in enumerate(self.cells) if i not in vague]
        for level, inside in by_level.items():
            kept += self._histogram(level + 1, inside)
        self.cells = kept
        self._index()

    def solve(self) -> tuple[int, list[int]]:
        """The least capacity for which the greedy walk needs no more than ``shards`` shards, and its cuts."""
        if not self.total:
            return 0, [0] * self.shards
        low = max(self.largest, -(-self.total // self.shards)) - 1
        high = low + 1 + self.largest
        while True:
            # Binary search for the least capacity surely enough and the largest surely too small.
            a, b = low, high
            while b - a > 1:
                mid = (a + b) // 2
                a, b = (a, mid) if self.walk(mid)[1] else (mid, b)
            high = b
            a, b = low, high
            while b - a > 1:
                mid = (a + b) // 2
                a, b = (mid, b) if not self.walk(mid)[2] else (a, mid)
            low = a
            cuts, enough, _, vague = self.walk(high)
            if enough and high - low <= 1:
                if not vague:
                    return high, cuts
                self._refine(vague)  # the capacity is known, a cut inside a cell is not yet
                continue
            tried = {low + 1 + (high - low - 1) * k // TRIALS for k in range(TRIALS + 1)}
            self._refine(set().union(*(self.walk(c)[3] for c in tried)))


def placed(docs: DataFrame) -> DataFrame:
    """Documents in group order: ``doc_id, size, text_crc32, digest``, rows (``pos``) and bytes (``at``) before each.

    Equal texts (a null text equals the empty one) are a group, in the order of
    its smallest id. Rows are dealt by ranges of (group, id), so a large group
    spreads over many tasks, and positions are put together from block totals.
    """
    text = text_of()
    rows = docs.select(
        F.col("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
    )
    rows = settle(rows, "shard-rows")
    first = settle(rows.groupBy("digest").agg(F.min("doc_id").alias("first")), "shard-firsts")
    order = ["first", "digest", "doc_id"]
    blocks = ordered_blocks(rows.join(first, "digest"), order, "shard-blocks")
    totals = blocks.groupBy("block").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        "block",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n"),
        F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("bytes"),
    )
    inside = Window.partitionBy("block").orderBy(*order)
    local = blocks.select(
        "*",
        (F.row_number().over(inside) - 1).alias("i"),
        F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("b"),
    )
    joined = local.join(F.broadcast(starts), "block")
    joined = joined.select(
        "doc_id", "size", "text_crc32", "digest", (F.col("i") + F.col("n")).alias("pos"), (F.col("b") + F.col("bytes")).alias("at")
    )
    return settle(joined, "shard-placed")


def shards(docs: DataFrame, count: int = 16) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, shard, slot``.

    Sizes are bytes of the text plus one. Groups of equal texts stay whole; the
    order of groups is kept and cut so that the largest shard is as small as
    such cuts allow. A shard can be empty when one group outweighs it. ``slot``
    counts from 0 without gaps. Null ids come first; an empty table gives none.
    """
    rows = placed(docs)
    groups = rows.groupBy("digest").agg(F.min("at").alias("at"), F.sum("size").alias("size")).select("at", "size")
    groups = settle(groups.repartitionByRange("at").sortWithinPartitions("at"), "shard-groups")
    _, cuts = Cuts(groups, count).solve()
    shard = sum((F.when(F.col("at") >= c, 1).otherwise(0) for c in cuts[:-1]), F.lit(0)).cast("int")
    numbered = rows.withColumn("shard", shard)
    firsts = numbered.groupBy("shard").agg(F.min("pos").alias("first"))
    return numbered.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("pos") - F.col("first")).alias("slot")
    )
