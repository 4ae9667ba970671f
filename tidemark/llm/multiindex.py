"""Hard negatives by an inverted multi-index: exact searches that stop when their windows are certified.

Each half of a vector has its own codebook; a pair of codes is a cell. For an
anchor, the score of every row of a cell is at most the sum of two half-score
bounds (code and radius), so a heap over the two sorted lists of bounds yields
cells in falling order of their bound. A search goes on, in rounds of growing
size, until the bound of the next cell shows that no unseen row can enter its
result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.session import settle

#: Rows the codebooks are fitted on (those of least hash), codes per half at most, rounds of fitting.
SAMPLE, CODES, FITS = 8192, 256, 10
#: Rows and anchors that meet in one product of matrices.
ROWS, ANCHORS = 2048, 1024
#: Rows an anchor's first round looks at, and how many times more each further round does.
START, GROWTH = 4096, 8
#: Whole numbers of this size and more are left out: sums of their products would not fit 64 bits.
LIMIT = 1 << 23
#: A want: rows of the anchor's label or of others, scores from ``low`` to ``high``, the best ``k`` of them.
WANT = "struct<key: bigint, same: boolean, low: bigint, high: bigint, k: int>"


@dataclass(frozen=True)
class Index:
    """Codebooks and cells; ``blocks(cell, block, members)`` holds all rows, at most about ROWS in each."""

    books: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray]
    counts: np.ndarray
    dim: int
    rows: DataFrame
    directory: DataFrame
    blocks: DataFrame


def vectors(df: DataFrame, relabel: Column | None = None, scale: int = 256) -> DataFrame:
    """``id, label, q``: the rows that take part, their components as whole numbers.

    Rows without id, label or vector, with a null or non-finite component or one
    of LIMIT / scale and more in size take no part. An id that occurs more than
    once counts once, with its smallest label and vector.
    """
    x = lambda v: v.cast("double")
    whole = F.transform("embedding", lambda v: F.floor(scale * x(v)))
    sound = F.forall("embedding", lambda v: v.isNotNull() & (F.abs(x(v)) < LIMIT / scale))
    usable = df.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & sound)
    named = usable.select(
        F.col("vec_id").cast("long").alias("id"),
        (F.col("label") if relabel is None else relabel).cast("long").alias("label"),
        whole.cast("array<int>").alias("q"),
    )
    return named.groupBy("id").agg(F.min(F.struct("label", "q")).alias("x")).select("id", "x.label", "x.q")


def matrix(lists: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column as a matrix; shorter vectors are filled up with zeros."""
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    if (lengths == dim).all():
        return flat.reshape(-1, dim).astype(np.float64)
    out = np.zeros((len(lengths), dim))
    out[np.arange(dim)[None, :] < lengths[:, None]] = flat
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers: in floating point while all sums stay below 2^53."""
    size = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(1, a.shape[1])
    if size < 2**53:
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code of each row and its distance from it."""
    square = (x * x).sum(1)[:, None] - 2 * x @ book.T + (book * book).sum(1)[None, :]
    code = square.argmin(1)
    return code, np.sqrt(((x - book[code]) ** 2).sum(1))


def fitted(x: np.ndarray, codes: int) -> np.ndarray:
    """A codebook by k-means, from the first different rows on."""
    book = np.unique(x, axis=0, return_index=True)[1]
    book = x[np.sort(book)[:codes]].astype(np.float64)
    for _ in range(FITS):
        code, _ = nearest(x, book)
        n = np.bincount(code, minlength=len(book))
        for c in np.flatnonzero(n):
            book[c] = x[code == c].mean(0)
    return book


def halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    middle = x.shape[1] // 2
    return x[:, :middle], x[:, middle:]


def built(rows: DataFrame, codes: int | None = None) -> Index:
    """The index over ``rows(id, label, q)``.

    Codes per half grow with the fourth root of the rows, up to CODES; the
    codebooks and the CODES^2 cell counts are all the driver holds.
    """
    rows = settle(rows, "index-input")
    total, dim = rows.agg(F.count(F.lit(1)), F.max(F.size("q"))).first()
    dim = max(2, dim or 0)
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("q").toArrow()["q"].combine_chunks()
    known = matrix(sample, dim) if len(sample) else np.zeros((1, dim))
    codes = codes or min(CODES, max(2, round(total**0.25)))
    books = tuple(fitted(h, codes) for h in halves(known))
    width = len(books[1])

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (c1, d1), (c2, d2) = (nearest(h, b) for h, b in zip(halves(matrix(batch.column("q"), dim)), books))
            names = ["id", "label", "q", "cell", "d1", "d2"]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array((c1 * width + c2).astype(np.int32)), pa.array(d1), pa.array(d2)], names)

    cells = rows.mapInArrow(placed, "id bigint, label bigint, q array<int>, cell int, d1 double, d2 double")
    cells = settle(cells, "index-cells")
    found = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("d1").alias("d1"), F.max("d2").alias("d2")).collect()
    counts = np.zeros(len(books[0]) * width, dtype=np.int64)
    radii = tuple(np.zeros(len(b)) for b in books)
    for r in found:  # at most CODES^2 rows
        counts[r.cell] = r.n
        a, b = divmod(r.cell, width)
        radii[0][a], radii[1][b] = max(radii[0][a], r.d1), max(radii[1][b], r.d2)
    parts = cells.groupBy("cell").agg((F.floor((F.count(F.lit(1)) - 1) / ROWS) + 1).cast("int").alias("blocks"))
    directory = settle(parts, "index-directory")
    dealt = cells.join(F.broadcast(directory), "cell").withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    blocks = dealt.groupBy("cell", "block").agg(F.collect_list(F.struct("id", "label", "q")).alias("members"))
    return Index(books, radii, counts, dim, rows, directory, settle(blocks, "index-blocks"))


def visits(anchor: np.ndarray, books, radii) -> Iterator[tuple[float, int]]:
    """Cells with the most that a row in them can score, in falling order of that bound.

    Multi-sequence walk: a cell of the two sorted lists enters the heap when its
    neighbours before it, in either list, have left it.
    """
    bounds, orders = [], []
    for half, book, radius in zip(halves(anchor[None, :]), books, radii):
        bound = book @ half[0] + np.linalg.norm(half[0]) * radius
        order = np.argsort(-bound, kind="stable")
        bounds.append(bound[order].tolist())
        orders.append(order.tolist())
    (u, v), (i1, i2), width = bounds, orders, len(books[1])
    heap = [(-(u[0] + v[0]), 0, 0)]
    done = [0] * len(u)  # columns that have left the heap, by row
    while heap:
        less, i, j = heapq.heappop(heap)
        yield -less, i1[i] * width + i2[j]
        done[i] = j + 1
        if j + 1 < len(v) and (i == 0 or done[i - 1] > j + 1):
            heapq.heappush(heap, (-(u[i] + v[j + 1]), i, j + 1))
        if i + 1 < len(u) and done[i + 1] == j:
            heapq.heappush(heap, (-(u[i + 1] + v[j]), i + 1, j))


def planned(active: DataFrame, index: Index, goal: int) -> DataFrame:
    """``active`` with the ``cells`` of this round, the number ``walked`` so far and the ``bound`` of what is left.

    Cells without rows are passed over. The bound is rounded up to a whole
    score; null when nothing is left.
    """
    books, radii, counts, dim = index.books, index.radii, index.counts, index.dim

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells, walked, left = [], [], []
            for x, before in zip(matrix(batch.column("q"), dim), batch.column("walked").to_pylist()):
                taken, seen, at, bound = [], 0, 0, None
                for b, cell in visits(x, books, radii):
                    if not counts[cell]:
                        continue
                    if at >= before and seen >= goal:
                        bound = int(np.floor(b + 1e-6 * (1 + abs(b))))
                        break
                    if at >= before:
                        taken.append(cell)
                        seen += int(counts[cell])
                    at += 1
                cells.append(taken)
                walked.append(at)
                left.append(bound)
            keep = {c: batch.column(c) for c in ("id", "label", "q", "wants")}
            yield pa.RecordBatch.from_pydict(
                {**keep, "walked": pa.array(walked, pa.int32()), "cells": pa.array(cells, pa.list_(pa.int32())), "bound": pa.array(left, pa.int64())}
            )

    schema = f"id bigint, label bigint, q array<int>, wants array<{WANT}>, walked int, cells array<int>, bound bigint"
    return active.select("id", "label", "q", "wants", "walked").mapInArrow(run, schema)


HIT = "anchor_id bigint, key bigint, k int, id bigint, score bigint"


def scored(round_: DataFrame, index: Index, anchors: int) -> DataFrame:
    """Per block and want the best ``k`` rows: ``anchor_id, key, k, id, score``."""
    dim = index.dim

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows, asks = (batch.column(c)[i].values for c in ("members", "asks"))
                q = matrix(asks.field("q"), dim)
                ids, labels = (rows.field(c).to_numpy() for c in ("id", "label"))
                scores = products(q, matrix(rows.field("q"), dim))
                wants = asks.field("wants").to_pylist()
                out = [[], [], [], [], []]
                for s, me, mine, asked in zip(scores, asks.field("id").to_pylist(), asks.field("label").to_pylist(), wants):
                    for same in {w["same"] for w in asked}:
                        ask = [w for w in asked if w["same"] == same]
                        low, high = min(w["low"] for w in ask), max(w["high"] for w in ask)
                        at = np.flatnonzero(((labels == mine) == same) & (s >= low) & (s <= high) & (ids != me))
                        at = at[np.lexsort((ids[at], -s[at]))]
                        falling = -s[at]
                        for w in ask:
                            a, b = np.searchsorted(falling, -w["high"], "left"), np.searchsorted(falling, -w["low"], "right")
                            best = at[a : min(b, a + w["k"])]
                            for column, values in zip(out, ([me] * len(best), [w["key"]] * len(best), [w["k"]] * len(best), ids[best], s[best])):
                                column.extend(values)
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], ["anchor_id", "key", "k", "id", "score"])

    groups = -(-anchors // ANCHORS)
    asked = round_.select(F.explode("cells").alias("cell"), F.struct("id", "label", "q", "wants").alias("ask"))
    asked = asked.join(F.broadcast(index.directory), "cell")
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    group = F.pmod(F.xxhash64("ask.id"), F.lit(groups)).alias("group")
    packed = asked.groupBy("cell", "block", group).agg(F.collect_list("ask").alias("asks"))
    met = packed.join(index.blocks, ["cell", "block"]).select("members", "asks")
    return met.mapInArrow(run, HIT)


def searched(index: Index, anchors: DataFrame) -> DataFrame:
    """``anchor_id, key, rank, id, score``: for each want of ``anchors(id, label, q, wants)`` its best rows.

    Higher scores come first, ties by the smaller id. A want is certified when
    it has all its rows and the last of them scores above the bound of what is
    left, or when that bound lies below its window; an anchor with all wants
    certified leaves the search.
    """
    best = Window.partitionBy("anchor_id", "key").orderBy(F.desc("score"), "id")
    active = settle(anchors.withColumn("walked", F.lit(0)), "search-active")
    hits, goal = None, START
    while (n := active.count()) > 0:
        round_ = settle(planned(active, index, goal), "search-round")
        new = scored(round_, index, n)
        new = new if hits is None else new.unionByName(hits.select("anchor_id", "key", "k", "id", "score"))
        hits = settle(new.withColumn("rank", F.row_number().over(best)).filter("rank <= k"), "search-hits")
        open_ = round_.filter("bound is not null").drop("cells")
        last = hits.filter("rank = k").select(F.col("anchor_id").alias("id"), "key", F.col("score").alias("last"))
        each = open_.select("id", "bound", F.explode("wants").alias("w")).select("id", "bound", "w.*")
        unsure = each.join(last, ["id", "key"], "left").filter("bound >= low and (last is null or last <= bound)")
        # What is not certified goes on, and takes only rows that can still enter its result.
        again = F.struct("key", "same", F.greatest("low", "last").alias("low"), "high", "k")
        left = unsure.groupBy("id").agg(F.collect_list(again).alias("wants"))
        active = settle(open_.drop("bound", "wants").join(left, "id"), "search-active")
        goal *= GROWTH
    return hits if hits is not None else anchors.sparkSession.createDataFrame([], HIT + ", rank int")


def _floor_div(x: Column, by: int) -> Column:
    return F.call_function("div", x - F.pmod(x, F.lit(by)), F.lit(by))


def hard_negatives(
    df: DataFrame,
    anchors: Column,
    relabel: Column | None = None,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    codes: int | None = None,
) -> DataFrame:
    """For each anchor and positive the best rows of other labels within ``low`` to ``high`` % of the positive's score.

    ``df(vec_id, label, embedding)``; ``anchors`` is a condition on ``id``. One
    row each: ``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score``. Scores are inner products of floor(256 * x); ties go by
    the smaller id. ``vectors`` says which rows take part; shorter vectors are
    filled up with zeros. Other columns play no part, an empty table gives none.
    """
    index = built(vectors(df, relabel), codes)
    everything = F.lit(-(1 << 62)), F.lit((1 << 62))

    def want(key: Column, same: bool, least: Column, most: Column, k: int) -> Column:
        return F.struct(key.alias("key"), F.lit(same).alias("same"), least.alias("low"), most.alias("high"), F.lit(k).alias("k"))

    chosen = index.rows.filter(anchors)
    first = chosen.withColumn("wants", F.array(want(F.lit(0).cast("long"), True, *everything, positives)).cast(f"array<{WANT}>"))
    found = searched(index, first).select("anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    found = settle(found, "search-positives")
    s = F.col("positive_score")
    window = found.select("anchor_id", want(F.col("positive_id"), False, -_floor_div(-low * s, 100), _floor_div(high * s, 100), negatives).alias("want"))
    window = window.filter("want.low <= want.high").groupBy("anchor_id").agg(F.collect_list("want").alias("wants"))
    second = chosen.join(window.withColumnRenamed("anchor_id", "id"), "id")
    second = second.select("id", "label", "q", F.col("wants").cast(f"array<{WANT}>").alias("wants"))
    named = searched(index, second).select(
        "anchor_id", F.col("key").alias("positive_id"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    return named.join(found, ["anchor_id", "positive_id"])
