"""Top-k per key and nearest vectors by cosine."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidemark.operators.joins import broadcast_if_small
from tidemark.session import settle

# Query vectors a task may hold; above it both sides are cut into blocks.
QUERY_BYTES = 16 * 1024 * 1024
# Scores that are in memory at once, and queries among them.
SCORES, COLUMNS = 1 << 20, 1 << 10


def lateral_topk(
    outer: DataFrame, inner: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int
) -> DataFrame:
    """For each outer row its best ``k`` inner rows by key.

    The inner side is cut to ``k`` rows per key before it is shuffled, then joined.
    """
    return outer.join(topk(inner, keys, order, k), list(keys))


def topk(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str | None = None) -> DataFrame:
    best = W.partitionBy(*keys).orderBy(*order)
    out = df.withColumn("__rn", F.row_number().over(best)).filter(F.col("__rn") <= k)
    return out.withColumnRenamed("__rn", rank) if rank else out.drop("__rn")


def mean_vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """Mean vector per key, summed on the map side."""
    mean = Summarizer.mean(array_to_vector(F.col(vector).cast("array<double>")))
    return df.groupBy(key).agg(vector_to_array(mean).alias(vector))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two array columns of equal length; null when one is all zero."""
    a, b = a.cast("array<double>"), b.cast("array<double>")

    def total(xs: Column) -> Column:
        return F.aggregate(xs, F.lit(0.0), lambda s, x: s + x)

    dot = total(F.zip_with(a, b, lambda x, y: x * y))
    norm = F.sqrt(total(F.transform(a, lambda x: x * x))) * F.sqrt(total(F.transform(b, lambda x: x * x)))
    return dot / F.nullif(norm, F.lit(0.0))


def _unit(rows) -> np.ndarray:
    m = np.stack([np.asarray(r, dtype=np.float64) for r in rows])
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, norm, out=np.full_like(m, np.nan), where=norm > 0)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best of each column by score, smaller id on a tie; undefined scores last."""
    s = np.where(np.isnan(scores), -np.inf, np.round(scores, 9))
    if len(s) > 4 * k:
        # Keep everything not below the k-th score, so ties are settled by id.
        floor = np.partition(s, len(s) - k, axis=0)[len(s) - k]
        rows = (s >= floor).any(axis=1)
        s, ids = s[rows], (ids[rows] if ids.ndim == 1 else ids[rows, :])
    if ids.ndim == 1:
        ids = np.repeat(ids[:, None], s.shape[1], axis=1)
    order = np.lexsort((ids, -s), axis=0)[:k]
    return np.take_along_axis(s, order, axis=0), np.take_along_axis(ids, order, axis=0)


def _ranked(
    x: np.ndarray, ids: np.ndarray, q: np.ndarray, k: int, best: tuple[np.ndarray, np.ndarray] | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """``_best`` of the products of the rows of ``x`` and of ``q``, and of the ``best`` of the rows before.

    No more than ``SCORES`` products are in memory, however many rows and queries meet.
    """
    blocks = []
    for j in range(0, len(q), COLUMNS):
        cols = q[j : j + COLUMNS].T
        kept = best and tuple(b[:, j : j + COLUMNS] for b in best)
        step = max(1, SCORES // cols.shape[1])
        for i in range(0, len(x), step):
            found = _best(x[i : i + step] @ cols, ids[i : i + step], k)
            kept = _best(*(np.vstack(b) for b in zip(kept, found)), k) if kept else found
        blocks.append(kept)
    return tuple(np.hstack(b) for b in zip(*blocks))


def _rows(qids: np.ndarray, s: np.ndarray, ids: np.ndarray) -> pd.DataFrame:
    out = pd.DataFrame(
        {"query_id": np.repeat(qids[None, :], len(s), axis=0).ravel(), "id": ids.ravel(), "score": s.ravel()}
    )
    return out[np.isfinite(out["score"])]


RESULT = "query_id long, id long, score double"


def nearest(
    corpus: DataFrame,
    id: str,
    vector: str,
    queries: DataFrame,
    k: int,
    cell: str | None = None,
    limit: int = QUERY_BYTES,
    decode: Callable[[pd.Series], np.ndarray] = _unit,
) -> DataFrame:
    """The ``k`` most similar corpus vectors of each query, exact.

    ``queries(query_id, vector)``. When the query vectors fit ``limit`` bytes
    every task scores its part of the corpus in matrix products of bounded size and
    hands on only its own ``k`` best per query; otherwise ``nearest_blocks`` is
    used. Score pairs are never rows. With ``cell`` a query row is multiplied only
    with corpus rows of the same cell. ``decode`` makes the matrix of a batch from
    what is stored, by default unit vectors.
    """
    n, width = queries.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size(vector)), F.lit(0))).first()
    if n * width * 8 > limit:
        return nearest_blocks(corpus, id, vector, queries, k, cell, decode=decode)
    at = (F.col(cell) if cell else F.lit(0)).alias("cell")
    found = queries.select("query_id", vector, at).collect()
    if not found:
        return corpus.sparkSession.createDataFrame([], RESULT + ", rank int")
    qids = np.array([r[0] for r in found], dtype=np.int64)
    q = _unit([r[1] for r in found])
    asked: dict[int, list[int]] = {}
    for n, r in enumerate(found):
        asked.setdefault(r[2], []).append(n)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for pdf in batches:
            for c, rows in pdf.groupby("cell").indices.items():
                if c in asked:
                    part = pdf.iloc[rows]
                    best[c] = _ranked(decode(part["v"]), part["id"].to_numpy(), q[asked[c]], k, best.get(c))
        if best:
            out = pd.concat([_rows(qids[asked[c]], *found) for c, found in best.items()])
            out = out.sort_values(["query_id", "score", "id"], ascending=[True, False, True], na_position="first")
            yield out.groupby("query_id").head(k)

    part = corpus.select(F.col(id).alias("id"), F.col(vector).alias("v"), at).mapInPandas(score, RESULT)
    return topk(part, ["query_id"], [F.desc("score"), F.asc("id")], k, rank="rank")


def nearest_blocks(
    corpus: DataFrame,
    id: str,
    vector: str,
    queries: DataFrame,
    k: int,
    cell: str | None = None,
    corpus_rows: int = 20_000,
    query_rows: int = 2_000,
    decode: Callable[[pd.Series], np.ndarray] = _unit,
) -> DataFrame:
    """``nearest`` for query sets of any size: blocks of both sides meet in tasks.

    Blocks come from a hash of the unique id, so no block is larger than the
    others; a task sees one block of each side and emits ``k`` rows per query.
    With ``cell`` a query row meets only corpus rows of the same cell.
    """
    cblocks = max(1, -(-corpus.count() // corpus_rows))
    qblocks = max(1, -(-queries.count() // query_rows))
    at = F.col(cell) if cell else F.lit(0)

    def block(c: str, n: int) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(n)).cast("int")

    left = corpus.select(
        F.col(id).alias("id"),
        F.col(vector).alias("v"),
        at.alias("cell"),
        block(id, cblocks).alias("cb"),
        F.explode(F.sequence(F.lit(0), F.lit(qblocks - 1))).alias("qb"),
    )
    right = queries.select(
        "query_id",
        F.col(vector).alias("v"),
        at.alias("cell"),
        F.explode(F.sequence(F.lit(0), F.lit(cblocks - 1))).alias("cb"),
        block("query_id", qblocks).alias("qb"),
    )

    def score(c: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if c.empty or q.empty:
            return pd.DataFrame({"query_id": [], "id": [], "score": []}).astype(
                {"query_id": "int64", "id": "int64"}
            )
        s, ids = _ranked(decode(c["v"]), c["id"].to_numpy(), _unit(q["v"]), k)
        return _rows(q["query_id"].to_numpy(), s, ids)

    keys = ["cell", "cb", "qb"]
    part = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(score, RESULT)
    return topk(part, ["query_id"], [F.desc("score"), F.asc("id")], k, rank="rank")


class HyperplaneIndex:
    """Approximate search: vectors stored by the side of ``bits`` random planes they lie on.

    The table is partitioned by that cell, so a search reads only the cells
    within ``reach`` flipped bits of its queries and ranks them exactly.
    """

    def __init__(self, path: str, dim: int, bits: int = 4, seed: int = 11):
        self.path, self.bits = path, bits
        self.planes = np.random.default_rng(seed).normal(size=(bits, dim))

    def _cells(self, vector: str, reach: int = 0) -> Column:
        planes, bits = self.planes, self.bits
        near = np.array([m for m in range(1 << bits) if bin(m).count("1") <= reach], dtype=np.int32)

        @F.pandas_udf("array<int>")
        def cells(vectors: pd.Series) -> pd.Series:
            if not len(vectors):
                return pd.Series([], dtype=object)
            m = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
            own = ((m @ planes.T) > 0) @ (1 << np.arange(bits))
            return pd.Series([near ^ int(b) for b in own])

        return cells(vector)

    def write(self, corpus: DataFrame, id: str, vector: str) -> None:
        rows = corpus.select(F.col(id).alias("id"), F.col(vector).alias("v"))
        rows = rows.withColumn("cell", F.element_at(self._cells("v"), 1))
        rows.write.mode("overwrite").partitionBy("cell").parquet(self.path)

    def search(self, queries: DataFrame, vector: str, k: int, reach: int = 1) -> DataFrame:
        """Partial lists per (query, cell block) are merged; a vector is in one cell only."""
        probes = queries.select("query_id", F.col(vector).alias("v"), F.explode(self._cells(vector, reach)).alias("cell"))
        probes = settle(probes, "probes")
        # At most 2**bits values; partitions outside the list are not read.
        cells = [r[0] for r in probes.select("cell").distinct().collect()]
        stored = queries.sparkSession.read.parquet(self.path).filter(F.col("cell").isin(cells))
        return nearest(stored, "id", "v", probes, k, cell="cell")


def _means(x: np.ndarray, n: int, rounds: int, seed: int) -> np.ndarray:
    """``n`` means of the rows of ``x``; a mean without rows stays where it was."""
    rng = np.random.default_rng(seed)
    means = x[rng.permutation(len(x))[:n]].copy()
    for _ in range(rounds):
        own = _closest(x, means)
        counts = np.bincount(own, minlength=len(means))
        sums = np.zeros_like(means)
        np.add.at(sums, own, x)
        means[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return means


def _closest(x: np.ndarray, means: np.ndarray) -> np.ndarray:
    return np.concatenate([far.argmin(axis=1) for far in _distances(x, means)] or [np.empty(0, np.int64)])


def _distances(x: np.ndarray, means: np.ndarray) -> Iterator[np.ndarray]:
    """Squared distances to the means, less the row's own square, by blocks of at most ``SCORES``."""
    squares, step = (means * means).sum(axis=1)[None, :], max(1, SCORES // max(1, len(means)))
    for i in range(0, len(x), step):
        yield squares - 2 * x[i : i + step] @ means.T


class InvertedFile:
    """Approximate search: an inverted file of trained cells, with product-quantised codes.

    Vectors are scaled to length one. A cell holds the vectors nearest to its
    mean; a code has one byte for each of ``parts`` slices of the vector, the
    number of the nearest of ``words`` trained slices. A search reads the codes
    of the cells nearest to a query, ranks them by the codes, reads the vectors
    of the ``short`` best only and ranks those exactly.

    Means are fitted on a sample of at most ``sample`` vectors, those of least
    hash; every vector is indexed. A zero vector has no direction: it is stored
    and never found. Ids are unique.
    """

    def __init__(self, path: str, parts: int = 16, words: int = 256, cells: int | None = None, sample: int = 20_000):
        self.path, self.parts, self.words, self.cells, self.sample = path, parts, words, cells, sample

    def fit(self, corpus: DataFrame, id: str, vector: str) -> None:
        total = corpus.count()
        taken = corpus.select(F.col(vector).alias("v"), F.xxhash64(id).alias("h")).orderBy("h").limit(self.sample)
        x = np.nan_to_num(_unit([r.v for r in taken.select("v").collect()]))  # at most ``sample`` rows
        n = self.cells or max(1, round(total**0.5))
        self.means = _means(x, min(n, len(x)), 10, 1)
        self.slices = np.array_split(np.arange(x.shape[1]), self.parts)
        self.books = [_means(x[:, s], min(self.words, len(x)), 10, 2) for s in self.slices]

    def write(self, corpus: DataFrame, id: str, vector: str) -> None:
        """Fit, then store ``id, code, v`` by cell."""
        self.fit(corpus, id, vector)
        means, slices, books = self.means, self.slices, self.books

        @F.pandas_udf("cell int, code binary")
        def placed(vectors: pd.Series) -> pd.DataFrame:
            x = np.nan_to_num(_unit(vectors)) if len(vectors) else np.zeros((0, means.shape[1]))
            codes = np.column_stack([_closest(x[:, s], b) for s, b in zip(slices, books)]).astype(np.uint8)
            return pd.DataFrame({"cell": _closest(x, means).astype(np.int32), "code": [c.tobytes() for c in codes]})

        rows = corpus.select(F.col(id).alias("id"), F.col(vector).alias("v"), placed(vector).alias("p"))
        rows = rows.select("id", "p.code", "v", "p.cell").repartition("cell", F.pmod(F.xxhash64("id"), F.lit(8)))
        rows.write.mode("overwrite").partitionBy("cell").parquet(self.path)

    def search(self, queries: DataFrame, vector: str, k: int, probes: int, short: int) -> DataFrame:
        """``query_id, id, score, rank``; scores are exact cosines of the short list."""
        means, slices, books = self.means, self.slices, self.books
        near = min(probes, len(means))

        @F.pandas_udf("array<int>")
        def visited(vectors: pd.Series) -> pd.Series:
            if not len(vectors):
                return pd.Series([], dtype=object)
            x = np.nan_to_num(_unit(vectors))
            order = [np.argsort(far, axis=1, kind="stable")[:, :near].astype(np.int32) for far in _distances(x, means)]
            return pd.Series([row for block in order for row in block])

        def decode(codes: pd.Series) -> np.ndarray:
            c = np.frombuffer(b"".join(codes), dtype=np.uint8).reshape(len(codes), -1)
            return np.hstack([b[c[:, i]] for i, b in enumerate(books)]) if len(codes) else np.zeros((0, len(slices)))

        asked = queries.select("query_id", F.col(vector).alias("q"))
        visits = settle(asked.select("query_id", F.col("q").alias("code"), F.explode(visited("q")).alias("cell")), "probes")
        # At most as many cells as there are means; folders of other cells are not read.
        cells = [r[0] for r in visits.select("cell").distinct().collect()]
        stored = queries.sparkSession.read.parquet(self.path).filter(F.col("cell").isin(cells))
        listed = settle(nearest(stored, "id", "code", visits, short, cell="cell", decode=decode).select("query_id", "id"), "short-list")
        held = stored.select("id", "v").join(broadcast_if_small(listed), "id").join(asked, "query_id")
        exact = held.select("query_id", "id", cosine(F.col("v"), F.col("q")).alias("score"))
        return topk(exact, ["query_id"], [F.desc(F.round("score", 9)), F.asc("id")], k, rank="rank")
