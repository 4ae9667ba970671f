"""Near duplicates: an inverted join over MinHash coordinates, confirmed on full shingle sets."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import broadcast_checked, row_of
from tidemark.llm.links import components
from tidemark.session import settle

#: Coordinates of a signature, and the chance a true pair at the threshold may be missed with.
COORDINATES, MISS = 24, 1e-7
#: Words whose hashes a Python worker remembers.
CACHE = 500_000
#: Members of a posting list compared in one block.
BLOCK = 256
#: Documents that a shingle may occur in to count as rare.
RARE = 16

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def match_floor(percent: int, coordinates: int = COORDINATES, miss: float = MISS) -> int:
    """Most matching coordinates that a pair at ``percent`` similarity still reaches, but for chance ``miss``."""
    p, below, t = percent / 100, 0.0, 0
    while t < coordinates:
        below += math.comb(coordinates, t) * p**t * (1 - p) ** (coordinates - t)
        if below > miss:
            break
        t += 1
    return max(1, t)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """64-bit hashes of a text's distinct word shingles."""

    def __init__(self, width: int, seed: int = 11):
        import xxhash

        self.width = width
        self.hash = xxhash.xxh3_64_intdigest
        self.known: dict[bytes, int] = {}
        rng = np.random.default_rng(seed)
        self.weights = rng.integers(1, 2**63, size=width, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.a = rng.integers(1, 2**63, size=(COORDINATES, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 2**63, size=(COORDINATES, 1), dtype=np.uint64)

    def words(self, text: bytes | None) -> np.ndarray:
        """Hashes of the words in order. ``bytes`` methods split and lower-case by ASCII only, as the word rule does."""
        found = (text or b"").lower().split()
        known = self.known
        new = {*found}.difference(known)
        if new:
            if len(known) > CACHE:
                known.clear()
                new = {*found}
            known.update(zip(new, map(self.hash, new)))
        return np.fromiter(map(known.__getitem__, found), dtype=np.uint64, count=len(found))

    def windows(self, h: np.ndarray) -> np.ndarray:
        """Hash of each run of ``width`` words; a shorter text is one run."""
        width = min(self.width, len(h))
        total = np.full(len(h) - width + 1 if width else 0, width, dtype=np.uint64)
        for k in range(width):
            total += h[k : k + len(total)] * self.weights[k]
        return _mixed(total)

    def shingles(self, text: bytes | None) -> np.ndarray:
        """Sorted distinct hashes of the word shingles."""
        return np.unique(self.windows(self.words(text)))

    def coordinates(self, s: np.ndarray) -> np.ndarray:
        """The least hash under each of the permutations, mixed with the coordinate's number."""
        least = np.full((COORDINATES, 1), ~np.uint64(0))
        for at in range(0, len(s), 65_536):
            h = s[None, at : at + 65_536] * self.a + self.b
            np.minimum(least, (h ^ (h >> np.uint64(32))).min(axis=1, keepdims=True), out=least)
        return _mixed(least[:, 0] + np.arange(1, COORDINATES + 1, dtype=np.uint64) * _A).view(np.int64)


@lru_cache(maxsize=4)
def shingler(width: int) -> Shingler:
    return Shingler(width)


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, digest, n, coordinates``: 128 bits of the shingle set, its size and its MinHash.

    A text without a word has no digest and no coordinates.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = shingler(width)
        for batch in batches:
            sizes, digests, marks = [], [], []
            for x in batch.column("text"):
                s = tool.shingles(x.as_py())
                sizes.append(len(s))
                digests.append(hashlib.md5(s.tobytes()).digest() if len(s) else None)
                marks.append(tool.coordinates(s) if len(s) else None)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "digest": pa.array(digests, pa.binary()),
                    "n": pa.array(sizes, pa.int64()),
                    "coordinates": pa.array(marks, pa.list_(pa.int64())),
                }
            )

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return slim.mapInArrow(run, "doc_id bigint, digest binary, n bigint, coordinates array<bigint>")


def _texts_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, text`` (as bytes) of the documents in ``nodes``."""
    slim = docs.select(F.col("doc_id").cast("long").alias("node"), F.col("text").cast("binary").alias("text"))
    return slim.join(broadcast_checked(nodes), "node")


def full_sets(docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """``node, shingles`` (sorted 64-bit hashes as bytes) for the documents in ``nodes``, from their whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = shingler(width)
        for batch in batches:
            sets = [tool.shingles(x.as_py()).tobytes() for x in batch.column("text")]
            yield pa.RecordBatch.from_pydict({"node": batch.column("node"), "shingles": pa.array(sets, pa.binary())})

    return _texts_of(docs, nodes).mapInArrow(run, "node bigint, shingles binary").distinct()


def confirmed(docs: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose full sets have ``100 * intersection >= percent * union``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for x, y in zip(batch.column("sa"), batch.column("sb")):
                s, t = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.concatenate([s, t])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                kept.append(100 * common >= percent * (len(both) - common))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(kept))

    nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    sets = settle(full_sets(docs, settle(nodes, "near-nodes"), width), "near-sets")
    first = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    second = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    found = pairs.join(first, "a").join(second, "b").select("a", "b", "sa", "sb").mapInArrow(run, "a bigint, b bigint")
    return found.distinct()


def postings(classes: DataFrame, floor: int) -> DataFrame:
    """``token, node, weight``: the posting lists that can hold a pair with ``floor`` matches.

    Tokens are coordinate-value pairs, ordered by how many documents have them.
    Two documents with ``floor`` common tokens share one among the first
    ``COORDINATES - floor + 1`` of either, so only that prefix is posted; tokens
    of a single document use up places in it but need no list. ``weight`` sums
    the list lengths of a document's tokens: it is highest for the centre of a
    group of copies.
    """
    tokens = classes.select("node", F.explode("coordinates").alias("token")).distinct()
    common = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    ranked = (
        tokens.join(common, "token")
        .groupBy("node")
        .agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("x"), F.sum("n").alias("weight"))
    )
    room = COORDINATES - floor + 1 - (COORDINATES - F.size("x"))
    prefix = ranked.filter(F.size("x") >= floor).select("node", "weight", F.explode(F.slice("x", F.lit(1), F.greatest(room, F.lit(0)))).alias("x"))
    return settle(prefix.select(F.col("x.token").alias("token"), "node", "weight"), "near-postings")


def _near_size(n: Column, m: Column, percent: int) -> Column:
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def star_pairs(lists: DataFrame, classes: DataFrame, floor: int, percent: int) -> DataFrame:
    """Each member of a posting list beside the list's heaviest one, if enough coordinates agree."""
    heads = (
        lists.groupBy("token")
        .agg(F.max(F.struct("weight", (-F.col("node")).alias("less"))).alias("h"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("token", (-F.col("h.less")).alias("head"))
    )
    pairs = lists.join(heads, "token").filter("node <> head").select("node", "head").distinct()
    one = classes.select("node", F.col("n").alias("n1"), F.col("coordinates").alias("c1"))
    two = classes.select(F.col("node").alias("head"), F.col("n").alias("n2"), F.col("coordinates").alias("c2"))
    met = pairs.join(one, "node").join(two, "head").filter(_near_size(F.col("n1"), F.col("n2"), percent))
    close = met.filter(F.size(F.array_intersect("c1", "c2")) >= floor)
    return settle(close.select(F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b")).distinct(), "near-candidates")


def rare_shingles(docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """``node, shingle, n`` for the shingles that at most ``RARE`` documents of ``nodes`` have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = shingler(width)
        for batch in batches:
            sets = [tool.shingles(x.as_py()).view(np.int64) for x in batch.column("text")]
            owner = np.repeat(batch.column("node").to_numpy(), [len(s) for s in sets])
            yield pa.RecordBatch.from_pydict({"node": owner, "shingle": np.concatenate([*sets, np.empty(0, np.int64)])})

    texts = _texts_of(docs, nodes)
    each = settle(texts.mapInArrow(run, "node bigint, shingle bigint").distinct(), "near-shingles")
    few = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") <= RARE)
    return settle(each.join(few, "shingle").select("node", "shingle", "n"), "near-rare")


def rare_pairs(rare: DataFrame, facts: DataFrame) -> DataFrame:
    """``x, y, r``: documents of different components with rare shingles in common, and how many.

    A list holds ``RARE`` documents at most. Component, size and rare shingles
    come along, so only pairs that can matter leave it.
    """
    member = F.struct("node", "label", F.col("size").alias("n"), "own").alias("m")
    known = facts.select("node", "label", F.col("n").alias("size"), "own")
    lists = rare.filter("n > 1").join(known, "node").groupBy("shingle").agg(F.sort_array(F.collect_list(member)).alias("l"))
    first = lists.select("l", F.posexplode("l").alias("i", "x"))
    others = F.filter(F.slice("l", F.col("i") + 2, RARE), lambda y: y["label"] != F.col("x")["label"])
    pairs = first.select("x", F.explode(others).alias("y"))
    return pairs.groupBy("x", "y").agg(F.count(F.lit(1)).alias("r"))


def rest_pairs(docs: DataFrame, lists: DataFrame, classes: DataFrame, labels: DataFrame, floor: int, width: int, percent: int) -> DataFrame:
    """Pairs of one posting list that the stars left in different components and that may still be similar.

    Pairs with a rare shingle in common are found from the short lists of such
    shingles. A document with ``own`` rare ones shares at most ``n - own`` with
    any other, and with a pair's number of common rare ones added that holds for
    the pair. This bound, exact, drops most documents at the rim of a group at
    once and leaves the others a narrow range of sizes to look at. Lists are
    compared in blocks of bounded size; only pairs that pass the bound and have
    enough matching coordinates are handed on.
    """
    marked = lists.join(labels.withColumnRenamed("label", "l"), "node", "left")
    marked = settle(marked.select("token", "node", "weight", F.coalesce("l", "node").alias("label")), "near-marked")
    open_lists = (
        marked.groupBy("token")
        .agg(
            F.min("label").alias("low"),
            F.max("label").alias("high"),
            F.max(F.struct("weight", (-F.col("node")).alias("less"), "label")).alias("h"),
            F.count(F.lit(1)).alias("members"),
        )
        .filter("low <> high")
        .select("token", F.col("h.label").alias("main"), "members")
    )
    within = settle(marked.join(open_lists, "token").drop("weight"), "near-within")
    nodes = settle(within.select("node").distinct(), "near-rest-nodes")
    rare = rare_shingles(docs, nodes, width)
    own = rare.groupBy("node").agg(F.count(F.lit(1)).alias("own"))
    posted = within.groupBy("node").agg(F.collect_list("token").alias("posted"))  # a prefix at most
    facts = classes.join(posted, "node").join(own, "node", "left").join(labels.withColumnRenamed("label", "l"), "node", "left")
    facts = facts.select(
        "node", "n", F.coalesce("own", F.lit(0)).alias("own"), "coordinates", F.coalesce("l", "node").alias("label"), "posted"
    )
    facts = settle(facts, "near-facts")
    n_x, n_y = F.col("x.n"), F.col("y.n")
    most = F.least(n_x - F.col("x.own"), n_y - F.col("y.own")) + F.col("r")
    possible = rare_pairs(rare, facts).filter(100 * most >= percent * (n_x + n_y - most))
    possible = possible.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
    one = facts.select(F.col("node").alias("a"), F.col("coordinates").alias("ca"))
    two = facts.select(F.col("node").alias("b"), F.col("coordinates").alias("cb"))
    met = possible.join(one, "a").join(two, "b").filter(F.size(F.array_intersect("ca", "cb")) >= floor)
    sharing = met.select("a", "b")
    shared = F.col("n") - F.col("own")
    # Largest size of a partner for which the bound still allows the threshold.
    reach = F.floor(100 * shared / percent) - F.col("own")
    rows = within.drop("label").join(facts, "node").filter(100 * shared >= percent * F.col("n")).withColumn("reach", reach)
    member = F.struct("node", "label", "n", "own", "coordinates", "posted")
    salt = F.pmod(F.xxhash64("node"), F.ceil(F.col("members") / BLOCK).cast("long"))
    blocks = rows.groupBy("token", "main", F.floor(F.col("n") / 16).alias("size"), salt.alias("salt"), (F.col("label") != F.col("main")).alias("rim"))
    blocks = settle(blocks.agg(F.collect_list(member).alias("members"), F.max("reach").alias("reach"), F.min("n").alias("n")), "near-blocks")
    left = blocks.filter("rim").select("token", "main", F.col("members").alias("x"), F.col("reach").alias("reach_x"), F.col("n").alias("n_x"))
    right = blocks.select("token", F.col("members").alias("y"), F.col("reach").alias("reach_y"), F.col("n").alias("n_y"))
    met = left.join(right, "token").filter("n_y <= reach_x AND n_x <= reach_y").select("token", "main", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def columns(members: pa.StructArray) -> list:
            ints = [members.field(k).to_numpy() for k in ("node", "label", "n", "own")]
            posted = [frozenset(p) for p in members.field("posted").to_pylist()]
            return [*ints, members.field("coordinates").flatten().to_numpy().reshape(-1, COORDINATES), posted]

        for batch in batches:
            for token, main, x, y in zip(*(batch.column(c) for c in ("token", "main", "x", "y"))):
                (v, lv, nv, ov, cv, pv), (w, lw, nw, ow, cw, pw) = columns(x.values), columns(y.values)
                token, main = token.as_py(), main.as_py()
                most = np.minimum((nv - ov)[:, None], (nw - ow)[None, :])
                may = (lv[:, None] != lw[None, :]) & (100 * most >= percent * (nv[:, None] + nw[None, :] - most))
                # Two documents of the rim meet twice, once from either side.
                may &= (lw == main)[None, :] | (v[:, None] < w[None, :])
                i, j = np.nonzero(may)
                for at in range(0, len(i), 65_536):
                    p, q = i[at : at + 65_536], j[at : at + 65_536]
                    enough = (cv[p] == cw[q]).sum(axis=1) >= floor
                    # A pair of several lists counts in the first.
                    once = [k for k in np.flatnonzero(enough).tolist() if min(pv[p[k]] & pw[q[k]]) == token]
                    a, b = v[p[once]], w[q[once]]
                    if len(a):
                        yield pa.RecordBatch.from_pydict({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return settle(met.mapInArrow(run, "a bigint, b bigint").unionByName(sharing).distinct(), "near-rest")


def near_groups(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    Words are runs of non-blank characters with A-Z lower-cased; a document's set
    holds its distinct ``width``-word shingles, or the whole word sequence if it
    is shorter. Documents link when their full sets reach ``percent`` similarity;
    equal sets are merged first, whatever their number. ``component_id`` is the
    smallest id reachable and ``kept`` marks it. Texts without a word (or null)
    and rows without an id link with nothing; the latter have no component and
    are kept. Rows with the same id are one document.

    Stars around each posting list's centre find the bulk of the links; what
    then lies in different components is compared within its lists, so a link
    is lost only if fewer than ``match_floor(percent)`` coordinates agree.
    """
    floor = match_floor(percent)
    known = settle(signatures(docs, width), "near-signatures")
    linkable = known.filter("digest IS NOT NULL AND doc_id IS NOT NULL")
    classes = linkable.groupBy("digest").agg(
        F.min("doc_id").alias("node"), F.max("n").alias("n"), F.max("coordinates").alias("coordinates"), F.count(F.lit(1)).alias("copies")
    )
    classes = settle(classes, "near-classes")
    lists = postings(classes, floor)
    labels = components(confirmed(docs, star_pairs(lists, classes, floor, percent), width, percent))
    rest = rest_pairs(docs, lists, classes, labels, floor, width, percent)
    if not rest.isEmpty():
        more = confirmed(docs, rest, width, percent)
        labels = components(more.unionByName(labels.select(F.col("node").alias("a"), F.col("label").alias("b"))))
    named = classes.join(labels, "node", "left").select(
        "digest", "copies", "node", F.coalesce("label", "node").alias("component_id")
    )
    grouped = settle(named.filter("copies > 1 OR component_id <> node").select("digest", "component_id"), "near-grouped")
    out = known.join(broadcast_checked(grouped), "digest", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        (component.isNull() | (F.col("doc_id") == component)).alias("kept"),
    )


def without_near_copies(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay, one document of each group, with the same columns."""
    gone = settle(near_groups(docs, width, percent).filter("NOT kept").select("doc_id").distinct(), "near-gone")
    rows = docs.select(row_of(docs), F.col("doc_id").cast("long").alias("doc_id"))
    return rows.join(broadcast_checked(gone), "doc_id", "left_anti").select("row.*")
