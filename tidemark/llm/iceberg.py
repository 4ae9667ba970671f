"""Source divergence audit: frequent terms by prefix refinement, then integer divergences of sources.

The terms of a language that stand in enough documents are found level by
level: prefixes of 4, 8, 16 ... bytes are counted by distinct documents, and
only prefixes with enough of them are extended. A term's last byte is followed
by a zero byte, which no term holds, so a prefix that ends in it is a complete
term. The levels end when no incomplete prefix is left.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import broadcast_checked, packed_bytes, slices, text_of
from tidemark.operators.joins import BROADCAST_BYTES
from tidemark.session import folder, settle, spread

#: Bytes of the shortest prefix counted; each level doubles it.
FIRST = 4
#: Bytes of text in a block of documents; bytes of stored blocks that are read at once.
TEXTS, ROW_GROUP = 8 << 20, 16 << 20
#: Blocks whose counts go to one part of the terms, about.
BLOCKS = 2
#: Sources on each side of a block of source pairs, and counted terms in one of its parts.
SOURCES, PART = 256, 200_000
#: Shares are counted in parts of this.
SCALE = 1_000_000_000

_byte = np.arange(256)
_upper = (_byte >= 0x41) & (_byte <= 0x5A)
LOWER = np.where(_upper, _byte + 32, _byte).astype(np.uint8).tobytes()
#: Bytes of terms: letters of ASCII, and every byte of a character beyond it.
_inside = _upper | ((_byte >= 0x61) & (_byte <= 0x7A)) | (_byte >= 0x80)
INSIDE, OUTSIDE = _inside.tobytes(), _byte[~_inside].astype(np.uint8).tobytes()


def tokens(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Row and bytes of every term of the texts, in order, with A-Z in lower case."""
    texts = texts.cast(pa.large_binary())
    _, places, data = texts.buffers()
    begins = np.frombuffer(places, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = data.slice(begins[0], begins[-1] - begins[0]).to_pybytes() if data else b""
    begins = begins - begins[0]
    inside = np.frombuffer(raw.translate(INSIDE), dtype=bool)
    before, after = np.zeros_like(inside), np.zeros_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    before[begins[begins < len(raw)]] = False  # a term ends with its text
    after[begins[begins > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    kept = pa.py_buffer(raw.translate(LOWER, OUTSIDE))
    found = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), kept])
    return np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(starts, begins))), found


def starts(ordered: np.ndarray) -> np.ndarray:
    """Where the runs of equal values begin."""
    return np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])[: len(ordered)])


def distinct(keys: np.ndarray) -> np.ndarray:
    """Sorted different keys; on many whole numbers plain ``np.unique`` hashes, which takes far longer."""
    ordered = np.sort(keys)
    return ordered[starts(ordered)]


def tally(keys: np.ndarray, ns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different keys and the sums of their ``ns``."""
    order = np.argsort(keys)
    ordered = keys[order]
    at = starts(ordered)
    return ordered[at], np.add.reduceat(ns[order].astype(np.int64), at) if len(at) else np.zeros(0, np.int64)


def packed(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The numbers as bytes, cut at ``ends``."""
    offsets = np.concatenate([[0], ends * values.itemsize]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def packed_strings(values: pa.Array, ends: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """The strings' bytes and their lengths, both cut after as many strings as ``ends`` says."""
    whole = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values), b"")
    lengths = pc.binary_length(values).to_numpy(zero_copy_only=False).astype(np.int32)
    places = np.concatenate([[0], np.cumsum(lengths)])
    return packed(np.frombuffer(whole[0].as_py(), dtype=np.uint8), places[ends]), packed(lengths, ends)


def joined(column: pa.ChunkedArray) -> np.ndarray:
    """The numbers of all rows that ``packed`` made of 32-bit ones."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.int32)


def strings(column: pa.ChunkedArray, lengths: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    data = b"".join(column.to_pylist())
    return pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


@dataclass
class Block:
    """Some documents: their different terms, and for each document which of them it holds how often."""

    terms: pa.Array
    codes: np.ndarray  # of the terms, document after document
    ns: np.ndarray
    docs: np.ndarray  # document of each code
    doc_groups: np.ndarray
    groups: list[tuple[str, str]]

    @classmethod
    def of(cls, part: pa.RecordBatch) -> Block:
        rows, found = tokens(part.column("text"))
        found = found.dictionary_encode()
        size = max(1, len(found.dictionary))
        keys, ns = np.unique(rows * size + found.indices.to_numpy(), return_counts=True)
        pairs = list(zip(part.column("lang").to_pylist(), part.column("source").to_pylist()))
        groups = {g: k for k, g in enumerate(dict.fromkeys(pairs))}
        doc_groups = np.array([groups[g] for g in pairs], dtype=np.int32)
        return cls(found.dictionary.cast(pa.binary()), keys % size, ns, keys // size, doc_groups, list(groups))

    def pack(self) -> pa.RecordBatch:
        """One row; numbers as bytes, which Spark only passes on."""
        ends = np.cumsum(pc.binary_length(self.terms).to_numpy(zero_copy_only=False), dtype=np.int32)
        sizes = np.bincount(self.docs, minlength=len(self.doc_groups))
        whole = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(self.terms)], pa.int32()), self.terms), b"")
        numbers = {"ends": ends, "codes": self.codes, "ns": self.ns, "sizes": sizes, "doc_groups": self.doc_groups}
        columns = {k: pa.array([v.astype(np.int32).tobytes()], pa.binary()) for k, v in numbers.items()}
        groups = [[{"lang": g, "source": s} for g, s in self.groups]]
        kind = pa.list_(pa.struct([("lang", pa.string()), ("source", pa.string())]))
        return pa.RecordBatch.from_pydict({"terms": whole, **columns, "groups": pa.array(groups, kind)})

    @classmethod
    def unpack(cls, batch: pa.RecordBatch, i: int) -> Block:
        read = lambda c: np.frombuffer(batch.column(c)[i].as_py(), dtype=np.int32)
        ends, sizes = read("ends"), read("sizes")
        offsets = pa.py_buffer(np.concatenate([[0], ends]).astype(np.int32))
        terms = pa.Array.from_buffers(pa.binary(), len(ends), [None, offsets, batch.column("terms")[i].as_buffer()])
        docs = np.repeat(np.arange(len(sizes)), sizes)
        groups = [(g["lang"], g["source"]) for g in batch.column("groups")[i].as_py()]
        return cls(terms, read("codes"), read("ns"), docs, read("doc_groups"), groups)

    def langs(self) -> tuple[list[str], np.ndarray]:
        """The languages, and the number of each group's."""
        langs = {g: k for k, g in enumerate(dict.fromkeys(g for g, _ in self.groups))}
        return list(langs), np.array([langs[g] for g, _ in self.groups], dtype=np.int64)

    def prefix_documents(self, size: int, first: int) -> pa.RecordBatch:
        """``lang, prefix, n``: documents of each language that hold a term with this prefix of ``size`` bytes."""
        lengths = pc.binary_length(self.terms).to_numpy(zero_copy_only=False)
        taken = np.flatnonzero(lengths >= (size // 2 if size > first else 0))
        closed = pc.binary_join_element_wise(self.terms.take(pa.array(taken)), pa.scalar(b"\0"), pa.scalar(b""))
        cut = pc.binary_slice(closed, 0, size).dictionary_encode()
        prefix_of = np.full(len(self.terms), -1, dtype=np.int64)
        prefix_of[taken] = cut.indices.to_numpy()
        width = max(1, len(cut.dictionary))
        prefix = prefix_of[self.codes]
        # A prefix with the last byte of its term belongs to no other term, so a document has it once.
        whole = (lengths < size)[self.codes] & (prefix >= 0)
        cuts = ~whole & (prefix >= 0)
        once = distinct(self.docs[cuts] * width + prefix[cuts])
        langs, lang_of = self.langs()
        lang_of = lang_of[self.doc_groups]
        found = lang_of[self.docs[whole]] * width + prefix[whole], lang_of[once // width] * width + once % width
        keys, n = np.unique(np.concatenate(found), return_counts=True)
        names = pa.array(langs, pa.string())
        return pa.RecordBatch.from_pydict(
            {"lang": names.take(pa.array(keys // width)), "prefix": cut.dictionary.take(pa.array(keys % width)), "n": pa.array(n, pa.int64())}
        )

    def dealt_counts(self, parts: int) -> pa.RecordBatch:
        """``DEALT``: occurrences of the terms in the sources of a language, one row for each part of its terms.

        Terms go to parts by their CRC-32. ``terms`` and ``lengths`` are a row's
        terms, ``holders`` tells how many sources have each; ``sources`` and
        ``ns`` are those sources, by their place in ``names``, and the counts.
        """
        width, size = max(1, len(self.terms)), max(1, len(self.groups))
        places, data = self.terms.buffers()[1:]
        places, data = np.frombuffer(places, dtype=np.int32).tolist(), data.to_pybytes()
        part = np.array([zlib.crc32(data[a:b]) for a, b in zip(places, places[1:])], dtype=np.int64) % parts
        order = np.argsort(part, kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        langs, lang_of = self.langs()
        group = self.doc_groups[self.docs]
        keys, ns = tally((lang_of[group] * width + place[self.codes]) * size + group, self.ns)
        group, terms = keys % size, keys // size
        ends = lambda at, n: np.append(at[1:], n)[: len(at)]
        at = starts(terms)
        codes = order[terms[at] % width]
        rows = terms[at] // width * parts + part[codes]
        first = starts(rows)  # terms at which the rows begin
        row_of = np.repeat(np.arange(len(first)), np.diff(np.append(at[first], len(keys))))
        named, source = np.unique(row_of * size + group, return_inverse=True)
        first_name = np.searchsorted(named, np.arange(len(first)) * size)
        names = pa.array([s for _, s in self.groups], pa.string()).cast(pa.binary()).take(pa.array(named % size))
        per_row = ends(at[first], len(keys))
        of_terms, lengths = packed_strings(self.terms.take(pa.array(codes)), ends(first, len(at)))
        of_names, name_lengths = packed_strings(names, ends(first_name, len(named)))
        return pa.RecordBatch.from_pydict(
            {
                "lang": pa.array(langs, pa.string()).take(pa.array(rows[first] // parts)),
                "part": pa.array(rows[first] % parts, pa.int32()),
                "terms": of_terms,
                "lengths": lengths,
                "holders": packed(np.diff(np.append(at, len(keys))).astype(np.int32), ends(first, len(at))),
                "sources": packed((source - first_name[row_of]).astype(np.int32), per_row),
                "ns": packed(ns.astype(np.int32), per_row),
                "names": of_names,
                "name_lengths": name_lengths,
            }
        )


DEALT = (
    "lang string, part int, terms binary, lengths binary, holders binary, sources binary, ns binary, "
    "names binary, name_lengths binary"
)
COUNTS = "lang string, source string, term string, id bigint, n bigint, in_lang bigint"
BLOCK = (
    "terms binary, ends binary, codes binary, ns binary, sizes binary, doc_groups binary, "
    "groups array<struct<lang: string, source: string>>"
)


def term_blocks(docs: DataFrame) -> DataFrame:
    """Blocks of documents with their terms, stored; every level and the last count read them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", TEXTS):
                yield Block.of(part).pack()

    named = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")]
    texts = spread(docs.select(*named, text_of().alias("text")))
    path = folder(docs.sparkSession, "audit-blocks")
    blocks = texts.mapInArrow(run, BLOCK)
    blocks.write.option("parquet.block.size", ROW_GROUP).parquet(path)
    return docs.sparkSession.read.schema(BLOCK).parquet(path)


def from_blocks(blocks: DataFrame, make: Callable[[Block], pa.RecordBatch], schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield make(Block.unpack(batch, i))

    return blocks.mapInArrow(run, schema)


def frequent_terms(blocks: DataFrame, threshold: int, first: int = FIRST) -> DataFrame:
    """``lang, term`` of the terms that at least ``threshold`` documents of the language hold.

    Up to the broadcast bound, the prefixes kept by the level before prune a
    level's rows before its shuffle. Beyond it the counts alone decide: a prefix
    that reaches the threshold has no shorter one that fails it.
    """
    size, kept, found = first, None, None
    while True:
        rows = from_blocks(blocks, partial(Block.prefix_documents, size=size, first=first), "lang string, prefix binary, n bigint")
        if kept is not None and packed_bytes(kept) <= BROADCAST_BYTES // 8:
            head = F.substring("prefix", 1, size // 2)
            rows = rows.withColumn("head", head).join(F.broadcast(kept), ["lang", "head"], "left_semi")
        counted = rows.groupBy("lang", "prefix").agg(F.sum("n").alias("n")).filter(F.col("n") >= threshold)
        level = settle(counted.select("lang", "prefix"), f"audit-prefixes-{size}")
        whole = F.substring("prefix", -1, 1) == F.lit(b"\0")
        term = F.expr("cast(substring(prefix, 1, octet_length(prefix) - 1) as string)")
        terms = level.filter(whole).select("lang", term.alias("term"))
        found = terms if found is None else found.unionByName(terms)
        kept = level.filter(~whole).select("lang", F.col("prefix").alias("head"))
        if kept.isEmpty():
            return settle(found, "audit-terms")
        size *= 2


def kept_counts(key: tuple, dealt: pa.Table, kept: pa.Table) -> pa.Table:
    """``COUNTS`` of the kept terms of one part of a language."""
    lang, part = (k.as_py() for k in key)
    per_row = lambda c: pc.binary_length(dealt.column(c)).to_numpy() // 4
    wanted = kept.column("term").combine_chunks().cast(pa.large_binary())
    found = pc.index_in(strings(dealt.column("terms"), joined(dealt.column("lengths"))), value_set=wanted)
    term = np.repeat(pc.fill_null(found, -1).to_numpy(zero_copy_only=False), joined(dealt.column("holders")))
    names = strings(dealt.column("names"), joined(dealt.column("name_lengths"))).dictionary_encode()
    before = np.cumsum(per_row("name_lengths")) - per_row("name_lengths")
    source = names.indices.to_numpy()[joined(dealt.column("sources")) + np.repeat(before, per_row("sources"))]
    here, size = term >= 0, max(1, len(names.dictionary))
    keys, n = tally(term[here].astype(np.int64) * size + source[here], joined(dealt.column("ns"))[here])
    term, source = keys // size, keys % size
    at = starts(term)
    in_lang = np.add.reduceat(n, at) if len(at) else n
    return pa.table(
        {
            "lang": pa.array([lang], pa.string()).take(pa.array(np.zeros(len(keys), np.int64))),
            "source": names.dictionary.take(pa.array(source)).cast(pa.large_string()).cast(pa.string()),
            "term": wanted.take(pa.array(term)).cast(pa.large_string()).cast(pa.string()),
            "id": pa.array((part << 32) + term),
            "n": pa.array(n),
            "in_lang": pa.array(np.repeat(in_lang, np.diff(np.append(at, len(keys))))),
        }
    )


def group_counts(blocks: DataFrame, terms: DataFrame) -> DataFrame:
    """``COUNTS``: occurrences of each kept term in a source of its language, and in the language.

    Blocks send their counts as bytes, dealt by term. A part holds about as
    much as ``BLOCKS`` blocks, whatever the size of the input. ``id`` numbers
    the terms of a language, with gaps, for this result only.
    """
    parts = max(blocks.sparkSession.sparkContext.defaultParallelism, blocks.count() // BLOCKS)
    dealt = from_blocks(blocks, partial(Block.dealt_counts, parts=parts), DEALT)
    kept = terms.withColumn("part", (F.crc32(F.col("term").cast("binary")) % parts).cast("int"))
    both = dealt.groupBy("lang", "part").cogroup(kept.groupBy("lang", "part"))
    return both.applyInArrow(kept_counts, COUNTS)


def part_of(count: Column, total: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / total); counts too large for 64 bits go through decimals."""
    most = 9_000_000_000
    exact = F.call_function("div", (F.lit(SCALE).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)")), total.cast("decimal(20,0)"))
    plain = F.call_function("div", F.lit(SCALE).cast("long") * (F.least(count, F.lit(most)) + 1), total)
    return 1 + F.when(count < most, plain).otherwise(exact)


def gain(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q) in whole numbers."""
    return F.call_function("div", (p - q) * (p - q), q)


PAIR = "lang string, a int, b int, sum bigint, covered bigint"


def _pair_block(rows: pd.DataFrame) -> pd.DataFrame:
    """Sums over the terms of one part of a block of source pairs, and how many terms that were.

    Rows with the term -1 give a source's share of a term it lacks.
    """
    lang = rows["lang"].iloc[0]
    blank = rows["term"] < 0
    sides = []
    terms = np.full(len(rows), -1)
    terms[~blank], found = pd.factorize(rows["term"].to_numpy()[~blank])
    n = len(found)
    for here in (rows["side"] != 1, rows["side"] != 0):
        ids = np.sort(rows.loc[here & blank, "src"].to_numpy())
        table = np.empty((n, len(ids)), dtype=np.int64)
        lacking = rows[here & blank].sort_values("src")["p"].to_numpy()
        table[:] = lacking
        filled = (here & ~blank).to_numpy()
        table[terms[filled], np.searchsorted(ids, rows["src"].to_numpy()[filled])] = rows["p"].to_numpy()[filled]
        sides.append((ids, table))
    (a, left), (b, right) = sides
    sums = np.zeros((len(a), len(b)), dtype=np.int64)
    for at in range(0, n, 4096):
        p, q = left[at : at + 4096], right[at : at + 4096]
        for i in range(len(a)):
            d = p[:, i : i + 1] - q
            sums[i] += (d * d // q).sum(axis=0)
    return pd.DataFrame(
        {"lang": lang, "a": np.repeat(a, len(b)), "b": np.tile(b, len(a)), "sum": sums.ravel(), "covered": n}
    )


def pair_sums(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, a, b, sum, covered`` over the terms that occur in the block of sources of either side.

    Sources are numbered within their language and taken in blocks; the terms
    of a language are dealt into parts by hash, so a large language spreads over
    many tasks and none holds more than a part of a block.
    """
    parts = max(1, -(-shares.count() // PART))
    width = groups.agg(F.coalesce(F.max("src"), F.lit(0))).first()[0] // SOURCES + 1
    spots = F.array(*[F.lit(i) for i in range(width)])

    def dealt(rows: DataFrame, part: Column) -> DataFrame:
        block = F.floor(F.col("src") / SOURCES).cast("int")
        mine = rows.select("lang", "src", "term", "p", block.alias("mine"), part.alias("part"), F.explode(spots).alias("other"))
        same = F.col("mine") == F.col("other")
        side = F.explode(F.when(same, F.array(F.lit(2))).otherwise(F.array(F.lit(0), F.lit(1))))
        both = mine.select("*", side.alias("side"))
        first = F.col("side") == 1
        return both.select(
            "lang",
            F.when(first, F.col("other")).otherwise(F.col("mine")).alias("x"),
            F.when(first, F.col("mine")).otherwise(F.col("other")).alias("y"),
            "part", "side", "src", "term", "p",
        )

    counted = dealt(shares.select("lang", "src", F.col("id").alias("term"), "p"), F.pmod(F.xxhash64("term"), F.lit(parts)).cast("int"))
    lacking = groups.select("lang", "src", F.lit(-1).cast("long").alias("term"), F.col("p0").alias("p"))
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    rows = counted.unionByName(dealt(lacking, everywhere))
    sums = rows.groupBy("lang", "x", "y", "part").applyInPandas(_pair_block, PAIR)
    return sums.groupBy("lang", "a", "b").agg(F.sum("sum").alias("sum"), F.sum("covered").alias("covered"))


def source_divergence(docs: DataFrame, threshold: int = 3, top: int = 200) -> DataFrame:
    """``lang, source, part, item, value, rank``: how each source of a language differs from others and from it.

    A row of ``docs`` is a document; null text, language and source count as
    empty, so an empty text gives its group without terms, and repeated rows
    are documents of their own. A group's share of a term is
    ``1 + floor(10^9 * (count + 1) / (N + V))``. Part ``pair`` has every other
    source of the language, ``term`` the ``top`` terms more frequent in the
    source than in the language. Ties go by the item's bytes; an empty table
    gives no rows.
    """
    blocks = term_blocks(docs)
    terms = frequent_terms(blocks, threshold)
    counts = settle(group_counts(blocks, terms), "audit-counts")
    by_lang = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = F.lit(0).cast("long")
    groups = blocks.select(F.explode("groups").alias("g")).select("g.*").distinct()
    groups = groups.join(totals, ["lang", "source"], "left")
    groups = groups.join(by_lang, "lang", "left").select(
        "lang", "source",
        F.coalesce("total", zero).alias("total"), F.coalesce("v", zero).alias("v"),
        (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).alias("src"),
        F.sum(F.coalesce("total", zero)).over(Window.partitionBy("lang")).alias("lang_total"),
    )
    size = F.col("total") + F.col("v")
    groups = groups.withColumn("p0", F.when(size > 0, part_of(zero, size)))
    groups = settle(groups, "audit-groups")
    known = counts.join(broadcast_checked(groups), ["lang", "source"])
    shares = known.select(
        "lang", "source", "src", "term", "id",
        part_of(F.col("n"), size).alias("p"),
        part_of(F.col("in_lang"), F.col("lang_total") + F.col("v")).alias("q"),
    )
    shares = settle(shares, "audit-shares")

    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    excess = shares.filter("p > q").select("lang", "source", F.col("term").alias("item"), gain(F.col("p"), F.col("q")).alias("value"))
    term_part = excess.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)

    x = groups.select("lang", "source", F.col("src").alias("a"), F.col("p0").alias("pa"), "v")
    y = groups.select("lang", F.col("source").alias("item"), F.col("src").alias("b"), F.col("p0").alias("pb"))
    pairs = x.join(y, "lang").filter("a <> b").join(pair_sums(shares, groups.filter("v > 0")), ["lang", "a", "b"], "left")
    # Terms of neither block of sources have the share of an absent term on both sides.
    rest = (F.col("v") - F.coalesce("covered", zero)) * gain(F.col("pa"), F.col("pb"))
    value = F.when(F.col("v") > 0, F.coalesce("sum", zero) + rest).otherwise(zero)
    pair_part = pairs.select("lang", "source", "item", value.alias("value")).withColumn("rank", F.row_number().over(best))

    named = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
    return named(pair_part, "pair").unionByName(named(term_part, "term"))
