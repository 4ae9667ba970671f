"""Text as columns: words, sentences, chunks and shingles, all inside the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once.

    A column named inside a lambda is evaluated for every element; a lambda
    variable is not.
    """
    return F.transform(F.array(value), use)[0]


def clean(c: Column) -> Column:
    """Trimmed, with every run of white space as one blank."""
    return F.trim(F.regexp_replace(c, r"[ \t\n\r\f]+", " "))


def strip(c: Column) -> Column:
    """Without white space at either end."""
    return F.regexp_replace(c, r"^[ \t\n\r\f]+|[ \t\n\r\f]+$", "")


def words(c: Column) -> Column:
    """Lower-case words: maximal runs of letters."""
    return F.filter(F.split(F.lower(c), r"[^\p{L}]+"), lambda w: w != "")


def sentences(c: Column) -> Column:
    return F.split(c, r"[.] ")


def chunks(c: Column, size: int = 300, overlap: int = 0) -> Column:
    """Pack sentences into chunks of about ``size`` characters, in order.

    A chunk ends before the sentence that would take it past ``size``; a single
    longer sentence is a chunk of its own. ``overlap`` repeats that many
    sentences of the chunk before. The result is an array of
    ``(chunk_index, chunk_text)``; blank text has none.

    Only lengths and start positions go through the fold, the texts are cut
    once at the end, so the cost stays linear in the text.
    """
    start = F.struct(
        F.array().cast("array<int>").alias("starts"),
        F.lit(0).alias("used"),
        F.lit(0).alias("at"),
    )

    def add(state: Column, length: Column) -> Column:
        full = (state["used"] == 0) | (state["used"] + length > size)
        return F.struct(
            F.when(full, F.concat(state["starts"], F.array(state["at"]))).otherwise(state["starts"]).alias("starts"),
            (F.when(full, 0).otherwise(state["used"]) + length + 2).alias("used"),
            (state["at"] + 1).alias("at"),
        )

    def cut_all(parts: Column) -> Column:
        starts = F.aggregate(F.transform(parts, F.length), start, add, lambda s: s["starts"])
        return bind(starts, lambda begins: F.transform(begins, cut(parts, begins)))

    def cut(parts: Column, begins: Column):
        def one(begin: Column, i: Column) -> Column:
            end = F.coalesce(F.get(begins, i + 1), F.size(parts))
            first = F.greatest(begin - overlap, F.lit(0))
            text = strip(F.array_join(F.slice(parts, first + 1, end - first), ". "))
            closed = F.when(text.endswith("."), text).otherwise(F.concat(text, F.lit(".")))
            return F.struct(i.alias("chunk_index"), closed.alias("chunk_text"))

        return one

    return F.when(strip(c) != "", bind(sentences(c), cut_all))


def shingles(c: Column, n: int = 3) -> Column:
    """Hashes of the distinct runs of ``n`` words; shorter texts hash as a whole."""

    def runs(w: Column) -> Column:
        return F.when(
            F.size(w) >= n,
            F.transform(
                F.sequence(F.lit(1), F.size(w) - (n - 1)),
                lambda i: F.xxhash64(*[F.element_at(w, i + k) for k in range(n)]),
            ),
        ).otherwise(F.array(F.xxhash64(F.array_join(w, " "))))

    return F.array_distinct(bind(words(c), runs))


def hash_share(c: Column, digits: int = 6) -> Column:
    """A number in [0, 1) from the md5 of the text; equal on every engine."""
    return F.conv(F.substring(F.md5(c.cast("string")), 1, digits), 16, 10).cast("double") / float(16**digits)
