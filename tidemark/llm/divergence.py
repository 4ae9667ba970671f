"""Quality rules: base counts, and the divergence of a document from its language."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.text import bind
from tidemark.llm.common import GAP, broadcast_checked, count_words, row_of, text_of, words
from tidemark.session import settle

# Fixed values of the base rules.
SYMBOLS = "[#*$%&|<>]"
WINDOW = 8
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30

#: Common words per language in the reference histogram.
COMMON = 24
#: Most common words of all languages together that are looked up as one set.
LISTED = 5_000
#: Jensen-Shannon distances (base 2, 0 to 1) up to which a long document is kept. A histogram of few
#: counts lies away from its source by chance: ``allowed`` adds that much for short ones.
MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE = 0.3, 0.25
#: Below these lengths a histogram says too little, and its test is passed.
MIN_CLASS_CHARS, MIN_HISTOGRAM_WORDS = 100, 30

#: Character classes, removed from the text one after another; what is left is the last class.
CLASSES = [r"\p{Ll}+", GAP, r"\p{Lu}+", r"\p{N}+", r"[.,;:!?'\"()-]+"]


def class_counts(text: Column) -> Column:
    """Characters of each class: lower case, white space, upper case, digits, punctuation, other."""

    def step(pattern: str):
        def after(s: Column, left: Column) -> Column:
            n = (F.length(s["left"]) - F.length(left)).cast("long")
            return F.struct(left.alias("left"), F.concat(s["counts"], F.array(n)).alias("counts"))

        return lambda s: bind(F.regexp_replace(s["left"], pattern, ""), lambda left: after(s, left))

    state = F.struct(text.alias("left"), F.array().cast("array<long>").alias("counts"))
    for pattern in CLASSES:
        state = bind(state, step(pattern))
    return bind(state, lambda s: F.concat(s["counts"], F.array(F.length(s["left"]).cast("long"))))


def repeated_words(w: Column, window: int = WINDOW) -> Column:
    """Words that lie in windows of ``window`` words (a power of two) found at least twice in the array.

    Windows are compared by a 64-bit hash, joined from the hashes of their halves. Only texts
    with a repeat are sorted, by (hash, place), to find which windows repeat.
    """

    def doubled(k: int):
        """From hashes of runs of ``k`` words those of runs of ``2 * k``; ``w`` is longer than a window."""
        return lambda h: F.zip_with(
            F.slice(h, F.lit(1), F.size(h) - k), F.slice(h, F.lit(1 + k), F.size(h) - k), lambda x, y: F.xxhash64(x, y)
        )

    windows = F.transform(w, lambda x: F.xxhash64(x))
    for k in (1 << i for i in range(window.bit_length() - 1)):
        windows = bind(windows, doubled(k))

    def places(s: Column) -> Column:
        alone = lambda i: (F.get(s, i - 1)["h"] != F.get(s, i)["h"]) & (F.get(s, i + 1)["h"] != F.get(s, i)["h"])
        twice = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: ~F.coalesce(alone(i), ends(s, i)))
        return F.sort_array(F.transform(twice, lambda i: F.get(s, i)["i"]))

    def ends(s: Column, i: Column) -> Column:
        left, right = F.get(s, i - 1)["h"], F.get(s, i + 1)["h"]
        return F.coalesce(left, right) != F.get(s, i)["h"]

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, i: F.least(F.lit(window), F.coalesce(F.get(p, i + 1) - x, F.lit(window))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    def count(x: Column) -> Column:
        marked = F.sort_array(F.transform(x, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(x)) < F.size(x), bind(bind(marked, places), covered)).otherwise(0)

    return F.when(F.size(w) > window, bind(windows, count)).otherwise(0).cast("long")


def js_distance(counts: Column, share: Column) -> Column:
    """Jensen-Shannon distance between a histogram of counts and reference shares, base 2."""

    def half(a: Column, b: Column) -> Column:
        return F.when(a > 0, 0.5 * a * F.log2(2 * a / (a + b))).otherwise(0.0)

    def total(x: Column) -> Column:
        return F.aggregate(x, F.lit(0.0), lambda a, v: a + v)

    def from_counts(c: Column) -> Column:
        def from_sum(n: Column) -> Column:
            terms = F.zip_with(c, share, lambda x, q: bind(x / n, lambda p: half(p, q) + half(q, p)))
            return F.when(n > 0, F.sqrt(F.greatest(total(terms), F.lit(0.0)))).otherwise(0.0)

        return bind(total(F.transform(c, lambda x: x.cast("double"))), from_sum)

    return F.round(bind(counts, from_counts), 9)


def allowed(limit: float, bins: int, n: Column) -> Column:
    """``limit`` widened by twice the expected divergence of ``n`` draws over ``bins`` bins from their own source."""
    return F.sqrt(limit * limit + 2 * (bins - 1) / (8 * math.log(2)) / F.greatest(n, F.lit(1)).cast("double"))


def references(docs: DataFrame, common: int = COMMON) -> DataFrame:
    """Per language over all documents: ``lang, class_share, common, word_share``.

    ``common`` holds the most frequent lower-cased words (ties by the word),
    ``word_share`` their shares and, last, that of all other words.
    """
    lang = F.coalesce(F.col("lang"), F.lit("")).alias("lang")
    classes = docs.select(lang, class_counts(text_of()).alias("c"), count_words(text_of()).alias("n"))
    sums = [F.coalesce(F.sum(F.col("c")[k]), F.lit(0)).cast("double") for k in range(len(CLASSES) + 1)]
    by_class = classes.groupBy("lang").agg(F.array(*sums).alias("sums"), F.sum("n").alias("n"))
    total = F.aggregate("sums", F.lit(0.0), lambda a, v: a + v)
    by_class = by_class.select("lang", "n", bind(total, lambda n: F.transform("sums", lambda v: v / F.greatest(n, F.lit(1.0)))).alias("class_share"))
    counts = (
        docs.select(lang, F.explode(words(F.lower(text_of()))).alias("word"))
        .groupBy("lang", "word")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    top = counts.select("lang", F.struct((-F.col("n")).alias("less"), "word").alias("x"))
    # A language's words are ranked in two steps, so no task sees all words of a large language.
    salted = top.withColumn("salt", F.pmod(F.xxhash64("x.word"), F.lit(64)))
    first = Window.partitionBy("lang", "salt").orderBy("x")
    second = Window.partitionBy("lang").orderBy("x")
    best = (
        salted.withColumn("r", F.row_number().over(first))
        .filter(F.col("r") <= common)
        .withColumn("r", F.row_number().over(second))
        .filter(F.col("r") <= common)
    )
    listed = best.groupBy("lang").agg(F.sort_array(F.collect_list("x")).alias("x"))
    share = F.transform("x", lambda v: -v["less"] / F.greatest(F.col("n"), F.lit(1)).cast("double"))
    rest = bind(share, lambda s: F.concat(s, F.array(1.0 - F.aggregate(s, F.lit(0.0), lambda a, v: a + v))))
    joined = by_class.join(listed, "lang", "left").select(
        "lang", "class_share", F.transform("x", lambda v: v["word"]).alias("common"), rest.alias("word_share")
    )
    return settle(joined, "quality-references")


def common_words(refs: DataFrame, w: Column) -> Column:
    """The words of ``w``, lower-cased, that are in the column ``common``, in order.

    A word is looked up in the set of all languages' common words first, which
    drops most at once; with more than ``LISTED`` such words there is no set.
    """
    listed = [r[0] for r in refs.select(F.explode("common")).distinct().limit(LISTED + 1).collect()]
    some = F.filter(w, lambda x: F.lower(x).isin(listed)) if len(listed) <= LISTED else w
    return F.filter(F.transform(some, F.lower), lambda x: F.array_contains(F.col("common"), x))


def rated(docs: DataFrame, common: int = COMMON) -> DataFrame:
    """``row`` (all columns of ``docs``) with the base counts, both distances and the verdict.

    A null text is an empty one and a null language a language of its own. A
    document fails the base with fewer than 20 words or with over 30 % of its
    words in repeated windows. The method rejects a document that is long
    enough to tell when its character classes or its common words lie too far
    from its language. Every row is judged by itself, so ties and repeated
    rows need no rule; an empty table gives none.
    """
    refs = references(docs, common)
    base = docs.select(
        row_of(docs), F.col("doc_id").alias("id"), text_of().alias("t"), F.coalesce(F.col("lang"), F.lit("")).alias("l")
    )
    split = base.withColumn("w", words(F.col("t")))
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    known = split.join(
        broadcast_checked(refs.withColumnRenamed("lang", "l")), "l", "left"
    )
    word_counts = bind(
        common_words(refs, F.col("w")),
        lambda f: F.concat(
            F.transform("common", lambda c: F.size(F.filter(f, lambda x: x == c))),
            F.array(F.size("w") - F.size(f)),
        ),
    )
    n_words = F.size("w").cast("long")
    counted = known.select(
        "row",
        F.col("id").alias("doc_id"),
        n_words.alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.regexp_replace("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        bind(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("w")).alias("n_repeat_words"),
        F.length("t").alias("chars"),
        F.when(F.length("t") >= MIN_CLASS_CHARS, js_distance(class_counts(F.col("t")), F.col("class_share")))
        .otherwise(0.0)
        .alias("class_distance"),
        F.when(
            (n_words >= MIN_HISTOGRAM_WORDS) & F.col("common").isNotNull(), js_distance(word_counts, F.col("word_share"))
        )
        .otherwise(0.0)
        .alias("word_distance"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    fits = (F.col("class_distance") <= allowed(MAX_CLASS_DISTANCE, len(CLASSES) + 1, F.col("chars"))) & (
        F.col("word_distance") <= allowed(MAX_WORD_DISTANCE, common + 1, F.col("n_words"))
    )
    return counted.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & fits)


def quality_report(docs: DataFrame) -> DataFrame:
    """One row per document: id, base counts, both distances, ``base_failed`` and ``kept``."""
    return rated(docs).drop("row", "chars")


def good_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with the same columns."""
    return rated(docs).filter("kept").select("row.*")
