"""Document jobs: chunks, duplicates, lexicons, summaries, scores, conversations."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from tidemark.functions import text as tx
from tidemark.operators.joins import BROADCAST_BYTES, broadcast_if_small, latest_by
from tidemark.session import settle


def chunk_rows(
    docs: DataFrame, doc_id: str, text: str, size: int = 300, overlap: int = 0, keep: Sequence[str] = ()
) -> DataFrame:
    """One row per chunk with ``chunk_id = <doc_id>_<chunk_index>``."""
    return (
        docs.select(doc_id, *keep, F.explode(tx.chunks(F.col(text), size, overlap)).alias("c"))
        .select(doc_id, *keep, "c.chunk_index", "c.chunk_text")
        .withColumn("chunk_id", F.concat_ws("_", F.col(doc_id).cast("string"), F.col("chunk_index").cast("string")))
    )


BLANKS = " \t\n\r\f"
CHUNKS = ArrayType(StructType([StructField("chunk_index", IntegerType()), StructField("chunk_text", StringType())]))


def chunk_udf(size: int = 300):
    """The same chunker as an Arrow UDF, for callers that bring their own Python splitter."""

    def pack(text: str) -> list[tuple[int, str]]:
        if text is None or not text.strip(BLANKS):
            return []
        groups: list[list[str]] = []
        used = 0
        for s in text.split(". "):
            if not used or used + len(s) > size:
                groups.append([])
                used = 0
            groups[-1].append(s)
            used += len(s) + 2
        joined = [". ".join(g).strip(BLANKS) for g in groups]
        return [(i, t if t.endswith(".") else t + ".") for i, t in enumerate(joined)]

    @F.pandas_udf(CHUNKS)
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda x: [{"chunk_index": i, "chunk_text": c} for i, c in pack(x)])

    return run


# --- words ------------------------------------------------------------------


def word_counts(df: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """(keys, word, n), summed on the map side before the shuffle."""
    return (
        df.select(*keys, F.explode(tx.words(F.col(text))).alias("word"))
        .groupBy(*keys, "word")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _tokens(df: DataFrame, key: str, text: str) -> DataFrame:
    """One row per word. Joined to a broadcast table the words never leave their task."""
    return df.select(key, F.explode(tx.words(F.col(text))).alias("word"))


def lexicon_score(df: DataFrame, key: str, text: str, lexicon: DataFrame) -> DataFrame:
    """Sum of word polarities per document and its label.

    ``lexicon(word, polarity)`` is broadcast only when its measured size allows.
    """
    scored = (
        _tokens(df, key, text)
        .join(broadcast_if_small(lexicon), "word")
        .groupBy(key)
        .agg(F.sum(F.col("polarity").cast("long")).alias("score"))
    )
    label = F.when(F.col("score") > 0, "positive").when(F.col("score") < 0, "negative").otherwise("neutral")
    return df.select(key).join(scored, key, "left").fillna(0, ["score"]).withColumn("sentiment", label)


def keyword_class(df: DataFrame, key: str, text: str, keywords: DataFrame, default: str = "other") -> DataFrame:
    """Class with the most keyword hits per document; a tie goes to the first name."""
    hits = (
        _tokens(df, key, text)
        .join(broadcast_if_small(keywords), "word")
        .groupBy(key, "category")
        .agg(F.count(F.lit(1)).alias("hits"))
    )
    best = latest_by(hits, [key], [F.desc("hits"), F.asc("category")])
    return df.select(key).join(best, key, "left").fillna(default, ["category"]).fillna(0, ["hits"])


def frequent_words(spread: DataFrame, limit: int) -> tuple[int, DataFrame]:
    """A floor, and the words of ``spread(word, docs)`` above it: as many of the commonest as fit ``limit`` bytes.

    The floor is 0 when all fit, else one less than a power of two. At most one row per power reaches the driver.
    """
    power = F.floor(F.log2("docs")).cast("int").alias("power")
    sizes = spread.groupBy(power).agg(F.sum(F.octet_length("word") + 16).alias("bytes")).orderBy(F.desc("power")).collect()
    floor, used = 0, 0
    for r in sizes:
        used += r["bytes"]
        if used > limit:
            floor = 2 ** (r["power"] + 1) - 1
            break
    return floor, spread.filter(F.col("docs") > floor)


def top_sentences(
    df: DataFrame, group: str, doc_id: str, text: str, min_words: int = 5, limit: int = BROADCAST_BYTES // 4
) -> DataFrame:
    """The sentence of each group whose words occur in the most documents on average.

    Sentences of ``min_words`` different words come first; a group that has none
    is summed up by a shorter one.

    Words are looked up among the commonest, as many as fit ``limit`` bytes; a
    word that is not there stands in one to ``floor`` documents, which bounds a
    sentence's score on both sides. Only sentences that may still be the best of
    their group are scored by the counts of all their words.
    """
    spread = settle(
        df.select(doc_id, F.explode(F.array_distinct(tx.words(F.col(text)))).alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("docs")),
        "word-spread",
    )
    key = [group, doc_id, "pos"]
    sent = df.select(group, doc_id, F.posexplode(tx.sentences(F.col(text))).alias("pos", "sentence"))

    def terms(rows: DataFrame) -> DataFrame:
        return rows.select(*key, F.explode(F.array_distinct(tx.words(F.col("sentence")))).alias("word"))

    floor, frequent = frequent_words(spread, limit)
    met = terms(sent).join(F.broadcast(frequent), "word", "left").groupBy(*key)
    known = met.agg(F.coalesce(F.sum("docs"), F.lit(0)).alias("weight"), F.count(F.lit(1)).alias("n"), F.count("docs").alias("found"))
    known = known.withColumn("full", F.col("n") >= min_words)
    if floor:
        rare = F.col("n") - F.col("found")
        low, high = (F.col("weight") + rare * k for k in (1, floor))
        known = settle(known.select(*key, "full", (low / F.col("n")).alias("low"), (high / F.col("n")).alias("high")), "sentence-bounds")
        least = known.groupBy(F.col(group).alias("g")).agg(F.max(F.struct("full", "low")).alias("best"))
        mine = F.col(group).eqNullSafe(F.col("g"))
        open_ = known.join(broadcast_if_small(settle(least, "sentence-floors")), mine)
        open_ = open_.filter(F.struct("full", F.col("high").alias("low")) >= F.col("best"))
        picked = broadcast_if_small(settle(open_.select(*(F.col(c).alias(f"__{c}") for c in key)), "sentences-open"))
        same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in key]
        exact = terms(sent.join(picked, same, "left_semi")).join(spread, "word").groupBy(*key)
        known = exact.agg(F.sum("docs").alias("weight"), F.count(F.lit(1)).alias("n")).withColumn("full", F.col("n") >= min_words)
    scored = known.select(*key, "weight", "n", "full", (F.col("weight") / F.col("n")).alias("score"))
    order = [F.desc("full"), F.desc("score"), F.asc(doc_id), F.asc("pos")]
    best = settle(latest_by(scored, [group], order), "best-sentences")
    # Only the winners fetch their text; stored, they are small enough for Spark to broadcast.
    return best.join(df.select(doc_id, text), doc_id).select(
        group, doc_id, "pos", "score", F.get(tx.sentences(F.col(text)), F.col("pos")).alias("sentence")
    )


def best_sentence(question: Column, answer: Column) -> Column:
    """The answer's sentence sharing the most distinct words with the question, first on a tie."""

    def rate(asked: Column) -> Column:
        return F.transform(
            tx.sentences(answer),
            lambda s, i: F.struct(
                F.size(F.array_intersect(tx.words(s), asked)).alias("overlap"), (-i).alias("late"), s.alias("sentence")
            ),
        )

    return F.array_max(tx.bind(tx.words(question), rate))


def token_scores(df: DataFrame, key: Sequence[str], answer: str, expected: str) -> DataFrame:
    """Token precision, recall and F1 of ``answer`` against ``expected``, repeats counted."""
    a = word_counts(df, key, answer).withColumnRenamed("n", "na")
    e = word_counts(df, key, expected).withColumnRenamed("n", "ne")
    both = a.join(e, [*key, "word"], "full_outer").fillna(0, ["na", "ne"])
    hit, na, ne = F.col("hit"), F.col("na"), F.col("ne")
    return (
        both.groupBy(*key)
        .agg(
            F.sum(F.least("na", "ne")).alias("hit"), F.sum("na").alias("na"), F.sum("ne").alias("ne")
        )
        .select(
            *key,
            F.when(na > 0, hit / na).otherwise(0.0).alias("precision"),
            F.when(ne > 0, hit / ne).otherwise(0.0).alias("recall"),
            F.when(na + ne > 0, 2 * hit / (na + ne)).otherwise(0.0).alias("f1"),
        )
    )


# --- conversations ----------------------------------------------------------


def next_turn(turns: DataFrame) -> DataFrame:
    """Each user turn beside the assistant turn right after it: an equi-join, no window."""
    q = turns.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("question"))
    a = turns.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer")
    )
    return q.join(a, ["conv_id", "turn"])


def fold_conversations(turns: DataFrame, page: int = 256) -> DataFrame:
    """Turns in order as one array per conversation and page of ``page`` turns.

    Turn numbers are unique in a conversation, so no row holds more than ``page``.
    """
    paged = turns.withColumn("page", F.floor(F.col("turn") / page))
    return paged.groupBy("conv_id", "page").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("messages")
    )


# --- duplicates -------------------------------------------------------------


def exact_copies(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Kept document and number of copies per normalised text; one aggregate."""
    return df.groupBy(F.md5(F.lower(tx.clean(F.col(text)))).alias("digest")).agg(
        F.min(doc_id).alias(doc_id), F.count(F.lit(1)).alias("copies")
    )
