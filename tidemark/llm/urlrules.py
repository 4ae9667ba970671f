"""URL filter rules matched by a sorted sweep over reversed-host keys."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.text import bind
from tidemark.llm.common import lower_ascii, ordered_blocks
from tidemark.session import inline_rows

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for null."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")))


def path_of(url: Column) -> Column:
    """From the host to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def host_key(host: Column) -> Column:
    """Labels in reverse, each closed by a dot: a host's subdomains are the keys that start with its own."""
    return F.when(host == "", "").otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


def prefixes(key: Column) -> Column:
    """The keys of a host and of all its parents, the empty one too."""
    labels = F.split(key, r"\.")
    return bind(
        labels,
        lambda x: F.transform(
            F.sequence(F.lit(0), F.size(x) - 1),
            lambda n: F.when(n == 0, "").otherwise(F.concat(F.array_join(F.slice(x, F.lit(1), n), "."), F.lit("."))),
        ),
    )


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """``host, path, verdict`` from a list of settings."""
    return inline_rows(spark, rules, "host string, path string, verdict string")


def judged(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict``.

    A rule ``(host, path, verdict)`` fits its host and all subdomains if the
    URL's path starts with the rule's. The longest rule wins, of equally long
    ones that with the longer host; for the same host and path named twice the
    first verdict in order. Without a fitting rule ``rule`` is null and the verdict
    ``default``. A null URL, or one without ``://``, has an empty host and path.
    Rules with a null are ignored; without rules, or for an empty host, the
    default holds. Repeated pages are judged alike.

    As keys, a rule is the interval of all keys that start with its own, and
    intervals nest. Pages and rules are sorted together by key; a sweep keeps the
    stack of intervals it is in. Pages are dealt by ranges of (key, page), so one
    host may fill many ranges; the intervals open at the start of a range are the
    rules found under the prefixes of its first key.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    asked = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    given = rules.select(lower_ascii(F.col("host")).alias("host"), "path", "verdict").dropna()
    given = given.groupBy("host", "path").agg(F.min("verdict").alias("verdict"))
    no_text, no_id = F.lit(None).cast("string"), F.lit(None).cast("long")
    rows = asked.select(host_key(F.col("host")).alias("key"), F.lit(1).alias("kind"), "page_id", "host", "path", no_text.alias("verdict"))
    marks = given.select(host_key(F.col("host")).alias("key"), F.lit(0).alias("kind"), no_id.alias("page_id"), "host", "path", "verdict")
    blocks = ordered_blocks(rows.unionByName(marks), ["key", "kind", "page_id", "path"], "url-blocks")
    firsts = blocks.groupBy("block").agg(F.min("key").alias("first"))
    opening = firsts.select("block", F.explode(prefixes(F.col("first"))).alias("key"))
    opened = marks.join(opening.filter("block > 0"), "key")
    dealt = blocks.unionByName(opened).repartition("block").sortWithinPartitions("block", "key", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: int | None = None
        # Key, host, path to verdict, and the lengths of these paths from the shortest.
        stack: list[tuple[str, str, dict[str, str], list[int]]] = []

        def verdict(path: str) -> tuple[str | None, str]:
            best: tuple[int, int, str, str] | None = None
            for _, own, paths, lengths in stack:
                for n in reversed(lengths[: bisect_right(lengths, len(path))]):
                    found = paths.get(path[:n])
                    if found is not None:
                        best = max(best or (-1, -1, "", ""), (len(own) + n, len(own), own + path[:n], found))
                        break
            return (best[2], best[3]) if best else (None, default)

        for batch in batches:
            out: list[tuple] = []
            for b, key, kind, page_id, host, path, mark in zip(*(c.to_pylist() for c in batch.columns)):
                if b != block:
                    block, stack = b, []
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if kind == 0:
                    if not stack or stack[-1][0] != key:
                        stack.append((key, host, {}, []))
                    _, _, paths, lengths = stack[-1]
                    paths[path] = mark
                    at = bisect_left(lengths, len(path))
                    if at == len(lengths) or lengths[at] != len(path):
                        lengths.insert(at, len(path))
                else:
                    out.append((page_id, host, path, *(verdict(path) if host else (None, default))))
            names, kinds = ("page_id", "host", "path", "rule", "verdict"), (pa.int64(), *[pa.string()] * 4)
            columns = zip(*out) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    columns = dealt.select("block", "key", "kind", "page_id", "host", "path", "verdict")
    return columns.mapInArrow(run, "page_id bigint, host string, path string, rule string, verdict string")
