"""Table changes as functions from frames to frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from tidemark.operators import segmented
from tidemark.operators.joins import BROADCAST_BYTES, latest_by, measured_bytes
from tidemark.session import settle


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    newest: Sequence[Column] | None = None,
) -> DataFrame:
    """Rows of ``source`` replace those of ``target`` with the same key; others are added.

    A key that occurs twice in the source is an error unless ``newest`` says
    which row wins. The error is raised inside the plan, where the rows are. A
    null key equals no other: such rows of the target stay, those of the source
    are added. The source is worked out once and stored. When that fits a
    broadcast, the target is not moved; else both sides go through one exchange
    on the keys, which finds replaced rows and clashes in one window.
    """
    if newest is not None:
        source = latest_by(source, keys, newest)
    source = settle(source.select(*target.columns), "upsert-source")
    clash = F.raise_error(F.concat(F.lit("source key occurs twice: "), F.to_json(F.struct(*keys))))
    once = lambda n: F.when(n > 1, clash.cast("boolean")).otherwise(F.lit(True))
    if measured_bytes(source) <= BROADCAST_BYTES:
        checked = source.withColumn("__n", F.count(F.lit(1)).over(W.partitionBy(*keys))).filter(once(F.col("__n")))
        kept = target.join(F.broadcast(source.select(*keys)), list(keys), "left_anti").select(*target.columns)
        return kept.unionByName(checked.drop("__n"))
    both = target.withColumn("__new", F.lit(0)).unionByName(source.withColumn("__new", F.lit(1)))
    null_key = F.greatest(*[F.col(k).isNull().cast("int") for k in (keys[0], *keys)]) == 1
    arriving = F.sum("__new").over(W.partitionBy(*keys))
    seen = both.withColumn("__arriving", arriving)
    stays = F.when(F.col("__new") == 1, once(F.col("__arriving"))).otherwise((F.col("__arriving") == 0) | null_key)
    return seen.filter(stays).select(*target.columns)


def upsert_partitions(
    spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], partition: str
) -> None:
    """Upsert into a table partitioned by a column that a key never changes.

    Only the partitions named by the source are read, joined and rewritten; the
    rest of the table stays as it is. The new
    partitions are staged first, so a failed overwrite is repeated from there.
    """
    touched = [r[0] for r in source.select(partition).distinct().collect()]
    table = spark.read.parquet(path)
    staged = settle(merge_upsert(table.filter(F.col(partition).isin(touched)), source, keys), "upsert")
    (
        staged.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def update_where(df: DataFrame, pred: Column, changes: dict[str, Column]) -> DataFrame:
    """Set columns where ``pred`` is true; a null predicate leaves the row alone."""
    hit = F.coalesce(pred, F.lit(False))
    return df.select(
        *[
            F.when(hit, changes[c]).otherwise(F.col(c)).alias(c) if c in changes else F.col(c)
            for c in df.columns
        ]
    )


def delete_where(df: DataFrame, pred: Column) -> DataFrame:
    """Drop rows where ``pred`` is true; a null predicate keeps the row."""
    return df.filter(~F.coalesce(pred, F.lit(False)))


def scd2(
    versions: DataFrame,
    keys: Sequence[str],
    effective_from: str,
    tracked: Sequence[str],
    skip_unchanged: bool = False,
    segment=segmented.AUTO,
) -> DataFrame:
    """Validity chain per key: ``[effective_from, effective_to)`` and ``is_current``.

    ``versions`` holds the open and the arriving rows, one per key and start.
    With ``skip_unchanged`` a row equal to its predecessor opens no version.
    """
    order = [effective_from]
    if segment is segmented.AUTO:
        segment = segmented.plan(versions, keys, order)
    chain = versions
    if skip_unchanged:
        mark = "__mark"
        chain = chain.withColumn(mark, F.md5(F.to_json(F.struct(*tracked))))
        chain = segmented.neighbour(chain, keys, order, mark, "__before", segment)
        changed = F.col("__before").isNull() | (F.col("__before") != F.col(mark))
        chain = chain.filter(changed).drop(mark, "__before")
    chain = segmented.neighbour(chain, keys, order, effective_from, "effective_to", segment, following=True)
    return chain.withColumn("is_current", F.col("effective_to").isNull())


def change_feed(before: DataFrame, after: DataFrame, keys: Sequence[str], version: int) -> DataFrame:
    """Row changes between two versions of a table.

    Types: ``insert``, ``delete``, ``update_preimage``, ``update_postimage``.
    Comparison is null-safe; unchanged rows give nothing.
    """
    cols = [c for c in after.columns if c not in keys]
    b = before.select(*keys, F.struct(*cols).alias("__old"))
    a = after.select(*keys, F.struct(*cols).alias("__new"))
    both = b.join(a, list(keys), "full_outer").filter(~F.col("__old").eqNullSafe(F.col("__new")))

    def change(kind: str, image: str) -> Column:
        return F.struct(F.lit(kind).alias("_change_type"), F.col(image).alias("__row"))

    changes = (
        F.when(F.col("__old").isNull(), F.array(change("insert", "__new")))
        .when(F.col("__new").isNull(), F.array(change("delete", "__old")))
        .otherwise(
            F.array(change("update_preimage", "__old"), change("update_postimage", "__new"))
        )
    )
    return (
        both.select(*keys, F.explode(changes).alias("__c"))
        .select(*keys, "__c._change_type", "__c.__row.*")
        .withColumn("_commit_version", F.lit(version).cast("long"))
    )


def apply_changes(target: DataFrame, feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bring ``target`` up to date with a change feed of any number of versions."""
    effect = feed.filter(F.col("_change_type") != "update_preimage")
    # A key deleted and inserted in one version ends with the insert.
    late = F.when(F.col("_change_type") == "delete", 0).otherwise(1)
    last = latest_by(effect, keys, [F.desc("_commit_version"), late.desc()])
    kept = target.join(last.select(*keys), list(keys), "left_anti")
    alive = last.filter(F.col("_change_type") != "delete").select(*target.columns)
    return kept.unionByName(alive)


def reconcile(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts of a copy against its original: rows, missing, extra, different.

    The hash takes a mark for each null besides the values, since it would skip a null.
    """

    def digest(df: DataFrame, name: str) -> DataFrame:
        values = [x for c in a.columns for x in (F.col(c).isNull(), F.col(c))]
        return df.select(*keys, F.xxhash64(*values).alias(name))

    both = digest(a, "__a").join(digest(b, "__b"), list(keys), "full_outer")
    return both.agg(
        F.count("__a").alias("rows_a"),
        F.count("__b").alias("rows_b"),
        F.count_if(F.col("__b").isNull()).alias("missing"),
        F.count_if(F.col("__a").isNull()).alias("extra"),
        F.count_if(F.col("__a") != F.col("__b")).alias("different"),
    )
