"""Physical layout of written tables: clustering, Z-order, compaction."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote, urlsplit

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.operators.joins import broadcast_if_small
from tidemark.operators.segmented import running_sum, search
from tidemark.session import settle


def write_clustered(df: DataFrame, path: str, by: Sequence[str], files: int) -> None:
    """Range-partition and sort by ``by`` so that row-group statistics can skip files."""
    df.repartitionByRange(files, *by).sortWithinPartitions(*by).write.mode("overwrite").parquet(path)


def write_bucketed(df: DataFrame, table: str, path: str, by: Sequence[str], buckets: int) -> None:
    """Hash-bucketed and sorted table: joins on ``by`` between equal buckets need no shuffle.

    Rows are brought to their bucket first, so a bucket is one file and not one per task.
    """
    (
        df.repartition(buckets, *by)
        .write.bucketBy(buckets, *by)
        .sortBy(*by)
        .option("path", path)
        .mode("overwrite")
        .saveAsTable(table)
    )


def z_value(columns: Sequence[Column], bits: int = 10) -> Column:
    """Interleave the low ``bits`` of the integer columns into one sort key."""
    z = F.lit(0).cast("long")
    width = len(columns)
    for b in range(bits):
        for i, c in enumerate(columns):
            bit = F.shiftright(c.cast("long"), b).bitwiseAND(F.lit(1).cast("long"))
            z = z.bitwiseOR(F.shiftleft(bit, b * width + i))
    return z


def range_ids(df: DataFrame, columns: Sequence[str], bits: int = 6) -> DataFrame:
    """Add ``__r0, __r1, ...``: the quantile range of each column, from one sketch pass."""
    n = 2**bits
    shares = [i / n for i in range(1, n)]
    cuts = df.agg(*[F.percentile_approx(c, shares, 10_000).alias(c) for c in columns]).first()
    return df.withColumns({f"__r{i}": search(F.col(c), cuts[c]) for i, c in enumerate(columns)})


def write_zordered(df: DataFrame, path: str, by: Sequence[str], files: int, bits: int = 6) -> None:
    """Order files along a Z-curve over ``by``."""
    keyed = range_ids(df, by, bits)
    z = z_value([F.col(f"__r{i}") for i in range(len(by))], bits)
    drop = [f"__r{i}" for i in range(len(by))]
    (
        keyed.withColumn("__z", z)
        .repartitionByRange(files, "__z")
        .sortWithinPartitions("__z")
        .drop("__z", *drop)
        .write.mode("overwrite")
        .parquet(path)
    )


def compact(df: DataFrame, path: str, target_bytes: int, total_bytes: int) -> int:
    """Rewrite a table into files of about ``target_bytes``; returns the number of tasks used."""
    files = max(1, -(-total_bytes // target_bytes))
    df.repartition(files).write.mode("overwrite").parquet(path)
    return files


STAGED = "_compact"


def compact_small(spark: SparkSession, path: str, target_bytes: int, small_bytes: int | None = None) -> int:
    """Merge the small files of a parquet folder in place; returns how many files were replaced.

    Files below ``small_bytes`` (half the target) are dealt into bins of about
    ``target_bytes`` in the order of their folders and names, by a running sum
    of their sizes. Only they are read, and their rows move once. Larger files,
    and a small one alone in its folder and bin, keep their names and times.
    Partition folders stay as they are written.

    New files are staged beside a list of those they replace, both written by
    executors, before the folder changes; ``finish_compaction`` then swaps
    them, and does so again after a crash. Nobody should read during the swap.
    """
    finish_compaction(spark, path)
    table, parts = _as_stored(spark, path)
    if table is None:
        return 0
    small = F.col("__bytes") < (target_bytes // 2 if small_bytes is None else small_bytes)
    # Spark leaves files out by their size before it opens them.
    rows = table.withColumns({"__file": F.col("_metadata.file_path"), "__bytes": F.col("_metadata.file_size")}).filter(small)
    found = rows.select("__file", "__bytes").distinct().withColumn("__folder", F.regexp_extract("__file", "^(.*)/", 1))
    summed = running_sum(settle(found, "small-files"), [], ["__folder", "__file"], "__bytes", "__upto")
    bins = summed.withColumn("__bin", F.floor((F.col("__upto") - F.col("__bytes")) / target_bytes).cast("int"))
    shared = bins.groupBy("__folder", "__bin").agg(F.count(F.lit(1)).alias("__files")).filter("__files > 1")
    chosen = settle(bins.join(broadcast_if_small(shared), ["__folder", "__bin"]).select("__file", "__bin"), "bins")
    files, last = chosen.agg(F.count(F.lit(1)), F.max("__bin")).first()
    if not files:
        return 0
    moved = rows.join(broadcast_if_small(chosen), "__file").repartitionById(last + 1, F.col("__bin"))
    moved.select(*table.columns).write.mode("overwrite").partitionBy(*parts).parquet(f"{path}/{STAGED}/data")
    chosen.select("__file").write.mode("overwrite").parquet(f"{path}/{STAGED}/replaced")
    finish_compaction(spark, path)
    return files


def _as_stored(spark: SparkSession, path: str) -> tuple[DataFrame | None, list[str]]:
    """The table with its partition columns as the text of their folders, and their names."""
    table = spark.read.parquet(path)
    one = table.select(F.col("_metadata.file_path")).first()
    if one is None:
        return None, []
    base = _folder(spark, path).toUri().getRawPath().rstrip("/")
    inside = urlsplit(one[0]).path[len(base) + 1 :].split("/")[:-1]
    parts = [unquote(level.split("=", 1)[0]) for level in inside]
    fields = [StructField(f.name, StringType()) if f.name in parts else f for f in table.schema.fields]
    return spark.read.schema(StructType(fields)).parquet(path), parts


def _folder(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where)


def finish_compaction(spark: SparkSession, path: str) -> None:
    """Swap staged files in. Each step can be repeated, so a swap that was cut off goes on where it stopped."""
    jvm, top = spark._jvm, _folder(spark, path)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    hadoop = jvm.org.apache.hadoop.fs
    staged = hadoop.Path(top, STAGED)
    if not fs.exists(hadoop.Path(staged, "replaced/_SUCCESS")):
        return
    for row in spark.read.parquet(f"{path}/{STAGED}/replaced").toLocalIterator():
        fs.delete(hadoop.Path(jvm.java.net.URI(row[0])), False)
    data = hadoop.Path(staged, "data")
    listed = fs.listFiles(data, True)
    while listed.hasNext():
        new = listed.next().getPath()
        if not new.getName().startswith("_"):
            inside = new.toString()[len(data.toString()) + 1 :]
            goal = hadoop.Path(f"{top.toString()}/{inside}")
            fs.mkdirs(goal.getParent())
            if not fs.rename(new, goal):
                raise OSError(f"{new} was not moved to {goal}")
    fs.delete(staged, True)
