"""File formats, sizes and shared views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

FORMATS = ("parquet", "orc", "json", "csv", "xml", "avro")


def write_files(df: DataFrame, path: str, fmt: str, mode: str = "errorifexists", **options) -> None:
    _known(fmt)
    writer = df.write.format(fmt).mode(mode).options(**options)
    _with_avro_hint(fmt, lambda: writer.save(path))


def read_files(
    spark: SparkSession, path: str | Sequence[str], fmt: str, schema: StructType | None = None, **options
) -> DataFrame:
    """Read one format; without ``schema`` the format's own or an inferred one is used."""
    _known(fmt)
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return _with_avro_hint(fmt, lambda: reader.load(path if isinstance(path, str) else list(path)))


def _known(fmt: str) -> None:
    if fmt not in FORMATS:
        raise ValueError(f"format {fmt!r} is not one of {', '.join(FORMATS)}")


def _with_avro_hint(fmt: str, act):
    try:
        return act()
    except AnalysisException as e:
        if fmt == "avro" and "avro" in str(e).lower():
            raise RuntimeError("Avro needs the spark-avro package on the cluster's class path") from e
        raise


def stored_bytes(df: DataFrame) -> DataFrame:
    """Files and bytes behind a file-based frame, counted where the files are read."""
    files = df.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")
    ).distinct()
    return files.agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"))


def shared_view(spark: SparkSession, share: dict) -> DataFrame:
    """Read a shared table: ``path``, optional ``columns`` and ``filter`` as granted."""
    df = spark.read.parquet(share["path"])
    if share.get("filter"):
        df = df.filter(share["filter"])
    return df.select(*share["columns"]) if share.get("columns") else df


def jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    lower: str,
    upper: str,
    partitions: int,
    **options,
) -> DataFrame:
    """Parallel database read, one range of ``column`` per task."""
    return (
        spark.read.format("jdbc")
        .options(
            url=url,
            dbtable=table,
            partitionColumn=column,
            lowerBound=lower,
            upperBound=upper,
            numPartitions=partitions,
            **options,
        )
        .load()
    )


def generated_events(spark: SparkSession, n: int) -> DataFrame:
    """``n`` sample events from arithmetic on the row number."""
    kinds = F.array(*[F.lit(k) for k in ("click", "view", "purchase", "signup")])
    return spark.range(n).select(
        F.col("id").alias("event_id"),
        (F.col("id") % 100).alias("user_id"),
        F.get(kinds, (F.col("id") % 4).cast("int")).alias("event_type"),
        ((F.col("id") * 37 % 10_000) / 100).alias("value"),
        F.date_add(F.lit("2025-01-01").cast("date"), (F.col("id") % 90).cast("int")).alias("event_date"),
    )
