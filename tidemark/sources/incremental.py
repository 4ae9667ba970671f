"""Loading only what has not been loaded: streams of files, copies, bookmarks."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    ByteType,
    DataType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    NullType,
    ShortType,
    StructField,
    StructType,
)

from tidemark.sources.files import read_files


def kept_schema(spark: SparkSession, location: str, path: str, fmt: str, **options) -> StructType:
    """The schema stored at ``location``; inferred from ``path`` and stored on first use."""
    stored = _stored(spark, location)
    if stored is None:
        stored = read_files(spark, path, fmt, **options).schema
        keep_schema(spark, location, stored)
    return stored


def evolved_schema(
    spark: SparkSession, location: str, path: str, fmt: str, mode: str = "add", **options
) -> StructType:
    """The stored schema brought up to date with the files at ``path``, and stored again."""
    arriving = read_files(spark, path, fmt, **options).schema
    stored = _stored(spark, location)
    schema = arriving if stored is None else evolve(stored, arriving, mode)
    if schema != stored:
        keep_schema(spark, location, schema)
    return schema


def _stored(spark: SparkSession, location: str) -> StructType | None:
    try:
        line = spark.read.text(location).first()
    except AnalysisException:
        return None
    return StructType.fromJson(json.loads(line[0])) if line else None


def keep_schema(spark: SparkSession, location: str, schema: StructType) -> None:
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(location)


class SchemaChanged(ValueError):
    """Arriving data has columns the stored schema lacks, or other types than it has."""


def wider(stored: DataType, arriving: DataType) -> DataType | None:
    """The type that holds values of both without loss of digits or range, if there is one."""
    if stored == arriving or isinstance(arriving, NullType):
        return stored
    if isinstance(stored, NullType):
        return arriving
    ranked = [ByteType, ShortType, IntegerType, LongType]
    at = [[i for i, k in enumerate(ranked) if isinstance(x, k)] for x in (stored, arriving)]
    if all(at):
        return max((stored, arriving), key=lambda x: ranked.index(type(x)))
    # A double has 53 bits: room for every number of up to 32, not for a bigint.
    floats = [isinstance(x, (FloatType, DoubleType)) for x in (stored, arriving)]
    whole = [bool(a) and a[0] < ranked.index(LongType) for a in at]
    return DoubleType() if all(f or w for f, w in zip(floats, whole)) else None


def evolve(stored: StructType, arriving: StructType, mode: str = "add") -> StructType:
    """Schema after new columns arrive: ``add`` appends them, ``ignore`` leaves them out, ``fail`` raises.

    A known column whose type changed is widened among numbers in mode ``add``
    where no digit is lost; any other change of type, bigint and double as well,
    raises in every mode.
    """
    if mode not in ("add", "fail", "ignore"):
        raise ValueError(f"unknown mode {mode!r}")
    known = {f.name for f in stored.fields}
    new = [f for f in arriving.fields if f.name not in known]
    kinds = {f.name: f.dataType for f in arriving.fields}
    kept, changed = [], []
    for f in stored.fields:
        kind = wider(f.dataType, kinds.get(f.name, f.dataType))
        if kind is None or (kind != f.dataType and mode != "add"):
            changed.append(f"{f.name} from {f.dataType.simpleString()} to {kinds[f.name].simpleString()}")
        kept.append(StructField(f.name, kind or f.dataType, f.nullable, f.metadata))
    if changed:
        raise SchemaChanged(f"changed types: {', '.join(changed)}")
    if new and mode == "fail":
        raise SchemaChanged(f"new columns: {', '.join(f.name for f in new)}")
    return StructType([*kept, *new]) if mode == "add" else stored


def append_evolving(table: DataFrame, arriving: DataFrame, mode: str = "add") -> DataFrame:
    """Union with columns matched by name; rows that lack a column get null."""
    schema = evolve(table.schema, arriving.schema, mode)
    names = [f.name for f in schema.fields]
    both = table.unionByName(
        arriving.select(*[c for c in arriving.columns if c in names]), allowMissingColumns=True
    )
    return both.select(*names)


def file_stream(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema: StructType,
    ingested_at: Column | None = None,
    max_files: int | None = None,
    **options,
) -> DataFrame:
    """Stream of files not seen before, with source file and load time."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    at = F.current_timestamp() if ingested_at is None else ingested_at
    return (
        reader.load(path)
        .withColumn("source_file", F.col("_metadata.file_path"))
        .withColumn("ingested_at", at)
    )


def copy_into(
    spark: SparkSession, source: str, target: str, ledger: str, fmt: str, schema: StructType, **options
) -> int:
    """Append the files of ``source`` that no earlier call has loaded; returns the number of rows loaded.

    The ledger is the checkpoint of a file stream that ends when all present
    files are read: Spark keeps which files were taken, and no list of them
    passes through here. Every batch fills its own ``load=N`` folder. A call
    that died between the write and its entry repeats the same files into the
    same folder, so nothing is loaded twice. Files count by their name, of any
    age and at any depth.
    """

    def load(batch: DataFrame, number: int) -> None:
        batch.drop("source_file", "ingested_at").write.mode("overwrite").parquet(f"{target}/load={number}")

    everything = {"recursiveFileLookup": "true", "maxFileAge": "36500d", **options}
    arriving = file_stream(spark, source, fmt, schema, **everything)
    run = arriving.writeStream.foreachBatch(load).option("checkpointLocation", ledger).trigger(availableNow=True).start()
    run.awaitTermination()
    return sum(p["numInputRows"] for p in run.recentProgress)


def since(df: DataFrame, column: str, bookmark: Column | None) -> DataFrame:
    """Rows past the bookmark; everything when there is none yet."""
    return df if bookmark is None else df.filter(F.col(column) > bookmark)


def next_bookmark(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.max(column).alias("bookmark"))
