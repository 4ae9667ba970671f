"""Structured Streaming building blocks; every one takes any streaming frame."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.operators.joins import latest_by


def table_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A stored table as a stream, one file or a folder of files."""
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    # The pattern matches the path itself, so a single file is accepted too.
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def timed(df: DataFrame, column: str, delay: str) -> DataFrame:
    """Event time with a watermark; times without a zone become instants first."""
    return df.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, delay)


def run_append(df: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = (), once: bool = False) -> StreamingQuery:
    """Write what is available as parquet and stop; a second run continues from the checkpoint."""
    writer = df.writeStream.format("parquet").outputMode("append").option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    trigger = {"once": True} if once else {"availableNow": True}
    q = writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
    q.awaitTermination()
    return q


def closing_beat(rows: DataFrame, time: str, path: str, after: str = "400 days") -> DataFrame:
    """A stream of one row, null but for a time ``after`` the newest of ``rows``.

    Put together with the stream of ``rows`` it moves the watermark past every
    window they opened, so append mode writes them all; its own window stays open.
    """
    newest = rows.agg((F.max(time) + F.expr(f"INTERVAL {after}")).alias(time))
    beat = newest.select(*[F.col(f.name) if f.name == time else F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields])
    beat.write.parquet(path)
    return rows.sparkSession.readStream.schema(rows.schema).parquet(path)


def run_batches(
    df: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> StreamingQuery:
    """Hand each micro-batch to ``handle(batch, batch_id)``; it may see a batch id twice."""
    q = (
        df.writeStream.foreachBatch(handle)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return q


class UpsertLog:
    """Keyed upsert target of a stream.

    A micro-batch writes only its own rows, to the folder of its batch id, and a
    replayed batch overwrites that folder: exactly-once without rewriting the
    table. Readers take the newest row per key; ``compact`` starts a new log
    with one row per key when the old one gets long.
    """

    def __init__(self, spark: SparkSession, root: str, schema: StructType, keys: Sequence[str]):
        self.spark, self.root, self.schema, self.keys = spark, root, schema, list(keys)

    def upsert(self, batch: DataFrame, batch_id: int, newest: Sequence[Column] | None = None) -> None:
        """Write the batch. Without ``newest`` a key that comes twice in it fails the batch, as in a merge."""
        if newest is None:
            again = F.count(F.lit(1)).over(W.partitionBy(*self.keys))
            twice = F.concat(F.lit("key twice in one batch: "), F.to_json(F.struct(*self.keys)))
            rows = batch.withColumn("__n", again)
            rows = rows.filter(F.when(F.col("__n") > 1, F.raise_error(twice).cast("boolean")).otherwise(True))
        else:
            rows = latest_by(batch, self.keys, newest)
        rows.select(*self.schema.names).write.mode("overwrite").parquet(f"{self.root}/batch_id={batch_id}")

    def current(self) -> DataFrame:
        full = StructType([*self.schema.fields, *StructType.fromDDL("batch_id long").fields])
        log = self.spark.read.schema(full).option("basePath", self.root).parquet(self.root)
        return latest_by(log, self.keys, [F.desc("batch_id")]).drop("batch_id")

    def compact(self, root: str) -> "UpsertLog":
        """The same rows in a new folder, below every batch id still to come."""
        self.current().write.mode("overwrite").parquet(f"{root}/batch_id=-1")
        return UpsertLog(self.spark, root, self.schema, self.keys)


def windowed(
    df: DataFrame, time: str, length: str, by: Sequence[str], aggs: Sequence[Column], slide: str | None = None
) -> DataFrame:
    """Tumbling or sliding aggregates with flat window bounds."""
    w = F.window(time, length, slide) if slide else F.window(time, length)
    return _flat(df.groupBy(w.alias("w"), *by).agg(*aggs), by)


def sessions(df: DataFrame, time: str, gap: str, by: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """Aggregates per session; rows are merged on the map side before the shuffle."""
    df.sparkSession.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    return _flat(df.groupBy(F.session_window(time, gap).alias("w"), *by).agg(*aggs), by)


def _flat(df: DataFrame, by: Sequence[str]) -> DataFrame:
    bounds = [
        F.col("w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("w.end").cast("timestamp_ntz").alias("window_end"),
    ]
    return df.select(*bounds, *[c for c in df.columns if c != "w"])


def within(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[tuple[str, str]],
    left_time: str,
    right_time: str,
    seconds: int,
) -> DataFrame:
    """Inner join where ``left_time <= right_time <= left_time + seconds``; batch or stream.

    The time bucket is part of the join key, so a hot key is spread over its
    buckets. A right row looks into its own and the previous bucket; a left row
    is in one, so no pair is found twice.
    """
    bucket = F.floor(F.unix_timestamp(left_time) / seconds)
    seen = F.floor(F.unix_timestamp(right_time) / seconds)
    l = left.withColumn("__lb", bucket)
    r = right.withColumn("__rb", F.explode(F.array(seen - 1, seen)))
    cond = F.col("__lb") == F.col("__rb")
    for a, b in keys:
        cond = cond & (F.col(a) == F.col(b))
    cond = cond & (F.col(right_time) >= F.col(left_time))
    cond = cond & (F.col(right_time) <= F.col(left_time) + F.expr(f"INTERVAL {seconds} SECONDS"))
    return l.join(r, cond, "inner").drop("__lb", "__rb")


def progress_rows(query: StreamingQuery) -> list[tuple]:
    """(batch, input rows, input rate, processed rate) of the last batches."""
    return [
        (p["batchId"], p["numInputRows"], p["inputRowsPerSecond"], p["processedRowsPerSecond"])
        for p in query.recentProgress
    ]


def fan_out(sinks: Sequence[Callable[[DataFrame, int], None]]) -> Callable[[DataFrame, int], None]:
    """One micro-batch to several sinks, computed once."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for sink in sinks:
                sink(batch, batch_id)
        finally:
            batch.unpersist()

    return handle
