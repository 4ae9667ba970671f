"""Streaming queries, run to completion; each equals a batch statement."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.quality import Expectation, enforce
from tidemark.plans.changes import MERGED, arriving, stored
from tidemark.plans.inputs import msum
from tidemark.plans.registry import query
from tidemark.sources.incremental import file_stream
from tidemark.streaming import jobs


def event_stream(t, delay="1 hour", closed=False):
    """Events with a watermark; ``closed`` adds a late beat, so that every window of theirs is written."""
    raw = jobs.table_stream(t.spark, t.path("events"))
    if closed:
        raw = raw.unionByName(jobs.closing_beat(t.events, "ts", t.folder("beat")))
    return jobs.timed(raw, "ts", delay)


def _aggs():
    return [
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total"),
    ]


def _finished(t, df, label):
    out = t.folder(label)
    jobs.run_append(df, out, t.folder("checkpoint"))
    return t.spark.read.parquet(out)


HOURLY = f"""SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR
  AS window_end, event_type, count(*) AS n, {msum('value')} AS total FROM events GROUP BY 1, 2, 3"""
CLOSED = "window_end <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)"


@query("stream_tumbling", HOURLY)
def stream_tumbling(t):
    """Update mode: every changed window goes to the upsert log, open ones included."""
    agg = jobs.windowed(event_stream(t), "ts", "1 hour", ["event_type"], _aggs())
    log = jobs.UpsertLog(t.spark, t.folder("tumbling"), agg.schema, ["window_start", "event_type"])
    jobs.run_batches(agg, log.upsert, t.folder("checkpoint"), "update")
    return log.current()


@query("stream_append_finalised", f"SELECT * FROM ({HOURLY}) WHERE {CLOSED}")
def stream_append_finalised(t):
    """Append mode: a window is written once, after the watermark has passed its end."""
    agg = jobs.windowed(event_stream(t), "ts", "1 hour", ["event_type"], _aggs())
    return _finished(t, agg, "tumbling")


@query(
    "stream_sliding",
    f"""SELECT s AS window_start, s + INTERVAL 1 HOUR AS window_end, event_type, count(*) AS n, {msum('value')} AS total
      FROM (SELECT *, unnest([time_bucket(INTERVAL 30 MINUTE, ts), time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE]) AS s
            FROM events) GROUP BY 1, 2, 3""",
)
def stream_sliding(t):
    agg = jobs.windowed(event_stream(t, closed=True), "ts", "1 hour", ["event_type"], _aggs(), slide="30 minutes")
    return _finished(t, agg, "sliding")


@query(
    "stream_session",
    f"""SELECT min(ts) AS window_start, max(ts) + INTERVAL 30 MINUTE AS window_end, user_id, count(*) AS n, {msum('value')} AS total
      FROM (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS sid FROM (
        SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh
        FROM events)) GROUP BY user_id, sid""",
)
def stream_session(t):
    return _finished(t, jobs.sessions(event_stream(t, closed=True), "ts", "30 minutes", ["user_id"], _aggs()), "sessions")


@query("stream_dedup", "SELECT event_id, event_type, user_id FROM events")
def stream_dedup(t):
    """Late copies of purchases arrive as well; each event comes out once."""
    raw = jobs.table_stream(t.spark, t.path("events"))
    late = jobs.table_stream(t.spark, t.path("events")).filter("event_type = 'purchase'")
    late = late.withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 MINUTE"))
    both = jobs.timed(raw.unionByName(late), "ts", "2 hours")
    once = both.dropDuplicatesWithinWatermark(["event_id"])
    return _finished(t, once.select("event_id", "event_type", "user_id"), "dedup")


@query(
    "stream_static_join",
    """SELECT event_id, user_id, c_mktsegment AS segment FROM events LEFT JOIN customer ON user_id = c_custkey""",
)
def stream_static_join(t):
    raw = jobs.table_stream(t.spark, t.path("events")).select("event_id", "user_id")
    joined = raw.join(t.customer, F.col("user_id") == F.col("c_custkey"), "left")
    return _finished(t, joined.select("event_id", "user_id", F.col("c_mktsegment").alias("segment")), "enriched")


@query(
    "stream_stream_join",
    """SELECT v.event_id AS impression_id, c.event_id AS click_id, v.user_id, v.ts AS impression_time, c.ts AS click_time
    FROM events v JOIN events c ON v.user_id = c.user_id AND c.ts BETWEEN v.ts AND v.ts + INTERVAL 1800 SECOND
    WHERE v.event_type = 'view' AND c.event_type = 'click'""",
)
def stream_stream_join(t):
    shown = event_stream(t).filter("event_type = 'view'").select(
        F.col("event_id").alias("impression_id"), "user_id", F.col("ts").alias("impression_time")
    )
    clicked = event_stream(t).filter("event_type = 'click'").select(
        F.col("event_id").alias("click_id"), F.col("user_id").alias("click_user"), F.col("ts").alias("click_time")
    )
    pairs = jobs.within(shown, clicked, [("user_id", "click_user")], "impression_time", "click_time", 1800)
    out = pairs.drop("click_user").withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("impression_time", "click_time")}
    )
    return _finished(t, out, "matched")


@query("stream_foreachbatch_merge", MERGED)
def stream_foreachbatch_merge(t):
    """Two arrivals, each merged into the target by key as a micro-batch."""
    landing, checkpoint = t.folder("landing"), t.folder("checkpoint")
    log = jobs.UpsertLog(t.spark, t.folder("merged"), stored(t).schema, ["event_id"])
    for part in (stored(t), arriving(t)):
        part.write.mode("append").parquet(landing)
        stream = t.spark.readStream.schema(log.schema).parquet(landing)
        jobs.run_batches(stream, log.upsert, checkpoint)
    return log.current()


@query(
    "stream_approx_users",
    """SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end,
      count(*) AS n, count(DISTINCT user_id) AS exact_users, TRUE AS within_bound FROM events GROUP BY 1, 2""",
)
def stream_approx_users(t):
    """Distinct users per day from a stream, where exact distinct is not allowed, beside the exact number of a batch."""
    users = [F.approx_count_distinct("user_id", 0.01).alias("users"), F.count(F.lit(1)).alias("n")]
    found = _finished(t, jobs.windowed(event_stream(t, closed=True), "ts", "1 day", [], users), "users")
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    exact = t.events.groupBy(day.alias("window_start")).agg(F.count_distinct("user_id").alias("exact_users"))
    off = F.abs(F.col("users") - F.col("exact_users"))
    return found.join(exact, "window_start").select(
        "window_start", "window_end", "n", "exact_users", (off <= F.ceil(0.05 * F.col("exact_users"))).alias("within_bound")
    )


@query(
    "stream_medallion",
    f"""SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end,
      event_type, count(*) AS n, {msum('value')} AS total FROM events WHERE value >= 5 GROUP BY 1, 2, 3""",
)
def stream_medallion(t):
    """Three chained streams: raw copy, valid rows, daily metrics of every day."""
    bronze, silver = t.folder("bronze"), t.folder("silver")
    raw = jobs.table_stream(t.spark, t.path("events"))
    jobs.run_append(raw, bronze, t.folder("checkpoint"))
    valid = enforce(
        t.spark.readStream.schema(raw.schema).parquet(bronze), [Expectation("large_enough", "value >= 5", "drop")]
    )
    jobs.run_append(valid, silver, t.folder("checkpoint"))
    beat = jobs.closing_beat(t.spark.read.schema(valid.schema).parquet(silver), "ts", t.folder("beat"))
    clean = jobs.timed(t.spark.readStream.schema(valid.schema).parquet(silver).unionByName(beat), "ts", "1 hour")
    return _finished(t, jobs.windowed(clean, "ts", "1 day", ["event_type"], _aggs()), "gold")


@query(
    "stream_output_modes",
    """SELECT mode, time_bucket(INTERVAL 1 DAY, ts) AS window_start, event_type, count(*) AS n
      FROM events, (VALUES ('append'), ('update'), ('complete')) m(mode) GROUP BY 1, 2, 3""",
)
def stream_output_modes(t):
    """The same daily counts in each output mode: final windows once, changed windows, the whole result."""

    def daily():
        return jobs.windowed(event_stream(t, closed=True), "ts", "1 day", ["event_type"], [F.count(F.lit(1)).alias("n")])

    appended, whole = t.folder("appended"), t.folder("complete")
    jobs.run_append(daily(), appended, t.folder("checkpoint"))
    log = jobs.UpsertLog(t.spark, t.folder("updated"), daily().schema, ["window_start", "event_type"])
    jobs.run_batches(daily(), log.upsert, t.folder("checkpoint"), "update")
    # The last batch holds the whole result, so each replaces the one before.
    jobs.run_batches(daily(), lambda df, i: df.write.mode("overwrite").parquet(whole), t.folder("checkpoint"), "complete")
    out = None
    for mode, found in (("append", t.spark.read.parquet(appended)), ("update", log.current()), ("complete", t.spark.read.parquet(whole))):
        part = found.filter("event_type is not null").select(F.lit(mode).alias("mode"), "window_start", "event_type", "n")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "stream_fan_out",
    """SELECT 'all' AS sink, event_type, count(*) AS n, CAST(4 AS BIGINT) AS batches FROM events GROUP BY event_type
      UNION ALL SELECT 'large', event_type, count(*), 4 FROM events WHERE value >= 50 GROUP BY event_type""",
)
def stream_fan_out(t):
    """Four landed files, one per micro-batch by the cap on files; each batch is worked out once and feeds two sinks."""
    landing, every, large = (t.folder(x) for x in ("landing", "all", "large"))
    t.events.repartition(4, "event_id").write.parquet(landing)
    stream = file_stream(t.spark, landing, "parquet", t.events.schema, max_files=1)
    sinks = [
        lambda df, i: df.write.mode("overwrite").parquet(f"{every}/batch={i}"),
        lambda df, i: df.filter("value >= 50").write.mode("overwrite").parquet(f"{large}/batch={i}"),
    ]
    jobs.run_batches(stream, jobs.fan_out(sinks), t.folder("checkpoint"))
    batches = t.spark.read.parquet(every).agg(F.count_distinct("batch")).scalar()
    out = None
    for sink, path in (("all", every), ("large", large)):
        counted = t.spark.read.parquet(path).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
        part = counted.select(F.lit(sink).alias("sink"), "event_type", "n", batches.alias("batches"))
        out = part if out is None else out.unionByName(part)
    return out
