import pytest
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tidemark.session import folder
from tidemark.streaming import jobs

SCHEMA = "k long, ts timestamp, v long"


@pytest.fixture()
def land(spark):
    path = folder(spark, "land")

    def add(rows, files=1):
        df = spark.createDataFrame([(k, s, v) for k, s, v in rows], "k long, ts string, v long")
        df.withColumn("ts", F.to_timestamp("ts")).repartition(files).write.mode("append").parquet(path)

    add.path = path
    return add


def at(minute, hour=0):
    return f"2024-01-01 {hour:02d}:{minute:02d}:00"


def stream(spark, path, n=None):
    reader = spark.readStream.schema(SCHEMA)
    return (reader.option("maxFilesPerTrigger", n) if n else reader).parquet(path)


def test_restart_loads_only_new_files(spark, land, rows):
    out, cp = folder(spark, "out"), folder(spark, "cp")
    land([(1, at(0), 1), (2, at(1), 2)])
    for _ in range(2):
        jobs.run_append(stream(spark, land.path), out, cp)
    land([(3, at(2), 3)])
    jobs.run_append(stream(spark, land.path), out, cp, once=True)
    assert rows(spark.read.parquet(out), "k") == [(1,), (2,), (3,)]


def test_batch_size_is_limited(spark, land):
    land([(i, at(i), i) for i in range(12)], files=6)
    seen = []
    jobs.run_batches(stream(spark, land.path, 2), lambda b, i: seen.append(i), folder(spark, "cp"))
    assert len(seen) == 3


def test_append_holds_back_open_windows(spark, land, rows):
    land([(1, at(5), 1), (1, at(15), 1), (1, at(0, 2), 1)])
    df = jobs.timed(stream(spark, land.path), "ts", "30 minutes")
    agg = jobs.windowed(df, "ts", "1 hour", [], [F.count(F.lit(1)).alias("n")])
    out = folder(spark, "out")
    jobs.run_append(agg, out, folder(spark, "cp"))
    assert rows(spark.read.parquet(out), "n") == [(2,)]


@pytest.mark.parametrize("mode,expect", [("update", [(1, 3), (2, 1)]), ("complete", [(1, 3), (2, 1)])])
def test_output_modes(spark, land, mode, expect):
    land([(1, at(0), 1), (2, at(1), 1)])
    cp, batches = folder(spark, "cp"), []
    keep = lambda b, i: batches.append(sorted(tuple(r) for r in b.collect()))

    def run():
        jobs.run_batches(stream(spark, land.path).groupBy("k").agg(F.count(F.lit(1)).alias("n")), keep, cp, mode)

    run()
    land([(1, at(2), 1), (1, at(3), 1)])
    run()
    merged = dict(x for b in batches for x in b)
    assert sorted(merged.items()) == expect
    last = [b for b in batches if b][-1]
    assert last == (expect if mode == "complete" else [(1, 3)])


def test_late_rows_are_dropped_after_the_watermark(spark, land, rows):
    out, cp = folder(spark, "out"), folder(spark, "cp")
    agg = lambda: jobs.windowed(
        jobs.timed(stream(spark, land.path), "ts", "10 minutes"), "ts", "1 hour", [], [F.count(F.lit(1)).alias("n")]
    )
    land([(1, at(5), 1), (1, at(0, 3), 1)])
    jobs.run_append(agg(), out, cp)
    land([(1, at(6), 1), (1, at(0, 6), 1)])
    jobs.run_append(agg(), out, cp)
    got = rows(spark.read.parquet(out).withColumn("h", F.hour("window_start")), "h", "n")
    assert got == [(0, 1), (3, 1)]


def test_upsert_log_survives_a_replayed_batch(spark, rows):
    schema = spark.createDataFrame([(1, 1)], "k long, v long").schema
    log = jobs.UpsertLog(spark, folder(spark, "log"), schema, ["k"])
    one = spark.createDataFrame([(1, 10), (2, 20)], "k long, v long")
    two = spark.createDataFrame([(2, 21), (2, 22), (3, 30)], "k long, v long")
    log.upsert(one, 0)
    for _ in range(2):
        log.upsert(two, 1, [F.desc("v")])
    assert rows(log.current()) == [(1, 10), (2, 22), (3, 30)]
    short = log.compact(folder(spark, "log"))
    short.upsert(spark.createDataFrame([(1, 11)], "k long, v long"), 2)
    assert rows(short.current()) == [(1, 11), (2, 22), (3, 30)]


def test_fan_out_feeds_every_sink_once(spark, land, rows):
    a, b = folder(spark, "a"), folder(spark, "b")
    land([(1, at(0), 1), (2, at(1), 2)])
    handle = jobs.fan_out(
        [
            lambda df, i: df.write.mode("overwrite").parquet(f"{a}/batch={i}"),
            lambda df, i: df.filter("v > 1").write.mode("overwrite").parquet(f"{b}/batch={i}"),
        ]
    )
    jobs.run_batches(stream(spark, land.path), handle, folder(spark, "cp"))
    assert rows(spark.read.parquet(a), "k") == [(1,), (2,)] and rows(spark.read.parquet(b), "k") == [(2,)]


def test_within_matches_each_pair_once(spark, rows):
    ts = lambda s: F.to_timestamp(F.lit(s))
    left = spark.range(1).select(F.lit(1).alias("k"), ts(at(10)).alias("shown"))
    clicks = [at(10), at(39), at(40), at(41), at(9)]
    right = spark.createDataFrame([(1, c) for c in clicks], "u long, s string").select("u", F.to_timestamp("s").alias("clicked"))
    got = jobs.within(left, right, [("k", "u")], "shown", "clicked", 1800)
    assert rows(got.select(F.minute("clicked"))) == [(10,), (39,), (40,)]


def test_rate_source(spark):
    src = spark.readStream.format("rate").options(rowsPerSecond=50, numPartitions=2).load()
    out, cp = folder(spark, "out"), folder(spark, "cp")
    q = src.select("timestamp", (F.col("value") % 5).alias("category")).writeStream.format("parquet")
    q = q.option("path", out).option("checkpointLocation", cp).trigger(processingTime="1 second").start()
    try:
        for _ in range(100):
            if sum(r[1] for r in jobs.progress_rows(q)) > 0:
                break
            q.awaitTermination(0.2)
    finally:
        q.stop()
    assert spark.read.parquet(out).count() > 0


def test_progress_reaches_a_listener(spark, land):
    seen = []

    class Listener(StreamingQueryListener):
        def onQueryStarted(self, event):
            pass

        def onQueryProgress(self, event):
            seen.append(event.progress.numInputRows)

        def onQueryTerminated(self, event):
            pass

    listener = Listener()
    spark.streams.addListener(listener)
    try:
        land([(1, at(0), 1), (2, at(1), 2)])
        q = jobs.run_append(stream(spark, land.path), folder(spark, "out"), folder(spark, "cp"))
        assert sum(r[1] for r in jobs.progress_rows(q)) == 2
        for _ in range(50):
            if sum(seen) >= 2:
                break
            spark.range(1).count()
    finally:
        spark.streams.removeListener(listener)
    assert sum(seen) >= 2


def test_upsert_log_rejects_a_key_twice_in_a_batch(spark):
    rows = spark.createDataFrame([(1, 5), (1, 6)], "k long, v long")
    log = jobs.UpsertLog(spark, folder(spark, "log"), rows.schema, ["k"])
    with pytest.raises(Exception, match="key twice in one batch"):
        log.upsert(rows, 0)
    log.upsert(rows, 1, [F.desc("v")])
    assert [tuple(r) for r in log.current().collect()] == [(1, 6)]
