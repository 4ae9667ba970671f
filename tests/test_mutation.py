import pytest
from pyspark.sql import functions as F

from tidemark.operators import history as hi, mutation as mu
from tidemark.session import folder

COLS = "customer_id long, name string, tier string, total_spend double"
START = [(1, "Alice", "Silver", 100.0), (2, "Bob", "Gold", 250.0), (3, "Cara", "Bronze", 30.0), (5, "Eve", None, None)]
CHANGES = [(1, "Alice", "Gold", 400.0), (3, "Cara", "Silver", 80.0), (6, "Finn", "Bronze", 10.0)]


@pytest.fixture()
def target(spark):
    return spark.createDataFrame(START, COLS)


@pytest.fixture()
def source(spark):
    return spark.createDataFrame(CHANGES, COLS)


def test_upsert(target, source, rows):
    got = rows(mu.merge_upsert(target, source, ["customer_id"]))
    assert got == sorted([START[1], START[3], *CHANGES], key=repr)


def test_upsert_twice_changes_nothing(target, source, rows):
    once = mu.merge_upsert(target, source, ["customer_id"])
    assert rows(mu.merge_upsert(once, source, ["customer_id"])) == rows(once)


def test_upsert_rejects_a_key_met_twice(target, source):
    with pytest.raises(Exception, match="occurs twice"):
        mu.merge_upsert(target, source.union(source), ["customer_id"]).collect()


def test_upsert_takes_the_newest(target, spark, rows):
    many = spark.createDataFrame([(1, "Alice", "Gold", 1.0), (1, "Alice", "Gold", 2.0)], COLS)
    got = mu.merge_upsert(target, many, ["customer_id"], [F.desc("total_spend")])
    assert (1, "Alice", "Gold", 2.0) in rows(got) and got.count() == 4


@pytest.mark.parametrize("limit", [mu.BROADCAST_BYTES, -1])
def test_upsert_small_and_large_source(spark, source, target, rows, monkeypatch, limit):
    """Broadcast and tagged union agree: null keys stay and arrive, a key the target has twice goes, empty sides."""
    monkeypatch.setattr(mu, "BROADCAST_BYTES", limit)
    odd = target.union(spark.createDataFrame([(None, "N", None, 1.0), (1, "Again", None, 2.0)], COLS))
    new = source.union(spark.createDataFrame([(None, "M", None, 3.0)], COLS))
    want = [START[1], START[3], *CHANGES, (None, "N", None, 1.0), (None, "M", None, 3.0)]
    assert rows(mu.merge_upsert(odd, new, ["customer_id"])) == sorted(want, key=repr)
    assert rows(mu.merge_upsert(odd, new.limit(0), ["customer_id"])) == rows(odd)
    assert rows(mu.merge_upsert(odd.limit(0), new, ["customer_id"])) == rows(new)
    with pytest.raises(Exception, match="occurs twice"):
        mu.merge_upsert(target.limit(0), source.union(source), ["customer_id"]).collect()


@pytest.mark.parametrize("limit, exchanges", [(mu.BROADCAST_BYTES, 0), (-1, 1)])
def test_upsert_reads_the_source_once(spark, target, source, monkeypatch, limit, exchanges):
    """The source's own plan does not stand in the result; a large one costs one exchange for both sides."""
    monkeypatch.setattr(mu, "BROADCAST_BYTES", limit)
    path, worked = folder(spark, "target"), spark.sparkContext.accumulator(0)
    target.write.parquet(path)

    def count(batches):
        for b in batches:
            worked.add(b.num_rows)
            yield b

    got = mu.merge_upsert(spark.read.parquet(path), source.mapInArrow(count, COLS), ["customer_id"])
    assert got.count() == 5 and worked.value == len(CHANGES)
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert "MapInArrow" not in plan
    whole = mu.merge_upsert(spark.read.parquet(path), source, ["customer_id"])._jdf.queryExecution().executedPlan().toString()
    kept = whole.split("Union")[-1] if limit == -1 else whole[: whole.index("Window")]
    assert whole.count("Exchange hashpartitioning") == 1
    assert kept.count("Exchange hashpartitioning") == 0 and (exchanges == 1) == ("Join" not in whole)


def test_update_and_delete_leave_rows_with_a_null_predicate(target, rows):
    up = mu.update_where(target, F.col("total_spend") > 50, {"tier": F.lit("Top")})
    assert rows(up, "customer_id", "tier") == [(1, "Top"), (2, "Top"), (3, "Bronze"), (5, None)]
    assert rows(mu.delete_where(target, F.col("total_spend") > 50), "customer_id") == [(3,), (5,)]


def test_change_feed_kinds(target, spark, rows):
    after = spark.createDataFrame(
        [START[0], (2, "Bob", "Platinum", 250.0), START[2], (7, "Gus", "Bronze", 5.0)], COLS
    )
    feed = mu.change_feed(target, after, ["customer_id"], 1)
    assert rows(feed, "_change_type", "customer_id", "tier") == [
        ("delete", 5, None),
        ("insert", 7, "Bronze"),
        ("update_postimage", 2, "Platinum"),
        ("update_preimage", 2, "Gold"),
    ]
    assert rows(mu.apply_changes(target, feed, ["customer_id"])) == rows(after)


def test_apply_several_versions(target, source, spark, rows):
    v1 = mu.merge_upsert(target, source, ["customer_id"])
    v2 = mu.delete_where(v1, F.col("customer_id") == 6)
    feeds = mu.change_feed(target, v1, ["customer_id"], 1).unionByName(mu.change_feed(v1, v2, ["customer_id"], 2))
    assert rows(mu.apply_changes(target, feeds, ["customer_id"])) == rows(v2)


def test_scd2_chain(spark, rows):
    v = spark.createDataFrame(
        [(1, "Silver", "2024-01-01"), (1, "Gold", "2025-06-01"), (1, "Gold", "2025-07-01"), (2, "Bronze", "2024-01-01")],
        "customer_id long, tier string, effective_from string",
    ).withColumn("effective_from", F.to_date("effective_from"))
    got = mu.scd2(v, ["customer_id"], "effective_from", ["tier"])
    assert got.filter("is_current").count() == 2 and got.count() == 4
    assert got.filter("effective_to <= effective_from").count() == 0
    less = mu.scd2(v, ["customer_id"], "effective_from", ["tier"], skip_unchanged=True)
    assert [(r[0], r[1], str(r[2]), str(r[3]), r[4]) for r in sorted(less.collect())] == [
        (1, "Gold", "2025-06-01", "None", True),
        (1, "Silver", "2024-01-01", "2025-06-01", False),
        (2, "Bronze", "2024-01-01", "None", True),
    ]


def test_reconcile_finds_each_difference(target, source):
    r = mu.reconcile(target, mu.merge_upsert(target, source, ["customer_id"]), ["customer_id"]).first()
    assert tuple(r) == (4, 5, 0, 1, 2)


def test_states_from_the_change_log(spark, target, source, rows):
    key = ["customer_id"]
    after = mu.merge_upsert(target, source, key)
    log = hi.logged(hi.as_load(target), "WRITE", "2024-01-01 00:00:00").unionByName(
        hi.logged(mu.change_feed(target, after, key, 1), "MERGE", "2024-01-02 00:00:00")
    )
    back = hi.logged(hi.changes_back(log, key, 0, 2), "RESTORE 0", "2024-01-03 00:00:00")
    # Repeated rows of a log, as after a commit sent twice, change no state.
    full = log.unionByName(back)
    for one in (full, full.unionByName(back)):
        assert rows(hi.state_at(one, key, 0), *target.columns) == rows(target)
        assert rows(hi.state_at(one, key, at="2024-01-01 12:00:00"), *target.columns) == rows(target)
        assert rows(hi.state_at(one, key, 1), *target.columns) == rows(after)
        assert rows(hi.state_at(one, key), *target.columns) == rows(target)
    assert hi.state_at(full, key, at="2023-01-01 00:00:00").count() == 0
    assert hi.state_at(full.limit(0), key).count() == 0
    assert rows(hi.history(full), "snapshot_version", "operation", "rows", "inserted", "updated", "deleted") == [
        (0, "WRITE", 4, 0, 0, 0),
        (1, "MERGE", 5, 1, 2, 0),
        (2, "RESTORE 0", 4, 0, 2, 1),
    ]


def test_upsert_rewrites_only_touched_partitions(spark, rows):
    path = folder(spark, "parts")
    old = spark.createDataFrame([(1, "a", 1), (2, "a", 2), (3, "b", 3)], "id long, p string, v long")
    old.write.partitionBy("p").parquet(path)
    before = {r[0] for r in spark.read.parquet(path).filter("p = 'b'").select("_metadata.file_path").collect()}
    mu.upsert_partitions(spark, path, spark.createDataFrame([(2, "a", 20), (4, "c", 4)], "id long, p string, v long"), ["id"], "p")
    assert rows(spark.read.parquet(path), "id", "p", "v") == [(1, "a", 1), (2, "a", 20), (3, "b", 3), (4, "c", 4)]
    assert {r[0] for r in spark.read.parquet(path).filter("p = 'b'").select("_metadata.file_path").collect()} == before


def test_reconcile_tells_nulls_apart(spark):
    a = spark.createDataFrame([(1, None, "x"), (2, "y", None)], "k long, a string, b string")
    b = spark.createDataFrame([(1, "x", None), (2, "y", None)], "k long, a string, b string")
    assert mu.reconcile(a, b, ["k"]).first()["different"] == 1
