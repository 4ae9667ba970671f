import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators import layout
from tidemark.session import folder, settle, shared_folder
from tidemark.sources import files, incremental as inc


def test_generated_events(spark):
    df = files.generated_events(spark, 100)
    assert df.count() == 100 and df.select("event_type").distinct().count() == 4


def test_unknown_format(spark):
    with pytest.raises(ValueError):
        files.read_files(spark, "/nowhere", "toml")


def test_avro_says_what_is_missing(spark):
    df = files.generated_events(spark, 10)
    path = folder(spark, "avro")
    try:
        files.write_files(df, path, "avro")
    except RuntimeError as e:
        assert "spark-avro" in str(e)
    else:
        assert files.read_files(spark, path, "avro").count() == 10


def test_schema_modes():
    old, new = StructType.fromDDL("a long, b string"), StructType.fromDDL("b string, c double")
    assert inc.evolve(old, new, "add").names == ["a", "b", "c"]
    assert inc.evolve(old, new, "ignore").names == ["a", "b"]
    with pytest.raises(inc.SchemaChanged, match="c"):
        inc.evolve(old, new, "fail")


def test_append_evolving(spark, rows):
    a = spark.createDataFrame([(1, "x")], "a long, b string")
    b = spark.createDataFrame([("y", 2.0)], "b string, c double")
    assert rows(inc.append_evolving(a, b)) == [(1, "x", None), (None, "y", 2.0)]
    assert rows(inc.append_evolving(a, b, "ignore")) == [(1, "x"), (None, "y")]


def test_kept_schema_is_read_back(spark):
    path, where = folder(spark, "data"), folder(spark, "schema")
    spark.range(3).write.json(path)
    first = inc.kept_schema(spark, where, path, "json")
    spark.range(3).withColumn("more", F.lit("x")).write.mode("append").json(path)
    assert inc.kept_schema(spark, where, path, "json") == first


def test_copy_after_a_crash_loads_once(spark, rows):
    src, target, ledger = folder(spark, "src"), folder(spark, "target"), folder(spark, "ledger")
    schema = spark.range(1).schema
    spark.range(5).write.json(src)
    # A run that wrote its rows but died before the ledger.
    spark.range(5).write.parquet(f"{target}/load=0")
    assert inc.copy_into(spark, src, target, ledger, "json", schema) > 0
    assert inc.copy_into(spark, src, target, ledger, "json", schema) == 0
    assert rows(spark.read.parquet(target), "id") == [(i,) for i in range(5)]


def test_copy_into_after_a_crash(spark, rows):
    """The entry of the last load is lost, as when a call dies between the write and it."""
    src, target, ledger = (folder(spark, x) for x in ("src", "target", "ledger"))
    spark.range(6).write.json(f"{src}/a/b")
    schema = StructType.fromDDL("id long")
    assert inc.copy_into(spark, src, target, ledger, "json", schema) == 6
    spark.range(6, 9).write.json(f"{src}/c")
    assert inc.copy_into(spark, src, target, ledger, "json", schema) == 3
    commits = sorted(f for f in os.listdir(f"{ledger}/commits") if f.isdigit())
    for name in (commits[-1], f".{commits[-1]}.crc"):
        if os.path.exists(f"{ledger}/commits/{name}"):
            os.remove(f"{ledger}/commits/{name}")
    spark.range(9, 10).write.json(f"{src}/d")
    assert inc.copy_into(spark, src, target, ledger, "json", schema) == 4  # the load is repeated, then the new file
    assert rows(spark.read.parquet(target), "id") == [(i,) for i in range(10)]
    assert inc.copy_into(spark, src, target, ledger, "json", schema) == 0


def test_bookmark(spark, rows):
    df = spark.range(10)
    assert inc.since(df, "id", None).count() == 10
    assert rows(inc.since(df, "id", F.lit(7))) == [(8,), (9,)]
    assert inc.next_bookmark(df, "id").first()[0] == 9


def test_sizes_are_counted_per_file(spark):
    path = folder(spark, "sizes")
    spark.range(100).repartition(4).write.parquet(path)
    r = files.stored_bytes(spark.read.parquet(path)).first()
    assert r["files"] == 4 and r["bytes"] > 0


def test_compaction_keeps_rows(spark):
    small, large = folder(spark, "small"), folder(spark, "large")
    spark.range(1000).repartition(20).write.parquet(small)
    assert layout.compact(spark.read.parquet(small), large, 1_000_000, 2_500_000) == 3
    out = spark.read.parquet(large)
    assert files.stored_bytes(out).first()["files"] == 3 and out.agg(F.sum("id")).first()[0] == 499500


def names_and_times(path):
    return {
        os.path.relpath(os.path.join(at, f), path): os.stat(os.path.join(at, f)).st_mtime_ns
        for at, _, found in os.walk(path)
        for f in found
        if f.endswith(".parquet")
    }


def test_small_files_are_merged_and_large_ones_left(spark, rows):
    path = folder(spark, "mixed")
    spark.range(40_000).repartition(2).write.parquet(path)
    spark.range(40_000, 41_000).repartition(30).write.mode("append").parquet(path)
    before = names_and_times(path)
    sizes = {f: os.path.getsize(f"{path}/{f}") for f in before}
    small = {f for f, size in sizes.items() if size < 20_000}
    assert len(small) == 30
    target = sum(sizes[f] for f in small) // 4
    assert layout.compact_small(spark, path, target, 20_000) == 30
    after = names_and_times(path)
    assert {f: at for f, at in before.items() if f not in small}.items() <= after.items()
    assert not small & set(after) and len(after) in (6, 7)
    assert rows(spark.read.parquet(path)) == [(i,) for i in sorted(range(41_000), key=lambda i: repr((i,)))]
    assert not os.path.exists(f"{path}/{layout.STAGED}")
    # What is large enough now stays where it is.
    assert layout.compact_small(spark, path, target, 1000) == 0 and names_and_times(path) == after


def test_partition_folders_stay_as_written(spark, rows):
    path = folder(spark, "parts")
    keys = F.array(F.lit("007"), F.lit("a b"), F.lit("x=y/z"), F.lit(None))
    df = spark.range(400).withColumn("part key", keys[F.col("id").cast("int") % 4]).withColumn("day", F.lit("2024-01-01"))
    df.repartition(8).write.partitionBy("part key", "day").parquet(path)
    single = f"{path}/part key=alone/day=2024-01-01"
    spark.range(1000, 1001).coalesce(1).write.parquet(single)
    before = names_and_times(path)
    assert len(before) == 33
    assert layout.compact_small(spark, path, 1_000_000) == 32
    after = names_and_times(path)
    assert len(after) == 5 and {os.path.dirname(f) for f in after} == {os.path.dirname(f) for f in before}
    alone = [f for f in before if "alone" in f]
    assert all(after[f] == before[f] for f in alone)
    back = spark.read.schema("id long, `part key` string, day string").parquet(path)
    extra = spark.createDataFrame([(1000, "alone", "2024-01-01")], df.schema)
    assert rows(back) == rows(df.unionByName(extra))


@pytest.mark.parametrize("lost", [0, 5, 12])
def test_a_swap_cut_off_goes_on(spark, rows, monkeypatch, lost):
    """The job ends after staging, and with some of the old files gone already."""
    path = folder(spark, "cut-off")
    spark.range(500).repartition(12).write.parquet(path)
    before = names_and_times(path)
    with monkeypatch.context() as m:
        m.setattr(layout, "finish_compaction", lambda *_: None)
        assert layout.compact_small(spark, path, 1_000_000) == 12
    assert rows(spark.read.parquet(path), "id") == rows(spark.range(500), "id")  # staged files are hidden
    for f in sorted(before)[:lost]:
        os.remove(f"{path}/{f}")
    layout.finish_compaction(spark, path)
    assert rows(spark.read.parquet(path), "id") == rows(spark.range(500), "id")
    assert len(names_and_times(path)) == 1


def test_nothing_to_merge(spark):
    path = folder(spark, "empty")
    spark.range(0).write.parquet(path)
    assert layout.compact_small(spark, path, 1_000_000) == 0
    spark.range(3).coalesce(1).write.mode("append").parquet(path)
    assert layout.compact_small(spark, path, 1_000_000) == 0
    assert spark.read.parquet(path).count() == 3


def test_z_value_interleaves(spark):
    got = spark.range(1).select(layout.z_value([F.lit(0b101), F.lit(0b011)], 3)).first()[0]
    assert got == 0b011011


def test_zorder_narrows_both_columns(spark):
    """Files written along the curve span less of each column than unordered ones."""
    df = spark.range(20_000).select((F.col("id") * 7919 % 1000).alias("a"), (F.col("id") * 104729 % 1000).alias("b"))
    path = folder(spark, "z")
    layout.write_zordered(df, path, ["a", "b"], 16)
    out = spark.read.parquet(path)
    span = out.groupBy("_metadata.file_path").agg((F.max("a") - F.min("a")).alias("a"), (F.max("b") - F.min("b")).alias("b"))
    r = span.agg(F.avg("a"), F.avg("b")).first()
    assert r[0] < 600 and r[1] < 600 and out.count() == 20_000


def test_shared_folder_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == base.rstrip("/") and folder(spark, "x").startswith(base.rstrip("/"))


def test_settle_cuts_the_plan(spark):
    df = spark.range(10).groupBy((F.col("id") % 2).alias("k")).count()
    out = settle(df, "x")
    assert out.count() == 2 and "Aggregate" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_shared_view_applies_the_grant(spark, t):
    df = files.shared_view(spark, {"path": t.path("orders"), "columns": ["o_orderkey"], "filter": "o_orderstatus = 'F'"})
    assert df.columns == ["o_orderkey"] and 0 < df.count() < t.orders.count()


def test_changed_types_are_widened_or_refused():
    ddl = StructType.fromDDL
    assert inc.evolve(ddl("a int, b string"), ddl("a bigint")) == ddl("a bigint, b string")
    assert inc.evolve(ddl("a double"), ddl("a int")) == ddl("a double")
    assert inc.evolve(ddl("a float"), ddl("a smallint")) == ddl("a double")
    for mode in ("add", "ignore", "fail"):
        # 2^53 + 1 is a bigint that no double holds.
        with pytest.raises(inc.SchemaChanged, match="a from bigint to double"):
            inc.evolve(ddl("a bigint"), ddl("a double"), mode)
        with pytest.raises(inc.SchemaChanged, match="a from float to bigint"):
            inc.evolve(ddl("a float"), ddl("a bigint"), mode)
        with pytest.raises(inc.SchemaChanged, match="a from bigint to string"):
            inc.evolve(ddl("a bigint"), ddl("a string"), mode)
