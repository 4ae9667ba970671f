"""Segmented windows equal plain windows, with one key holding most of the rows."""

import pytest
from oracle import compare, connect
from conftest import SF
from pyspark.sql import Window as W, functions as F

from tidemark.operators import segmented as sg
from tidemark.operators.joins import asof_join
from tidemark.operators.mutation import scd2
from tidemark.plans import ORACLES, QUERIES


@pytest.fixture(scope="module")
def hot(spark):
    """3000 rows; key 0 holds two thirds, one day holds half of those, some values are null."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id") % 7).cast("long").alias("k"),
        F.when(F.col("id") % 2 == 0, F.lit(500)).otherwise((F.col("id") * 7919) % 1000).cast("long").alias("day"),
        F.col("id"),
        F.when(F.col("id") % 5 == 0, None).otherwise((F.col("id") * 31) % 50).cast("long").alias("v"),
    )
    return df


KEYS, ORDER = ["k"], ["day", "id"]


def check(a, b):
    cols = sorted(a.columns)
    assert sorted(a.columns) == sorted(b.columns)
    assert a.select(*cols).exceptAll(b.select(*cols)).count() == 0
    assert b.select(*cols).exceptAll(a.select(*cols)).count() == 0


@pytest.fixture(scope="module")
def cut(hot):
    return sg.plan(hot, KEYS, ORDER, max_rows=100)


def test_plan_measures_the_largest_key(hot):
    assert sg.plan(hot, KEYS, ORDER, max_rows=5000) is None
    assert sg.plan(hot, KEYS, ORDER, max_rows=100) is not None


def test_segments_are_small_and_ordered(hot, cut):
    seg = sg.with_segments(hot, ORDER, cut).withColumnRenamed(sg.SEG, "s")
    assert seg.groupBy("k", "s").count().agg(F.max("count")).first()[0] <= 250
    w = W.partitionBy("k").orderBy(*ORDER)
    assert seg.withColumn("p", F.lag("s").over(w)).filter("p > s").count() == 0


def test_running_sum(hot, cut):
    for inclusive in (True, False):
        got = sg.running_sum(hot, KEYS, ORDER, "v", "out", cut, inclusive)
        check(got, sg.running_sum(hot, KEYS, ORDER, "v", "out", None, inclusive))


def test_row_position(hot, cut):
    check(sg.row_position(hot, KEYS, ORDER, "out", cut), sg.row_position(hot, KEYS, ORDER, "out", None))


@pytest.mark.parametrize("following", [False, True])
def test_neighbour(hot, cut, following):
    got = sg.neighbour(hot, KEYS, ORDER, "v", "out", cut, following)
    check(got, sg.neighbour(hot, KEYS, ORDER, "v", "out", None, following))


def test_last_seen(hot, cut):
    check(sg.last_seen(hot, KEYS, ORDER, "v", "out", cut), sg.last_seen(hot, KEYS, ORDER, "v", "out", None))


def test_ranges_take_any_order(hot):
    """Text, and three columns of which the first two are the same in most rows."""
    rows = hot.select("k", F.lit(1).alias("one"), F.when(F.col("day") == 500, "x").otherwise("y").alias("text"), "id", "v")
    for order in (["text", "id"], ["one", "text", "id"]):
        want = sg.running_sum(rows, ["k"], order, "v", "out", None)
        check(sg.running_sum(rows, ["k"], order, "v", "out", sg.Ranges(7)), want)
        assert sg.with_segments(rows, order, sg.Ranges(7)).groupBy(sg.SEG).count().agg(F.max("count")).first()[0] < 1000


def test_many_ranges_are_not_capped(hot):
    assert sg.plan(hot, KEYS, ORDER, max_rows=1).parts == 3000
    assert sg.plan(hot, [], ORDER, max_rows=100).parts == 30


def test_exact_quantiles(spark):
    import math

    from tidemark.operators.quantiles import exact_quantiles

    rows = [(None if i % 4 == 3 else i % 2, float((i * 7919) % 501) if i % 11 else None) for i in range(2000)]
    df = spark.createDataFrame(rows, "k long, v double")
    shares = ["0.1", "0.5", "0.95", "1"]
    for keys, seg in ((["k"], None), (["k"], sg.Ranges(5)), ([], sg.Ranges(6)), ([], sg.AUTO)):
        found = exact_quantiles(df, keys, "v", shares, segment=seg).collect()
        assert len(found) == (3 if keys else 1)
        for r in found:
            values = sorted(v for k, v in rows if v is not None and (not keys or k == r["k"]))
            want = [values[max(1, math.ceil(round(float(s) * len(values), 9))) - 1] for s in shares]
            assert r["quantiles"] == want
    none = df.filter("false")
    assert exact_quantiles(none, ["k"], "v", shares).collect() == []
    assert exact_quantiles(none, [], "v", shares).first()[0] == [None] * 4


def test_without_keys(hot):
    cut = sg.Ranges(9)
    check(sg.running_sum(hot, [], ORDER, "v", "out", cut), sg.running_sum(hot, [], ORDER, "v", "out", None))


def test_ranks(hot):
    rows = hot.filter("v IS NOT NULL")
    w = W.partitionBy("k").orderBy(F.desc("v"))
    want = rows.withColumns({"rank": F.rank().over(w).cast("long"), "dense_rank": F.dense_rank().over(w).cast("long")})
    for seg in (None, F.floor(F.col("v") / 7)):
        got = sg.ranks(rows, KEYS, "v", segment=seg)
        check(got.withColumns({c: F.col(c).cast("long") for c in ("rank", "dense_rank")}), want)


def test_asof_takes_the_latest_at_or_before(spark):
    ts = "timestamp_ntz"
    left = spark.createDataFrame(
        [(1, "2024-01-01 10:00:00"), (1, "2024-01-03 00:00:00"), (2, "2024-01-01 00:00:00")], "k long, at string"
    ).withColumn("at", F.col("at").cast(ts))
    right = spark.createDataFrame(
        [(1, "2024-01-01 10:00:00", 5), (1, "2024-01-01 09:00:00", 4), (1, "2024-01-01 10:00:00", 6), (2, "2024-01-02 00:00:00", 9)],
        "k long, at string, f long",
    ).withColumn("at", F.col("at").cast(ts))
    for seg in (None, F.date_trunc("day", F.col("__time"))):
        got = asof_join(left, right, ["k"], "at", "at", ["f"], tie="f", segment=seg)
        assert sorted((r["k"], str(r["at"]), r["f"]) for r in got.collect()) == [
            (1, "2024-01-01 10:00:00", 6),
            (1, "2024-01-03 00:00:00", 6),
            (2, "2024-01-01 00:00:00", None),
        ]


def test_scd2_segmented(hot):
    versions = hot.select("k", F.col("id").alias("effective_from"), "v").filter("v IS NOT NULL")
    cut = F.floor(F.col("effective_from") / 100)
    for skip in (False, True):
        args = (versions, ["k"], "effective_from", ["v"], skip)
        check(scd2(*args, segment=cut), scd2(*args, segment=None))


@pytest.mark.parametrize(
    "name",
    "win_rank_dense win_lag_lead win_running_total win_moving_avg scd2_apply scd2_skip_unchanged "
    "asof_join_features roc_points binary_metrics stratified_split".split(),
)
def test_registered_queries_when_keys_are_too_large(spark, monkeypatch, name):
    """The same queries with a limit so low that every key is cut."""
    monkeypatch.setattr(sg, "MAX_ROWS", 60)
    assert compare(spark, connect(SF), SF, QUERIES[name], ORACLES[name]) is None
