"""Validity joins against the plain comparison of every fact with every interval of its key."""

import pytest
from conftest import SF
from oracle import compare, connect
from pyspark.sql import functions as F

from tidemark.operators import segmented as sg, validity as vj
from tidemark.plans import ORACLES, QUERIES
from tidemark.session import settle

ARGS = (["k"], "at", "start", "end")


def brute(facts, intervals, how):
    out = []
    for f in facts:
        hits = [v for v in intervals if None not in (f[1], f[2], v[0], v[1]) and v[0] == f[1] and v[1] <= f[2] and (v[2] is None or v[2] > f[2])]
        out += [(*f, *v[1:]) for v in hits] or ([(*f, None, None, None)] if how == "left" else [])
    return sorted(out, key=str)


def frames(spark, facts, intervals):
    return (
        spark.createDataFrame(facts, "id long, k long, at long"),
        spark.createDataFrame(intervals, "k long, start long, end long, price long"),
    )


def facts_of(n):
    """Key 0 holds two thirds, a fifth of its facts one instant; null keys and times."""
    rows = [(i, 0 if i % 3 else i % 7, 500 if i % 5 == 0 else (i * 7919) % 1000) for i in range(n)]
    return rows + [(n, None, 5), (n + 1, 0, None), (n + 2, 99, 5)]


def chained():
    hot = [(0, s, s + (9 if s % 4 else 10), s) for s in range(10, 1000, 10)] + [(0, 1000, None, -1)]
    return hot + [(2, 0, 300, 1), (2, 300, None, 2), (None, 0, None, 3), (4, None, 9, 4), (4, 7, 7, 5), (4, 9, 2, 6)]


def overlapping():
    hot = [(0, (s * 37) % 900, (s * 37) % 900 + 1 + (s * s) % 60, s) for s in range(120)]
    return hot + [(0, 3, None, -1), (0, 3, None, -1), (0, 0, 5000, -2), (2, 0, 700, 1), (2, 300, None, 2), (4, 7, 7, 5), (5, 2000, None, 8)]


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("segment", [sg.AUTO, sg.Ranges(7)])
@pytest.mark.parametrize("intervals, apart", [(chained(), True), (overlapping(), False)])
def test_equals_brute_force(spark, monkeypatch, intervals, apart, segment, how):
    monkeypatch.setattr(vj, "NEAR_ROWS", 0)
    monkeypatch.setattr(vj, "BIN_ROWS", 4)
    facts = facts_of(600)
    f, v = frames(spark, facts, intervals)
    proper = v.filter("k IS NOT NULL AND start IS NOT NULL AND (end IS NULL OR end > start)")
    assert vj.disjoint(proper, ["k"], "start", "end", segment) == apart
    got = vj.validity_join(f, v, *ARGS, how, segment)
    assert got.columns == ["id", "k", "at", "start", "end", "price"]
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute(facts, intervals, how)


@pytest.mark.parametrize("near", [0, 128])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_empty_sides(spark, monkeypatch, near, how):
    monkeypatch.setattr(vj, "NEAR_ROWS", near)
    f, v = frames(spark, facts_of(5), overlapping())
    assert vj.validity_join(f.limit(0), v, *ARGS, how).count() == 0
    assert vj.validity_join(f, v.limit(0), *ARGS, how).count() == (f.count() if how == "left" else 0)


def test_a_hot_key_is_not_compared_row_by_row(spark, monkeypatch):
    """One key with 20,000 facts and 20,000 overlapping intervals: times are compared in the bins of the ends only."""
    kept = {}
    monkeypatch.setattr(vj, "settle", lambda df, label: kept.setdefault(label, settle(df, label)))
    n = 20_000
    facts = spark.range(n).select("id", F.lit(0).cast("long").alias("k"), (F.col("id") * 10).alias("at"))
    intervals = spark.range(n).select(
        F.lit(0).cast("long").alias("k"), (F.col("id") * 10).alias("start"), (F.col("id") * 10 + 25).alias("end"), F.col("id").alias("price")
    )
    got = vj.validity_join(facts, intervals, *ARGS, segment=sg.Ranges(8))
    assert got.count() == 3 * n - 3
    assert kept["blocks"].groupBy("level", "block").count().agg(F.max("count")).first()[0] <= 2 * vj.BIN_ROWS
    assert kept["bins"].filter("__kind = 0").groupBy("__bin").count().agg(F.max("count")).first()[0] <= vj.BIN_ROWS


@pytest.mark.parametrize("name", ["temporal_price_join", "overlapping_windows"])
def test_registered_queries_by_order_and_bins(spark, monkeypatch, name):
    monkeypatch.setattr(vj, "NEAR_ROWS", 0)
    monkeypatch.setattr(sg, "MAX_ROWS", 200)
    assert compare(spark, connect(SF), SF, QUERIES[name], ORACLES[name]) is None
