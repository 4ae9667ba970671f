"""The physical plans are the ones wanted."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from conftest import SF
from tidemark.functions.measures import count_where
from tidemark.operators import joins, quality as dq
from tidemark.plans import QUERIES
from tidemark.plans.spec import run_spec
from tidemark.session import folder


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_filter_and_columns_reach_the_scan(spark):
    p = plan(QUERIES["filter_conjunctive"](spark, SF))
    assert "EqualTo(event_type,purchase)" in p and "GreaterThan(value,25.0)" in p
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string,value:double>" in p


def test_date_filter_reaches_the_scan(spark):
    assert "GreaterThanOrEqual(ts," in plan(QUERIES["filter_last_n_days"](spark, SF))


def test_partitions_are_pruned(spark):
    assert "PartitionFilters: [isnotnull(event_type" in plan(QUERIES["sink_partitioned"](spark, SF))


def test_bucketed_tables_join_without_a_shuffle(spark):
    p = plan(QUERIES["layout_bucketed_join"](spark, SF))
    assert "SortMergeJoin" in p and "Exchange" not in p


def test_versions_are_pruned(spark):
    p = plan(QUERIES["restore_version"](spark, SF))
    assert "PartitionFilters: [isnotnull(snapshot_version" in p


def test_broadcast_only_when_small(spark, t):
    small = t.supplier.select("s_suppkey", "s_name")
    joined = lambda d: t.lineitem.join(d, F.col("l_suppkey") == F.col("s_suppkey"))
    assert "BroadcastHashJoin" in plan(joined(joins.broadcast_if_small(small)))
    assert joins.measured_bytes(small) > 100
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in plan(joined(joins.broadcast_if_small(small, limit=10)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_hot_join_key_is_split(spark):
    """Half of the rows share one key: the join runs in several tasks for it."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        fact = spark.range(0, 200_000, 1, 16).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
        dim = spark.range(200_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
        joined = fact.join(dim, "k")
        assert len(joined.collect()) == 200_000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in conf:
            spark.conf.unset(k)


@pytest.mark.parametrize("name", ["dedup_latest_by_key", "lateral_topk", "latest_per_key"])
def test_topk_is_limited_before_the_shuffle(spark, name):
    assert "WindowGroupLimit" in plan(QUERIES[name](spark, SF))


@pytest.mark.parametrize("name", ["top_users_by_value", "slowest_n"])
def test_global_topk_needs_no_full_sort(spark, name):
    assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, SF))


LAZY = """medallion_gold star_join_active_sales temporal_price_join asof_join_features gold_daily_metrics zscore_outliers
drift_report quality_kpis evaluate_alerts binary_metrics row_filter_region lineage_upstream embedding_drift
win_rank_dense profile_full sentiment_lexicon answer_scores above_avg_customers""".split()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_joins(spark, name):
    p = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in p and "NestedLoopJoin" not in p


def test_one_pass_for_all_rules(spark, t):
    p = plan(dq.expectation_metrics(t.events, [dq.Expectation("a", "value > 0"), dq.Expectation("b", "user_id > 0")]))
    assert p.count("Scan parquet") == 2  # once in the tree, once in the details


def test_spec_operators(spark, t, rows):
    spec = [
        {"name": "o", "op": "source", "table": "orders"},
        {"name": "kinds", "op": "select", "inputs": ["o"], "columns": ["o_orderstatus AS s", "o_orderpriority AS prio"]},
        {"name": "one", "op": "distinct", "inputs": ["kinds"]},
        {"name": "n", "op": "aggregate", "inputs": ["kinds"], "by": ["s", "prio"], "aggregates": [{"fn": "count", "as": "n"}]},
        {"name": "wide", "op": "reshape", "inputs": ["n"], "to": "wide", "keep": ["prio"], "names": "s", "values": ["F", "O", "P"], "value": "n"},
        {"name": "long", "op": "reshape", "inputs": ["wide"], "to": "long", "keep": ["prio"], "columns": ["F", "O", "P"], "names": "s", "value": "n"},
        {"name": "both", "op": "union", "inputs": ["n", "long"]},
        {"name": "mine", "op": "custom", "inputs": ["both"], "fn": "halve"},
        {"name": "out", "op": "sink", "inputs": ["mine"], "path": folder(spark, "sink")},
        {"name": "top", "op": "limit", "inputs": ["sorted"], "rows": 2},
        {"name": "sorted", "op": "sort", "inputs": ["out"], "by": ["-n", "prio", "s"]},
    ]
    half = lambda df: df.groupBy("s", "prio").agg((F.sum("n") / 2).cast("long").alias("n"))
    got = run_spec(spec, {"orders": t.orders}, {"halve": half})
    assert rows(got["out"], "s", "prio", "n") == rows(got["n"], "s", "prio", "n")
    assert got["one"].count() == got["n"].count() and got["top"].count() == 2


def test_spec_errors(t):
    loop = [{"name": "a", "op": "distinct", "inputs": ["b"]}, {"name": "b", "op": "distinct", "inputs": ["a"]}]
    with pytest.raises(ValueError, match="cycle"):
        run_spec(loop, {})
    with pytest.raises(ValueError, match="unknown operator"):
        run_spec([{"name": "a", "op": "magic"}], {})
    with pytest.raises(KeyError):
        run_spec([{"name": "a", "op": "distinct", "inputs": ["x"]}], {})


def test_custom_hook(t):
    shape = lambda df: df.groupBy("event_type").agg(count_where(F.col("value") > 50).alias("n"))
    assert t.events.transform(shape).count() == 5


def test_small_medallion(spark, rows):
    """Three transactions, one without an amount: two are left, one row per name."""
    raw = spark.createDataFrame(
        [(1, "Alice", "2025-01-01", 100.0), (2, "Bob", "2025-01-02", None), (3, "Cara", "2025-01-03", 75.5)],
        "id long, name string, date string, amount double",
    )
    silver = raw.filter(F.col("amount").isNotNull())
    gold = silver.groupBy("name").agg(F.sum("amount").alias("total_spent"), F.avg("amount").alias("avg_spent"))
    assert (raw.count(), silver.count()) == (3, 2)
    assert rows(gold) == [("Alice", 100.0, 100.0), ("Cara", 75.5, 75.5)]
