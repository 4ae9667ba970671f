"""Window analytics over each customer's orders, safe for customers of any size."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.measures import money, pct
from tidemark.operators import segmented
from tidemark.operators.joins import latest_by
from tidemark.plans.inputs import BRONZE, bronze_events
from tidemark.plans.registry import query

KEYS = ["o_custkey"]
ORDER = ["o_orderdate", "o_orderkey"]


def _orders(t):
    return t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")


@query(
    "win_rank_dense",
    """SELECT o_custkey, o_orderkey, o_totalprice,
      rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC) AS revenue_rank,
      dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC) AS revenue_dense_rank
    FROM orders""",
)
def win_rank_dense(t):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_totalprice")
    return segmented.ranks(rows, KEYS, "o_totalprice", "revenue_rank", "revenue_dense_rank")


@query(
    "win_lag_lead",
    """SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice,
      lag(o_totalprice) OVER w AS prev_revenue, lead(o_totalprice) OVER w AS next_revenue
    FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""",
)
def win_lag_lead(t):
    rows = _orders(t)
    cut = segmented.plan(rows, KEYS, ORDER)
    back = segmented.neighbour(rows, KEYS, ORDER, "o_totalprice", "prev_revenue", cut)
    return segmented.neighbour(back, KEYS, ORDER, "o_totalprice", "next_revenue", cut, following=True)


@query(
    "win_running_total",
    """SELECT o_custkey, o_orderkey, o_orderdate,
      CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_total
    FROM orders""",
)
def win_running_total(t):
    rows = _orders(t).withColumn("price", money("o_totalprice"))
    out = segmented.running_sum(rows, KEYS, ORDER, "price", "running_total")
    return out.select(*KEYS, "o_orderkey", "o_orderdate", F.col("running_total").cast("double"))


@query(
    "win_moving_avg",
    """SELECT o_custkey, o_orderkey, o_orderdate, round(
      CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER w AS DOUBLE) / count(*) OVER w, 4) AS moving_avg_3
    FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
      ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
)
def win_moving_avg(t):
    rows = _orders(t).withColumn("price", money("o_totalprice"))
    cut = segmented.plan(rows, KEYS, ORDER)
    one = segmented.neighbour(rows, KEYS, ORDER, "price", "one_back", cut)
    two = segmented.neighbour(one, KEYS, ORDER, "one_back", "two_back", cut)
    zero = F.lit(0).cast("decimal(18,2)")
    total = F.col("price") + F.coalesce("one_back", zero) + F.coalesce("two_back", zero)
    n = 1 + F.col("one_back").isNotNull().cast("int") + F.col("two_back").isNotNull().cast("int")
    return two.select(
        *KEYS, "o_orderkey", "o_orderdate", F.round(total.cast("double") / n, 4).alias("moving_avg_3")
    )


@query(
    "win_pct_of_total",
    """SELECT o_custkey, o_orderkey, o_totalprice * 100.0 /
      CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey) AS DOUBLE) AS pct_of_total
    FROM (SELECT o_custkey, o_orderkey, o_totalprice FROM orders)""",
)
def win_pct_of_total(t):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_totalprice")
    totals = rows.groupBy(*KEYS).agg(F.sum(money("o_totalprice")).cast("double").alias("total"))
    share = pct(F.col("o_totalprice"), F.col("total"))
    return rows.join(totals, KEYS).select(*KEYS, "o_orderkey", share.alias("pct_of_total"))


@query(
    "latest_per_key",
    f"""
    WITH {BRONZE} SELECT event_id, ts, event_type, value FROM (
      SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ts DESC) AS rn FROM bronze)
    WHERE rn = 1 AND value IS NOT NULL""",
)
def latest_per_key(t):
    # Deleted entities (null value) go after the latest version is known, not before.
    newest = latest_by(bronze_events(t), ["event_id"], [F.desc("ts")])
    return newest.filter(F.col("value").isNotNull()).select("event_id", "ts", "event_type", "value")
