"""Shared inputs of the queries, each beside the SQL text that defines it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.measures import money
from tidemark.session import Tables

# Reference day of the reports: data, not the clock.
AS_OF_EVENTS = "2024-01-31"
AS_OF_ORDERS = "2001-12-31"
# Events before this instant form the first load, the rest arrives later.
SECOND_LOAD = "2024-01-16 00:00:00"


def bronze_events(t: Tables) -> DataFrame:
    """Events with the faults raw input has: nulls, negative values, late corrections."""
    ev = t.events
    value = (
        F.when(F.col("event_type") == "error", F.lit(None).cast("double"))
        .when((F.col("event_type") == "click") & (F.col("value") < 20), -F.col("value"))
        .otherwise(F.col("value"))
    )
    user = F.when(F.col("value") >= 5, F.col("user_id"))
    again = ev.filter(F.col("event_type") == "purchase").withColumns(
        {"ts": F.col("ts") + F.expr("INTERVAL 1 MINUTE"), "value": F.col("value") + 1}
    )
    return ev.unionByName(again).withColumns({"user_id": user, "value": value})


BRONZE = """
bronze AS (
  SELECT event_id, ts, CASE WHEN value >= 5 THEN user_id END AS user_id, event_type,
         CASE WHEN event_type = 'error' THEN NULL
              WHEN event_type = 'click' AND value < 20 THEN -value
              ELSE value END AS value, props
  FROM (SELECT event_id, ts, user_id, event_type, value, props FROM events
        UNION ALL
        SELECT event_id, ts + INTERVAL 1 MINUTE, user_id, event_type, value + 1, props
        FROM events WHERE event_type = 'purchase'))
"""


def silver_events(t: Tables) -> DataFrame:
    """Valid keys only, the latest copy of each event, calendar columns added."""
    from tidemark.operators.joins import latest_by

    valid = bronze_events(t).filter("event_id IS NOT NULL AND user_id IS NOT NULL")
    one = latest_by(valid, ["event_id"], [F.desc("ts")])
    weekend = F.dayofweek("ts").isin(1, 7)
    return one.withColumns(
        {
            "event_date": F.to_date("ts").cast("string"),
            "event_hour": F.hour("ts").cast("long"),
            "day_of_week": F.dayofweek("ts").cast("long"),
            "is_weekend": weekend,
            "value_category": F.when(F.col("value") < 50, "low")
            .when(F.col("value") < 200, "medium")
            .otherwise("high"),
        }
    )


SILVER = (
    BRONZE.rstrip()
    + """,
silver AS (
  SELECT event_id, ts, user_id, event_type, value, props,
         CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date,
         CAST(hour(ts) AS BIGINT) AS event_hour,
         CAST(dayofweek(ts) + 1 AS BIGINT) AS day_of_week,
         dayofweek(ts) IN (0, 6) AS is_weekend,
         CASE WHEN value < 50 THEN 'low' WHEN value < 200 THEN 'medium' ELSE 'high' END
           AS value_category
  FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ts DESC) AS rn
        FROM bronze WHERE event_id IS NOT NULL AND user_id IS NOT NULL)
  WHERE rn = 1)
"""
)


def sales(t: Tables, status: str | None = "F") -> DataFrame:
    """Star of order lines, customers, products and regions; ``F`` marks a completed order."""
    orders = t.orders if status is None else t.orders.filter(F.col("o_orderstatus") == status)
    place = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    buyers = t.customer.join(place, F.col("c_nationkey") == F.col("n_nationkey"))
    # Customers and regions meet the orders first: the lines are shuffled on the order key once.
    placed = orders.join(buyers, F.col("o_custkey") == F.col("c_custkey"))
    return (
        t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            "o_orderkey",
            "c_custkey",
            F.col("c_mktsegment").alias("tier"),
            F.col("r_name").alias("region"),
            F.col("p_type").alias("category"),
            F.col("l_quantity").alias("quantity"),
            "o_orderdate",
            "o_orderstatus",
            (money("l_quantity") * money("p_retailprice")).alias("revenue"),
        )
    )


def sales_sql(status: str | None = "F") -> str:
    where = "" if status is None else f"WHERE o_orderstatus = '{status}'"
    return f"""
sales AS (
  SELECT o_orderkey, c_custkey, c_mktsegment AS tier, r_name AS region, p_type AS category,
         l_quantity AS quantity, o_orderdate, o_orderstatus,
         CAST(l_quantity AS DECIMAL(18,2)) * CAST(p_retailprice AS DECIMAL(18,2)) AS revenue
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey {where})
"""


SALES = sales_sql()


def msum(c: str) -> str:
    """SQL twin of ``money_sum``."""
    return f"CAST(sum(CAST({c} AS DECIMAL(18,2))) AS DOUBLE)"


def mavg(c: str) -> str:
    """SQL twin of ``money_avg``."""
    return f"CAST(sum(CAST({c} AS DECIMAL(18,2))) AS DOUBLE) / count({c})"


# Columns of the given tables, for SQL that has to spell them out. Operators read the schemas.
TABLE_COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def columns_of(table: str) -> list[tuple[str, str]]:
    return [tuple(c.split(" ")) for c in TABLE_COLUMNS[table].split(", ")]
