"""Selections, joins, aggregates, sorts, set operations and scalar functions."""

from __future__ import annotations

from pyspark.sql import Window as W, functions as F

from tidemark.functions.measures import count_where, money_avg, money_sum, pct
from tidemark.operators.joins import (
    Lookup,
    asof_join,
    broadcast_if_small,
    feature_lookup,
    latest_by,
)
from tidemark.operators.quantiles import exact_quantiles
from tidemark.operators.validity import validity_join
from tidemark.operators.vectors import lateral_topk
from tidemark.plans.inputs import (
    AS_OF_EVENTS,
    AS_OF_ORDERS,
    BRONZE,
    SALES,
    SILVER,
    bronze_events,
    mavg,
    msum,
    sales,
    silver_events,
)
from tidemark.plans.registry import query
from tidemark.session import inline_rows, spread

# --- layered flagship -------------------------------------------------------


@query(
    "medallion_gold",
    f"""
    SELECT r_name AS region, c_mktsegment AS segment, count(*) AS orders,
           {msum('o_totalprice')} AS total_spent, {mavg('o_totalprice')} AS avg_spent
    FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    WHERE o_totalprice > 0 AND o_orderstatus IN ('F', 'O')
    GROUP BY r_name, c_mktsegment""",
)
def medallion_gold(t):
    bronze = t.orders.select("o_custkey", "o_orderstatus", "o_totalprice")
    silver = bronze.filter((F.col("o_totalprice") > 0) & F.col("o_orderstatus").isin("F", "O"))
    # Per-customer totals first: the join then moves one row per customer.
    spend = silver.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("spent"),
    )
    place = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return (
        spend.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(place, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("r_name").alias("region"), F.col("c_mktsegment").alias("segment"))
        .agg(F.sum("n").alias("orders"), F.sum("spent").cast("double").alias("total_spent"))
        .withColumn("avg_spent", F.col("total_spent") / F.col("orders"))
    )


# --- scans and projections --------------------------------------------------


@query("scan_table", "SELECT * FROM customer")
def scan_table(t):
    t.views("customer")
    return t.spark.table("customer")


@query(
    "gen_range_events",
    """
    SELECT r.id AS slot, count(event_id) AS events,
           CAST(coalesce(sum(CAST(value AS DECIMAL(18,2))), 0) AS DOUBLE) AS total
    FROM range(0, (SELECT max(event_id) // 100 + 1 FROM events)) r(id)
    LEFT JOIN events ON event_id // 100 = r.id GROUP BY r.id""",
)
def gen_range_events(t):
    slots = t.events.agg((F.max("event_id") / 100).cast("long") + 1).first()[0]
    counted = t.events.groupBy((F.col("event_id") / 100).cast("long").alias("slot")).agg(
        F.count("event_id").alias("events"), money_sum("value").alias("total")
    )
    spine = t.spark.range(slots).withColumnRenamed("id", "slot")
    return spine.join(counted, "slot", "left").fillna(0, ["events", "total"])


@query("project_columns", "SELECT event_id, event_type FROM events")
def project_columns(t):
    return t.events.select("event_id", "event_type")


@query("rename_drop", "SELECT event_id AS id, ts AS event_time, user_id, event_type, value FROM events")
def rename_drop(t):
    return t.events.withColumnsRenamed({"event_id": "id", "ts": "event_time"}).drop("props")


@query(
    "derive_columns",
    """
    SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date, value * 2 AS doubled,
           value >= 50 AS is_large, concat(event_type, '-', CAST(user_id AS VARCHAR)) AS tag
    FROM events""",
)
def derive_columns(t):
    return t.events.select("event_id", "ts", "user_id", "event_type", "value").withColumns(
        {
            "event_date": F.to_date("ts").cast("string"),
            "doubled": F.col("value") * 2,
            "is_large": F.col("value") >= 50,
            "tag": F.concat("event_type", F.lit("-"), F.col("user_id").cast("string")),
        }
    ).drop("ts", "user_id", "event_type", "value")


@query("silver_not_null", f"WITH {BRONZE} SELECT * FROM bronze WHERE value IS NOT NULL AND user_id IS NOT NULL")
def silver_not_null(t):
    return bronze_events(t).filter(F.col("value").isNotNull() & F.col("user_id").isNotNull())


@query(
    "filter_conjunctive",
    "SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase' AND value > 25 AND value < 75",
)
def filter_conjunctive(t):
    return (
        t.events.filter(F.col("event_type") == "purchase")
        .filter((F.col("value") > 25) & (F.col("value") < 75))
        .select("event_id", "user_id", "value")
    )


@query("filter_in_list", "SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'view')")
def filter_in_list(t):
    return t.events.filter(F.col("event_type").isin("click", "view")).select("event_id", "event_type")


IPV4 = r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}"


@query(
    "filter_like_rlike",
    rf"""
    SELECT doc_id, regexp_matches(text, '(^|[^0-9.]){IPV4}([^0-9.]|$)') AS has_ip,
           regexp_matches(text, '[A-Za-z0-9._]+@[A-Za-z0-9.]+') AS has_email
    FROM documents WHERE source LIKE 'src1%' OR regexp_matches(lang, '^(en|de)$')""",
)
def filter_like_rlike(t):
    return spread(t.documents.select("doc_id", "lang", "source", "text")).filter(
        F.col("source").like("src1%") | F.col("lang").rlike("^(en|de)$")
    ).select(
        "doc_id",
        F.col("text").rlike(rf"(^|[^0-9.]){IPV4}([^0-9.]|$)").alias("has_ip"),
        F.col("text").rlike("[A-Za-z0-9._]+@[A-Za-z0-9.]+").alias("has_email"),
    )


@query(
    "filter_last_n_days",
    f"SELECT event_id, ts FROM events WHERE ts >= DATE '{AS_OF_EVENTS}' - INTERVAL 7 DAY",
)
def filter_last_n_days(t):
    since = F.date_sub(F.lit(AS_OF_EVENTS).cast("date"), 7).cast("timestamp_ntz")
    return t.events.filter(F.col("ts") >= since).select("event_id", "ts")


@query(
    "bucket_value_category",
    """
    SELECT event_id, CASE WHEN value < 50 THEN 'low' WHEN value < 200 THEN 'medium' ELSE 'high' END
      AS value_category FROM events""",
)
def bucket_value_category(t):
    band = F.when(F.col("value") < 50, "low").when(F.col("value") < 200, "medium").otherwise("high")
    return t.events.select("event_id", band.alias("value_category"))


@query(
    "typed_cast",
    """
    SELECT o_orderkey, CAST(o_totalprice AS BIGINT) AS price_int,
           CAST(o_orderkey AS VARCHAR) AS key_text,
           CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date,
           TRY_CAST(left(o_orderpriority, 1) AS INTEGER) AS priority,
           TRY_CAST(o_orderstatus AS INTEGER) AS not_a_number
    FROM (SELECT * REPLACE (floor(o_totalprice) AS o_totalprice) FROM orders)""",
)
def typed_cast(t):
    return t.orders.select(
        "o_orderkey",
        F.floor("o_totalprice").cast("long").alias("price_int"),
        F.col("o_orderkey").cast("string").alias("key_text"),
        F.col("o_orderdate").cast("date").cast("string").alias("order_date"),
        F.col("o_orderpriority").substr(1, 1).try_cast("int").alias("priority"),
        F.col("o_orderstatus").try_cast("int").alias("not_a_number"),
    )


@query("distinct_users", "SELECT DISTINCT user_id, 'active' AS profile_status FROM events")
def distinct_users(t):
    return t.events.select("user_id").distinct().withColumn("profile_status", F.lit("active"))


@query(
    "dedup_latest_by_key",
    f"""
    WITH {BRONZE} SELECT event_id, ts, event_type FROM (
      SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ts DESC) AS rn FROM bronze)
    WHERE rn = 1""",
)
def dedup_latest_by_key(t):
    return latest_by(bronze_events(t), ["event_id"], [F.desc("ts")]).select("event_id", "ts", "event_type")


@query(
    "struct_fields",
    """
    SELECT o_orderkey, o_custkey AS customer_id, upper(c_name) AS customer_name, n_name AS nation
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
)
def struct_fields(t):
    who = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey",
        F.struct(
            F.col("c_name").alias("name"), F.struct(F.col("n_name").alias("nation")).alias("address")
        ).alias("identity"),
    )
    return t.orders.join(who, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey",
        F.col("o_custkey").alias("customer_id"),
        F.upper("identity.name").alias("customer_name"),
        F.col("identity.address.nation").alias("nation"),
    )


# --- joins ------------------------------------------------------------------


@query(
    "star_join_active_sales",
    f"""
    WITH {SALES} SELECT o_orderkey, c_custkey, tier, region, category, quantity, o_orderdate,
      CAST(revenue AS DOUBLE) AS revenue FROM sales""",
)
def star_join_active_sales(t):
    return sales(t).drop("o_orderstatus").withColumn("revenue", F.col("revenue").cast("double"))


@query(
    "left_join_fill",
    f"""
    SELECT c_custkey, coalesce(n, 0) AS order_count, coalesce(spent, 0) AS total_spend,
           CASE WHEN coalesce(n, 0) > 0 THEN failed * 1.0 / n ELSE 0.0 END AS failure_rate
    FROM customer LEFT JOIN (
      SELECT o_custkey, count(*) AS n, {msum('o_totalprice')} AS spent,
             CAST(count(*) FILTER (o_orderstatus = 'P') AS DOUBLE) AS failed
      FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1) ON o_custkey = c_custkey""",
)
def left_join_fill(t):
    urgent = t.orders.filter(F.col("o_orderpriority") == "1-URGENT")
    spend = urgent.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("order_count"),
        money_sum("o_totalprice").alias("total_spend"),
        count_where(F.col("o_orderstatus") == "P").alias("failed"),
    )
    filled = t.customer.select("c_custkey").join(spend, "c_custkey", "left").fillna(
        0, ["order_count", "total_spend", "failed"]
    )
    rate = F.when(F.col("order_count") > 0, F.col("failed") / F.col("order_count")).otherwise(0.0)
    return filled.withColumn("failure_rate", rate).drop("failed")


@query(
    "broadcast_join",
    """
    SELECT l_linestatus, s_name, count(*) AS n, CAST(sum(l_quantity) AS DOUBLE) AS qty
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY l_linestatus, s_name""",
)
def broadcast_join(t):
    supplier = broadcast_if_small(t.supplier.select("s_suppkey", "s_name"))
    return (
        t.lineitem.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("l_linestatus", "s_name")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("qty"))
    )


# Price list: a flag stands for a product code, prices change on 1 July 1998.
PRICES = [
    ("A", 0.10, "1990-01-01", "1998-07-01"),
    ("A", 0.12, "1998-07-01", None),
    ("N", 0.20, "1990-01-01", "1998-07-01"),
    ("N", 0.25, "1998-07-01", None),
    ("R", 0.05, "1990-01-01", None),
]
PRICES_SQL = """
prices(sku, list_price, price_start, price_end) AS (VALUES
  ('A', CAST(0.10 AS DECIMAL(18,2)), TIMESTAMP '1990-01-01', TIMESTAMP '1998-07-01'),
  ('A', CAST(0.12 AS DECIMAL(18,2)), TIMESTAMP '1998-07-01', NULL),
  ('N', CAST(0.20 AS DECIMAL(18,2)), TIMESTAMP '1990-01-01', TIMESTAMP '1998-07-01'),
  ('N', CAST(0.25 AS DECIMAL(18,2)), TIMESTAMP '1998-07-01', NULL),
  ('R', CAST(0.05 AS DECIMAL(18,2)), TIMESTAMP '1990-01-01', NULL))
"""


def price_list(spark):
    rows = inline_rows(spark, PRICES, "sku string, list_price double, price_start string, price_end string")
    return rows.select(
        "sku",
        F.col("list_price").cast("decimal(18,2)").alias("list_price"),
        F.col("price_start").cast("timestamp_ntz").alias("price_start"),
        F.col("price_end").cast("timestamp_ntz").alias("price_end"),
    )


def usage(t):
    """Usage records: shipped quantity per product code."""
    return t.lineitem.select(
        "l_orderkey",
        F.col("l_returnflag").alias("sku"),
        F.col("l_shipdate").alias("used_at"),
        F.col("l_quantity").cast("decimal(18,2)").alias("units"),
    )


USAGE_SQL = """
usage AS (SELECT l_orderkey, l_returnflag AS sku, l_shipdate AS used_at,
                 CAST(l_quantity AS DECIMAL(18,2)) AS units FROM lineitem)
"""


@query(
    "temporal_price_join",
    f"""
    WITH {PRICES_SQL}, {USAGE_SQL}
    SELECT sku, CAST(list_price AS DOUBLE) AS list_price, count(*) AS records,
           CAST(sum(units * list_price) AS DOUBLE) AS cost
    FROM usage JOIN prices USING (sku)
    WHERE price_start <= used_at AND (price_end IS NULL OR price_end > used_at)
    GROUP BY sku, list_price""",
)
def temporal_price_join(t):
    priced = validity_join(usage(t), price_list(t.spark), ["sku"], "used_at", "price_start", "price_end")
    return priced.groupBy("sku", F.col("list_price").cast("double").alias("list_price")).agg(
        F.count(F.lit(1)).alias("records"),
        F.sum(F.col("units") * F.col("list_price")).cast("double").alias("cost"),
    )


@query(
    "overlapping_windows",
    """
    SELECT p.event_id, count(e.event_id) AS open_windows, max(e.event_id) AS last_error
    FROM (SELECT * FROM events WHERE event_type = 'purchase') p
    LEFT JOIN (SELECT * FROM events WHERE event_type = 'error') e
      ON e.user_id = p.user_id AND e.ts <= p.ts AND e.ts + INTERVAL 2 DAY > p.ts
    GROUP BY p.event_id""",
)
def overlapping_windows(t):
    """Windows of two days that a user's errors open, and that are open at a purchase; they may overlap."""
    of = lambda kind: t.events.filter(F.col("event_type") == kind)
    windows = of("error").select(
        "user_id", F.col("event_id").alias("error_id"), F.col("ts").alias("opened"), (F.col("ts") + F.expr("INTERVAL 2 DAY")).alias("closed")
    )
    met = validity_join(of("purchase").select("event_id", "user_id", "ts"), windows, ["user_id"], "ts", "opened", "closed", "left")
    return met.groupBy("event_id").agg(F.count("error_id").alias("open_windows"), F.max("error_id").alias("last_error"))


@query(
    "asof_join_features",
    """
    SELECT c.event_id, c.user_id, c.ts, p.event_id AS purchase_id, p.value AS purchase_value
    FROM (SELECT * FROM events WHERE event_type = 'click') c
    ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') p
      ON c.user_id = p.user_id AND c.ts >= p.ts""",
)
def asof_join_features(t):
    ev = t.events
    clicks = ev.filter(F.col("event_type") == "click").select("event_id", "user_id", "ts")
    buys = ev.filter(F.col("event_type") == "purchase").select(
        "user_id", "ts", F.col("event_id").alias("purchase_id"), F.col("value").alias("purchase_value")
    )
    return asof_join(
        clicks, buys, ["user_id"], "ts", "ts", ["purchase_id", "purchase_value"], tie="purchase_id"
    )


@query(
    "feature_lookup",
    f"""
    SELECT o_orderkey, o_custkey, c_acctbal, c_mktsegment, coalesce(order_count, 0) AS order_count
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN (SELECT o_custkey AS k, count(*) AS order_count FROM orders GROUP BY 1) ON k = o_custkey""",
)
def lookup_features(t):
    profile = t.customer.withColumnRenamed("c_custkey", "o_custkey")
    behaviour = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("order_count"))
    return feature_lookup(
        t.orders.select("o_orderkey", "o_custkey"),
        [
            Lookup(profile, "o_custkey", ["c_acctbal", "c_mktsegment"]),
            Lookup(behaviour, "o_custkey", ["order_count"]),
        ],
        fill=0,
    )


@query(
    "lateral_topk",
    """
    SELECT c_custkey, o_orderkey, o_totalprice FROM (
      SELECT o_custkey AS c_custkey, o_orderkey, o_totalprice,
        row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn
      FROM orders JOIN customer ON o_custkey = c_custkey) WHERE rn <= 3""",
)
def lateral_topk_orders(t):
    return lateral_topk(
        t.customer.select("c_custkey"),
        t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice"),
        ["c_custkey"],
        [F.desc("o_totalprice"), F.asc("o_orderkey")],
        3,
    )


@query(
    "cte_region_share",
    f"""
    WITH {SALES}, monthly AS (
      SELECT region, strftime(o_orderdate, '%Y-%m') AS month, sum(revenue) AS revenue FROM sales GROUP BY 1, 2),
    totals AS (SELECT region, sum(revenue) AS total FROM monthly GROUP BY region)
    SELECT m.region, month, CAST(revenue AS DOUBLE) AS revenue, CAST(total AS DOUBLE) AS total_revenue,
           CAST(revenue AS DOUBLE) * 100.0 / CAST(total AS DOUBLE) AS pct_of_region_total
    FROM monthly m JOIN totals t ON m.region = t.region""",
)
def cte_region_share(t):
    sales(t).createOrReplaceTempView("active_sales")
    return t.spark.sql(
        """
        WITH monthly AS (
          SELECT region, date_format(o_orderdate, 'yyyy-MM') AS month, sum(revenue) AS revenue
          FROM active_sales GROUP BY 1, 2),
        totals AS (SELECT region, sum(revenue) AS total FROM monthly GROUP BY region)
        SELECT m.region, month, CAST(revenue AS DOUBLE) AS revenue,
               CAST(total AS DOUBLE) AS total_revenue,
               CAST(revenue AS DOUBLE) * 100.0D / CAST(total AS DOUBLE) AS pct_of_region_total
        FROM monthly m JOIN totals t ON m.region = t.region"""
    )


# --- aggregates -------------------------------------------------------------


@query(
    "gold_customer_spending",
    f"""SELECT o_custkey, {msum('o_totalprice')} AS total_spent, {mavg('o_totalprice')} AS avg_spent
    FROM orders GROUP BY o_custkey""",
)
def gold_customer_spending(t):
    return t.orders.groupBy("o_custkey").agg(
        money_sum("o_totalprice").alias("total_spent"), money_avg("o_totalprice").alias("avg_spent")
    )


@query("count_by_type", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type ORDER BY n DESC, event_type")
def count_by_type(t):
    return t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "event_type")


@query(
    "conditional_counts",
    f"""
    WITH {BRONZE} SELECT event_type, count(*) AS total_records,
      CAST(sum(CASE WHEN value > 0 THEN 1 ELSE 0 END) AS BIGINT) AS positive_values,
      count(CASE WHEN value <= 0 THEN 1 END) AS non_positive_values,
      coalesce(CAST(sum(CASE WHEN value > 50 THEN CAST(value AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE), 0) AS large_total
    FROM bronze GROUP BY event_type""",
)
def conditional_counts(t):
    v = F.col("value")
    return bronze_events(t).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("total_records"),
        F.sum(F.when(v > 0, 1).otherwise(0)).alias("positive_values"),
        F.count(F.when(v <= 0, 1)).alias("non_positive_values"),
        F.sum(F.when(v > 50, v.cast("decimal(18,2)")).otherwise(0)).cast("double").alias("large_total"),
    )


@query(
    "distinct_counts",
    """SELECT event_type, count(DISTINCT user_id) AS users, count(DISTINCT CAST(ts AS DATE)) AS days
    FROM events GROUP BY event_type""",
)
def distinct_counts(t):
    return t.events.groupBy("event_type").agg(
        F.count_distinct("user_id").alias("users"), F.count_distinct(F.to_date("ts")).alias("days")
    )


@query(
    "daily_p95",
    """
    SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date, event_type,
           quantile_disc(value, 0.95) AS p95_value
    FROM events GROUP BY 1, 2""",
)
def daily_p95(t):
    rows = t.events.select(F.to_date("ts").cast("string").alias("event_date"), "event_type", "value")
    found = exact_quantiles(rows, ["event_date", "event_type"], "value", ["0.95"])
    return found.select("event_date", "event_type", F.col("quantiles")[0].alias("p95_value"))


@query(
    "stats_by_group",
    """
    SELECT p_type, p_brand, min(p_size) AS min_size, max(p_size) AS max_size,
           max(p_retailprice) AS max_price, round(coalesce(stddev_samp(p_retailprice), 0), 4) AS price_spread
    FROM part GROUP BY p_type, p_brand""",
)
def stats_by_group(t):
    return (
        t.part.groupBy("p_type", "p_brand")
        .agg(
            F.min("p_size").alias("min_size"),
            F.max("p_size").alias("max_size"),
            F.max("p_retailprice").alias("max_price"),
            F.round(F.stddev("p_retailprice"), 4).alias("price_spread"),
        )
        .fillna(0, ["price_spread"])
    )


@query(
    "monthly_revenue",
    f"""
    SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month, count(*) AS orders,
           {msum('o_totalprice')} AS revenue FROM orders GROUP BY 1""",
)
def monthly_revenue(t):
    month = F.date_format(F.date_trunc("month", "o_orderdate"), "yyyy-MM-dd")
    return t.orders.groupBy(month.alias("month")).agg(
        F.count(F.lit(1)).alias("orders"), money_sum("o_totalprice").alias("revenue")
    )


@query(
    "success_rate",
    """
    SELECT o_orderpriority AS job, count(*) AS total_runs,
           CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS successful,
           CAST(count(*) FILTER (o_orderstatus = 'F') AS DOUBLE) * 100.0 / count(*) AS success_rate_pct
    FROM orders GROUP BY 1""",
)
def success_rate(t):
    ok = F.sum(F.when(F.col("o_orderstatus") == "F", 1).otherwise(0))
    runs = t.orders.groupBy(F.col("o_orderpriority").alias("job")).agg(
        F.count(F.lit(1)).alias("total_runs"), ok.alias("successful")
    )
    return runs.withColumn("success_rate_pct", pct(F.col("successful"), F.col("total_runs")))


@query(
    "gold_daily_metrics",
    f"""
    WITH {SILVER} SELECT event_date, event_type, is_weekend, count(*) AS event_count,
      count(DISTINCT user_id) AS unique_users, {msum('value')} AS total_value,
      {mavg('value')} AS avg_value, quantile_disc(value, 0.95) AS p95_value
    FROM silver GROUP BY event_date, event_type, is_weekend""",
)
def gold_daily_metrics(t):
    keys = ["event_date", "event_type", "is_weekend"]
    rows = silver_events(t)
    daily = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("event_count"),
        F.count_distinct("user_id").alias("unique_users"),
        money_sum("value").alias("total_value"),
        money_avg("value").alias("avg_value"),
    )
    # One row per day, type and weekend mark: a group without any value keeps its row.
    high = exact_quantiles(rows, keys, "value", ["0.95"]).withColumn("p95_value", F.col("quantiles")[0])
    return daily.join(high.drop("quantiles"), keys, "left")


@query(
    "gold_user_activity",
    f"""
    WITH {SILVER} SELECT event_date, user_id, count(*) AS daily_event_count,
      count(DISTINCT event_type) AS event_type_variety, {msum('value')} AS daily_total_value,
      max(ts) AS last_activity,
      CASE WHEN count(*) >= 10 THEN 'power_user' WHEN count(*) >= 3 THEN 'regular_user'
           ELSE 'casual_user' END AS activity_tier
    FROM silver GROUP BY event_date, user_id""",
)
def gold_user_activity(t):
    n = F.col("daily_event_count")
    return (
        silver_events(t)
        .groupBy("event_date", "user_id")
        .agg(
            F.count(F.lit(1)).alias("daily_event_count"),
            F.count_distinct("event_type").alias("event_type_variety"),
            money_sum("value").alias("daily_total_value"),
            F.max("ts").alias("last_activity"),
        )
        .withColumn(
            "activity_tier",
            F.when(n >= 10, "power_user").when(n >= 3, "regular_user").otherwise("casual_user"),
        )
    )


@query(
    "null_counts",
    f"""
    WITH {BRONZE} SELECT count(*) FILTER (event_id IS NULL) AS event_id, count(*) FILTER (ts IS NULL) AS ts,
      count(*) FILTER (user_id IS NULL) AS user_id, count(*) FILTER (event_type IS NULL) AS event_type,
      count(*) FILTER (value IS NULL) AS value, count(*) FILTER (props IS NULL) AS props FROM bronze""",
)
def null_counts(t):
    df = bronze_events(t)
    return df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in df.columns])


REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


@query(
    "pivot_region_revenue",
    f"WITH {SALES} SELECT category, "
    + ", ".join(
        f"CAST(sum(CASE WHEN region = '{r}' THEN revenue END) AS DOUBLE) AS \"{r.replace(' ', '_')}\""
        for r in REGIONS
    )
    + " FROM sales GROUP BY category",
)
def pivot_region_revenue(t):
    # Named values: no extra job to find them, one aggregate pass.
    wide = sales(t).groupBy("category").pivot("region", REGIONS).agg(F.sum("revenue").cast("double"))
    return wide.withColumnsRenamed({r: r.replace(" ", "_") for r in REGIONS})


@query(
    "unpivot_metrics",
    f"""
    SELECT event_type, metric, value FROM (
      SELECT event_type, min(value) AS min_value, max(value) AS max_value, {msum('value')} AS total_value
      FROM events GROUP BY event_type)
    UNPIVOT (value FOR metric IN (min_value, max_value, total_value))""",
)
def unpivot_metrics(t):
    wide = t.events.groupBy("event_type").agg(
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        money_sum("value").alias("total_value"),
    )
    return wide.unpivot("event_type", ["min_value", "max_value", "total_value"], "metric", "value")


@query(
    "cost_by_tag",
    """
    SELECT tag_key, tag_value, CAST(sum(l_quantity) AS DOUBLE) AS units FROM (
      SELECT 'flag' AS tag_key, l_returnflag AS tag_value, l_quantity FROM lineitem
      UNION ALL SELECT 'status', l_linestatus, l_quantity FROM lineitem) GROUP BY 1, 2""",
)
def cost_by_tag(t):
    tags = F.create_map(F.lit("flag"), F.col("l_returnflag"), F.lit("status"), F.col("l_linestatus"))
    return (
        t.lineitem.select("l_quantity", F.explode(tags).alias("tag_key", "tag_value"))
        .groupBy("tag_key", "tag_value")
        .agg(F.sum("l_quantity").alias("units"))
    )


# --- sorts, limits, sets ----------------------------------------------------


@query(
    "sort_multi_key",
    "SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM orders ORDER BY o_custkey, o_orderdate DESC, o_orderkey",
)
def sort_multi_key(t):
    return t.orders.select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice").orderBy(
        "o_custkey", F.desc("o_orderdate"), "o_orderkey"
    )


@query(
    "top_users_by_value",
    f"""SELECT user_id, {msum('value')} AS total_value, count(*) AS events FROM events
    GROUP BY user_id ORDER BY total_value DESC, user_id LIMIT 5""",
)
def top_users_by_value(t):
    per_user = t.events.groupBy("user_id").agg(
        money_sum("value").alias("total_value"), F.count(F.lit(1)).alias("events")
    )
    return per_user.orderBy(F.desc("total_value"), "user_id").limit(5)


@query(
    "slowest_n",
    """SELECT doc_id, n_chars, left(text, 120) AS preview FROM documents
    ORDER BY n_chars DESC, doc_id LIMIT 10""",
)
def slowest_n(t):
    return (
        t.documents.select("doc_id", "n_chars", F.left("text", F.lit(120)).alias("preview"))
        .orderBy(F.desc("n_chars"), "doc_id")
        .limit(10)
    )


@query(
    "union_all",
    """SELECT c_custkey AS party_id, c_name AS name, c_acctbal AS balance, 'customer' AS kind FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_acctbal, 'supplier' FROM supplier""",
)
def union_all(t):
    customers = t.customer.select(
        F.col("c_custkey").alias("party_id"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"),
        F.lit("customer").alias("kind"),
    )
    suppliers = t.supplier.select(
        F.lit("supplier").alias("kind"),
        F.col("s_acctbal").alias("balance"),
        F.col("s_suppkey").alias("party_id"),
        F.col("s_name").alias("name"),
    )
    return customers.unionByName(suppliers)


# --- scalar functions -------------------------------------------------------


@query(
    "str_clean",
    r"""SELECT doc_id, upper(trim(lang)) AS lang, lower(source) AS source,
      md5(trim(regexp_replace(text, '[ \t\n\r\f]+', ' ', 'g'))) AS text_md5,
      length(trim(regexp_replace(text, '[ \t\n\r\f]+', ' ', 'g'))) AS chars,
      concat(source, '/', CAST(doc_id AS VARCHAR)) AS ref FROM documents""",
)
def str_clean(t):
    clean = F.trim(F.regexp_replace("text", r"[ \t\n\r\f]+", " "))
    return t.documents.select(
        "doc_id",
        F.upper(F.trim("lang")).alias("lang"),
        F.lower("source").alias("source"),
        F.md5(clean).alias("text_md5"),
        F.length(clean).cast("long").alias("chars"),
        F.concat("source", F.lit("/"), F.col("doc_id").cast("string")).alias("ref"),
    )


@query(
    "str_mask_parts",
    """SELECT c_custkey, substring(c_name, 1, 2) AS head, right(c_name, 4) AS tail,
      split_part(c_name, '#', 2) AS number, left(c_mktsegment, 3) AS seg,
      c_mktsegment || ':' || c_name AS joined FROM customer""",
)
def str_mask_parts(t):
    return t.customer.select(
        "c_custkey",
        F.substring("c_name", 1, 2).alias("head"),
        F.substring("c_name", -4, 4).alias("tail"),
        F.split("c_name", "#")[1].alias("number"),
        F.left("c_mktsegment", F.lit(3)).alias("seg"),
        F.concat_ws(":", "c_mktsegment", "c_name").alias("joined"),
    )


@query(
    "date_parts",
    """SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date, CAST(hour(ts) AS BIGINT) AS event_hour,
      CAST(dayofweek(ts) + 1 AS BIGINT) AS day_of_week, dayofweek(ts) IN (0, 6) AS is_weekend,
      date_trunc('hour', ts) AS hour_start FROM (SELECT event_id, CAST(ts AS TIMESTAMP) AS ts FROM events)""",
)
def date_parts(t):
    return t.events.select(
        "event_id",
        F.to_date("ts").cast("string").alias("event_date"),
        F.hour("ts").cast("long").alias("event_hour"),
        F.dayofweek("ts").cast("long").alias("day_of_week"),
        F.dayofweek("ts").isin(1, 7).alias("is_weekend"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour_start"),
    )


@query(
    "date_arith",
    f"""SELECT o_orderkey, CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '{AS_OF_ORDERS}') AS BIGINT) AS age_days,
      CAST(CAST(o_orderdate AS DATE) + 30 AS VARCHAR) AS due, o_orderdate + INTERVAL 30 SECOND AS soon,
      CAST(CAST(o_orderdate - INTERVAL 1 MONTH AS DATE) AS VARCHAR) AS month_before FROM orders""",
)
def date_arith(t):
    day = F.col("o_orderdate").cast("date")
    return t.orders.select(
        "o_orderkey",
        F.datediff(F.lit(AS_OF_ORDERS).cast("date"), day).cast("long").alias("age_days"),
        F.date_add(day, 30).cast("string").alias("due"),
        (F.col("o_orderdate") + F.expr("INTERVAL 30 SECOND")).alias("soon"),
        F.add_months(day, -1).cast("string").alias("month_before"),
    )


@query(
    "math_exprs",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate,
      l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge,
      abs(l_discount - l_tax) AS gap, CAST(l_orderkey % 7 AS BIGINT) AS rest,
      CAST(floor(l_extendedprice / l_quantity) AS BIGINT) AS unit_price,
      round(l_quantity / 7, 6) AS weeks FROM lineitem""",
)
def math_exprs(t):
    price, disc, tax = F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")
    return t.lineitem.select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        "l_shipdate",
        (price * (1 - disc) * (1 + tax)).alias("charge"),
        F.abs(disc - tax).alias("gap"),
        (F.col("l_orderkey") % 7).alias("rest"),
        F.floor(price / F.col("l_quantity")).alias("unit_price"),
        F.round(F.col("l_quantity") / 7, 6).alias("weeks"),
    )


@query(
    "array_ops",
    """SELECT doc_id, len(words) AS n_words, words[1] AS first_word, words[-1] AS last_word,
      list_aggregate(list_transform(words, lambda x: length(x)), 'sum')::BIGINT AS letters,
      len(list_distinct(words)) AS n_distinct, list_contains(words, 'the') AS has_the
    FROM (SELECT doc_id, string_split(lower(text), ' ') AS words FROM documents)""",
)
def array_ops(t):
    words = t.documents.select("doc_id", F.split(F.lower("text"), " ").alias("words"))
    return words.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.element_at("words", 1).alias("first_word"),
        F.element_at("words", -1).alias("last_word"),
        F.aggregate("words", F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("letters"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
        F.array_contains("words", "the").alias("has_the"),
    )


@query(
    "struct_map_ops",
    """SELECT c_custkey, c_name AS who, c_mktsegment AS segment, CAST(n_regionkey AS VARCHAR) AS region_code,
      n_name AS nation FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def struct_map_ops(t):
    joined = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    packed = joined.select(
        "c_custkey",
        F.struct(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")).alias("who"),
        F.map_from_entries(
            F.array(
                F.struct(
                    F.lit("region").alias("key"), F.col("n_regionkey").cast("string").alias("value")
                ),
                F.struct(F.lit("nation").alias("key"), F.col("n_name").alias("value")),
            )
        ).alias("place"),
    )
    return packed.select(
        "c_custkey",
        F.col("who.name").alias("who"),
        F.col("who.segment").alias("segment"),
        F.col("place")["region"].alias("region_code"),
        F.col("place")["nation"].alias("nation"),
    )


@query(
    "json_extract_props",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
      json_extract_string(props, '$.missing') AS missing FROM events""",
)
def json_extract_props(t):
    return t.events.select(
        "event_id",
        F.from_json("props", "k long")["k"].alias("k"),
        F.get_json_object("props", "$.missing").alias("missing"),
    )
