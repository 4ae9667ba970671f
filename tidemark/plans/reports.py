"""Views, refreshable aggregates, SQL functions, dashboards and cost reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from tidemark.functions.measures import money_avg, money_sum, pct
from tidemark.operators import quality as dq
from tidemark.operators.validity import validity_join
from tidemark.plans.inputs import AS_OF_EVENTS, AS_OF_ORDERS, SALES, columns_of, mavg, msum, sales
from tidemark.plans.registry import query
from tidemark.plans.relational import PRICES_SQL, USAGE_SQL, price_list, usage
from tidemark.plans.spec import run_spec
from tidemark.session import TABLES, inline_rows

# --- views ------------------------------------------------------------------


@query(
    "view_revenue_by_tier",
    f"WITH {SALES} SELECT tier, CAST(sum(revenue) AS DOUBLE) AS total_revenue, count(*) AS order_count FROM sales GROUP BY tier",
)
def view_revenue_by_tier(t):
    """A temporary view on a view."""
    sales(t).createOrReplaceTempView("v_active_sales")
    t.spark.sql(
        """CREATE OR REPLACE TEMP VIEW tv_revenue_by_tier AS
        SELECT tier, CAST(sum(revenue) AS DOUBLE) AS total_revenue, count(*) AS order_count
        FROM v_active_sales GROUP BY tier"""
    )
    return t.spark.table("tv_revenue_by_tier")


@query(
    "view_category_sales",
    f"WITH {SALES} SELECT category, count(*) AS order_count, CAST(sum(revenue) AS DOUBLE) / count(*) AS avg_revenue FROM sales GROUP BY category",
)
def view_category_sales(t):
    """A global temporary view, visible to every session of the application."""
    by = sales(t).groupBy("category").agg(
        F.count(F.lit(1)).alias("order_count"),
        (F.sum("revenue").cast("double") / F.count(F.lit(1))).alias("avg_revenue"),
    )
    by.createOrReplaceGlobalTempView("gv_category_sales")
    return t.spark.newSession().table("global_temp.gv_category_sales")


MV = f"""WITH {SALES} SELECT region, tier, category, strftime(o_orderdate, '%Y-%m') AS order_month, count(*) AS order_count,
  CAST(sum(quantity) AS DOUBLE) AS total_quantity, CAST(sum(revenue) AS DOUBLE) AS total_revenue FROM sales GROUP BY 1, 2, 3, 4"""


def monthly_sales(rows: DataFrame) -> DataFrame:
    return rows.groupBy("region", "tier", "category", F.date_format("o_orderdate", "yyyy-MM").alias("order_month")).agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum("quantity").alias("total_quantity"),
        F.sum("revenue").cast("double").alias("total_revenue"),
    )


@query("mv_sales", MV)
def mv_sales(t):
    path = t.folder("mv-sales")
    monthly_sales(sales(t)).write.mode("overwrite").parquet(path)
    return t.spark.read.parquet(path)


@query("mv_incremental_refresh", MV)
def mv_incremental_refresh(t):
    """Orders from 2001 on arrive late; only the months they touch are computed again and replaced."""
    path = t.folder("mv-refresh")
    late = F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz")
    everything = sales(t)
    monthly_sales(everything.filter(~late)).write.partitionBy("order_month").parquet(path)
    touched = t.orders.filter(late).select(F.date_format("o_orderdate", "yyyy-MM").alias("m")).distinct()
    month = F.date_format("o_orderdate", "yyyy-MM")
    again = everything.withColumn("m", month).join(touched, "m", "left_semi")
    (
        monthly_sales(again)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("order_month")
        .parquet(path)
    )
    back = t.spark.read.option("basePath", path).parquet(path)
    return back.withColumn("order_month", F.col("order_month").cast("string"))


# --- SQL functions ----------------------------------------------------------


@query(
    "udf_sql_tier",
    """SELECT c_custkey, CASE WHEN c_custkey < 50 THEN 'Bronze' WHEN c_custkey < 100 THEN 'Silver'
      WHEN c_custkey < 150 THEN 'Gold' ELSE 'Platinum' END AS tier FROM customer""",
)
def udf_sql_tier(t):
    t.views("customer")
    t.spark.sql(
        """CREATE OR REPLACE TEMPORARY FUNCTION customer_tier(id BIGINT) RETURNS STRING
        RETURN CASE WHEN id < 50 THEN 'Bronze' WHEN id < 100 THEN 'Silver' WHEN id < 150 THEN 'Gold'
               ELSE 'Platinum' END"""
    )
    return t.spark.sql("SELECT c_custkey, customer_tier(c_custkey) AS tier FROM customer")


@query(
    "udtf_month_revenue",
    f"""SELECT strftime(o_orderdate, '%Y-%m') AS month, {msum('o_totalprice')} AS total_revenue, count(*) AS order_count
    FROM orders GROUP BY 1""",
)
def udtf_month_revenue(t):
    """The table function is called for every month there is."""
    t.views("orders")
    t.spark.sql(
        """CREATE OR REPLACE TEMPORARY FUNCTION month_revenue(m STRING)
        RETURNS TABLE (total_revenue DOUBLE, order_count BIGINT)
        RETURN SELECT CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE), count(*)
               FROM orders WHERE date_format(o_orderdate, 'yyyy-MM') = m"""
    )
    return t.spark.sql(
        """SELECT month, total_revenue, order_count
        FROM (SELECT DISTINCT date_format(o_orderdate, 'yyyy-MM') AS month FROM orders) AS months,
             LATERAL month_revenue(months.month)"""
    )


# --- configured flow --------------------------------------------------------

CLICK_SPEC = [
    {"name": "ranked", "op": "sort", "inputs": ["summary"], "by": ["-total_value", "user_id"]},
    {"name": "events", "op": "source", "table": "events"},
    {"name": "clicks", "op": "filter", "inputs": ["events"], "condition": "event_type = 'click'"},
    {"name": "users", "op": "source", "table": "customer"},
    {"name": "profile", "op": "select", "inputs": ["users"], "columns": ["c_custkey AS user_id", "c_mktsegment AS tier"]},
    {"name": "joined", "op": "join", "inputs": ["clicks", "profile"], "on": "user_id", "how": "left"},
    {"name": "exact", "op": "derive", "inputs": ["joined"], "columns": {"cents": "CAST(value AS DECIMAL(18,2))"}},
    {
        "name": "totals",
        "op": "aggregate",
        "inputs": ["exact"],
        "by": ["user_id", "tier"],
        "aggregates": [
            {"fn": "count", "as": "click_count"},
            {"fn": "sum", "column": "cents", "as": "cents"},
            {"fn": "max", "column": "value", "as": "max_value"},
        ],
    },
    {
        "name": "summary",
        "op": "select",
        "inputs": ["totals"],
        "columns": ["user_id", "tier", "click_count", "CAST(cents AS DOUBLE) AS total_value", "max_value"],
    },
]


@query(
    "spec_click_summary",
    f"""SELECT user_id, c_mktsegment AS tier, count(*) AS click_count, {msum('value')} AS total_value, max(value) AS max_value
    FROM events LEFT JOIN customer ON user_id = c_custkey WHERE event_type = 'click' GROUP BY 1, 2""",
)
def spec_click_summary(t):
    return run_spec(CLICK_SPEC, {"events": t.events, "customer": t.customer})["ranked"]


# --- dashboards -------------------------------------------------------------


@query("kpi_total_customers", f"SELECT count(*) AS total_customers, {mavg('c_acctbal')} AS avg_balance FROM customer")
def kpi_total_customers(t):
    return t.customer.agg(F.count(F.lit(1)).alias("total_customers"), money_avg("c_acctbal").alias("avg_balance"))


SPENT = f"SELECT o_custkey, {msum('o_totalprice')} AS total_spent FROM orders GROUP BY o_custkey"


@query(
    "above_avg_customers",
    f"WITH s AS ({SPENT}) SELECT * FROM s WHERE total_spent > (SELECT sum(CAST(total_spent AS DECIMAL(38,2)))::DOUBLE / count(*) FROM s)",
)
def above_avg_customers(t):
    spent = t.orders.groupBy("o_custkey").agg(money_sum("o_totalprice").alias("total_spent"))
    mean = (
        t.orders.agg(money_sum("o_totalprice") / F.count_distinct("o_custkey"))
    ).scalar()
    return spent.filter(F.col("total_spent") > mean)


@query(
    "monthly_trend",
    f"""SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS orders, {msum('o_totalprice')} AS revenue
    FROM orders WHERE o_orderstatus = 'F' GROUP BY 1""",
)
def monthly_trend(t):
    """A dashboard dataset with its parameter bound, not pasted into the text."""
    t.views("orders")
    return t.spark.sql(
        """SELECT date_format(o_orderdate, 'yyyy-MM') AS month, count(*) AS orders,
             CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
        FROM orders WHERE o_orderstatus = :status GROUP BY 1""",
        args={"status": "F"},
    )


# --- cost and usage ---------------------------------------------------------

PRICED = f"""{PRICES_SQL}, {USAGE_SQL}, priced AS (
  SELECT l_orderkey, sku, used_at, units, units * list_price AS cost FROM usage JOIN prices USING (sku)
  WHERE price_start <= used_at AND (price_end IS NULL OR price_end > used_at))"""


def priced_usage(t) -> DataFrame:
    rows = validity_join(usage(t), price_list(t.spark), ["sku"], "used_at", "price_start", "price_end")
    return rows.withColumn("cost", F.col("units") * F.col("list_price"))


def priced_days(t) -> DataFrame:
    """Usage summed per product code and day before it meets the prices, which change by day."""
    day = F.to_date("used_at").cast("timestamp_ntz").alias("used_at")
    daily = usage(t).groupBy("sku", day).agg(F.sum("units").alias("units"))
    rows = validity_join(daily, price_list(t.spark), ["sku"], "used_at", "price_start", "price_end")
    return rows.withColumn("cost", F.col("units") * F.col("list_price"))


def _cost():
    return [F.sum("units").cast("double").alias("units"), F.sum("cost").cast("double").alias("cost")]


_COST = "CAST(sum(units) AS DOUBLE) AS units, CAST(sum(cost) AS DOUBLE) AS cost"


@query("daily_cost", f"WITH {PRICED} SELECT CAST(CAST(used_at AS DATE) AS VARCHAR) AS day, sku, {_COST} FROM priced GROUP BY 1, 2")
def daily_cost(t):
    return priced_days(t).groupBy(F.to_date("used_at").cast("string").alias("day"), "sku").agg(*_cost())


@query(
    "cost_by_sku",
    f"WITH {PRICED} SELECT sku, {_COST} FROM priced WHERE used_at >= DATE '{AS_OF_ORDERS}' - INTERVAL 365 DAY GROUP BY sku ORDER BY cost DESC, sku LIMIT 10",
)
def cost_by_sku(t):
    since = F.date_sub(F.lit(AS_OF_ORDERS).cast("date"), 365).cast("timestamp_ntz")
    return (
        priced_days(t).filter(F.col("used_at") >= since).groupBy("sku").agg(*_cost()).orderBy(F.desc("cost"), "sku").limit(10)
    )


@query(
    "job_cost",
    f"""WITH {PRICED} SELECT o_orderpriority AS job, count(DISTINCT l_orderkey) AS runs, {_COST}
    FROM priced JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""",
)
def job_cost(t):
    """Cost per job: usage is summed per run before it meets the run table."""
    per_run = priced_usage(t).groupBy("l_orderkey").agg(F.sum("units").alias("units"), F.sum("cost").alias("cost"))
    return (
        per_run.join(t.orders.select("o_orderkey", "o_orderpriority"), F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("o_orderpriority").alias("job"))
        .agg(F.count(F.lit(1)).alias("runs"), *_cost())
    )


BUDGETS = [("A", 300.0), ("N", 900.0), ("R", 120.0)]


@query(
    "budget_status",
    f"""WITH {PRICED}, budgets(sku, budget) AS (VALUES ('A', 300.0::DOUBLE), ('N', 900.0::DOUBLE), ('R', 120.0::DOUBLE)),
    d AS (SELECT sku, strftime(used_at, '%Y-%m') AS month, CAST(CAST(used_at AS DATE) AS VARCHAR) AS day, sum(cost) AS cost FROM priced GROUP BY 1, 2, 3)
    SELECT sku, month, day, CAST(sum(cost) OVER w AS DOUBLE) AS spent, budget,
      CASE WHEN CAST(sum(cost) OVER w AS DOUBLE) > budget THEN 'over' WHEN CAST(sum(cost) OVER w AS DOUBLE) > budget * 0.8 THEN 'near' ELSE 'ok' END AS state
    FROM d JOIN budgets USING (sku) WINDOW w AS (PARTITION BY sku, month ORDER BY day)""",
)
def budget_status(t):
    """Spend so far in the month against the budget; at most 31 daily sums per window."""
    daily = (
        priced_days(t)
        .groupBy("sku", F.date_format("used_at", "yyyy-MM").alias("month"), F.to_date("used_at").cast("string").alias("day"))
        .agg(F.sum("cost").alias("cost"))
    )
    budgets = inline_rows(t.spark, BUDGETS, "sku string, budget double")
    so_far = F.sum("cost").over(W.partitionBy("sku", "month").orderBy("day")).cast("double")
    state = F.when(F.col("spent") > F.col("budget"), "over").when(F.col("spent") > F.col("budget") * 0.8, "near").otherwise("ok")
    return daily.withColumn("spent", so_far).join(budgets, "sku").withColumn("state", state).drop("cost")


@query(
    "daily_spend_trend",
    f"""WITH {PRICED}, d AS (SELECT CAST(CAST(used_at AS DATE) AS VARCHAR) AS day, sku, sum(units) AS units FROM priced GROUP BY 1, 2)
    SELECT day, sku, CAST(units AS DOUBLE) AS units, CAST(units - lag(units) OVER (PARTITION BY sku ORDER BY day) AS DOUBLE) AS change FROM d""",
)
def daily_spend_trend(t):
    """Daily sums first: the window then sees one row per product code and day."""
    daily = usage(t).groupBy(F.to_date("used_at").cast("string").alias("day"), "sku").agg(F.sum("units").alias("units"))
    before = F.lag("units").over(W.partitionBy("sku").orderBy("day"))
    return daily.withColumn("change", (F.col("units") - before).cast("double")).withColumn(
        "units", F.col("units").cast("double")
    )


@query(
    "query_count_by_user",
    f"""SELECT user_id, count(*) AS query_count, {msum('value')} AS total_seconds FROM events
    WHERE ts >= DATE '{AS_OF_EVENTS}' - INTERVAL 7 DAY GROUP BY 1 ORDER BY query_count DESC, user_id LIMIT 10""",
)
def query_count_by_user(t):
    since = F.date_sub(F.lit(AS_OF_EVENTS).cast("date"), 7).cast("timestamp_ntz")
    return (
        t.events.filter(F.col("ts") >= since)
        .groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("query_count"), money_sum("value").alias("total_seconds"))
        .orderBy(F.desc("query_count"), "user_id")
        .limit(10)
    )


@query(
    "flow_events",
    """SELECT event_type, count(*) AS n, max(ts) AS latest, arg_max(event_id, (ts, event_id)) AS latest_id FROM events GROUP BY 1""",
)
def flow_events(t):
    return t.events.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.max("ts").alias("latest"), F.max_by("event_id", F.struct("ts", "event_id")).alias("latest_id")
    )


@query(
    "ticket_analytics",
    """SELECT o_orderpriority AS priority, o_orderstatus AS status, count(*) AS ticket_count,
      count(DISTINCT o_custkey) AS affected_customers FROM orders GROUP BY 1, 2""",
)
def ticket_analytics(t):
    return t.orders.groupBy(F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status")).agg(
        F.count(F.lit(1)).alias("ticket_count"), F.count_distinct("o_custkey").alias("affected_customers")
    )


@query(
    "recent_runs",
    f"""SELECT l.l_orderkey AS run_id, o_orderstatus AS state, o_orderdate AS started, CAST(date_diff('day', o_orderdate, ended) AS INTEGER) AS days
    FROM orders JOIN (SELECT l_orderkey, max(l_shipdate) AS ended FROM lineitem GROUP BY 1) l ON l.l_orderkey = o_orderkey
    WHERE o_orderdate >= DATE '2000-12-31' - INTERVAL 365 DAY ORDER BY started DESC, run_id LIMIT 20""",
)
def recent_runs(t):
    since = F.date_sub(F.lit("2000-12-31").cast("date"), 365).cast("timestamp_ntz")
    ended = t.lineitem.groupBy(F.col("l_orderkey").alias("run_id")).agg(F.max("l_shipdate").alias("ended"))
    runs = t.orders.filter(F.col("o_orderdate") >= since).select(
        F.col("o_orderkey").alias("run_id"), F.col("o_orderstatus").alias("state"), F.col("o_orderdate").alias("started")
    )
    return (
        runs.join(ended, "run_id")
        .withColumn("days", F.datediff("ended", "started"))
        .drop("ended")
        .orderBy(F.desc("started"), "run_id")
        .limit(20)
    )


@query(
    "column_catalog",
    " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, CAST({i} AS INTEGER) AS position, '{c}' AS column_name, '{kind}' AS data_type, count(*) AS rows, "
        f"(count(*) - count({c})) / count(*) AS null_rate, count(DISTINCT {c}) AS n_distinct FROM {table}"
        for table in TABLES
        for i, (c, kind) in enumerate(columns_of(table))
    ),
)
def column_catalog(t):
    """Schema of every table beside what its columns hold."""
    out = None
    for table in TABLES:
        df = getattr(t, table)
        fields = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
        schema = inline_rows(t.spark, fields, "position int, column_name string, data_type string")
        found = dq.profile(df, exact_distinct=True).select("column_name", "rows", "null_rate", "n_distinct")
        part = schema.join(found, "column_name").withColumn("table_name", F.lit(table))
        out = part if out is None else out.unionByName(part)
    return out
