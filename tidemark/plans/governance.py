"""Access policies, masking, PII tagging, audit and lineage queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemark.functions.measures import count_where
from tidemark.operators import governance as gov
from tidemark.plans.inputs import AS_OF_EVENTS, columns_of
from tidemark.plans.registry import query
from tidemark.session import TABLES, spread


@query(
    "row_filter_region",
    """SELECT o_orderkey, c_custkey, r_name AS region, o_totalprice FROM orders
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
    WHERE r_name IN (SELECT r.r_name FROM supplier JOIN nation n ON s_nationkey = n.n_nationkey
      JOIN region r ON n.n_regionkey = r.r_regionkey WHERE s_name = 'Supplier#000000003')""",
)
def row_filter_region(t):
    """A user (here a supplier) sees the orders of the own region."""
    place = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    grants = t.supplier.join(place, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_name").alias("user"), F.col("r_name").alias("value")
    )
    orders = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(place, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("o_orderkey", "c_custkey", F.col("r_name").alias("region"), "o_totalprice")
    )
    return gov.row_policy(orders, "region", "Supplier#000000003", grants)


@query(
    "mask_columns",
    """SELECT c_custkey, left(email, 2) || '***@' || split_part(email, '@', 2) AS email,
      '***-***-' || right(phone, 4) AS phone, CASE WHEN salary IS NOT NULL THEN '***' END AS salary, '***-**-****' AS ssn
    FROM (SELECT c_custkey, lower(replace(c_name, '#', '.')) || '@' || lower(c_mktsegment) || '.example' AS email,
      '+1-555-' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS phone, c_acctbal AS salary FROM customer)""",
)
def mask_customer(t):
    people = t.customer.select(
        "c_custkey",
        F.concat(
            F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@"), F.lower("c_mktsegment"), F.lit(".example")
        ).alias("email"),
        F.concat(F.lit("+1-555-"), F.lpad(F.col("c_custkey").cast("string"), 10, "0")).alias("phone"),
        F.col("c_acctbal").cast("string").alias("salary"),
        F.lpad(F.col("c_custkey").cast("string"), 9, "0").alias("ssn"),
    )
    return gov.mask_columns(
        people, {"email": "email", "phone": "phone", "salary": "salary", "ssn": "ssn"}, groups=["analysts"]
    )


_TAGS = " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, '{c}' AS column_name, '{k}' AS kind, "
    f"count(*) FILTER (regexp_matches({c}, '{rx}')) / count(*) AS hit_rate FROM {table}"
    for table in TABLES
    for c, kind in columns_of(table)
    if kind == "string"
    for k, rx in gov.PII_PATTERNS.items()
)


def _tags(t):
    """Every text column of every table, by the schemas; one pass per table."""
    out = None
    for table in TABLES:
        df = getattr(t, table)
        text = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
        if text:
            part = gov.classify_columns(spread(df.select(*text)), table)
            out = part if out is None else out.unionByName(part)
    return out


@query("classify_pii_columns", f"SELECT *, hit_rate >= 0.01 AS pii FROM ({_TAGS})")
def classify_pii_columns(t):
    return _tags(t)


@query(
    "pii_columns",
    f"SELECT table_name, column_name, string_agg(kind, ',' ORDER BY kind) AS kinds FROM ({_TAGS}) WHERE hit_rate >= 0.01 GROUP BY 1, 2",
)
def pii_columns(t):
    # At most one entry per pattern in a list.
    return (
        _tags(t)
        .filter("pii")
        .groupBy("table_name", "column_name")
        .agg(F.array_join(F.sort_array(F.collect_set("kind")), ",").alias("kinds"))
    )


@query(
    "audit_by_action",
    f"""SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date, event_type AS action, count(*) AS event_count,
      count(*) FILTER (value < 5) AS small FROM events
    WHERE ts >= DATE '{AS_OF_EVENTS}' - INTERVAL 7 DAY GROUP BY 1, 2 ORDER BY event_count DESC, event_date, action""",
)
def audit_by_action(t):
    since = F.date_sub(F.lit(AS_OF_EVENTS).cast("date"), 7).cast("timestamp_ntz")
    return (
        t.events.filter(F.col("ts") >= since)
        .groupBy(F.to_date("ts").cast("string").alias("event_date"), F.col("event_type").alias("action"))
        .agg(F.count(F.lit(1)).alias("event_count"), count_where(F.col("value") < 5).alias("small"))
        .orderBy(F.desc("event_count"), "event_date", "action")
    )


@query(
    "audit_users_by_action",
    """SELECT event_type AS action, user_id // 1000 AS page, count(DISTINCT user_id) AS n_users,
      list_aggregate(list_transform(list_sort(list(DISTINCT user_id)), lambda x: CAST(x AS VARCHAR)),
        'string_agg', ',') AS users
    FROM events GROUP BY 1, 2""",
)
def audit_users_by_action(t):
    sets = gov.paged_sets(t.events.withColumnRenamed("event_type", "action"), ["action"], "user_id")
    return sets.select(
        "action",
        "page",
        F.size("members").cast("long").alias("n_users"),
        F.array_join(F.col("members").cast("array<string>"), ",").alias("users"),
    )


@query(
    "audit_failures",
    f"""SELECT event_id, ts, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
    WHERE event_type = 'error' AND ts >= DATE '{AS_OF_EVENTS}' - INTERVAL 7 DAY ORDER BY ts DESC, event_id LIMIT 10""",
)
def audit_failures(t):
    since = F.date_sub(F.lit(AS_OF_EVENTS).cast("date"), 7).cast("timestamp_ntz")
    return (
        t.events.filter((F.col("event_type") == "error") & (F.col("ts") >= since))
        .select("event_id", "ts", "user_id", F.from_json("props", "k long")["k"].alias("k"))
        .orderBy(F.desc("ts"), "event_id")
        .limit(10)
    )


@query(
    "lineage_upstream",
    """WITH RECURSIVE edges(node, upstream) AS (
      SELECT DISTINCT 'order:' || o_orderkey, 'customer:' || o_custkey FROM orders
      UNION ALL SELECT 'customer:' || c_custkey, 'nation:' || c_nationkey FROM customer
      UNION ALL SELECT 'nation:' || n_nationkey, 'region:' || n_regionkey FROM nation),
    walk(node, upstream, depth) AS (
      SELECT node, upstream, CAST(1 AS BIGINT) FROM edges
      UNION SELECT w.node, e.upstream, w.depth + 1 FROM walk w JOIN edges e ON w.upstream = e.node)
    SELECT node, upstream, min(depth) AS depth FROM walk GROUP BY 1, 2""",
)
def lineage_upstream(t):
    def edge(df, kind, key, parent_kind, parent):
        return df.select(
            F.concat(F.lit(f"{kind}:"), F.col(key).cast("string")).alias("node"),
            F.concat(F.lit(f"{parent_kind}:"), F.col(parent).cast("string")).alias("upstream"),
        )

    edges = (
        edge(t.orders, "order", "o_orderkey", "customer", "o_custkey")
        .unionByName(edge(t.customer, "customer", "c_custkey", "nation", "c_nationkey"))
        .unionByName(edge(t.nation, "nation", "n_nationkey", "region", "n_regionkey"))
    )
    return gov.upstream(edges)
