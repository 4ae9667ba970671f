"""Data quality and monitoring queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.measures import count_where, money_avg, money_sum, pct
from tidemark.operators import quality as dq
from tidemark.plans.inputs import (
    AS_OF_EVENTS,
    BRONZE,
    SECOND_LOAD,
    SILVER,
    bronze_events,
    mavg,
    msum,
    silver_events,
)
from tidemark.plans.registry import query
from tidemark.session import inline_rows

RULES = [
    dq.Expectation("valid_event_id", "event_id IS NOT NULL", "drop"),
    dq.Expectation("valid_user_id", "user_id IS NOT NULL", "drop"),
    dq.Expectation("positive_value", "value > 0", "warn"),
    dq.Expectation("json_props", "props RLIKE '^[{].*[}]$'", "warn"),
]


@query(
    "expect_warn_metrics",
    f"""WITH {BRONZE} SELECT expectation, action, passed, (SELECT count(*) FROM bronze) - passed AS failed FROM (
      SELECT 'valid_event_id' AS expectation, 'drop' AS action, count(*) FILTER (event_id IS NOT NULL) AS passed FROM bronze
      UNION ALL SELECT 'valid_user_id', 'drop', count(*) FILTER (user_id IS NOT NULL) FROM bronze
      UNION ALL SELECT 'positive_value', 'warn', count(*) FILTER (value > 0) FROM bronze
      UNION ALL SELECT 'json_props', 'warn', count(*) FILTER (regexp_matches(props, '^[{{].*[}}]$')) FROM bronze)""",
)
def expect_warn_metrics(t):
    return dq.expectation_metrics(bronze_events(t), RULES)


@query("expect_or_drop", f"WITH {BRONZE} SELECT * FROM bronze WHERE event_id IS NOT NULL AND user_id IS NOT NULL")
def expect_or_drop(t):
    return dq.enforce(bronze_events(t), RULES)


@query("expect_or_fail", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def expect_or_fail(t):
    """The rules hold, so every row passes; tests break one and expect the failure."""
    strict = [dq.Expectation("has_type", "event_type IS NOT NULL", "fail")]
    return dq.enforce(t.events, strict).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "check_constraint_report",
    f"""WITH {BRONZE}
    SELECT 'value_not_negative' AS check_name, count(*) FILTER (NOT coalesce(value >= 0, true)) AS violations FROM bronze
    UNION ALL SELECT 'user_present', count(*) FILTER (user_id IS NULL) FROM bronze
    UNION ALL SELECT 'known_type', count(*) FILTER (event_type NOT IN ('view', 'click', 'purchase')) FROM bronze""",
)
def check_constraint_report(t):
    return dq.check_report(
        bronze_events(t),
        {
            "value_not_negative": "value >= 0",
            "user_present": "user_id IS NOT NULL",
            "known_type": "event_type IN ('view', 'click', 'purchase')",
        },
    )


@query(
    "pk_fk_report",
    f"""WITH {BRONZE}
    SELECT 'bronze.event_id unique' AS rule, count(*) AS violations FROM (SELECT event_id FROM bronze GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'orders.o_orderkey unique', count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'lineitem.l_orderkey in orders', count(*) FROM lineitem ANTI JOIN orders ON l_orderkey = o_orderkey
    UNION ALL SELECT 'documents.doc_id in labels', count(*) FROM documents ANTI JOIN labels USING (doc_id)""",
)
def pk_fk_report(t):
    n = F.count(F.lit(1)).alias("violations")
    checks = {
        "bronze.event_id unique": dq.duplicate_keys(bronze_events(t), ["event_id"]).agg(n),
        "orders.o_orderkey unique": dq.duplicate_keys(t.orders, ["o_orderkey"]).agg(n),
        "lineitem.l_orderkey in orders": dq.orphan_count(t.lineitem, t.orders, [("l_orderkey", "o_orderkey")]),
        "documents.doc_id in labels": dq.orphan_count(t.documents, t.labels, [("doc_id", "doc_id")]),
    }
    out = None
    for rule, bad in checks.items():
        row = bad.withColumn("rule", F.lit(rule))
        out = row if out is None else out.unionByName(row)
    return out


@query(
    "profile_numeric",
    f"""WITH {BRONZE} SELECT count(*) AS total_rows, count(value) AS non_null_value, {mavg('value')} AS avg_value,
    round(stddev_samp(value), 4) AS stddev_value, min(value) AS min_value, max(value) AS max_value FROM bronze""",
)
def profile_numeric(t):
    return bronze_events(t).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count("value").alias("non_null_value"),
        money_avg("value").alias("avg_value"),
        F.round(F.stddev("value"), 4).alias("stddev_value"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
    )


def _profile_sql(column: str, number: bool, shown: str | None = None) -> str:
    shown = shown or f"CAST({{}}({column}) AS VARCHAR)"
    extra = (
        f"round(avg({column}), 4) AS mean, CAST(quantile_disc({column}, 0.5) AS DOUBLE) AS median"
        if number
        else "CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS median"
    )
    return f"""SELECT '{column}' AS column_name, count(*) AS rows, count({column}) AS non_null,
      (count(*) - count({column})) / count(*) AS null_rate, count(DISTINCT {column}) AS n_distinct,
      {shown.format('min')} AS min_value, {shown.format('max')} AS max_value, {extra} FROM bronze"""


#: Columns of the table that the SQL spells out, and whether they are numbers.
PROFILED = [("event_id", True), ("ts", False), ("user_id", True), ("event_type", False), ("value", True), ("props", False)]


@query(
    "profile_full",
    f"WITH {BRONZE} "
    + " UNION ALL ".join(_profile_sql(c, n) for c, n in PROFILED),
)
def profile_full(t):
    """Every column of the table, taken from its schema."""
    return dq.profile(bronze_events(t), exact_distinct=True)


@query(
    "zscore_outliers",
    """SELECT event_id, value, round((value - m) / s, 4) AS z FROM events,
      (SELECT avg(value) AS m, stddev_samp(value) AS s FROM events) WHERE abs((value - m) / s) > 3""",
)
def zscore_outliers(t):
    return dq.zscores(t.events.select("event_id", "value"), "value").withColumn("z", F.round("z", 4))


@query(
    "drift_report",
    f"""WITH b AS (SELECT value FROM events WHERE ts < TIMESTAMP '{SECOND_LOAD}'),
    c AS (SELECT value FROM events WHERE ts >= TIMESTAMP '{SECOND_LOAD}'),
    cuts AS (SELECT quantile_disc(value, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9]) AS cut FROM b),
    bb AS (SELECT len(list_filter(cut, lambda x: x < value)) AS bucket, count(*) AS n FROM b, cuts GROUP BY 1),
    cb AS (SELECT len(list_filter(cut, lambda x: x < value)) AS bucket, count(*) AS n FROM c, cuts GROUP BY 1),
    s AS (SELECT (SELECT avg(value) FROM b) AS mb, (SELECT avg(value) FROM c) AS mc,
      (SELECT stddev_samp(value) FROM b) AS sb, (SELECT stddev_samp(value) FROM c) AS sc,
      (SELECT count(*) FROM b) AS nb, (SELECT count(*) FROM c) AS nc)
    SELECT round(any_value(mb), 4) AS baseline_mean, round(any_value(mc), 4) AS current_mean,
      round(any_value((mc - mb) / sb), 6) AS mean_shift, round(any_value(sc / sb), 6) AS sd_ratio,
      round(sum((cb.n / nc - bb.n / nb) * ln((cb.n / nc) / (bb.n / nb))), 6) AS psi
    FROM bb JOIN cb USING (bucket), s""",
)
def drift_report(t):
    split = F.lit(SECOND_LOAD).cast("timestamp_ntz")
    ev = t.events.select("ts", "value")
    return dq.drift(ev.filter(F.col("ts") < split), ev.filter(F.col("ts") >= split), "value")


@query(
    "freshness",
    f"""SELECT event_type, count(*) AS rows, max(ts) AS newest,
      CAST(date_diff('day', CAST(max(ts) AS DATE), DATE '{AS_OF_EVENTS}') AS BIGINT) AS days_old FROM events GROUP BY 1""",
)
def freshness(t):
    as_of = F.lit(AS_OF_EVENTS).cast("date")
    return (
        t.events.groupBy("event_type")
        .agg(F.count(F.lit(1)).alias("rows"), F.max("ts").alias("newest"))
        .withColumn("days_old", F.datediff(as_of, F.to_date("newest")).cast("long"))
    )


@query(
    "quality_kpis",
    f"""WITH {SILVER}, n AS (SELECT (SELECT count(*) FROM bronze) AS b, (SELECT count(*) FROM silver) AS s)
    SELECT 'bronze_to_silver_retention' AS metric_name, CAST(s AS DOUBLE) * 100.0 / b AS metric_value FROM n
    UNION ALL SELECT 'silver_dedup_rate', CAST(b - s AS DOUBLE) * 100.0 / b FROM n""",
)
def quality_kpis(t):
    b = bronze_events(t).agg(F.count(F.lit(1)).alias("b"))
    counts = b.withColumn("s", silver_events(t).agg(F.count(F.lit(1))).scalar())
    return dq.as_rows(
        counts,
        [
            F.struct(
                F.lit("bronze_to_silver_retention").alias("metric_name"),
                pct(F.col("s"), F.col("b")).alias("metric_value"),
            ),
            F.struct(
                F.lit("silver_dedup_rate").alias("metric_name"),
                pct(F.col("b") - F.col("s"), F.col("b")).alias("metric_value"),
            ),
        ],
    )


ALERTS = [
    ("null values", "null_rate_pct", ">", 5.0, False),
    ("null users", "null_user_pct", ">=", 50.0, False),
    ("volume", "rows", "<", 100.0, False),
    ("errors", "error_pct", "<=", 100.0, True),
    ("no rows", "rows", "==", 0.0, False),
    ("some value", "total_value", "!=", 0.0, False),
]


@query(
    "evaluate_alerts",
    f"""WITH {BRONZE}, m AS (SELECT CAST(count(*) AS DOUBLE) AS rows,
        count(*) FILTER (value IS NULL) * 100.0::DOUBLE / count(*) AS null_rate_pct,
        count(*) FILTER (user_id IS NULL) * 100.0::DOUBLE / count(*) AS null_user_pct,
        count(*) FILTER (event_type = 'error') * 100.0::DOUBLE / count(*) AS error_pct,
        {msum('value')} AS total_value FROM bronze)
    SELECT 'null values' AS alert, 'null_rate_pct' AS metric, null_rate_pct AS value, CASE WHEN null_rate_pct > 5 THEN 'TRIGGERED' ELSE 'OK' END AS state FROM m
    UNION ALL SELECT 'null users', 'null_user_pct', null_user_pct, CASE WHEN null_user_pct >= 50 THEN 'TRIGGERED' ELSE 'OK' END FROM m
    UNION ALL SELECT 'volume', 'rows', rows, CASE WHEN rows < 100 THEN 'TRIGGERED' ELSE 'OK' END FROM m
    UNION ALL SELECT 'errors', 'error_pct', error_pct, CASE WHEN error_pct <= 100 THEN 'MUTED' ELSE 'OK' END FROM m
    UNION ALL SELECT 'no rows', 'rows', rows, CASE WHEN rows = 0 THEN 'TRIGGERED' ELSE 'OK' END FROM m
    UNION ALL SELECT 'some value', 'total_value', total_value, CASE WHEN total_value <> 0 THEN 'TRIGGERED' ELSE 'OK' END FROM m""",
)
def alerts(t):
    n = F.count(F.lit(1))
    wide = bronze_events(t).agg(
        n.cast("double").alias("rows"),
        pct(count_where(F.col("value").isNull()), n).alias("null_rate_pct"),
        pct(count_where(F.col("user_id").isNull()), n).alias("null_user_pct"),
        pct(count_where(F.col("event_type") == "error"), n).alias("error_pct"),
        money_sum("value").alias("total_value"),
    )
    metrics = wide.unpivot([], wide.columns, "metric", "value")
    rules = inline_rows(t.spark, ALERTS, "alert string, metric string, op string, threshold double, muted boolean")
    return dq.evaluate_alerts(metrics, rules).select("alert", "metric", "value", "state")


@query(
    "ingest_summary",
    """SELECT event_type, count(*) AS rows, CAST(1 AS BIGINT) AS files, min(ts) AS first_ts, max(ts) AS last_ts
    FROM events GROUP BY 1""",
)
def ingest_summary(t):
    return t.events.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("_metadata.file_path").alias("files"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
    )
