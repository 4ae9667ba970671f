"""Upsert, validity chains, change feeds and versions over events and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import history
from tidemark.operators.joins import latest_by
from tidemark.operators.mutation import (
    apply_changes,
    change_feed,
    delete_where,
    merge_upsert,
    reconcile,
    scd2,
    update_where,
    upsert_partitions,
)
from tidemark.plans.inputs import BRONZE, bronze_events
from tidemark.plans.registry import query

COLS = ["event_id", "ts", "user_id", "event_type", "value"]
# The stored table ends on the 20th; the arriving one starts on the 11th and doubles values.
STORED_END = "2024-01-21 00:00:00"
ARRIVING_FROM = "2024-01-11 00:00:00"


def stored(t):
    return t.events.select(*COLS).filter(F.col("ts") < F.lit(STORED_END).cast("timestamp_ntz"))


def arriving(t):
    late = t.events.select(*COLS).filter(F.col("ts") >= F.lit(ARRIVING_FROM).cast("timestamp_ntz"))
    return late.withColumn("value", F.col("value") * 2)


def current(t):
    """Version after the upsert and the removal of early errors."""
    merged = merge_upsert(stored(t), arriving(t), ["event_id"])
    early = F.col("ts") < F.lit(ARRIVING_FROM).cast("timestamp_ntz")
    return delete_where(merged, (F.col("event_type") == "error") & early)


MERGED = f"""
SELECT event_id, ts, user_id, event_type,
  CASE WHEN ts >= TIMESTAMP '{ARRIVING_FROM}' THEN value * 2 ELSE value END AS value FROM events
"""
CURRENT = f"{MERGED} WHERE NOT (event_type = 'error' AND ts < TIMESTAMP '{ARRIVING_FROM}')"
STORED = f"SELECT event_id, ts, user_id, event_type, value FROM events WHERE ts < TIMESTAMP '{STORED_END}'"
FEED = f"""
before AS ({STORED}), after AS ({CURRENT}),
feed AS (
  SELECT 'insert' AS _change_type, a.* FROM after a ANTI JOIN before b USING (event_id)
  UNION ALL SELECT 'delete', b.* FROM before b ANTI JOIN after a USING (event_id)
  UNION ALL SELECT 'update_preimage', b.* FROM before b JOIN after a USING (event_id)
    WHERE b.value IS DISTINCT FROM a.value
  UNION ALL SELECT 'update_postimage', a.* FROM before b JOIN after a USING (event_id)
    WHERE b.value IS DISTINCT FROM a.value)
"""


@query("merge_upsert", MERGED)
def merged(t):
    return merge_upsert(stored(t), arriving(t), ["event_id"])


@query(
    "merge_upsert_latest_source",
    f"WITH {BRONZE} SELECT event_id, ts, value FROM (SELECT *, row_number() OVER "
    "(PARTITION BY event_id ORDER BY ts DESC) AS rn FROM bronze) WHERE rn = 1",
)
def merged_latest(t):
    """The source brings several rows for a key; the newest wins."""
    base = t.events.select("event_id", "ts", "value")
    return merge_upsert(base, bronze_events(t).select("event_id", "ts", "value"), ["event_id"], [F.desc("ts")])


@query(
    "merge_upsert_partitions",
    f"SELECT event_id, user_id, event_type, value, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM ({MERGED})",
)
def merged_partitions(t):
    """Only the days the source touches are joined and rewritten."""
    path, day = t.folder("by-day"), F.to_date("ts").cast("string")
    stored(t).withColumn("day", day).drop("ts").write.partitionBy("day").parquet(path)
    upsert_partitions(t.spark, path, arriving(t).withColumn("day", day).drop("ts"), ["event_id"], "day")
    return t.spark.read.parquet(path).withColumn("day", F.col("day").cast("string"))


def priority_versions(t):
    """One version per customer and day: the priority of the day's last order."""
    rows = t.orders.select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderpriority").alias("tier"),
        F.col("o_orderdate").alias("effective_from"),
        "o_orderkey",
    )
    return latest_by(rows, ["customer_id", "effective_from"], [F.desc("o_orderkey")]).drop("o_orderkey")


VERSIONS = """
versions AS (SELECT customer_id, tier, effective_from FROM (
  SELECT o_custkey AS customer_id, o_orderpriority AS tier, o_orderdate AS effective_from,
    row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) AS rn FROM orders)
  WHERE rn = 1)
"""
CHAIN = """
SELECT customer_id, tier, effective_from,
  lead(effective_from) OVER (PARTITION BY customer_id ORDER BY effective_from) AS effective_to,
  lead(effective_from) OVER (PARTITION BY customer_id ORDER BY effective_from) IS NULL AS is_current
"""


@query("scd2_apply", f"WITH {VERSIONS} {CHAIN} FROM versions")
def scd2_apply(t):
    return scd2(priority_versions(t), ["customer_id"], "effective_from", ["tier"])


@query(
    "scd2_skip_unchanged",
    f"""WITH {VERSIONS} {CHAIN} FROM (SELECT *, lag(tier) OVER
    (PARTITION BY customer_id ORDER BY effective_from) AS before FROM versions)
    WHERE before IS NULL OR before <> tier""",
)
def scd2_skip_unchanged(t):
    return scd2(priority_versions(t), ["customer_id"], "effective_from", ["tier"], skip_unchanged=True)


@query(
    "update_where",
    """SELECT o_orderkey, o_orderstatus, o_totalprice,
      CASE WHEN o_orderstatus = 'P' AND o_totalprice > 300000 THEN '1-URGENT' ELSE o_orderpriority END
      AS o_orderpriority FROM orders""",
)
def updated(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    hit = (F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 300_000)
    return update_where(rows, hit, {"o_orderpriority": F.lit("1-URGENT")})


@query("delete_where", f"WITH {BRONZE} SELECT * FROM bronze WHERE NOT coalesce(value < 0, false)")
def deleted(t):
    return delete_where(bronze_events(t), F.col("value") < 0)


@query("change_feed", f"WITH {FEED} SELECT *, CAST(1 AS BIGINT) AS _commit_version FROM feed")
def feed(t):
    return change_feed(stored(t), current(t), ["event_id"], 1)


@query("change_feed_counts", f"WITH {FEED} SELECT _change_type, count(*) AS n FROM feed GROUP BY 1")
def feed_counts(t):
    return feed(t).groupBy("_change_type").agg(F.count(F.lit(1)).alias("n"))


@query("apply_changes", CURRENT)
def applied(t):
    return apply_changes(stored(t), feed(t), ["event_id"])


def event_log(t):
    """Change log of three commits, stored by version: load, upsert, removal of early errors."""
    first, merged = stored(t), merge_upsert(stored(t), arriving(t), ["event_id"])
    commits = [
        history.logged(history.as_load(first), "WRITE", "2024-02-01 00:00:00"),
        history.logged(change_feed(first, merged, ["event_id"], 1), "MERGE", "2024-02-02 00:00:00"),
        history.logged(change_feed(merged, current(t), ["event_id"], 2), "DELETE", "2024-02-03 00:00:00"),
    ]
    path = t.folder("change-log")
    for commit in commits:
        commit.write.mode("append").partitionBy(history.VERSION).parquet(path)
    return t.spark.read.schema(commits[0].schema).parquet(path)


@query("read_as_of", MERGED)
def read_as_of(t):
    return history.state_at(event_log(t), ["event_id"], at="2024-02-02 12:00:00").select(*COLS)


@query("restore_version", STORED)
def restore_version(t):
    """The state after a fourth commit that takes the table back to the first one."""
    log = event_log(t)
    back = history.logged(history.changes_back(log, ["event_id"], 0, 3), "RESTORE 0", "2024-02-04 00:00:00")
    return history.state_at(log.unionByName(back), ["event_id"]).select(*COLS)


@query(
    "snapshot_history",
    f"""
    WITH m AS ({MERGED}), c AS ({CURRENT}), s AS ({STORED})
    SELECT CAST(0 AS BIGINT) AS snapshot_version, 'WRITE' AS operation, (SELECT count(*) FROM s) AS rows,
      CAST(0 AS BIGINT) AS inserted, CAST(0 AS BIGINT) AS updated, CAST(0 AS BIGINT) AS deleted
    UNION ALL SELECT 1, 'MERGE', (SELECT count(*) FROM m), (SELECT count(*) FROM m ANTI JOIN s USING (event_id)),
      (SELECT count(*) FROM m JOIN s USING (event_id) WHERE m.value <> s.value), 0
    UNION ALL SELECT 2, 'DELETE', (SELECT count(*) FROM c), 0, 0, (SELECT count(*) FROM m ANTI JOIN c USING (event_id))""",
)
def snapshot_history(t):
    return history.history(event_log(t))


@query(
    "backup_reconcile",
    """SELECT count(*) AS rows_a, count(*) AS rows_b, CAST(0 AS BIGINT) AS missing, CAST(0 AS BIGINT) AS extra,
    CAST(0 AS BIGINT) AS different FROM orders""",
)
def backup_reconcile(t):
    path = t.folder("backup")
    t.orders.write.parquet(path)
    copy = t.spark.read.schema(t.orders.schema).parquet(path)
    return reconcile(t.orders, copy, ["o_orderkey"])


@query(
    "reconcile_versions",
    f"""WITH a AS ({STORED}), b AS ({CURRENT}) SELECT count(a.event_id) AS rows_a, count(b.event_id) AS rows_b,
      count(*) FILTER (b.event_id IS NULL) AS missing, count(*) FILTER (a.event_id IS NULL) AS extra,
      count(*) FILTER (a.value <> b.value) AS different
    FROM a FULL JOIN b ON a.event_id = b.event_id""",
)
def reconcile_versions(t):
    return reconcile(stored(t), current(t), ["event_id"])
