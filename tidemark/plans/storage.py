"""Round trips through formats and sinks, incremental loads and layouts."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators import layout
from tidemark.operators.mutation import merge_upsert
from tidemark.plans.inputs import SECOND_LOAD
from tidemark.plans.registry import query
from tidemark.session import Tables, settle
from tidemark.sources import files, incremental
from tidemark.streaming import jobs

EVENTS = "event_id long, user_id long, event_type string, value double, event_date string"
EVENTS_SQL = (
    "SELECT event_id, user_id, event_type, value, CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date FROM events"
)


def sample(t: Tables):
    return t.events.select(
        "event_id", "user_id", "event_type", "value", F.to_date("ts").cast("string").alias("event_date")
    )


def round_trip(t: Tables, fmt: str, schema: str | None = None, write=None, read=None):
    path = t.folder(f"fmt-{fmt}")
    files.write_files(sample(t), path, fmt, **(write or {}))
    back = files.read_files(t.spark, path, fmt, StructType.fromDDL(schema) if schema else None, **(read or {}))
    return back.withColumn("event_date", F.col("event_date").cast("string")).select(
        "event_id", "user_id", "event_type", "value", "event_date"
    )


@query("fmt_parquet_roundtrip", EVENTS_SQL)
def fmt_parquet(t):
    return round_trip(t, "parquet")


@query("fmt_orc_roundtrip", EVENTS_SQL)
def fmt_orc(t):
    return round_trip(t, "orc")


@query("fmt_json_roundtrip", EVENTS_SQL)
def fmt_json(t):
    return round_trip(t, "json")


@query(
    "fmt_csv_inferred",
    EVENTS_SQL.replace("SELECT event_id, user_id,", "SELECT CAST(event_id AS INTEGER) AS event_id, CAST(user_id AS INTEGER) AS user_id,"),
)
def fmt_csv_inferred(t):
    back = round_trip(t, "csv", write={"header": True}, read={"header": True, "inferSchema": True})
    # Inference picks the narrowest type, which depends on the data.
    return back.withColumns({c: F.col(c).cast("int") for c in ("event_id", "user_id")})


@query("fmt_csv_explicit", EVENTS_SQL)
def fmt_csv_explicit(t):
    return round_trip(t, "csv", EVENTS, write={"header": True}, read={"header": True})


@query("fmt_xml_flat", EVENTS_SQL)
def fmt_xml_flat(t):
    return round_trip(t, "xml", EVENTS, write={"rootTag": "events", "rowTag": "event"}, read={"rowTag": "event"})


@query("fmt_xml_nested", EVENTS_SQL)
def fmt_xml_nested(t):
    path = t.folder("fmt-xml")
    nested = sample(t).select(
        F.col("event_id").alias("id"), F.struct("user_id", "event_type").alias("event"), "value", "event_date"
    )
    files.write_files(nested, path, "xml", rootTag="events", rowTag="row")
    back = files.read_files(t.spark, path, "xml", nested.schema, rowTag="row")
    return back.select(
        F.col("id").alias("event_id"), "event.user_id", "event.event_type", "value", "event_date"
    )


@query(
    "codec_sizes",
    """SELECT unnest(['snappy', 'gzip', 'zstd']) AS codec, (SELECT count(*) FROM events) AS rows, TRUE AS at_most_snappy""",
)
def codec_sizes(t):
    """Rows of the event table under each codec, and whether it takes no more bytes than the fastest one."""
    out = None
    for codec in ("snappy", "gzip", "zstd"):
        path = t.folder(f"codec-{codec}")
        t.events.write.option("compression", codec).parquet(path)
        back = t.spark.read.parquet(path)
        row = files.stored_bytes(back).withColumns({"codec": F.lit(codec), "rows": back.agg(F.count(F.lit(1))).scalar()})
        out = row if out is None else out.unionByName(row)
    out = settle(out, "codecs")
    snappy = out.filter("codec = 'snappy'").agg(F.max("bytes")).scalar()
    return out.select("codec", "rows", (F.col("bytes") <= snappy).alias("at_most_snappy"))


@query("format_size_report")
def format_size_report(t):
    """Bytes of the event table in each format, and against parquet."""
    out = None
    for fmt in ("parquet", "orc", "json", "csv", "xml"):
        path = t.folder(f"size-{fmt}")
        options = {"rootTag": "events", "rowTag": "event"} if fmt == "xml" else {}
        files.write_files(sample(t), path, fmt, **options)
        back = files.read_files(t.spark, path, fmt, StructType.fromDDL(EVENTS), **options)
        row = files.stored_bytes(back).withColumn("format", F.lit(fmt))
        out = row if out is None else out.unionByName(row)
    base = out.filter("format = 'parquet'").agg(F.max("bytes")).scalar()
    return out.withColumn("times_parquet", F.round(F.col("bytes") / base, 2))


# --- sinks ------------------------------------------------------------------


@query("sink_overwrite", "SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 0")
def sink_overwrite(t):
    path = t.folder("overwrite")
    t.customer.write.mode("overwrite").parquet(path)
    t.customer.filter("c_acctbal > 0").select("c_custkey", "c_name").write.mode("overwrite").parquet(path)
    return t.spark.read.parquet(path)


@query("sink_append", "SELECT o_orderkey, o_totalprice FROM orders")
def sink_append(t):
    path = t.folder("append")
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderdate")
    split = F.lit("1998-07-01").cast("timestamp_ntz")
    for part in (rows.filter(F.col("o_orderdate") < split), rows.filter(F.col("o_orderdate") >= split)):
        part.drop("o_orderdate").write.mode("append").parquet(path)
    return t.spark.read.parquet(path)


def _name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex[:12]}"


CLICKS = "SELECT user_id, count(*) AS clicks FROM events WHERE event_type = 'click' GROUP BY user_id"


@query("sink_ctas", CLICKS)
def sink_ctas(t):
    t.views("events")
    table, path = _name("clicks"), t.folder("ctas")
    t.spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{path}' AS {CLICKS}")
    return t.spark.table(table)


@query("sink_insert_select", "SELECT event_id, user_id, value FROM events WHERE event_type IN ('click', 'view')")
def sink_insert_select(t):
    t.views("events")
    table, path = _name("picked"), t.folder("insert")
    t.spark.sql(f"CREATE TABLE {table} (event_id BIGINT, user_id BIGINT, value DOUBLE) USING parquet LOCATION '{path}'")
    for kind in ("click", "view"):
        t.spark.sql(
            f"INSERT INTO {table} SELECT event_id, user_id, value FROM events WHERE event_type = :kind",
            args={"kind": kind},
        )
    return t.spark.table(table)


@query("sink_partitioned", "SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase'")
def sink_partitioned(t):
    path = t.folder("partitioned")
    t.events.write.partitionBy("event_type").parquet(path)
    back = t.spark.read.schema(t.events.schema).parquet(path)
    return back.filter("event_type = 'purchase'").select("event_id", "user_id", "value")


@query("layout_cluster_by", "SELECT o_orderkey, o_orderdate, o_orderstatus FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'")
def layout_cluster_by(t):
    path = t.folder("clustered")
    layout.write_clustered(t.orders.select("o_orderkey", "o_orderdate", "o_orderstatus"), path, ["o_orderdate", "o_orderstatus"], 8)
    back = t.spark.read.parquet(path)
    return back.filter(F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz"))


@query(
    "layout_bucketed_join",
    "SELECT l_orderkey, count(*) AS lines, CAST(sum(l_quantity) AS DOUBLE) AS quantity, any_value(o_orderstatus) AS status "
    "FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_orderkey",
)
def layout_bucketed_join(t):
    """Both tables bucketed on the order key once: the join and the sum shuffle nothing."""
    lines, orders = _name("lines"), _name("orders")
    layout.write_bucketed(t.lineitem.select("l_orderkey", "l_quantity"), lines, t.folder("lines"), ["l_orderkey"], 8)
    layout.write_bucketed(t.orders.select("o_orderkey", "o_orderstatus"), orders, t.folder("orders"), ["o_orderkey"], 8)
    joined = t.spark.table(lines).hint("merge").join(t.spark.table(orders), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("quantity"), F.max("o_orderstatus").alias("status")
    )


@query("layout_zorder", "SELECT event_id, user_id, value FROM events")
def layout_zorder(t):
    path = t.folder("zorder")
    layout.write_zordered(t.events.select("event_id", "user_id", "value"), path, ["user_id", "value"], 8)
    return t.spark.read.parquet(path)


@query(
    "compact_files",
    """SELECT 'before' AS state, count(*) AS rows, FALSE AS fewer_files FROM events
    UNION ALL SELECT 'after', count(*), TRUE FROM events""",
)
def compact_files(t):
    """Files and rows before and after compaction of a table in many small files."""
    small, large = t.folder("small"), t.folder("large")
    t.events.repartition(32).write.parquet(small)
    before = t.spark.read.parquet(small)
    total = files.stored_bytes(before).first()["bytes"]
    layout.compact(before, large, 128 * 1024 * 1024, total)
    out = None
    for state, path in (("before", small), ("after", large)):
        df = t.spark.read.parquet(path)
        rows = df.agg(F.count(F.lit(1))).scalar()
        part = files.stored_bytes(df).withColumns({"rows": rows, "state": F.lit(state)})
        out = part if out is None else out.unionByName(part)
    out = settle(out, "compacted")
    at_first = out.filter("state = 'before'").agg(F.max("files")).scalar()
    return out.select("state", "rows", (F.col("files") < at_first).alias("fewer_files"))


@query(
    "compact_small_files",
    "SELECT event_id, user_id, event_type, value, event_id % 2 = 1 AS moved FROM events",
)
def compact_small_files(t):
    """Half of the events in two large files, half in 16 small ones: only rows of the small files move."""
    path = t.folder("mixed")
    events = t.events.select("event_id", "user_id", "event_type", "value")
    events.filter("event_id % 2 = 0").repartition(2).write.parquet(path)
    name, size = F.col("_metadata.file_name"), F.col("_metadata.file_size")
    large = t.spark.read.parquet(path).agg(F.min(size)).first()[0]
    events.filter("event_id % 2 = 1").repartition(16).write.mode("append").parquet(path)
    before = settle(t.spark.read.parquet(path).select(name.alias("file")).distinct(), "files-before")
    layout.compact_small(t.spark, path, target_bytes=large, small_bytes=large)
    after = t.spark.read.parquet(path).withColumn("file", name)
    kept = before.withColumn("kept", F.lit(True))
    return after.join(kept, "file", "left").select(*events.columns, F.col("kept").isNull().alias("moved"))


# --- incremental loads ------------------------------------------------------


def halves(t: Tables):
    split = F.lit(SECOND_LOAD).cast("timestamp_ntz")
    rows = t.events.withColumn("ts", F.col("ts").cast("string"))
    return rows.filter(F.col("ts").cast("timestamp_ntz") < split), rows.filter(F.col("ts").cast("timestamp_ntz") >= split)


LANDED = "event_id long, ts string, user_id long, event_type string, value double, props string"


@query("ingest_incremental", "SELECT event_id, user_id, event_type, value FROM events")
def ingest_incremental(t):
    """Two runs of one stream over a growing folder; the second loads only new files."""
    landing, out, checkpoint = t.folder("landing"), t.folder("bronze"), t.folder("checkpoint")
    schema = StructType.fromDDL(LANDED)
    for part in halves(t):
        part.write.mode("append").option("header", True).csv(landing)
        stream = incremental.file_stream(t.spark, landing, "csv", schema, header=True)
        jobs.run_append(stream, out, checkpoint)
    return t.spark.read.parquet(out).select("event_id", "user_id", "event_type", "value")


@query("ingest_schema_inferred", "SELECT event_id, user_id, event_type, value, props FROM events")
def ingest_schema_inferred(t):
    landing, out, where = t.folder("landing"), t.folder("bronze"), t.folder("schema")
    checkpoint = t.folder("checkpoint")
    for part in halves(t):
        part.write.mode("append").json(landing)
        schema = incremental.kept_schema(t.spark, where, landing, "json")
        jobs.run_append(incremental.file_stream(t.spark, landing, "json", schema), out, checkpoint)
    return t.spark.read.parquet(out).select("event_id", "user_id", "event_type", "value", "props")


@query(
    "ingest_schema_evolution",
    f"SELECT event_id, user_id, value, CASE WHEN ts >= TIMESTAMP '{SECOND_LOAD}' THEN props END AS props FROM events",
)
def ingest_schema_evolution(t):
    """The second load brings a new column; rows of the first get null."""
    landing, out, where = t.folder("landing"), t.folder("bronze"), t.folder("schema")
    checkpoint, columns = t.folder("checkpoint"), ["event_id", "user_id", "value"]
    first, second = halves(t)
    for i, part in enumerate((first.select(*columns), second.select(*columns, "props")), 1):
        part.write.json(f"{landing}/load_{i}")
        schema = incremental.evolved_schema(t.spark, where, f"{landing}/load_{i}", "json")
        jobs.run_append(incremental.file_stream(t.spark, f"{landing}/*", "json", schema), out, checkpoint)
    return t.spark.read.schema(schema).parquet(out).select(*columns, "props")


@query(
    "union_evolving",
    f"SELECT event_id, user_id, value, CASE WHEN ts >= TIMESTAMP '{SECOND_LOAD}' THEN props END AS props FROM events",
)
def union_evolving(t):
    """Union of unlike schemas by name; a row without a column gets null."""
    first, second = halves(t)
    columns = ["event_id", "user_id", "value"]
    return incremental.append_evolving(first.select(*columns), second.select("props", *columns), "add")


@query(
    "ingest_provenance",
    f"""SELECT CASE WHEN ts < TIMESTAMP '{SECOND_LOAD}' THEN 'load_1' ELSE 'load_2' END AS load,
    TIMESTAMP '2024-02-01 06:00:00' AS ingested_at, count(*) AS rows, CAST(sum(event_id) AS BIGINT) AS id_sum
    FROM events GROUP BY 1""",
)
def ingest_provenance(t):
    landing, out, checkpoint = t.folder("landing"), t.folder("bronze"), t.folder("checkpoint")
    at = F.lit("2024-02-01 06:00:00").cast("timestamp_ntz")
    for i, part in enumerate(halves(t), 1):
        part.write.json(f"{landing}/load_{i}")
        stream = incremental.file_stream(t.spark, f"{landing}/*", "json", StructType.fromDDL(LANDED), at)
        jobs.run_append(stream, out, checkpoint)
    load = F.regexp_extract("source_file", "/(load_[0-9]+)/", 1)
    return (
        t.spark.read.parquet(out)
        .groupBy(load.alias("load"), "ingested_at")
        .agg(F.count(F.lit(1)).alias("rows"), F.sum("event_id").alias("id_sum"))
    )


@query("copy_into_idempotent", "SELECT event_id, user_id, event_type, value FROM events")
def copy_into_idempotent(t):
    """Load, load again with nothing new, load after more files arrived."""
    landing, target, ledger = t.folder("landing"), t.folder("target"), t.folder("ledger")
    schema = StructType.fromDDL(LANDED)
    first, second = halves(t)
    first.write.json(f"{landing}/a")
    for _ in range(2):
        incremental.copy_into(t.spark, landing, target, ledger, "json", schema)
    second.write.json(f"{landing}/b")
    incremental.copy_into(t.spark, landing, target, ledger, "json", schema)
    return t.spark.read.parquet(target).select("event_id", "user_id", "event_type", "value")


@query("incremental_watermark_load", "SELECT event_id, ts, value FROM events")
def incremental_watermark_load(t):
    """Full load up to a bookmark, then only rows past it; together the table."""
    out = t.folder("bookmarked")
    rows = t.events.select("event_id", "ts", "value")
    first = rows.filter(F.col("ts") < F.lit(SECOND_LOAD).cast("timestamp_ntz"))
    first.write.mode("append").parquet(out)
    last = incremental.next_bookmark(t.spark.read.parquet(out), "ts").first()[0]
    incremental.since(rows, "ts", F.lit(last).cast("timestamp_ntz")).write.mode("append").parquet(out)
    return t.spark.read.parquet(out)


@query(
    "sync_incremental_pk",
    f"SELECT event_id, event_type, CASE WHEN ts >= TIMESTAMP '{SECOND_LOAD}' THEN value * 2 ELSE value END AS value FROM events",
)
def sync_incremental_pk(t):
    """A synced table receives only the rows changed since its bookmark, merged on the key."""
    source = t.events.select("event_id", "ts", "event_type", "value")
    split = F.lit(SECOND_LOAD).cast("timestamp_ntz")
    changed = source.withColumn("value", F.when(F.col("ts") >= split, F.col("value") * 2).otherwise(F.col("value")))
    delta = incremental.since(changed, "ts", split - F.expr("INTERVAL 1 MICROSECOND"))
    return merge_upsert(source, delta, ["event_id"]).drop("ts")


@query("shared_view", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def shared(t):
    return files.shared_view(
        t.spark,
        {
            "path": t.path("orders"),
            "columns": ["o_orderkey", "o_orderstatus", "o_totalprice"],
            "filter": "o_orderstatus = 'F'",
        },
    )
