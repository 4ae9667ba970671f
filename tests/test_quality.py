import math

import pytest
from pyspark.sql import functions as F

from tidemark.operators import governance as gov, quality as dq


@pytest.fixture()
def orders(spark):
    return spark.createDataFrame(
        [(1, 10.0, "ok"), (2, -5.0, "ok"), (3, None, "bad"), (3, 20.0, None)], "id long, amount double, status string"
    )


def test_warn_keeps_drop_removes(orders, rows):
    rules = [dq.Expectation("positive", "amount > 0"), dq.Expectation("known", "status IS NOT NULL", "drop")]
    assert dq.enforce(orders, rules).count() == 3
    assert rows(dq.expectation_metrics(orders, rules), "expectation", "passed", "failed") == [
        ("known", 3, 1),
        ("positive", 2, 2),
    ]


def test_fail_stops_the_job(orders):
    with pytest.raises(Exception, match="positive"):
        dq.enforce(orders, [dq.Expectation("positive", "amount > 0", "fail")]).collect()


def test_unknown_action():
    with pytest.raises(ValueError):
        dq.Expectation("x", "true", "ignore")


def test_null_passes_a_check(orders, rows):
    assert rows(dq.check_report(orders, {"not_negative": "amount >= 0"})) == [("not_negative", 1)]


def test_keys(orders, spark, rows):
    assert rows(dq.duplicate_keys(orders, ["id"])) == [(3, 2)]
    parent = spark.createDataFrame([(1,), (2,)], "pid long")
    assert rows(dq.orphans(orders, parent, [("id", "pid")]), "id") == [(3,), (3,)]


def test_profile_counts(orders, rows):
    got = {r["column_name"]: r for r in dq.profile(orders, exact_distinct=True).collect()}
    assert got["amount"]["null_rate"] == 0.25 and got["amount"]["n_distinct"] == 3
    assert got["status"]["mean"] is None and got["amount"]["median"] == 10.0


def test_zscore_of_a_constant_is_empty(spark):
    assert dq.zscores(spark.range(10).select(F.lit(1.0).alias("v")), "v").count() == 0


def test_drift_of_equal_samples_is_zero(spark):
    df = spark.range(1000).select((F.col("id") % 97).cast("double").alias("v"))
    r = dq.drift(df, df, "v").first()
    assert r["psi"] == 0 and r["mean_shift"] == 0
    assert dq.drift(df, df.withColumn("v", F.col("v") + 30), "v").first()["psi"] > 0.2


def test_alert_operators(spark):
    metrics = spark.createDataFrame([("m", 5.0)], "metric string, value double")
    cases = [(">", 4, True), ("<", 4, False), (">=", 5, True), ("<=", 4, False), ("==", 5, True), ("!=", 5, False)]
    rules = spark.createDataFrame(
        [(op, "m", op, float(x), False) for op, x, _ in cases] + [("quiet", "m", ">", 1.0, True), ("gone", "x", ">", 1.0, False)],
        "alert string, metric string, op string, threshold double, muted boolean",
    )
    state = {r["alert"]: r["state"] for r in dq.evaluate_alerts(metrics, rules).collect()}
    for op, _, hit in cases:
        assert state[op] == ("TRIGGERED" if hit else "OK"), op
    assert state["quiet"] == "MUTED" and state["gone"] == "UNKNOWN"


def test_row_policy(spark, rows):
    orders = spark.createDataFrame([(1, "US"), (2, "EU"), (3, "US"), (4, "APAC")], "id long, region string")
    grants = spark.createDataFrame([("ann", "US"), ("ann", "US"), ("bob", "EU")], "user string, value string")
    assert rows(gov.row_policy(orders, "region", "ann", grants), "id") == [(1,), (3,)]
    assert gov.row_policy(orders, "region", "eve", grants).count() == 0
    assert gov.row_policy(orders, "region", "eve", grants, groups=["admins"]).count() == 4


def test_masks(spark, rows):
    people = spark.createDataFrame(
        [(1, "alice@corp.com", "555-123-4567"), (2, None, None)], "id long, email string, phone string"
    )
    masks = {"email": "email", "phone": "phone"}
    assert rows(gov.mask_columns(people, masks)) == [(1, "al***@corp.com", "***-***-4567"), (2, None, None)]
    assert rows(gov.mask_columns(people, masks, groups=["data_engineers"])) == rows(people)


def test_pii_tags(spark):
    df = spark.createDataFrame([("a@b.com", "x"), ("plain", "y")], "mail string, other string")
    tagged = gov.classify_columns(df, "t", 0.4).filter("pii")
    assert [(r["column_name"], r["kind"]) for r in tagged.collect()] == [("mail", "email")]


def test_lineage_diamond(spark, rows):
    edges = spark.createDataFrame([("d", "b"), ("d", "c"), ("b", "a"), ("c", "a"), ("a", "r")], "node string, upstream string")
    got = rows(gov.upstream(edges))
    assert ("d", "a", 2) in got and ("d", "r", 3) in got and len(got) == 9


def test_paged_sets_are_bounded(spark):
    df = spark.range(2500).select(F.lit("view").alias("k"), F.col("id").alias("u"))
    got = gov.paged_sets(df.union(df), ["k"], "u").collect()
    assert len(got) == 3 and max(len(r["members"]) for r in got) == 1000
    assert sum(len(r["members"]) for r in got) == 2500


def test_lineage_follows_chains_and_cycles_to_their_end(spark, rows):
    chain = [(f"n{i}", f"n{i + 1}") for i in range(6)]
    got = rows(gov.upstream(spark.createDataFrame(chain + [("x", "y"), ("y", "x")], "node string, upstream string")))
    assert ("n0", "n6", 6) in got and {("x", "x", 2), ("x", "y", 1)} <= set(got)
    assert len(got) == 21 + 4


def test_mask_email_without_a_domain(spark, rows):
    df = spark.createDataFrame([("plain",), ("ab@c.de",), (None,)], "m string")
    assert rows(df.select(gov.mask_email(F.col("m")).alias("m"))) == [("***",), ("ab***@c.de",), (None,)]


def test_drift_without_spread_or_rows(spark):
    same = spark.createDataFrame([(5.0,)] * 4, "v double")
    r = dq.drift(same, same, "v").first()
    assert (r["mean_shift"], r["sd_ratio"], r["psi"]) == (None, None, 0.0)
    assert dq.drift(same.filter("false"), same, "v").first()["psi"] is None
    assert dq.drift(same, same.filter("false"), "v").first()["psi"] is None


def test_label_index(spark, rows, monkeypatch):
    """More labels than one task numbers; null and unseen ones come after the last."""
    from tidemark.operators import learning, segmented

    monkeypatch.setattr(segmented, "KEYLESS_ROWS", 300)
    names = [f"label {i * 7919 % 2000:04d}" for i in range(2000)] * 2 + [None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(names)], "id long, c string").repartition(5)
    want = {x: i for i, x in enumerate(sorted(set(names) - {None}))}
    got = learning.encode_labels(df, "c", "n")
    assert got.columns == ["id", "c", "n"]
    assert rows(got) == sorted(((i, x, want.get(x, 2000)) for i, x in enumerate(names)), key=repr)
    new = spark.createDataFrame([(1, "label 0003"), (2, "other"), (3, None)], "id long, c string")
    placed = rows(learning.encode_labels(new, "c", "n", learning.label_dictionary(df, "c")))
    assert placed == [(1, "label 0003", 3), (2, "other", 2000), (3, None, 2000)]


def test_millions_of_labels(spark):
    """Numbered in ranges; nothing is collected."""
    from tidemark.operators import learning

    n = 3_000_000
    df = spark.range(n).selectExpr("lpad(cast(id as string), 9, '0') AS c")
    found = learning.label_dictionary(df, "c")
    assert found.filter("cast(label as long) <> label_index").count() == 0 and found.count() == n


def test_column_quantiles(spark, rows):
    """All columns at once, plain and in ranges, against a sort."""
    from tidemark.operators import quantiles, segmented

    data = [(i * 37 % 101, float(i % 13) if i % 5 else None, None) for i in range(500)]
    df = spark.createDataFrame(data, "a long, b double, c int").repartition(3)
    shares = ["0.01", "0.5", "0.95", "1"]
    want = []
    for k, name in enumerate(["a", "b"]):
        x = sorted(float(r[k]) for r in data if r[k] is not None)
        want.append((name, [x[max(1, math.ceil(round(float(s) * len(x), 9))) - 1] for s in shares]))
    for segment in (segmented.AUTO, None, segmented.Ranges(4)):
        got = quantiles.column_quantiles(df, ["a", "b", "c"], shares, segment=segment)
        assert sorted((r[0], r[1]) for r in got.collect()) == want
