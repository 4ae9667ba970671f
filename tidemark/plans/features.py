"""Features, training sets, scores and models."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF
from pyspark.sql import Window, functions as F

from tidemark.functions import text as tx
from tidemark.functions.measures import count_where, money_avg, money_sum
from tidemark.operators import learning as ml
from tidemark.operators.joins import Lookup, feature_lookup
from tidemark.plans.inputs import AS_OF_ORDERS, mavg, msum
from tidemark.plans.registry import query
from tidemark.session import settle, spread


@query(
    "customer_features",
    f"""SELECT o_custkey AS customer_id, count(*) AS total_orders, CAST(sum(l_quantity) AS DOUBLE) AS total_quantity,
      CAST(sum(l_quantity) AS DOUBLE) / count(*) AS avg_order_size,
      CAST(date_diff('day', CAST(max(o_orderdate) AS DATE), DATE '{AS_OF_ORDERS}') AS INTEGER) AS days_since_last_order,
      CASE WHEN count(*) >= 20 THEN 'high_value' WHEN count(*) >= 10 THEN 'medium_value' ELSE 'low_value' END AS customer_segment
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F' GROUP BY 1""",
)
def customer_features(t):
    done = t.orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_custkey", "o_orderdate")
    # Lines are summed per order before the join: it then moves one row per order.
    lines = t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("q"))
    n = F.col("total_orders")
    return (
        done.join(lines, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("o_custkey").alias("customer_id"))
        .agg(F.sum("n").alias("total_orders"), F.sum("q").alias("total_quantity"), F.max("o_orderdate").alias("last"))
        .withColumns(
            {
                "avg_order_size": F.col("total_quantity") / n,
                "days_since_last_order": F.datediff(F.lit(AS_OF_ORDERS).cast("date"), F.to_date("last")),
                "customer_segment": F.when(n >= 20, "high_value").when(n >= 10, "medium_value").otherwise("low_value"),
            }
        )
        .drop("last")
    )


@query(
    "product_features",
    """SELECT l_partkey AS product_id, count(*) AS product_order_count, count(DISTINCT o_custkey) AS unique_customers,
      CAST(sum(l_quantity) AS DOUBLE) / count(*) AS avg_quantity_per_order,
      round(coalesce(stddev_samp(l_quantity), 0), 4) AS quantity_variability
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F' GROUP BY 1""",
)
def product_features(t):
    done = t.orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_custkey")
    return (
        t.lineitem.join(done, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("l_partkey").alias("product_id"))
        .agg(
            F.count(F.lit(1)).alias("product_order_count"),
            F.count_distinct("o_custkey").alias("unique_customers"),
            (F.sum("l_quantity") / F.count(F.lit(1))).alias("avg_quantity_per_order"),
            F.round(F.stddev("l_quantity"), 4).alias("quantity_variability"),
        )
        .fillna(0, ["quantity_variability"])
    )


KINDS = ("purchase", "signup", "view", "click")
BEHAVIOUR = f"""
SELECT *, purchase_count / total_events AS purchase_rate, signup_count / total_events AS signup_rate,
  CASE WHEN view_count > 0 THEN click_count / view_count ELSE 0 END AS click_to_view_ratio,
  total_events * 0.3::DOUBLE + event_variety * 10 + purchase_count * 5 AS engagement_score,
  CASE WHEN total_events >= 15 THEN 1 ELSE 0 END AS is_power_user
FROM (SELECT user_id, count(*) AS total_events, count(DISTINCT event_type) AS event_variety,
  count(DISTINCT CAST(ts AS DATE)) AS days_active,
  {', '.join(f"count(*) FILTER (event_type = '{k}') AS {k}_count" for k in KINDS)},
  {mavg('value')} AS avg_event_value, max(value) AS max_event_value,
  round(coalesce(stddev_samp(value), 0), 4) AS stddev_event_value FROM events GROUP BY user_id)
"""


def behaviour(events):
    total, kind = F.col("total_events"), F.col("event_type")
    per_user = (
        events.groupBy("user_id")
        .agg(
            F.count(F.lit(1)).alias("total_events"),
            F.count_distinct("event_type").alias("event_variety"),
            F.count_distinct(F.to_date("ts")).alias("days_active"),
            *[count_where(kind == k).alias(f"{k}_count") for k in KINDS],
            money_avg("value").alias("avg_event_value"),
            F.max("value").alias("max_event_value"),
            F.round(F.stddev("value"), 4).alias("stddev_event_value"),
        )
        .fillna(0, ["stddev_event_value"])
    )
    views = F.col("view_count")
    return per_user.withColumns(
        {
            "purchase_rate": F.col("purchase_count") / total,
            "signup_rate": F.col("signup_count") / total,
            "click_to_view_ratio": F.when(views > 0, F.col("click_count") / views).otherwise(0.0),
            "engagement_score": total * 0.3 + F.col("event_variety") * 10 + F.col("purchase_count") * 5,
            "is_power_user": F.when(total >= 15, 1).otherwise(0),
        }
    )


@query("user_behavior_features", BEHAVIOUR)
def user_behavior_features(t):
    return behaviour(t.events)


@query(
    "gold_customer_features",
    f"""SELECT c_custkey, segment, nation, coalesce(n, 0) AS total_transactions, coalesce(spend, 0) AS total_spend,
      coalesce(mean, 0) AS avg_transaction_amount, coalesce(top, 0) AS max_transaction_amount,
      coalesce(channels, 0) AS distinct_channels, coalesce(failed, 0) AS failed_transactions,
      CASE WHEN n > 0 THEN failed / n ELSE 0 END AS failure_rate,
      CASE WHEN segment = 'machinery' THEN 1 ELSE 0 END AS is_enterprise, CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS is_churned
    FROM (SELECT c_custkey, lower(trim(c_mktsegment)) AS segment, upper(trim(n_name)) AS nation, c_acctbal
          FROM customer JOIN nation ON c_nationkey = n_nationkey)
    LEFT JOIN (SELECT o_custkey, count(*) AS n, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS spend,
      {mavg('o_totalprice')} AS mean, max(o_totalprice) AS top, count(DISTINCT o_orderpriority) AS channels,
      count(*) FILTER (o_orderstatus = 'P') AS failed FROM orders WHERE o_totalprice > 0 GROUP BY 1) ON o_custkey = c_custkey""",
)
def gold_customer_features(t):
    price, status = F.col("o_totalprice"), F.col("o_orderstatus")
    per_customer = t.orders.filter(price > 0).groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.sum(F.when(status == "F", price.cast("decimal(18,2)")).otherwise(0)).cast("double").alias("total_spend"),
        money_avg("o_totalprice").alias("avg_transaction_amount"),
        F.max(price).alias("max_transaction_amount"),
        F.count_distinct("o_orderpriority").alias("distinct_channels"),
        count_where(status == "P").alias("failed_transactions"),
    )
    profile = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", F.lower(F.trim("c_mktsegment")).alias("segment"), F.upper(F.trim("n_name")).alias("nation"), "c_acctbal"
    )
    n = F.col("total_transactions")
    counted = per_customer.columns[1:]
    return (
        profile.join(per_customer, "c_custkey", "left")
        .fillna(0, counted)
        .withColumns(
            {
                "failure_rate": F.when(n > 0, F.col("failed_transactions") / n).otherwise(0.0),
                "is_enterprise": F.when(F.col("segment") == "machinery", 1).otherwise(0),
                "is_churned": F.when(F.col("c_acctbal") < 0, 1).otherwise(0),
            }
        )
        .drop("c_acctbal")
    )


@query(
    "training_set",
    f"SELECT user_id, total_events, engagement_score, quality AS label FROM ({BEHAVIOUR}) JOIN labels ON user_id = doc_id",
)
def training_set(t):
    labels = t.labels.select(F.col("doc_id").alias("user_id"), F.col("quality").alias("label"))
    return behaviour(t.events).join(labels, "user_id").select("user_id", "total_events", "engagement_score", "label")


@query(
    "label_encode",
    """SELECT c_custkey, c_mktsegment, dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS segment_index FROM customer""",
)
def label_encode(t):
    return ml.encode_labels(t.customer.select("c_custkey", "c_mktsegment"), "c_mktsegment", "segment_index")


HASH_SHARE = "('0x' || left(md5(CAST(o_orderkey AS VARCHAR)), 6))::BIGINT / 16777216.0::DOUBLE"


@query(
    "standard_scale",
    f"""SELECT o_orderkey, round((o_totalprice - m) / s, 6) AS o_totalprice, round((o_custkey - mc) / sc, 6) AS o_custkey
    FROM orders, (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS s, avg(o_custkey) AS mc, stddev_pop(o_custkey) AS sc
      FROM orders WHERE {HASH_SHARE} < 0.8)""",
)
def standard_scale(t):
    rows = t.orders.select("o_orderkey", "o_totalprice", F.col("o_custkey").cast("double").alias("o_custkey"))
    train = rows.filter(tx.hash_share(F.col("o_orderkey")) < 0.8)
    scaled = ml.standardise(train, rows, ["o_totalprice", "o_custkey"])
    return scaled.withColumns({c: F.round(c, 6) for c in ("o_totalprice", "o_custkey")})


@query(
    "stratified_split",
    """SELECT doc_id, quality, CASE WHEN rn * 5 <= n * 4 THEN 'train' ELSE 'test' END AS split FROM (
      SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY left(md5(CAST(doc_id AS VARCHAR)), 8), doc_id) AS rn,
        count(*) OVER (PARTITION BY quality) AS n FROM labels)""",
)
def stratified_split(t):
    return ml.stratified_split(t.labels.select("doc_id", "quality"), "doc_id", "quality")


@query(
    "stratified_folds",
    """SELECT doc_id, quality, CAST((row_number() OVER (PARTITION BY quality ORDER BY left(md5(CAST(doc_id AS VARCHAR)), 8), doc_id) - 1) % 5 AS INTEGER) AS fold
    FROM labels""",
)
def stratified_folds(t):
    return ml.stratified_folds(t.labels.select("doc_id", "quality"), "doc_id", "quality")


# --- scores -----------------------------------------------------------------


def scored_documents(t):
    """Labelled documents with a fixed score: the length, levelled off at 5000 characters."""
    score = F.least(F.col("n_chars"), F.lit(5000).cast("long")) / 5000
    rows = t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id")
    return rows.select("doc_id", "quality", score.alias("score")).withColumn(
        "predicted", F.when(F.col("score") >= 0.1, 1).otherwise(0)
    )


SCORED = """
scored AS (SELECT doc_id, quality, least(n_chars, 5000) / 5000 AS score,
  CASE WHEN least(n_chars, 5000) / 5000 >= 0.1 THEN 1 ELSE 0 END AS predicted FROM labels JOIN documents USING (doc_id))
"""


@query(
    "binary_metrics",
    f"""WITH {SCORED}, c AS (SELECT count(*) FILTER (quality = 1 AND predicted = 1) AS tp, count(*) FILTER (quality = 0 AND predicted = 1) AS fp,
      count(*) FILTER (quality = 1 AND predicted = 0) AS fn, count(*) FILTER (quality = 0 AND predicted = 0) AS tn FROM scored),
    wins AS (SELECT sum(CASE WHEN p.score > n.score THEN 1.0 WHEN p.score = n.score THEN 0.5 ELSE 0 END)::DOUBLE AS w
      FROM scored p, scored n WHERE p.quality = 1 AND n.quality = 0)
    SELECT *, (tp + tn) / (tp + fp + fn + tn) AS accuracy, tp / (tp + fp) AS precision, tp / (tp + fn) AS recall,
      2 * tp / (2 * tp + fp + fn) AS f1, (SELECT w FROM wins) / ((tp + fn) * (fp + tn)) AS auc FROM c""",
)
def binary_metrics(t):
    rows = scored_documents(t)
    return ml.binary_metrics(rows, "quality", "predicted").withColumn("auc", ml.auc(rows, "quality", "score").scalar())


@query("confusion_matrix", f"WITH {SCORED} SELECT quality AS label, predicted, count(*) AS n FROM scored GROUP BY 1, 2")
def confusion_matrix(t):
    return ml.confusion(scored_documents(t), "quality", "predicted")


@query(
    "roc_points",
    f"""WITH {SCORED} SELECT score AS threshold, CAST(sum(sum(quality)) OVER w AS DOUBLE) / (SELECT sum(quality) FROM labels) AS tpr,
      CAST(sum(sum(1 - quality)) OVER w AS DOUBLE) / (SELECT sum(1 - quality) FROM labels) AS fpr
    FROM scored GROUP BY score WINDOW w AS (ORDER BY score DESC)""",
)
def roc_points(t):
    curve = ml.roc_curve(scored_documents(t), "quality", "score")
    totals = t.labels.agg(F.struct(F.sum("quality").alias("p"), F.sum(1 - F.col("quality")).alias("n"))).scalar()
    return curve.select("threshold", (F.col("tp") / totals["p"]).alias("tpr"), (F.col("fp") / totals["n"]).alias("fpr"))


@query(
    "compare_runs",
    f"""WITH {SCORED} SELECT source AS run, count(*) AS n, CAST(count(*) FILTER (quality = predicted) AS DOUBLE) / count(*) AS accuracy
    FROM scored JOIN documents USING (doc_id) GROUP BY source ORDER BY accuracy DESC, run LIMIT 5""",
)
def compare_runs(t):
    """Each document source counts as a run of the same rule; the five best."""
    runs = scored_documents(t).join(t.documents.select("doc_id", "source"), "doc_id")
    right = count_where(F.col("quality") == F.col("predicted"))
    per_run = runs.groupBy(F.col("source").alias("run")).agg(
        F.count(F.lit(1)).alias("n"), (right / F.count(F.lit(1))).alias("accuracy")
    )
    return per_run.orderBy(F.desc("accuracy"), "run").limit(5)


# --- models -----------------------------------------------------------------

COLUMNS = ["chars", "n_words", "distinct_share", "digit_share", "mark_share", "lines"]


def document_features(documents, only=None):
    """Text measures per document; with ``only`` just for the documents listed there."""
    texts = spread(documents.select("doc_id", "text"))
    if only is not None:
        texts = texts.join(only.select("doc_id"), "doc_id", "left_semi")

    def features(w):
        distinct = F.size(F.array_distinct(w)) / F.greatest(F.size(w), F.lit(1))
        return F.struct(F.size(w).cast("double").alias("n_words"), distinct.alias("distinct_share"))

    chars = F.greatest(F.length("text"), F.lit(1)).cast("double")

    def share(pattern):
        return F.regexp_count("text", F.lit(pattern)) / chars

    return texts.select(
        "doc_id",
        chars.alias("chars"),
        tx.bind(tx.words(F.col("text")), features).alias("w"),
        share("[0-9]").alias("digit_share"),
        share(r"[^\p{L}\p{N}\s]").alias("mark_share"),
        (F.regexp_count("text", F.lit("\n")) + 1).cast("double").alias("lines"),
    ).select("doc_id", "chars", "w.n_words", "w.distinct_share", "digit_share", "mark_share", "lines")


def labelled(t):
    """Train and test rows, written once because every model reads them."""
    labels = t.labels.select("doc_id", "quality")
    rows = document_features(t.documents, labels).join(labels, "doc_id")
    split = settle(ml.stratified_split(rows, "doc_id", "quality"), "labelled")
    return split.filter("split = 'train'"), split.filter("split = 'test'")


@query("train_compare")
def train_compare(t):
    """Logistic regression, random forest and boosted trees on the quality labels."""
    train, test = labelled(t)
    return ml.compare_models(train, test, COLUMNS, "quality")[0]


@query("feature_importances")
def feature_importances(t):
    train, _ = labelled(t)
    model = ml.stages(COLUMNS, ml.classifiers("quality")["random_forest"]).fit(train)
    return ml.importances(model, t.spark, COLUMNS)


@query("grid_search")
def grid_search(t):
    """The grid of one family over five stratified folds."""
    train, _ = labelled(t)
    dealt = settle(ml.stratified_folds(train, "doc_id", "quality"), "folds")
    return ml.grid_search(dealt, COLUMNS, "quality")


@query("tuning_runs")
def tuning_runs(t):
    """Three families on held-out rows, then the grid of the best one over five folds, by AUC."""
    train, test = labelled(t)
    return ml.tuning_runs(train, test, COLUMNS, "doc_id", "quality")


@query(
    "tuning_checks",
    """SELECT stage, runs, folds, TRUE AS better_than_chance, TRUE AS grid_of_best, TRUE AS in_order
    FROM (VALUES ('family', 3::BIGINT, 1), ('grid', 4::BIGINT, 5)) v(stage, runs, folds)""",
)
def tuning_checks(t):
    """Counts and bounds of the run list: all runs there, the best one far from chance, places in the order of AUC."""
    runs = tuning_runs(t)
    best = runs.filter("stage = 'family' AND place = 1").agg(F.max("model")).scalar()
    after = F.lead("auc").over(Window.partitionBy("stage").orderBy("place"))
    return (
        runs.withColumns({"after": after, "best": best})
        .groupBy("stage")
        .agg(
            F.count(F.lit(1)).alias("runs"),
            F.max("folds").alias("folds"),
            (F.max("auc").between(0.8, 1.0) & (F.min("auc") >= 0)).alias("better_than_chance"),
            F.bool_and((F.col("stage") == "family") | (F.col("model") == F.col("best"))).alias("grid_of_best"),
            F.bool_and(F.coalesce(F.col("after") <= F.col("auc"), F.lit(True))).alias("in_order"),
        )
    )


@query("score_batch")
def score_batch(t):
    """Features of every document looked up by key, then scored by the trained model."""
    train, _ = labelled(t)
    model = ml.stages(COLUMNS, ml.classifiers("quality")["logistic_regression"]).fit(train)
    rows = feature_lookup(
        t.documents.select("doc_id"), [Lookup(document_features(t.documents), "doc_id", COLUMNS)]
    )
    return ml.score_rows(model, rows, ["doc_id"])


@query("classify_quality")
def classify_quality(t):
    """Text classifier: hashed and weighted words into logistic regression, all documents scored."""
    rows = spread(t.documents.select("doc_id", "text")).select("doc_id", tx.words(F.col("text")).alias("words"))
    steps = [
        HashingTF(inputCol="words", outputCol="tf", numFeatures=4096),
        IDF(inputCol="tf", outputCol="features"),
        LogisticRegression(featuresCol="features", labelCol="quality", maxIter=20, regParam=0.1),
    ]
    model = Pipeline(stages=steps).fit(rows.join(t.labels.select("doc_id", "quality"), "doc_id"))
    return ml.score_rows(model, rows, ["doc_id"])


@query(
    "forecast_linear",
    f"""WITH d AS (SELECT event_type, CAST(ts AS DATE) AS day, {msum('value')} AS y FROM events GROUP BY 1, 2),
    r AS (SELECT event_type, day, y, date_diff('day', DATE '1970-01-01', day) AS x FROM d),
    tr AS (SELECT event_type, regr_slope(y, x) AS b, regr_intercept(y, x) AS a, max(day) AS last FROM r GROUP BY 1),
    f AS (SELECT event_type, dayofweek(day) AS dow, avg(y / (a + b * x)) AS factor FROM r JOIN tr USING (event_type) GROUP BY 1, 2),
    ahead AS (SELECT event_type, a, b, CAST(last + CAST(step AS INTEGER) AS DATE) AS day FROM tr, range(1, 8) s(step))
    SELECT ahead.event_type, CAST(day AS VARCHAR) AS day,
      round((a + b * date_diff('day', DATE '1970-01-01', day)) * coalesce(factor, 1), 4) AS forecast
    FROM ahead LEFT JOIN f ON f.event_type = ahead.event_type AND dow = dayofweek(day)""",
)
def forecast_linear(t):
    daily = t.events.groupBy("event_type", F.to_date("ts").alias("day")).agg(money_sum("value").alias("total"))
    ahead = ml.forecast(daily, "event_type", "day", "total")
    return ahead.withColumns({"day": F.col("day").cast("string"), "forecast": F.round("forecast", 4)})
