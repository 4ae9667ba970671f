"""Feature scaling, splits, scores and MLlib training on executors."""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.text import hash_share
from tidemark.operators import segmented
from tidemark.operators.joins import broadcast_if_small
from tidemark.session import settle


def label_dictionary(df: DataFrame, column: str) -> DataFrame:
    """``label, label_index``: every different label and its place in alphabetical order, from 0; stored.

    Labels are dealt into ranges when there are many, and numbered by their
    place in the range and the sizes of the ranges before, so no task and no
    driver holds them all. Null is no label.
    """
    labels = settle(df.select(F.col(column).alias("label")).filter("label is not null").distinct(), "labels")
    placed = segmented.row_position(labels, [], ["label"], "__place")
    return settle(placed.select("label", (F.col("__place") - 1).cast("long").alias("label_index")), "label-index")


def encode_labels(df: DataFrame, column: str, out: str, dictionary: DataFrame | None = None) -> DataFrame:
    """``df`` with the index of its label, by the ``dictionary`` of a training set or its own.

    Null and labels that the dictionary lacks get the first index after it.
    """
    known = label_dictionary(df, column) if dictionary is None else dictionary
    known = known.select(F.col("label").alias(column), F.col("label_index").alias(out))
    unseen = known.agg(F.count(F.lit(1))).scalar()
    return df.join(broadcast_if_small(known), column, "left").withColumn(out, F.coalesce(F.col(out), unseen)).select(*df.columns, out)


def standardise(train: DataFrame, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """z-scores with mean and population deviation of ``train`` only."""
    stats = train.agg(
        F.struct(
            *[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]
        )
    ).scalar()
    scaled = {c: (F.col(c) - stats[f"m_{c}"]) / F.nullif(stats[f"s_{c}"], F.lit(0.0)) for c in columns}
    return df.withColumns(scaled)


def stratified_split(df: DataFrame, id: str, label: str, fifths: int = 4) -> DataFrame:
    """``split`` is ``train`` for the first ``fifths``/5 of each label in hash order.

    Positions come from segmented ranks, so a label may hold most of the rows.
    """
    hashed = df.withColumn("__h", hash_share(F.col(id), 8))
    placed = segmented.row_position(hashed, [label], ["__h", id], "__rn")
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("__n"))
    part = F.when(F.col("__rn") * 5 <= F.col("__n") * fifths, "train").otherwise("test")
    return placed.join(sizes, label).withColumn("split", part).drop("__h", "__rn", "__n")


def stratified_folds(df: DataFrame, id: str, label: str, folds: int = 5, out: str = "fold") -> DataFrame:
    """``out`` from 0 to ``folds`` - 1: each label in hash order is dealt out in turn, so its counts differ by one at most.

    Positions come from segmented ranks, so a label may hold most of the rows.
    """
    placed = segmented.row_position(df.withColumn("__h", hash_share(F.col(id), 8)), [label], ["__h", id], "__rn")
    return placed.withColumn(out, ((F.col("__rn") - 1) % folds).cast("int")).drop("__h", "__rn")


# --- scores -----------------------------------------------------------------


def roc_curve(df: DataFrame, label: str, score: str, segment=segmented.AUTO) -> DataFrame:
    """Rows per distinct score with the true and false positives at that threshold.

    Scores are counted first, then summed from the top in segments, so neither
    many rows nor many scores meet in one task.
    """
    levels = df.groupBy(F.col(score).alias("threshold")).agg(
        F.sum(F.col(label).cast("long")).alias("pos"), F.sum(1 - F.col(label).cast("long")).alias("neg")
    )
    down = levels.withColumn("__down", -F.col("threshold"))
    if segment is segmented.AUTO:
        segment = segmented.plan(down, [], ["__down"])
    tp = segmented.running_sum(down, [], ["__down"], "pos", "tp", segment)
    return segmented.running_sum(tp, [], ["__down"], "neg", "fp", segment).drop("__down")


def auc(df: DataFrame, label: str, score: str, segment=segmented.AUTO) -> DataFrame:
    """Area under the ROC curve; tied scores count half."""
    curve = roc_curve(df, label, score, segment)
    # Products of row counts outgrow a long.
    pos, neg, fp = (F.col(c).cast("double") for c in ("pos", "neg", "fp"))
    # A positive wins against the negatives below it: all of them less those at or above.
    sums = curve.agg(
        F.sum(pos).alias("p"), F.sum(neg).alias("n"), F.sum(pos * fp).alias("above"), F.sum(pos * neg).alias("tied")
    )
    p, n = F.col("p"), F.col("n")
    return sums.select(((p * n - F.col("above") + F.col("tied") / 2) / (p * n)).alias("auc"))


def confusion(df: DataFrame, label: str, predicted: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def binary_metrics(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Accuracy, precision, recall and F1 in one aggregate."""
    l, p = F.col(label) == 1, F.col(predicted) == 1
    counts = df.agg(
        F.count_if(l & p).alias("tp"),
        F.count_if(~l & p).alias("fp"),
        F.count_if(l & ~p).alias("fn"),
        F.count_if(~l & ~p).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def ratio(a: Column, b: Column) -> Column:
        return F.when(b > 0, a / b).otherwise(0.0)

    return counts.select(
        "tp",
        "fp",
        "fn",
        "tn",
        ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


# --- models -----------------------------------------------------------------


def classifiers(label: str) -> dict:
    at = {"featuresCol": "features", "labelCol": label, "seed": 42}
    return {
        "logistic_regression": LogisticRegression(featuresCol="features", labelCol=label, maxIter=50),
        "random_forest": RandomForestClassifier(numTrees=50, maxDepth=5, **at),
        "gradient_boosting": GBTClassifier(maxIter=20, maxDepth=3, **at),
    }


def stages(columns: Sequence[str], estimator) -> Pipeline:
    """Null features take the training mean, so no row is left out, neither in training nor in scoring."""
    return Pipeline(
        stages=[
            Imputer(inputCols=list(columns), outputCols=[f"__{c}" for c in columns], strategy="mean"),
            VectorAssembler(inputCols=[f"__{c}" for c in columns], outputCol="raw"),
            StandardScaler(inputCol="raw", outputCol="features", withMean=True),
            estimator,
        ]
    )


def score_rows(model: PipelineModel, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Probability of class 1 and the predicted class."""
    out = model.transform(df)
    return out.select(
        *keep,
        vector_to_array("probability")[1].alias("score"),
        F.col("prediction").cast("int").alias("predicted"),
    )


def compare_models(
    train: DataFrame, test: DataFrame, columns: Sequence[str], label: str
) -> tuple[DataFrame, dict[str, PipelineModel]]:
    """Train each classifier and measure it on ``test``; one row per model."""
    rows, models = None, {}
    for name, estimator in classifiers(label).items():
        models[name] = stages(columns, estimator).fit(train)
        scored = score_rows(models[name], test, [label])
        one = (
            binary_metrics(scored, label, "predicted")
            .select("accuracy", "precision", "recall", "f1")
            .withColumn("auc", auc(scored, label, "score").scalar())
            .withColumn("model", F.lit(name))
        )
        rows = one if rows is None else rows.unionByName(one)
    return rows, models


def importances(model: PipelineModel, spark, columns: Sequence[str], k: int = 5) -> DataFrame:
    """The ``k`` features a tree model uses most; as many values as columns."""
    weights = [(c, float(v)) for c, v in zip(columns, model.stages[-1].featureImportances.toArray())]
    found = spark.createDataFrame(weights, "feature string, importance double")
    return found.orderBy(F.desc("importance"), "feature").limit(k)


# Parameter sets tried for each model family.
GRIDS = {
    "logistic_regression": {"regParam": [0.0, 0.05], "elasticNetParam": [0.0, 0.5]},
    "random_forest": {"numTrees": [20, 50], "maxDepth": [3, 6]},
    "gradient_boosting": {"maxIter": [10, 20], "maxDepth": [2, 4]},
}


def grid_search(
    train: DataFrame,
    columns: Sequence[str],
    label: str,
    family: str = "logistic_regression",
    fold: str = "fold",
    folds: int = 5,
    parallelism: int = 4,
) -> DataFrame:
    """AUC of every parameter set of a family's grid over the folds that ``fold`` (0 to ``folds`` - 1) names, best first.

    The features of a fold are prepared once, by its training rows, for all parameter sets.
    """
    estimator = classifiers(label)[family]
    builder = ParamGridBuilder()
    for name, values in GRIDS[family].items():
        builder = builder.addGrid(estimator.getParam(name), values)
    grid = builder.build()
    evaluator = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC")
    auc_of = np.zeros((len(grid), folds))
    for k in range(folds):
        prepare = Pipeline(stages=stages(columns, estimator).getStages()[:-1]).fit(train.filter(F.col(fold) != k))
        ready = prepare.transform(train.select(fold, label, *columns)).select(fold, label, "features")
        inner, outer = (ready.filter(c).drop(fold).persist() for c in (F.col(fold) != k, F.col(fold) == k))
        with ThreadPool(parallelism) as pool:
            measured = pool.map(inheritable_thread_target(train.sparkSession)(lambda g: evaluator.evaluate(estimator.fit(inner, g).transform(outer))), grid)
        auc_of[:, k] = measured
        inner.unpersist()
        outer.unpersist()
    rows = [
        (family, ", ".join(f"{p.name}={v}" for p, v in sorted(g.items(), key=lambda x: x[0].name)), float(np.mean(v)), float(np.std(v)))
        for g, v in zip(grid, auc_of)
    ]
    found = train.sparkSession.createDataFrame(rows, "model string, params string, mean_auc double, std_auc double")
    return found.orderBy(F.desc("mean_auc"), "params")


def tuning_runs(
    train: DataFrame, test: DataFrame, columns: Sequence[str], id: str, label: str, folds: int = 5
) -> DataFrame:
    """Every run of a tuning as one stored row with its AUC, best first within its stage.

    Stage ``family`` trains each model family and measures it on ``test``.
    Stage ``grid`` goes through the grid of the best family over stratified folds of ``train``.
    """
    families = settle(compare_models(train, test, columns, label)[0].select("model", "auc"), "family-runs")
    best = families.orderBy(F.desc("auc"), "model").first()["model"]
    dealt = settle(stratified_folds(train, id, label, folds), "folds")
    tried = grid_search(dealt, columns, label, best, "fold", folds)
    runs = families.select(
        F.lit("family").alias("stage"), "model", F.lit("").alias("params"), F.lit(1).alias("folds"), "auc", F.lit(None).cast("double").alias("std_auc")
    ).unionByName(
        tried.select(F.lit("grid").alias("stage"), "model", "params", F.lit(folds).alias("folds"), F.col("mean_auc").alias("auc"), "std_auc")
    )
    place = F.row_number().over(Window.partitionBy("stage").orderBy(F.desc("auc"), "model", "params"))
    return settle(runs.withColumn("place", place), "runs")


# --- forecast ---------------------------------------------------------------


def forecast(daily: DataFrame, series: str, day: str, value: str, horizon: int = 7) -> DataFrame:
    """Linear trend per series times the mean day-of-week factor, ``horizon`` days ahead.

    ``daily`` holds one row per series and day. Trend and factors are plain
    aggregates, so a series may be as long as it likes.
    """
    x = F.datediff(F.col(day), F.lit("1970-01-01").cast("date"))
    rows = daily.select(series, F.col(day).alias("day"), F.col(value).cast("double").alias("y"), x.alias("x"))
    trend = rows.groupBy(series).agg(
        F.regr_slope("y", "x").alias("slope"),
        F.regr_intercept("y", "x").alias("intercept"),
        F.max("day").alias("last"),
    )
    line = F.col("intercept") + F.col("slope") * F.col("x")
    factor = (
        rows.join(trend, series)
        .groupBy(series, F.dayofweek("day").alias("dow"))
        .agg(F.avg(F.col("y") / F.nullif(line, F.lit(0.0))).alias("factor"))
    )
    ahead = trend.select(
        series, "slope", "intercept", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"), "last"
    ).withColumn("day", F.date_add("last", F.col("step")))
    ahead = ahead.withColumns({"x": F.datediff("day", F.lit("1970-01-01").cast("date")), "dow": F.dayofweek("day")})
    return ahead.join(factor, [series, "dow"], "left").select(
        series, "day", (line * F.coalesce("factor", F.lit(1.0))).alias("forecast")
    )
