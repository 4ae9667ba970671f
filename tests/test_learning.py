import pytest
from pyspark.sql import functions as F

from tidemark.operators import learning as ml


def test_folds_are_even_within_each_label(spark):
    """One label holds nine tenths of the rows."""
    df = spark.range(1003).select("id", (F.col("id") % 10 == 0).cast("int").alias("label"))
    dealt = ml.stratified_folds(df, "id", "label", 5)
    assert dealt.columns == ["id", "label", "fold"] and dealt.count() == 1003
    for label in (0, 1):
        sizes = [r["n"] for r in dealt.filter(F.col("label") == label).groupBy("fold").agg(F.count("*").alias("n")).collect()]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1
    again = ml.stratified_folds(df.repartition(7), "id", "label", 5)
    assert sorted(dealt.collect()) == sorted(again.collect())


def test_folds_of_few_rows(spark):
    df = spark.createDataFrame([(1, 0), (2, 0), (3, 1)], "id long, label int")
    got = {(r["label"], r["fold"]) for r in ml.stratified_folds(df, "id", "label").collect()}
    assert got == {(0, 0), (0, 1), (1, 0)}
    assert ml.stratified_folds(df.limit(0), "id", "label").count() == 0


@pytest.mark.parametrize("family", sorted(ml.GRIDS))
def test_grid_covers_every_setting(spark, family):
    noise = F.pmod(F.xxhash64("id"), F.lit(7)) / 10
    df = spark.range(60).select("id", (F.col("id") % 2).cast("int").alias("label"))
    df = ml.stratified_folds(df.withColumn("x", F.col("label") + noise), "id", "label", 2)
    found = ml.grid_search(df, ["x"], "label", family, folds=2).collect()
    assert len({r["params"] for r in found}) == len(found) == 4
    assert [r["mean_auc"] for r in found] == sorted((r["mean_auc"] for r in found), reverse=True)
    assert all(r["model"] == family and r["mean_auc"] > 0.9 for r in found)


def test_grid_prepares_features_once_a_fold(spark, monkeypatch):
    fits, plain = [], ml.Pipeline.fit
    monkeypatch.setattr(ml.Pipeline, "fit", lambda self, *a: fits.append(self) or plain(self, *a))
    df = spark.range(60).select("id", (F.col("id") % 2).cast("int").alias("label"), (F.col("id") % 7).cast("double").alias("x"))
    assert ml.grid_search(ml.stratified_folds(df, "id", "label", 2), ["x"], "label", folds=2).count() == 4
    assert len(fits) == 2
