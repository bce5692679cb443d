import random

import pytest
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    MulticlassClassificationEvaluator,
    RegressionEvaluator,
)
from pyspark.sql import functions as F

from helpers import rows
from textsignal.operators import evaluation, summaries


def scored(spark, n=700, distinct=None, seed=1):
    rng = random.Random(seed)
    data = []
    for i in range(n):
        score = rng.random() if distinct is None else rng.randrange(distinct) / distinct
        label = float(rng.random() < 0.3 + 0.4 * score)
        data.append((i, label, score, float(score > 0.6)))
    return spark.createDataFrame(data, "id int, label double, score double, prediction double")


@pytest.mark.parametrize("distinct", [None, 5, 1])
def test_areas_equal_the_evaluator(spark, distinct):
    df = scored(spark, distinct=distinct)
    found = evaluation.areas(df, "label", "score").first()
    for name, value in [("areaUnderROC", found["auc_roc"]), ("areaUnderPR", found["auc_pr"])]:
        evaluator = BinaryClassificationEvaluator(
            rawPredictionCol="score", metricName=name, numBins=0
        )
        assert value == pytest.approx(evaluator.evaluate(df), abs=1e-9)


def test_auc_of_hard_predictions(spark):
    df = scored(spark)
    counts = {(r[0], r[1]): r[2] for r in rows(evaluation.confusion(df, "label", "prediction"))}
    tpr = counts[1.0, 1.0] / (counts[1.0, 1.0] + counts[1.0, 0.0])
    tnr = counts[0.0, 0.0] / (counts[0.0, 0.0] + counts[0.0, 1.0])
    assert evaluation.auc(df, "label", "prediction").first()[0] == pytest.approx((tpr + tnr) / 2)


def test_known_curve(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.2)], "label int, score double")
    points = [tuple(r) for r in evaluation.roc_points(df, "label", "score").orderBy(F.desc("threshold")).collect()]
    assert points == [
        (float("inf"), 0, 0, 0.0, 0.0), (0.9, 1, 0, 0.5, 0.0), (0.8, 1, 1, 0.5, 0.5),
        (0.7, 2, 1, 1.0, 0.5), (0.2, 2, 2, 1.0, 1.0),
    ]
    assert evaluation.auc(df, "label", "score").first()[0] == 0.75
    pr = [tuple(r) for r in evaluation.pr_points(df, "label", "score").orderBy(F.desc("threshold")).collect()]
    assert pr[0] == (float("inf"), 1.0, 0.0) and pr[1] == (0.9, 1.0, 0.5)
    tied = df.withColumn("score", F.lit(0.3))
    assert evaluation.auc(tied, "label", "score").first()[0] == 0.5


def test_a_score_of_zero_has_a_positive_threshold(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.0), (1, -0.0)], "label int, score double")
    lowest = evaluation.roc_points(df, "label", "score").orderBy("threshold").first()
    assert str(lowest["threshold"]) == "0.0" and (lowest["tp"], lowest["fp"]) == (2, 1)


def test_curves_without_rows_or_with_one_class(spark):
    empty = scored(spark).where("id < 0")
    assert evaluation.areas(empty, "label", "score").first()["auc_roc"] is None
    assert rows(evaluation.pr_points(empty, "label", "score")) == []
    ones = scored(spark).where("label = 1")
    assert evaluation.areas(ones, "label", "score").first()["auc_roc"] is None
    assert evaluation.roc_points(ones, "label", "score").agg(F.max("fpr")).first()[0] == 0.0


def test_class_metrics_equal_the_evaluator(spark):
    df = scored(spark)
    one = evaluation.classification_metrics(df, "label", "prediction").first()
    names = {
        "accuracy": "accuracy", "weightedPrecision": "weighted_precision",
        "weightedRecall": "weighted_recall", "f1": "f1",
    }
    for name, column in names.items():
        value = MulticlassClassificationEvaluator(metricName=name).evaluate(df)
        assert one[column] == pytest.approx(value)
    per_class = {r["class"]: r for r in evaluation.class_metrics(df, "label", "prediction").collect()}
    for k in (0.0, 1.0):
        for name, column in [("precisionByLabel", "precision"), ("recallByLabel", "recall")]:
            value = MulticlassClassificationEvaluator(metricName=name, metricLabel=k).evaluate(df)
            assert per_class[k][column] == pytest.approx(value)


def test_undefined_precision_is_zero(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0)], "label double, prediction double")
    got = {r["class"]: r["precision"] for r in evaluation.class_metrics(df, "label", "prediction").collect()}
    assert got == {0.0: 0.5, 1.0: 0.0}
    wide = evaluation.confusion_wide(df, "label", "prediction")
    assert rows(wide) == [(0.0, 1, 0), (1.0, 1, 0)]


def test_regression_metrics_equal_the_evaluator(spark):
    df = scored(spark).withColumn("prediction", F.col("score"))
    one = evaluation.regression_metrics(df, "label", "prediction").first()
    for name in ("rmse", "mse", "mae", "r2"):
        assert one[name] == pytest.approx(RegressionEvaluator(metricName=name).evaluate(df))


def test_residuals_and_pair_counts(spark):
    df = spark.createDataFrame([(1.0, 0.75), (0.5, 0.75), (0.52, 0.76)], "label double, prediction double")
    assert [r["residual"] for r in evaluation.residuals(df, "label", "prediction").collect()][:2] == [0.25, -0.25]
    assert rows(evaluation.pair_counts(df, "label", "prediction", 0.25)) == [(2, 3, 2), (4, 3, 1)]


def test_histogram(spark):
    df = spark.createDataFrame([(0.0,), (0.1,), (0.5,), (1.0,), (1.0,), (None,)], "v double")
    got = [tuple(r) for r in summaries.histogram(df, "v", 4).orderBy("bin").collect()]
    assert got == [(0, 0.0, 0.25, 2), (1, 0.25, 0.5, 0), (2, 0.5, 0.75, 1), (3, 0.75, 1.0, 2)]
    flat = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    got = [tuple(r) for r in summaries.histogram(flat, "v", 2).orderBy("bin").collect()]
    assert got == [(0, 1.5, 2.0, 0), (1, 2.0, 2.5, 2)]


def test_distribution_summary_shape(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (0.5,), (None,)], "v double")
    assert rows(summaries.distribution(df, "v")) == sorted(
        [(0.0, 1, 25.0), (0.5, 2, 50.0), (None, 1, 25.0)], key=repr
    )
    one = summaries.summary(df, "v").first()
    assert (one["n"], one["min"], one["max"]) == (3, 0.0, 0.5)
    assert one["stddev"] == pytest.approx(0.2886751)
    assert summaries.shape(df).first() == (4, 1)
    assert summaries.distinct_count(df, "v").first() == (2, 4)


def test_win_reports(spark):
    df = spark.createDataFrame([(0.9, 1.0), (0.7, 1.0), (0.2, 0.0), (0.6, 1.0)], "p double, prediction double")
    one = summaries.win_score(df, "p", ("a", "b")).first()
    assert one["score_a"] == pytest.approx(0.6) and one["score_b"] == pytest.approx(0.4)
    shares = summaries.class_shares(df, "prediction", {0.0: "b", 1.0: "a"})
    assert rows(shares) == [("a", 1.0, 3, 0.75), ("b", 0.0, 1, 0.25)]
    both = summaries.complement_scores(df, "p", ("a", "b"))
    report = summaries.win_report(both, "prediction", {"a": (1.0, "p_a"), "b": (0.0, "p_b")})
    got = {r[0]: (r[1], round(r[2], 6)) for r in report.collect()}
    assert got == {"a": (0.75, 0.6), "b": (0.25, 0.4)}
    means = summaries.mean_probabilities(both, {"m": "p_b"}).first()
    assert means["m"] == pytest.approx(0.4)
