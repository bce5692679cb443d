"""Evaluation of predictions as plain aggregates: tables in, tables out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textsignal.operators.running import running_total


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Rows per pair of actual and predicted class: `[label, prediction, n]`."""
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count("*").alias("n")
    )


def confusion_wide(
    df: DataFrame, label: str, prediction: str, classes: Sequence[float] = (0, 1)
) -> DataFrame:
    """One row per actual class and one column `predicted_<class>` per given class."""
    return df.groupBy(F.col(label).alias("label")).agg(
        *[
            F.count_if(F.col(prediction) == value).alias(f"predicted_{value}")
            for value in classes
        ]
    )


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def class_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Per class: support, predicted, hits, precision, recall and F1; 0 where undefined."""
    counts = df.groupBy(
        F.col(label).cast("double").alias("_label"),
        F.col(prediction).cast("double").alias("_prediction"),
    ).agg(F.count("*").alias("_n"))
    none = F.lit(0).cast("long")
    hit = F.when(F.col("_label") == F.col("_prediction"), F.col("_n")).otherwise(none)
    # Every cell of the small count table speaks for its actual and for its predicted class.
    sides = F.array(
        F.struct(
            F.col("_label").alias("class"),
            F.col("_n").alias("support"),
            none.alias("predicted"),
            hit.alias("hits"),
        ),
        F.struct(
            F.col("_prediction").alias("class"),
            none.alias("support"),
            F.col("_n").alias("predicted"),
            none.alias("hits"),
        ),
    )
    per_class = (
        counts.select(F.explode(sides).alias("side"))
        .select("side.*")
        .groupBy("class")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    )
    precision = _ratio(F.col("hits"), F.col("predicted"))
    recall = _ratio(F.col("hits"), F.col("support"))
    return per_class.withColumns({"precision": precision, "recall": recall}).withColumn(
        "f1",
        _ratio(
            2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")
        ),
    )


def classification_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Accuracy and the support-weighted precision, recall and F1, in one row."""
    n = F.sum("support")

    def weighted(column: str) -> Column:
        return F.sum(F.col("support") * F.col(column)) / n

    return class_metrics(df, label, prediction).agg(
        (F.sum("hits") / n).alias("accuracy"),
        weighted("precision").alias("weighted_precision"),
        weighted("recall").alias("weighted_recall"),
        weighted("f1").alias("f1"),
    )


def residuals(df: DataFrame, label: str, prediction: str, out: str = "residual") -> DataFrame:
    """Adds what the prediction misses: label minus prediction."""
    return df.withColumn(out, F.col(label) - F.col(prediction))


def pair_counts(df: DataFrame, x: str, y: str, step: float) -> DataFrame:
    """Rows per cell of a grid of `step` by `step`: what a scatter plot of two columns shows."""
    return df.groupBy(
        F.floor(F.col(x) / step).alias(f"{x}_cell"), F.floor(F.col(y) / step).alias(f"{y}_cell")
    ).agg(F.count("*").alias("n"))


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Root mean squared, mean squared and mean absolute error, and R squared, in one pass."""
    scored = df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    error = F.col(label) - F.col(prediction)
    return scored.agg(
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(error * error).alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - F.avg(error * error) / F.nullif(F.var_pop(label), F.lit(0.0))).alias("r2"),
    )


def _curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """Per distinct score: rows of each class at it, and at or above it.

    Rows are counted per score first, so a score that many rows share is one row afterwards.
    """
    scored = df.select(
        (F.col(label) > 0).alias("_positive"),
        (-F.col(score).cast("double")).alias("_down"),
    ).where(F.col("_positive").isNotNull() & F.col("_down").isNotNull())
    per_score = scored.groupBy("_down").agg(
        F.count_if("_positive").alias("pos"), F.count_if(~F.col("_positive")).alias("neg")
    )
    counted = running_total(per_score, ["_down"], {"tp": "pos", "fp": "neg"}, keys=scored)
    totals = per_score.agg(
        F.struct(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).alias("totals")
    )
    return counted.select(
        (F.lit(0.0) - F.col("_down")).alias("threshold"),  # a score of zero stays positive
        "pos",
        "neg",
        "tp",
        "fp",
        totals.scalar().alias("totals"),
    )


def roc_points(df: DataFrame, label: str, score: str) -> DataFrame:
    """Points of the ROC curve, one per distinct score and one at the origin.

    `[threshold, tp, fp, tpr, fpr]`; a row counts as predicted if its score is at least the
    threshold, and the origin has an infinite threshold.
    """
    points = _curve(df, label, score).select(
        "threshold",
        "tp",
        "fp",
        _ratio(F.col("tp"), F.col("totals.pos")).alias("tpr"),
        _ratio(F.col("fp"), F.col("totals.neg")).alias("fpr"),
    )
    none = F.lit(0).cast("long")
    origin = df.sparkSession.range(1).select(
        F.lit(float("inf")).alias("threshold"),
        none.alias("tp"),
        none.alias("fp"),
        F.lit(0.0).alias("tpr"),
        F.lit(0.0).alias("fpr"),
    )
    return points.unionByName(origin)


def pr_points(df: DataFrame, label: str, score: str) -> DataFrame:
    """Points of the precision-recall curve, one per distinct score, and its left end.

    `[threshold, precision, recall]`; the left end has recall 0 and the precision of the
    highest score.
    """
    curve = _curve(df, label, score)
    points = curve.select(
        "threshold",
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        _ratio(F.col("tp"), F.col("totals.pos")).alias("recall"),
    )
    first = points.agg(F.max_by("precision", "threshold").alias("precision")).select(
        F.lit(float("inf")).alias("threshold"), "precision", F.lit(0.0).alias("recall")
    )
    return points.unionByName(first.where(F.col("precision").isNotNull()))


def areas(df: DataFrame, label: str, score: str) -> DataFrame:
    """Areas under the ROC and the precision-recall curve by trapezoids: `[auc_roc, auc_pr]`.

    The point before each one is known from its own counts, so no row looks at another.
    """
    tp, fp = F.col("tp").cast("double"), F.col("fp").cast("double")
    tp_before, fp_before = tp - F.col("pos"), fp - F.col("neg")
    above = tp_before + fp_before
    precision = tp / (tp + fp)
    precision_before = F.when(above > 0, tp_before / F.nullif(above, F.lit(0.0))).otherwise(
        precision
    )
    roc_part = F.col("neg") * (tp + tp_before) / 2
    pr_part = F.col("pos") * (precision + precision_before) / 2
    pos, neg = F.max("totals.pos").cast("double"), F.max("totals.neg").cast("double")
    return _curve(df, label, score).agg(
        (F.sum(roc_part) / F.nullif(pos * neg, F.lit(0.0))).alias("auc_roc"),
        (F.sum(pr_part) / F.nullif(pos, F.lit(0.0))).alias("auc_pr"),
    )


def auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the ROC curve of a score; of hard 0/1 predictions it is (TPR + TNR) / 2."""
    return areas(df, label, score).select("auc_roc")
