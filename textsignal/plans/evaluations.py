"""Queries on scores and predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textsignal.operators import evaluation, kept, models, summaries
from textsignal.plans import inputs
from textsignal.plans.registry import query

SIDES = ("a", "b")


def _rounded(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query(f"""
WITH {inputs.SCORED_DOCUMENTS_SQL}
SELECT CASE WHEN prediction = 0 THEN 'b' ELSE 'a' END AS subject, prediction, count(*) AS n,
       count(*) / CAST((SELECT count(*) FROM scored) AS DOUBLE) AS share
FROM scored GROUP BY prediction""")
def prediction_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.class_shares(
        inputs.scored_documents(spark, sf_dir), "prediction", {0.0: "b", 1.0: "a"}
    )


@query(f"""
WITH {inputs.SCORED_DOCUMENTS_SQL}
SELECT round(avg(score), 6) AS score_a, round(1 - avg(score), 6) AS score_b FROM scored""")
def win_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = summaries.win_score(inputs.scored_documents(spark, sf_dir), "score", SIDES)
    return _rounded(found, ["score_a", "score_b"])


@query(f"""
WITH {inputs.SCORED_DOCUMENTS_SQL}
SELECT doc_id, round(score, 6) AS p_a, round(1 - score, 6) AS p_b FROM scored""")
def complement_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = inputs.scored_documents(spark, sf_dir)
    found = summaries.complement_scores(scored, "score", SIDES).select("doc_id", "p_a", "p_b")
    return _rounded(found, ["p_a", "p_b"])


@query(f"""
WITH {inputs.SCORED_DOCUMENTS_SQL}
SELECT round(avg(1 - score), 6) AS avg_p_b, round(avg(score), 6) AS avg_p_a FROM scored""")
def mean_probabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = summaries.complement_scores(inputs.scored_documents(spark, sf_dir), "score", SIDES)
    found = summaries.mean_probabilities(scored, {"avg_p_b": "p_b", "avg_p_a": "p_a"})
    return _rounded(found, ["avg_p_b", "avg_p_a"])


@query(f"""
WITH {inputs.SCORED_DOCUMENTS_SQL}
SELECT 'a' AS subject, round(avg(prediction), 6) AS share, round(avg(score), 6) AS mean_probability
FROM scored
UNION ALL
SELECT 'b', round(avg(1 - prediction), 6), round(avg(1 - score), 6) FROM scored""")
def win_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = summaries.complement_scores(inputs.scored_documents(spark, sf_dir), "score", SIDES)
    found = summaries.win_report(scored, "prediction", {"a": (1.0, "p_a"), "b": (0.0, "p_b")})
    return _rounded(found, ["share", "mean_probability"])


@query(f"""
WITH {inputs.SCORED_ITEMS_SQL}
SELECT l_orderkey, l_linenumber, round(label, 6) AS label, round(prediction, 6) AS prediction,
       round(label - prediction, 6) AS residual
FROM items""")
def residuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = evaluation.residuals(
        inputs.scored_items(spark, sf_dir).drop("returned"), "label", "prediction"
    )
    return _rounded(found, ["label", "prediction", "residual"])


@query(f"""
WITH {inputs.SCORED_ITEMS_SQL}
SELECT CAST(floor(label / 0.05::DOUBLE) AS BIGINT) AS label_cell,
       CAST(floor(prediction / 0.05::DOUBLE) AS BIGINT) AS prediction_cell, count(*) AS n
FROM items GROUP BY ALL""")
def actual_against_predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.pair_counts(
        inputs.scored_items(spark, sf_dir), "label", "prediction", 0.05
    )


@query(f"""
WITH {inputs.SCORED_ITEMS_SQL}, missed AS (
  SELECT prediction, label - prediction AS residual FROM items)
SELECT CAST(floor(prediction / 0.05::DOUBLE) AS BIGINT) AS prediction_cell,
       CAST(floor(residual / 0.05::DOUBLE) AS BIGINT) AS residual_cell, count(*) AS n
FROM missed GROUP BY ALL""")
def residuals_against_predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    missed = evaluation.residuals(inputs.scored_items(spark, sf_dir), "label", "prediction")
    return evaluation.pair_counts(missed, "prediction", "residual", 0.05)


@query(f"""
WITH {inputs.SCORED_DOCUMENTS_SQL}
SELECT label, prediction, count(*) AS n FROM scored GROUP BY ALL""")
def confusion_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.confusion(inputs.scored_documents(spark, sf_dir), "label", "prediction")


@query(f"""
WITH {inputs.SCORED_DOCUMENTS_SQL}
SELECT label, count(*) FILTER (prediction = 0) AS predicted_0,
       count(*) FILTER (prediction = 1) AS predicted_1
FROM scored GROUP BY label""")
def confusion_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.confusion_wide(
        inputs.scored_documents(spark, sf_dir), "label", "prediction"
    )


_CLASSES_SQL = f"""{inputs.SCORED_DOCUMENTS_SQL},
classes AS (SELECT label AS class FROM scored UNION SELECT prediction FROM scored),
counted AS (
  SELECT class,
         (SELECT count(*) FROM scored WHERE label = class) AS support,
         (SELECT count(*) FROM scored WHERE prediction = class) AS predicted,
         (SELECT count(*) FROM scored WHERE prediction = class AND label = class) AS hits
  FROM classes),
per_class AS (
  SELECT *, CASE WHEN predicted > 0 THEN hits / predicted::DOUBLE ELSE 0 END AS precision,
         CASE WHEN support > 0 THEN hits / support::DOUBLE ELSE 0 END AS recall
  FROM counted),
with_f1 AS (
  SELECT *, CASE WHEN precision + recall > 0
                 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1
  FROM per_class)"""


@query(f"""
WITH {_CLASSES_SQL}
SELECT class, CAST(support AS BIGINT) AS support, CAST(predicted AS BIGINT) AS predicted,
       CAST(hits AS BIGINT) AS hits, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1
FROM with_f1""")
def class_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = evaluation.class_metrics(
        inputs.scored_documents(spark, sf_dir), "label", "prediction"
    )
    return _rounded(found, ["precision", "recall", "f1"])


@query(f"""
WITH {_CLASSES_SQL}
SELECT round(sum(hits) / sum(support), 6) AS accuracy,
       round(sum(support * precision) / sum(support), 6) AS weighted_precision,
       round(sum(support * recall) / sum(support), 6) AS weighted_recall,
       round(sum(support * f1) / sum(support), 6) AS f1
FROM with_f1""")
def accuracy_precision_recall_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = evaluation.classification_metrics(
        inputs.scored_documents(spark, sf_dir), "label", "prediction"
    )
    return _rounded(found, found.columns)


@query(f"""
WITH {inputs.SCORED_ITEMS_SQL}, centred AS (SELECT avg(label) AS mean FROM items)
SELECT round(sqrt(avg((label - prediction) * (label - prediction))), 6) AS rmse,
       round(avg((label - prediction) * (label - prediction)), 6) AS mse,
       round(avg(abs(label - prediction)), 6) AS mae,
       round(1 - sum((label - prediction) * (label - prediction))
               / sum((label - mean) * (label - mean)), 6) AS r2
FROM items, centred""")
def regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = evaluation.regression_metrics(
        inputs.scored_items(spark, sf_dir), "label", "prediction"
    )
    return _rounded(found, found.columns)


def _curve_sql(relation: str, source: str, label: str, score: str) -> str:
    return f"""{relation},
per_score AS (
  SELECT {score} AS threshold, count(*) FILTER ({label} > 0) AS pos,
         count(*) FILTER (NOT {label} > 0) AS neg
  FROM {source} GROUP BY {score}),
curve AS (
  SELECT threshold, pos, neg,
         CAST(sum(pos) OVER down AS BIGINT) AS tp, CAST(sum(neg) OVER down AS BIGINT) AS fp,
         CAST(sum(pos) OVER () AS DOUBLE) AS p, CAST(sum(neg) OVER () AS DOUBLE) AS n
  FROM per_score
  WINDOW down AS (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


_DOCUMENT_CURVE = _curve_sql(inputs.SCORED_DOCUMENTS_SQL, "scored", "label", "score")
_ITEM_CURVE = _curve_sql(inputs.SCORED_ITEMS_SQL, "items", "returned", "label")


def _roc_sql(curve: str) -> str:
    return f"""
WITH {curve}
SELECT threshold, tp, fp, round(tp / p, 6) AS tpr, round(fp / n, 6) AS fpr FROM curve
UNION ALL SELECT 'Infinity'::DOUBLE, 0, 0, 0, 0"""


def _pr_sql(curve: str) -> str:
    return f"""
WITH {curve}
SELECT threshold, round(tp / (tp + fp)::DOUBLE, 6) AS precision, round(tp / p, 6) AS recall FROM curve
UNION ALL
(SELECT 'Infinity'::DOUBLE, round(tp / (tp + fp)::DOUBLE, 6), 0 FROM curve
 ORDER BY threshold DESC LIMIT 1)"""


def _areas_sql(curve: str) -> str:
    return f"""
WITH {curve},
pairs AS (
  SELECT p, n, tp, fp, tp / (tp + fp)::DOUBLE AS pr,
         lag(tp, 1, 0) OVER down AS tp0, lag(fp, 1, 0) OVER down AS fp0,
         lag(tp / (tp + fp)::DOUBLE) OVER down AS pr0
  FROM curve WINDOW down AS (ORDER BY threshold DESC))
SELECT round(sum((fp - fp0) / n * (tp + tp0) / p / 2), 6) AS auc_roc,
       round(sum((tp - tp0) / p * (pr + coalesce(pr0, pr)) / 2), 6) AS auc_pr
FROM pairs"""


@query(_roc_sql(_DOCUMENT_CURVE))
def roc_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = evaluation.roc_points(inputs.scored_documents(spark, sf_dir), "label", "score")
    return _rounded(found, ["tpr", "fpr"])


@query(_roc_sql(_ITEM_CURVE))
def roc_points_many_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = evaluation.roc_points(inputs.scored_items(spark, sf_dir), "returned", "label")
    return _rounded(found, ["tpr", "fpr"])


@query(_pr_sql(_DOCUMENT_CURVE))
def pr_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = evaluation.pr_points(inputs.scored_documents(spark, sf_dir), "label", "score")
    return _rounded(found, ["precision", "recall"])


@query(_areas_sql(_DOCUMENT_CURVE))
def auc_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = evaluation.areas(inputs.scored_documents(spark, sf_dir), "label", "score")
    return _rounded(found, ["auc_roc", "auc_pr"])


@query(_areas_sql(_ITEM_CURVE))
def auc_many_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = evaluation.areas(inputs.scored_items(spark, sf_dir), "returned", "label")
    return _rounded(found, ["auc_roc", "auc_pr"])


@query(f"""
WITH {inputs.SCORED_ITEMS_SQL},
cells AS (
  SELECT CAST(least(1023, greatest(0, floor(label * 1024))) AS INTEGER) AS cell,
         count(*) FILTER (returned > 0) AS pos, count(*) FILTER (NOT returned > 0) AS neg
  FROM items GROUP BY 1),
ranked AS (
  SELECT *, coalesce(sum(neg) OVER (ORDER BY cell ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
              AS below
  FROM cells),
bounds AS (
  SELECT sum(pos * below) / (sum(pos) * sum(neg))::DOUBLE AS low,
         sum(pos * (below + neg)) / (sum(pos) * sum(neg))::DOUBLE AS high
  FROM ranked),
areas AS ({_areas_sql(_ITEM_CURVE)})
SELECT round(low, 6) AS auc_low, round(high, 6) AS auc_high, auc_roc,
       auc_roc BETWEEN round(low, 6) AND round(high, 6) AS enclosed
FROM bounds, areas""")
def auc_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States of each line number, folded to bounds of the exact area."""
    items = inputs.scored_items(spark, sf_dir)
    states = kept.score_states(items, "returned", "label", ["l_linenumber"])
    bounds = _rounded(kept.area_bounds(states), ["auc_low", "auc_high"])
    exact = evaluation.areas(items, "returned", "label").select(F.round("auc_roc", 6).alias("auc"))
    both = bounds.withColumn("auc_roc", exact.scalar())
    return both.withColumn("enclosed", F.col("auc_roc").between(F.col("auc_low"), F.col("auc_high")))


@query("""
SELECT l_returnflag, count(l_quantity) AS n, round(avg(l_extendedprice), 4) AS mean,
       round(stddev_samp(l_extendedprice), 4) AS stddev, min(l_extendedprice) AS least,
       max(l_extendedprice) AS most
FROM lineitem GROUP BY l_returnflag""")
def kept_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A state for each day and class, folded over the days."""
    items = inputs.table(spark, sf_dir, "lineitem").withColumn("day", F.to_date("l_shipdate"))
    states = kept.value_states(items, ["l_returnflag", "day"], "l_extendedprice")
    found = kept.folded_values(states, ["l_returnflag"])
    return found.withColumns({c: F.round(c, 4) for c in ("mean", "stddev")})


@query(f"""
WITH {inputs.SCORED_DOCUMENTS_SQL}, rates AS (
  SELECT avg(prediction) FILTER (label = 1) AS tpr, avg(1 - prediction) FILTER (label = 0) AS tnr
  FROM scored)
SELECT round((tpr + tnr) / 2, 6) AS auc_hard FROM rates""")
def auc_hard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = evaluation.auc(inputs.scored_documents(spark, sf_dir), "label", "prediction")
    return found.select(F.round("auc_roc", 6).alias("auc_hard"))


@query(f"""
WITH areas AS ({_areas_sql(_ITEM_CURVE)})
SELECT 'areaUnderROC' AS metric, auc_roc AS value FROM areas""")
def evaluator_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = inputs.scored_items(spark, sf_dir).withColumn("rawPrediction", F.col("label"))
    found = models.evaluate(spark, items, "returned", ["areaUnderROC"])
    return _rounded(found, ["value"])


@query(f"""
WITH {_CLASSES_SQL},
metrics AS (
  SELECT sum(hits) / sum(support) AS accuracy,
         sum(support * precision) / sum(support) AS precision,
         sum(support * recall) / sum(support) AS recall, sum(support * f1) / sum(support) AS f1
  FROM with_f1)
SELECT 'accuracy' AS metric, round(accuracy, 6) AS value FROM metrics
UNION ALL SELECT 'weightedPrecision', round(precision, 6) FROM metrics
UNION ALL SELECT 'weightedRecall', round(recall, 6) FROM metrics
UNION ALL SELECT 'f1', round(f1, 6) FROM metrics""")
def evaluator_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = inputs.scored_documents(spark, sf_dir)
    names = ["accuracy", "weightedPrecision", "weightedRecall", "f1"]
    return _rounded(models.evaluate(spark, scored, "label", names), ["value"])
