import math

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from helpers import rows
from textsignal.functions.vectors import as_array, as_vector, element
from textsignal.operators import features, models
from textsignal.operators.split import hash_split
from textsignal.plans import inputs

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def vectors(spark):
    return inputs.embedded(spark, SF)


def test_vector_conversions(spark):
    df = spark.createDataFrame([(Vectors.sparse(3, [1], [2.0]),)], ["v"])
    assert df.select(as_array(F.col("v"))).first()[0] == [0.0, 2.0, 0.0]
    assert df.select(element(F.col("v"), 0)).first()[0] == 0.0
    back = df.select(as_vector(as_array(F.col("v"))).alias("v")).first()[0]
    assert back == Vectors.dense([0.0, 2.0, 0.0])


def test_scaler_is_fitted_on_the_first_frame_only(spark):
    train = spark.createDataFrame([(Vectors.dense([1.0, 5.0]),), (Vectors.dense([3.0, 5.0]),)], ["f"])
    other = spark.createDataFrame([(Vectors.dense([math.sqrt(2), 7.0]),)], ["f"])
    scaled_train, scaled_other = features.scale(train, other, "f")
    assert scaled_other.first()["scaled"].toArray() == pytest.approx([1.0, 0.0])
    assert scaled_train.count() == 2


def test_mean_vector(spark):
    df = spark.createDataFrame([("a", [1.0, 2.0]), ("a", [3.0, 4.0]), ("b", [5.0, 6.0])], "k string, v array<float>")
    assert rows(features.mean_vector(df, ["k"], "v")) == [
        ("a", 0, 2.0), ("a", 1, 3.0), ("b", 0, 5.0), ("b", 1, 6.0),
    ]


def test_embedding_is_the_mean_of_word_vectors(spark):
    df = spark.createDataFrame([(["a", "b", "a"],), ([],), (["c"],)] * 5, "t array<string>")
    model = features.fit_embedding(df, "t", "e", size=4, num_partitions=1)
    words = {r[0]: r[1].toArray() for r in model.getVectors().collect()}
    for r in model.transform(df).distinct().collect():
        expected = np.mean([words[w] for w in r["t"]], axis=0) if r["t"] else np.zeros(4)
        assert r["e"].toArray() == pytest.approx(expected, abs=1e-6)


def test_topics(spark):
    cut = inputs.segments(spark, SF)
    counter, topics = features.topic_model(cut, "segment", k=3, max_iter=3)
    terms = features.topic_terms(counter, topics, 4).collect()
    assert len(terms) == 12 and {r["topic"] for r in terms} == {0, 1, 2}
    assert {r["word"] for r in terms} <= set(counter.vocabulary)
    mixed = features.topic_mixture(cut, counter, topics)
    total = F.aggregate(as_array(F.col("mixture"), "float64"), F.lit(0.0), lambda a, x: a + x)
    known = F.size(F.array_intersect("segment", F.array(*map(F.lit, counter.vocabulary)))) > 0
    # A text without any word of the vocabulary has no mixture.
    for share, has_words in mixed.select(total, known).collect():
        assert share == pytest.approx(1.0 if has_words else 0.0)


def test_attach_by_array_does_not_multiply(spark):
    left = spark.createDataFrame([(1, ["a"]), (2, ["a"]), (3, [])], "k int, t array<string>")
    right = left.select("t", F.size("t").alias("n"))
    assert left.join(right, "t").count() == 5
    assert rows(features.attach_by_array(left, right, "t").select("k", "n")) == [(1, 1), (2, 1), (3, 0)]


def test_regression_recovers_a_line(spark):
    df = spark.range(200).select(
        as_vector(F.array((F.col("id") % 17).cast("double"), (F.col("id") % 5).cast("double"))).alias("features"),
        (2 * (F.col("id") % 17) - 3 * (F.col("id") % 5) + 1).cast("double").alias("label"),
    )
    found = {r[0]: r[1] for r in models.coefficients(spark, models.fit_regression(df)).collect()}
    assert found == pytest.approx({-1: 1.0, 0: 2.0, 1: -3.0}, abs=1e-6)


def test_saved_model_gives_the_same_predictions(spark, vectors, tmp_path):
    train, test = hash_split(vectors, ["vec_id"], [0.7, 0.3])
    for kind, options in [("linear", {"scaled": True}), ("forest", {"numTrees": 5, "seed": 1})]:
        model = models.fit_regression(train, kind, **options)
        for _ in range(2):
            models.save(model, f"{tmp_path}/{kind}")
        again = models.load(f"{tmp_path}/{kind}")
        assert rows(model.transform(test).select("vec_id", "prediction")) == rows(
            again.transform(test).select("vec_id", "prediction")
        )


def test_classifiers_and_probabilities(spark, vectors):
    train, test = hash_split(vectors, ["vec_id"], [0.7, 0.3])
    for kind in ("logistic", "forest"):
        scored = models.class_probabilities(models.fit_classifier(train, kind).transform(test), ["b", "a"])
        bad = scored.where(F.abs(F.col("prob_a") + F.col("prob_b") - 1) > 1e-9)
        assert bad.count() == 0
        assert set(r[0] for r in scored.select("prediction").distinct().collect()) <= {0.0, 1.0}
    with pytest.raises(ValueError):
        models.fit_classifier(train, "unknown")


def test_searches(spark, vectors):
    train, _ = hash_split(vectors, ["vec_id"], [0.7, 0.3])
    linear = models.search_linear(train, grid={"regParam": [0.1, 0.01], "fitIntercept": [False, True]}, folds=3)
    found = models.search_results(spark, linear).collect()
    assert len(found) == 4 and sum(r["best"] for r in found) == 1
    assert min(found, key=lambda r: r["metric"])["best"]
    forest = models.search_forest(train, grid={"numTrees": [3, 5], "maxDepth": [2]}, folds=2)
    found = models.search_results(spark, forest).collect()
    assert len(found) == 2 and max(found, key=lambda r: r["metric"])["best"]
    params = {r["param"]: r["value"] for r in models.best_parameters(spark, forest).collect()}
    assert params["maxDepth"] == "2" and params["numTrees"] in ("3", "5")


def test_a_forest_search_keeps_the_nodes_of_rows_and_grows_the_same_trees(spark, monkeypatch):
    points = [(Vectors.dense([i % 7, i * 31 % 101, i * i % 53]), int(i * 17 % 19 > 8), i // 2) for i in range(120)]
    df = spark.createDataFrame(points, ["features", "binary_label", "k"])
    found = []
    for name, own, caches in [(None, {}, False), ("folder", {}, True), ("folder", {"cacheNodeIds": False}, False)]:
        monkeypatch.setattr(type(spark.sparkContext), "getCheckpointDir", lambda self, name=name: name)
        search = models.search_forest(df, grid={"numTrees": [3], "maxDepth": [8]}, folds=2, key=["k"], **own)
        assert search.getEstimator().getCacheNodeIds() is caches
        found.append((search.avgMetrics, search.stdMetrics, search.bestModel.toDebugString.split("\n", 1)[1]))
    assert found[0] == found[1] == found[2]


def test_evaluators(spark, vectors):
    train, test = hash_split(vectors, ["vec_id"], [0.7, 0.3])
    scored = models.fit_classifier(train).transform(test)
    names = ["areaUnderROC", "accuracy", "f1"]
    got = {r[0]: r[1] for r in models.evaluate(spark, scored, "binary_label", names).collect()}
    assert set(got) == set(names) and all(0 <= v <= 1 for v in got.values())


def test_vectors_do_not_depend_on_cores_or_partitions(spark):
    texts = [([f"w{(i * j) % 13}" for j in range(9)],) for i in range(40)]
    df = spark.createDataFrame(texts, "t array<string>").withColumn("k", F.monotonically_increasing_id())
    found = [
        rows(features.counted_vectors(part, "t", 8, 2))
        for part in (df.repartition(1), df.repartition(7))
    ]
    assert found[0] == found[1] and len(found[0]) > 13
    assert features.fit_embedding(df, "t", "e", size=2).getVectors().count() == 13


def test_too_many_words_are_an_error_and_never_dropped(spark, monkeypatch):
    df = spark.createDataFrame([([f"w{i}" for i in range(51)],)], "t array<string>")
    assert features.fit_embedding(df, "t", "e", size=2).getVectors().count() == 51
    monkeypatch.setattr(features, "MOST_VALUES", 40)
    with pytest.raises(ValueError, match="min_count"):
        features.fit_embedding(df, "t", "e", size=2)


def test_folds_keep_a_key_together(spark, vectors, monkeypatch):
    seen = []
    real = models.kept
    monkeypatch.setattr(models, "kept", lambda df: seen.append(df) or real(df))
    twice = vectors.union(vectors).withColumn("k", F.col("vec_id"))
    for part in (twice.repartition(1), twice.repartition(7)):
        models.search_linear(part, grid={"regParam": [0.1]}, folds=3, key=["k"])
    folds = [sorted(r[0] for r in df.groupBy(models.FOLD).count().select("count").collect()) for df in seen]
    assert folds[0] == folds[1] and all(n % 2 == 0 for n in folds[0]) and len(folds[0]) == 3


def test_a_search_keeps_scaling_and_settings(spark, vectors):
    found = models.search_linear(vectors, grid={"regParam": [0.1]}, folds=2, scaled=True, maxIter=3)
    assert [type(s).__name__ for s in found.bestModel.stages] == ["StandardScalerModel", "LinearRegressionModel"]
    params = {r["param"]: r["value"] for r in models.best_parameters(spark, found).collect()}
    assert params["maxIter"] == "3"
