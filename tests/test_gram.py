"""Searches from sums of products against Spark's own fits, row by row errors and SQL."""

import duckdb
import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from helpers import rows
from textsignal.operators import gram, models
from textsignal.operators.split import hash_split
from textsignal.plans import QUERIES, SQL, inputs

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def train(spark):
    return hash_split(inputs.embedded(spark, SF), ["vec_id"], [0.7, 0.3])[0].cache()


@pytest.fixture(scope="module")
def sums(train):
    return gram.moments(train)[0]


@pytest.mark.parametrize("intercept", [True, False])
@pytest.mark.parametrize("strength, mix", [(0.0, 0.0), (0.1, 0.0), (0.01, 0.5), (0.05, 1.0)])
def test_equal_to_sparks_fit(train, sums, strength, mix, intercept):
    named = {"regParam": strength, "elasticNetParam": mix, "fitIntercept": intercept}
    own = gram.fit(sums, **named)
    other = models.fit_regression(train, maxIter=5_000, tol=1e-14, **named).stages[-1]
    assert own.coefficients == pytest.approx(other.coefficients.toArray(), abs=1e-6)
    assert own.intercept == pytest.approx(other.intercept, abs=1e-6)


def test_search_equals_sparks_search(spark, train):
    own = gram.search(train, ["vec_id"], folds=3)
    other = models.search_linear(train, folds=3, key=["vec_id"], maxIter=2_000, tol=1e-12)
    expected = {r["setting"]: r for r in models.search_results(spark, other).collect()}
    found = {r["setting"]: r for r in own.results(spark).collect()}
    assert set(found) == set(expected) and sum(r["best"] for r in found.values()) == 1
    for name, r in found.items():
        assert r["metric"] == pytest.approx(expected[name]["metric"], abs=1e-6)
        assert r["metric_stddev"] == pytest.approx(expected[name]["metric_stddev"], abs=1e-6)
    best = next(r for r in found.values() if r["best"])
    assert best["metric"] == pytest.approx(min(r["metric"] for r in expected.values()), abs=1e-6)


def test_error_from_sums_is_that_of_the_rows(train, sums):
    model = gram.fit(sums, regParam=0.05, elasticNetParam=0.5)
    scored = train.withColumn("p", model.predicted(F.col("features")))
    error = scored.agg(F.avg((F.col("label") - F.col("p")) ** 2)).first()[0]
    assert model.squared_error(sums) == pytest.approx(error, rel=1e-9)


def test_sums_do_not_depend_on_partitions(train, sums):
    number = F.pmod("vec_id", F.lit(3))
    parts = gram.moments(train.repartition(7), by=number)
    assert set(parts) == {0, 1, 2}
    total = parts[0] + parts[1] + parts[2]
    assert total.n == sums.n and total.means() == pytest.approx(sums.means(), abs=1e-12)
    rest = total - parts[1]
    assert rest.n == parts[0].n + parts[2].n


def test_far_from_zero_and_constant_columns(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 2)) * 1e-3 + 1e6
    y = 3 * x[:, 0] - 2 * x[:, 1] + 5
    data = [(Vectors.dense([*map(float, a), 7.0]), float(b)) for a, b in zip(x, y)]
    frame = spark.createDataFrame([*data, (None, 1.0), (Vectors.dense([1.0, 1.0, 1.0]), None)], ["features", "label"])
    fitted = gram.fit(gram.moments(frame)[0])
    assert fitted.coefficients[:2] == pytest.approx([3, -2], abs=1e-4) and fitted.coefficients[2] == 0
    same = frame.where("features IS NOT NULL AND label IS NOT NULL").withColumn("label", F.lit(4.0))
    flat = gram.fit(gram.moments(same)[0], regParam=0.1)
    assert flat.intercept == pytest.approx(4) and not flat.coefficients.any()


def test_no_rows(spark, train):
    assert gram.moments(train.limit(0)) == {}
    with pytest.raises(ValueError):
        gram.search(train.limit(0), ["vec_id"])


@pytest.mark.parametrize("name", ["elastic_net", "grid_linear", "best_model_score", "best_parameters"])
def test_equal_to_sql(spark, name):
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
        found = db.execute(SQL[name])
        names = [c[0] for c in found.description]
        expected = sorted(found.fetchall(), key=repr)
    assert rows(QUERIES[name](spark, SF).select(*names)) == expected
