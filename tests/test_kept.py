"""Kept states: folded over days they equal one pass, and bounds enclose the exact area."""

import random

import pytest
from pyspark.sql import functions as F

from textsignal.operators import evaluation, kept

SCHEMA = "show string, day int, value double, name string"


def some_rows(seed, n=600):
    rng = random.Random(seed)
    return [
        (rng.choice(["hot", "hot", "b", None]), rng.randrange(5), rng.choice([None, 1e6 + rng.random()]), f"n{rng.randrange(80)}")
        for _ in range(n)
    ]


def test_folded_states_equal_one_pass(spark, tmp_path):
    df = spark.createDataFrame(some_rows(1), SCHEMA)
    path = str(tmp_path / "states")
    for day in range(5):
        states = kept.value_states(df.where(F.col("day") == day), ["show", "day"], "value", "name")
        kept.keep_states(states, path, "day")
    got = {r.show: r for r in kept.folded_values(kept.kept_states(spark, path), ["show"]).collect()}
    direct = df.groupBy("show").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("stddev"),
        F.min("value").alias("least"), F.max("value").alias("most"), F.countDistinct("name").alias("names"),
    ).collect()
    assert set(got) == {r.show for r in direct}
    for r in direct:
        f = got[r.show]
        assert (f.n, f.least, f.most) == (r.n, r.least, r.most)
        assert f.mean == pytest.approx(r.mean, rel=1e-12) and f.stddev == pytest.approx(r.stddev, rel=1e-6)
        assert abs(f.n_distinct - r.names) <= 0.05 * r.names


def test_a_day_that_is_written_again_replaces_itself_only(spark, tmp_path):
    df = spark.createDataFrame(some_rows(2), SCHEMA)
    path = str(tmp_path / "states")
    states = kept.value_states(df, ["show", "day"], "value")
    kept.keep_states(states, path, "day")
    before = kept.folded_values(kept.kept_states(spark, path)).first()
    kept.keep_states(states.where("day = 3"), path, "day")
    assert kept.folded_values(kept.kept_states(spark, path)).first() == before
    kept.keep_states(kept.value_states(df.where("day = 3").limit(0).union(df.where("day = 3").limit(1)), ["show", "day"], "value"), path, "day")
    assert kept.folded_values(kept.kept_states(spark, path)).first().n <= before.n


def test_no_rows_and_one(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert kept.folded_values(kept.value_states(empty, ["show"], "value")).first().n == 0
    one = spark.createDataFrame([("a", 1, 2.0, "x"), ("b", 1, None, "x")], SCHEMA)
    got = kept.folded_values(kept.value_states(one, ["show"], "value")).first()
    assert (got.n, got.mean, got.stddev) == (1, 2.0, None)


@pytest.mark.parametrize("cells", [1, 4, 1024])
def test_bounds_enclose_the_area(spark, cells):
    rng = random.Random(cells)
    data = []
    for i in range(500):
        label = rng.choice([0, 1, None])
        score = rng.choice([None, rng.gauss(0.4 + 0.2 * (label or 0), 0.4), 0.5, 1.0])
        data.append((i % 3, label, score))
    df = spark.createDataFrame(data, "day int, label int, score double")
    exact = evaluation.areas(df, "label", "score").first().auc_roc
    states = kept.score_states(df, "label", "score", ["day"], cells)
    assert states.count() <= 3 * cells
    low, high = kept.area_bounds(states).first()
    assert low <= exact <= high
    assert tuple(kept.area_bounds(kept.score_states(df, "label", "score", [], cells)).first()) == (low, high)
    assert tuple(kept.area_bounds(states.where("neg = 0")).first()) == (None, None)
