import pytest
from pyspark.sql import functions as F

from helpers import rows
from textsignal.operators.labels import attach_labels, binarize, random_label
from textsignal.operators.split import bounds, hash_split, shuffle, spread, spread_if_few

LABELS = [("a", "1", "0"), ("a", "1", "0.5"), ("a", "1", "1"), ("b", "1", "-"), ("c", "x", "1")]


def frames(spark):
    features = spark.createDataFrame([("a", 1, 10), ("b", 1, 20), ("d", 1, 30)], "show string, segment_id int, f int")
    labels = spark.createDataFrame(LABELS, "show string, segment_id string, label string")
    return features, labels


def test_attach_labels_all(spark):
    features, labels = frames(spark)
    got = attach_labels(features, labels, ["show", "segment_id"])
    assert rows(got) == [
        ("a", 1, 10, 0.0), ("a", 1, 10, 0.5), ("a", 1, 10, 1.0), ("b", 1, 20, None),
    ]


def test_attach_labels_mean(spark):
    features, labels = frames(spark)
    got = attach_labels(features, labels, ["show", "segment_id"], mode="mean")
    assert rows(got) == [("a", 1, 10, 0.5, 3, 0.5), ("b", 1, 20, None, 0, None)]


@pytest.mark.parametrize(
    "neutral, expected",
    [
        ("drop", [(0.0, 0), (0.4, 0), (1.0, 1)]),
        ("one", [(0.0, 0), (0.4, 0), (0.5, 1), (1.0, 1), (None, 0)]),
        ("zero", [(0.0, 0), (0.4, 0), (0.5, 0), (1.0, 1), (None, 0)]),
    ],
)
def test_binarize(spark, neutral, expected):
    df = spark.createDataFrame([(0.0,), (0.4,), (0.5,), (1.0,), (None,)], "label double")
    assert rows(binarize(df, neutral=neutral)) == sorted(expected, key=repr)


def test_random_label_is_fixed_and_balanced(spark):
    df = spark.range(4000)
    one = rows(random_label(df.repartition(1), ["id"], seed=3))
    assert one == rows(random_label(df.repartition(9), ["id"], seed=3))
    assert one != rows(random_label(df, ["id"], seed=4))
    assert 0.45 < sum(r[1] for r in one) / 4000 < 0.55


def test_bounds():
    assert bounds([0.8, 0.2]) == ["cccccccc"]
    assert bounds([0.7, 0.3]) == ["b3333333"]
    assert bounds([1, 1, 2]) == ["40000000", "80000000"]
    with pytest.raises(ValueError):
        bounds([1, 0])


def test_hash_split_is_disjoint_complete_and_fixed(spark):
    df = spark.range(5000).select((F.col("id") % 1700).alias("key"), "id")
    parts = hash_split(df.repartition(1), ["key"], [0.7, 0.2, 0.1])
    again = hash_split(df.repartition(7), ["key"], [0.7, 0.2, 0.1])
    got = [rows(p) for p in parts]
    assert got == [rows(p) for p in again]
    assert sorted(sum(got, [])) == sorted(rows(df))
    keys = [{r[0] for r in part} for part in got]
    assert not (keys[0] & keys[1] or keys[0] & keys[2] or keys[1] & keys[2])
    assert 0.65 < len(keys[0]) / 1700 < 0.75


def test_shuffle_and_spread_keep_all_rows(spark):
    df = spark.range(500)
    shuffled = [r[0] for r in shuffle(df, ["id"], seed=1).collect()]
    assert sorted(shuffled) == list(range(500)) and shuffled != list(range(500))
    assert shuffled == [r[0] for r in shuffle(df.repartition(3), ["id"], seed=1).collect()]
    assert spread(df, ["id"], 5).rdd.getNumPartitions() == 5
    assert spread_if_few(df.coalesce(1), ["id"]).rdd.getNumPartitions() == 8
    many = df.repartition(20)
    assert spread_if_few(many, ["id"]) is many
