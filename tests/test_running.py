import random

import pytest
from pyspark.sql import functions as F

from helpers import plan_of, rows
from textsignal.operators.running import _split_points, row_numbers, running_total


def plain(data):
    totals, found = {}, []
    for show, at, n in sorted(data, key=lambda d: (str(d[0]), d[1])):
        totals[show] = totals.get(show, 0) + n
        found.append((show, at, n, totals[show]))
    return sorted(found, key=repr)


@pytest.mark.parametrize("ranges", [1, 2, 7, 64])
@pytest.mark.parametrize("size", [0, 1, 5, 3000])
def test_running_total_per_group_with_a_hot_group(spark, ranges, size):
    rng = random.Random(size)
    data = [
        ("hot" if rng.random() < 0.5 else f"s{rng.randrange(20)}", i, rng.randrange(5))
        for i in range(size)
    ]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "show string, at int, n long").repartition(5)
    got = running_total(df, ["at"], {"total": "n"}, ["show"], ranges)
    assert got.columns == ["show", "at", "n", "total"]
    assert rows(got) == plain(data)


def test_running_total_keeps_a_null_group(spark):
    data = [(None, i, 1) for i in range(50)] + [("a", i, 2) for i in range(50)]
    df = spark.createDataFrame(data, "show string, at int, n long")
    assert rows(running_total(df, ["at"], {"total": "n"}, ["show"], 4)) == plain(data)


def test_row_numbers_do_not_depend_on_partitions(spark):
    df = spark.range(2000).select(F.col("id"), F.md5(F.col("id").cast("string")).alias("k"))
    one = rows(row_numbers(df.repartition(1), ["k"]))
    many = rows(row_numbers(df.repartition(7), ["k"], ranges=13))
    assert one == many
    by_key = sorted(one, key=lambda r: r[1])
    assert [r[2] for r in by_key] == list(range(1, 2001))


def test_a_hot_group_is_split_over_ranges(spark):
    df = spark.range(20000).select("id", F.lit("hot").alias("show"))
    numbered = row_numbers(df, ["id"], ["show"], ranges=8)
    assert numbered.agg(F.count_distinct("row_num"), F.max("row_num")).first() == (20000, 20000)
    windows = [line for line in plan_of(numbered).split("\n") if "Window [sum(_one" in line]
    assert windows and all("_range" in line for line in windows)
    keys = df.select("show", "id")
    points = _split_points(keys, F.struct("show", "id"), 8).first()["points"]
    edges = [-1, *[p["id"] for p in points], 19999]
    sizes = [b - a for a, b in zip(edges, edges[1:])]
    assert len(sizes) == 8 and max(sizes) < 2 * 20000 / 8
