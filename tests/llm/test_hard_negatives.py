"""Hard negatives against a plain form over all pairs."""

import math

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textsignal.llm import hard_negatives, queries
from textsignal.llm.hard_negatives import Bucket, Lists, Slab, feasible, search, sorted_lists

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, every=50):
    """By definition, over all pairs of rows."""
    good = [
        (i, label, [math.floor(256 * float(np.float32(x))) for x in v])
        for i, v, label in rows
        if None not in (i, v, label) and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for a, own, u in good:
        if a % every:
            continue
        scored = [(-sum(x * y for x, y in zip(u, v)), i, label) for i, label, v in good]
        near = sorted((s, i) for s, i, label in scored if label == own and i != a)[:5]
        for s, i in near:
            hard = sorted((n, j) for n, j, label in scored if label != own and 50 * -s <= 100 * -n <= 95 * -s)
            out += [(a, i, r, j, -s, -n) for r, (n, j) in enumerate(hard[:3], 1)]
    return sorted(out)


def mined(spark, rows, **named):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = hard_negatives.mine(frame, F.col("id") % 50 == 0, **named)
    return sorted(map(tuple, found.collect()))


def random_rows(n, width, labels, seed, copies=0.3):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(max(1, n // 10), width))
    rows = []
    for i in range(n):
        v = base[rng.integers(len(base))] if rng.random() < copies else rng.normal(size=width)
        v = v + rng.normal(size=width) * rng.choice([0, 0.02, 0.6])
        rows.append((i * 5, (v * rng.choice([0.5, 1.0, 3.0])).tolist(), int(rng.integers(labels))))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    rows = random_rows(300, 8, 3, seed)
    assert mined(spark, rows) == plain(rows)


def test_small_buckets_and_slabs(spark, monkeypatch):
    for name, value in (("BUCKET", 20), ("ANCHORS", 3), ("FIRST", 4), ("SLAB", 12)):
        monkeypatch.setattr(hard_negatives, name, value)
    rows = random_rows(260, 6, 4, 7)
    assert mined(spark, rows) == plain(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        *random_rows(120, 4, 2, 3),
        (None, [1.0, 1.0, 1.0, 1.0], 1), (1000, None, 1), (1050, [1.0], None), (1100, [nan, 1.0], 0),
        (1150, [inf, 0.0], 0), (1200, [1.0, None], 0), (1250, [], 0), (1300, [0.0, 0.0, 0.0, 0.0], 1),
        (1350, [2.0], 0), (1400, [1.0, 2.0, 3.0, 4.0, 5.0], 1), (1450, [-1.0, -1.0, -1.0, -1.0], 9),
    ]
    assert mined(spark, rows) == plain(rows)


def test_ties_and_repeated_rows(spark):
    """A third of all rows have one vector, and some rows are repeated."""
    rows = random_rows(200, 4, 3, 5) + [(2001 + i, [0.5, 0.5, 0.5, 0.5], i % 3) for i in range(120)]
    rows += [(2001, [0.5, 0.5, 0.5, 0.5], 0)] * 3 + [(2050, [0.4, 0.5, 0.5, 0.5], 1)]
    assert mined(spark, rows) == plain(rows)


def test_long_vectors_stay_exact(spark):
    rows = [(i, [1e4 * ((i * 7919) % 13 + 0.1), 3e4, -1e4 * (i % 5)], i % 2) for i in range(150)]
    assert mined(spark, rows) == plain(rows)
    with pytest.raises(ValueError):
        hard_negatives.exact_kind(1e30)


def test_no_rows(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(50, [1.0], 1)]) == []


def test_other_columns_may_clash(spark):
    rows = random_rows(100, 3, 2, 9)
    frame = spark.createDataFrame(rows, SCHEMA)
    for name in ("id", "q", "anchor", "list", "place", "square"):
        frame = frame.withColumn(name, F.lit(None).cast("string"))
    found = hard_negatives.mine(frame, F.col("id") % 50 == 0)
    assert sorted(map(tuple, found.collect())) == plain(rows)


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 1000), st.floats(-1, 1))
def test_range_of_a_coordinate_loses_nothing(seed, least):
    rng = np.random.default_rng(seed)
    q, p = rng.normal(size=(2, 500, 4))
    q, p = (x / np.linalg.norm(x, axis=1)[:, None] for x in (q, p))
    near = (q * p).sum(axis=1) >= least
    low, high = feasible(q[:, 0], np.full(500, least))
    assert ((p[:, 0] >= low) & (p[:, 0] <= high))[near].all()


def test_pruned_search_equals_dense_one(monkeypatch):
    """Sparse verification finds what verification of whole buckets finds, and does take place."""
    rng = np.random.default_rng(4)
    base = rng.normal(size=(40, 16))
    base *= 400 / np.linalg.norm(base, axis=1)[:, None]
    p = np.round(base[rng.integers(40, size=3000)] + rng.normal(size=(3000, 16)) * 4).astype(np.int64)
    slab = Slab(-np.arange(1, 41), np.zeros(40, int), np.round(base).astype(np.int64))
    bucket = Bucket(0, np.arange(3000), p, sorted_lists(p))

    def found(dense):
        monkeypatch.setattr(hard_negatives, "DENSE", dense)
        low = (0.95 * slab.lengths**2).astype(np.int64)
        lists = Lists(np.ones(40, np.int64), low, np.full(40, 1 << 62), 5)
        search(lists, slab, bucket, True)
        return lists.scores.tolist(), lists.ids.tolist()

    calls = []
    real = hard_negatives._take
    monkeypatch.setattr(hard_negatives, "_take", lambda lists, a, s, i, sl: (calls.append(len(a)), real(lists, a, s, i, sl)))
    assert found(0.0) == found(0.5)
    assert len(calls) > 40


def test_query_equals_its_sql(spark):
    folder = "/root/testdata/sf0.01"
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
        expected = db.execute(queries.SQL["op13_hard_negatives"]).fetchall()
    found = queries.QUERIES["op13_hard_negatives"](spark, folder)
    assert sorted(map(tuple, found.collect())) == sorted(expected) and expected
