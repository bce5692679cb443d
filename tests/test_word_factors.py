"""Factorised word vectors: a dense form, orthonormal columns, residual, SQL."""

import math
import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import rows
from textsignal.operators import word_factors
from textsignal.operators.word_factors import factor_words, mean_vectors, orthonormal
from textsignal.plans import QUERIES, SQL

SF = "/root/testdata/sf0.001"


def made_texts():
    chance = random.Random(3)
    groups = [["sun", "sea", "sand", "wave", "beach"], ["cpu", "disk", "ram", "bus", "chip"]]
    return [[chance.choice(chance.choice(groups) if chance.random() < 0.1 else groups[i % 2]) for _ in range(12)] for i in range(60)]


TEXTS = made_texts()


@pytest.fixture(scope="module")
def texts(spark):
    data = [(i, t) for i, t in enumerate(TEXTS)] + [(900, []), (901, ["alone"]), (902, None)]
    return spark.createDataFrame(data, "k int, t array<string>").repartition(3)


def dense(window=2):
    """The matrix by its definition."""
    w = Counter()
    for t in TEXTS:
        for i, a in enumerate(t):
            for j, b in enumerate(t):
                if i != j and abs(i - j) <= window:
                    w[a, b] += window + 1 - abs(i - j)
    words = sorted({a for a, _ in w})
    sums = {a: sum(w[a, b] for b in words) for a in words}
    total = sum(sums.values())
    ratio = [[max(0.0, math.log(w[a, b] * total / (sums[a] * sums[b]))) if w[a, b] else 0.0 for b in words] for a in words]
    return words, np.array(ratio)


def table(frame, words):
    found = {r["word"]: r["v"] for r in frame.collect()}
    assert set(found) == set(words)
    return np.array([found[x] for x in words])


def test_matrix_is_that_of_the_definition(texts):
    words, matrix = dense()
    found = word_factors.shifted_ratios(texts, "t", window=2).collect()
    assert len(found) == (matrix > 0).sum()
    for r in found:
        assert r["value"] == pytest.approx(matrix[words.index(r["a"]), words.index(r["b"])])


def test_columns_are_orthonormal_and_settle(texts):
    words, matrix = dense()
    found = factor_words(texts, "t", size=3, rounds=1, window=2)
    first = found.residual()
    for _ in range(7):
        found = found.round()
    q = table(found.columns, words)
    assert q.T @ q == pytest.approx(np.eye(3), abs=1e-10)
    assert found.residual() < first and found.residual() < 0.2
    # The two groups of words are told apart by the vectors.
    v = table(found.vectors(), words)
    unit = v / np.linalg.norm(v, axis=1)[:, None]
    close = unit @ unit.T
    at = {w: i for i, w in enumerate(words)}
    assert close[at["sun"], at["sea"]] > close[at["sun"], at["cpu"]]
    assert close[at["ram"], at["disk"]] > close[at["ram"], at["wave"]]
    # Largest eigenvalue of the dense matrix.
    largest = max(abs(np.linalg.eigvalsh(matrix)))
    assert (v[:, 0] @ v[:, 0]) == pytest.approx(largest, rel=0.05)


def test_partitions_do_not_matter(texts):
    found = [factor_words(f, "t", size=2, rounds=2, window=2).columns for f in (texts, texts.repartition(7))]
    named = [sorted((r["word"], *np.round(r["v"], 9)) for r in f.collect()) for f in found]
    assert named[0] == named[1]


def test_more_columns_than_directions(texts):
    gram = np.array([[4.0, 2.0, 0.0], [2.0, 1.0, 0.0], [0.0, 0.0, 9.0]])
    made = orthonormal(gram)
    assert np.diag(made.T @ gram @ made) == pytest.approx([1, 0, 1])
    found = factor_words(texts, "t", size=14, rounds=1, window=2)
    words, _ = dense()
    q = table(found.columns, words)
    kept = np.abs(q).sum(axis=0) > 0
    assert kept.sum() <= len(words)
    assert (q.T @ q)[np.ix_(kept, kept)] == pytest.approx(np.eye(kept.sum()), abs=1e-6)


def test_means(spark, texts):
    vectors = spark.createDataFrame([("sun", [1.0, 2.0]), ("sea", [3.0, 0.0])], "word string, v array<double>")
    df = spark.createDataFrame([(1, ["sun", "sun", "sea", "?"]), (2, ["?"]), (3, [])], "k int, t array<string>")
    assert [tuple(r) for r in mean_vectors(df, ["k"], "t", vectors, 2).collect()] == [(1, [1.25, 1.0])]


def test_no_words(texts):
    found = factor_words(texts.limit(0), "t", size=2, rounds=1)
    assert found.vectors().count() == 0 and found.residual() == 0


def test_equal_to_sql(spark):
    name = "factored_embedding"
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
        found = db.execute(SQL[name])
        names = [c[0] for c in found.description]
        expected = sorted(found.fetchall(), key=repr)
    assert rows(QUERIES[name](spark, SF).select(*names)) == expected


def test_a_pair_is_written_once_and_slices_are_the_whole(spark, texts, monkeypatch):
    words, matrix = dense()
    whole = rows(factor_words(texts, "t", size=2, rounds=1, window=2).columns.select("word"))
    monkeypatch.setattr(word_factors, "SLICE_ROWS", 25)
    found = word_factors.shifted_ratios(texts, "t", window=2)
    assert found.count() == (matrix > 0).sum()
    assert spark.read.parquet(*found.inputFiles()).count() == (np.triu(matrix) > 0).sum()
    assert rows(factor_words(texts, "t", size=2, rounds=1, window=2).columns.select("word")) == whole
