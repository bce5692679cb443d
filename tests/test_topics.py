"""Topics by factorisation: SQL, a dense form, and what never rises."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import rows
from textsignal.operators import rounds
from textsignal.operators.topics import factor_topics
from textsignal.plans import QUERIES, SQL

SF = "/root/testdata/sf0.001"
TEXTS = [
    ("a", ["sun", "sea", "sand", "sun"]), ("b", ["sea", "sun", "wave"]), ("c", ["cpu", "disk", "ram"]),
    ("d", ["ram", "cpu", "cpu", "disk"]), ("e", ["sun", "cpu"]), ("f", []), (None, ["sea", None]),
    ("g", ["rare"]), ("a", ["sea"]),
]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(TEXTS, "k string, t array<string>").repartition(3)


def start(parts, k):
    import hashlib

    def number(i):
        named = ":".join(["topic", str(i), *parts])
        return 1 + int(hashlib.md5(named.encode()).hexdigest()[:8], 16) / 2**32

    return [number(i) for i in range(k)]


def dense(n_rounds, k, words):
    """The updates by their formula, on whole matrices."""
    keys = ["a", "b", "c", "d", "e", ""]
    v = np.zeros((len(keys), len(words)))
    for key, tokens in TEXTS:
        for t in tokens:
            if t in words:
                v[keys.index(key or ""), words.index(t)] += 1
    w = np.array([start([key], k) for key in keys])
    h = np.array([start([word], k) for word in words])
    for _ in range(n_rounds):
        w = w * ((v / (w @ h.T)) @ h) / h.sum(axis=0)
        h = h * ((v / (w @ h.T)).T @ w) / w.sum(axis=0)
    return keys, w, h


def test_equal_to_dense_updates(spark, texts):
    found = factor_topics(texts, ["k"], "t", k=2, rounds=2, vocabulary_size=20, min_df=2)
    words = sorted(r["word"] for r in found.words.collect())
    assert words == ["cpu", "disk", "ram", "sea", "sun"]
    keys, w, h = dense(2, 2, words)
    got = {r["word"]: [r["_t0"], r["_t1"]] for r in found.words.collect()}
    assert np.array([got[x] for x in words]) == pytest.approx(h)
    got = {r["k"] or "": [r["_t0"], r["_t1"]] for r in found.texts.collect()}
    assert set(got) == set(keys)
    assert np.array([got[x] for x in keys]) == pytest.approx(w)


def test_divergence_never_rises(texts):
    found = factor_topics(texts, ["k"], "t", k=3, rounds=0, vocabulary_size=20, min_df=1)
    values = [found.divergence()]
    for _ in range(4):
        found = found.round()
        values.append(found.divergence())
    assert all(b <= a + 1e-9 for a, b in zip(values, values[1:])) and values[-1] < values[0]


def test_shares_add_up_and_partitions_do_not_matter(texts):
    found = factor_topics(texts, ["k"], "t", k=2, rounds=1, vocabulary_size=20, min_df=1)
    other = factor_topics(texts.repartition(7), ["k"], "t", k=2, rounds=1, vocabulary_size=20, min_df=1)
    rounded = [f.mixture().withColumn("share", F.round("share", 9)) for f in (found, other)]
    assert rows(rounded[0]) == rows(rounded[1])
    sums = found.mixture().groupBy("k").agg(F.sum("share").alias("s")).collect()
    assert len(sums) == 7 and all(r["s"] == pytest.approx(1) for r in sums)
    terms = found.terms(2).collect()
    assert len(terms) == 4 and {r["place"] for r in terms} == {1, 2}


def test_no_texts(texts):
    found = factor_topics(texts.limit(0), ["k"], "t", k=2, rounds=1)
    assert found.mixture().count() == 0 and found.terms().count() == 0 and found.divergence() == 0


def test_a_cluster_must_name_a_folder(spark, monkeypatch):
    class Elsewhere:
        conf = {}
        sparkContext = type("C", (), {"master": "spark://x", "getConf": lambda self: {}})()

    with pytest.raises(ValueError):
        rounds.shared_folder(Elsewhere())


@pytest.mark.parametrize("name", ["factor_terms", "factor_mixture"])
def test_equal_to_sql(spark, name):
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
        found = db.execute(SQL[name])
        names = [c[0] for c in found.description]
        expected = sorted(found.fetchall(), key=repr)
    assert rows(QUERIES[name](spark, SF).select(*names)) == expected
