"""Sums of word vectors in blocks against plain sums, and what is shuffled for them."""

import random
import time
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import plan_of
from textsignal.operators import blocks, features, rounds, word_vectors


def test_counted_embedding_moves_no_row_a_token(spark, monkeypatch):
    monkeypatch.setattr(blocks, "AT_ONCE", 5)
    rng = random.Random(3)
    data = [(i % 40 or None, [rng.choice("abcdefgh") for _ in range(i % 9)]) for i in range(90)]
    df = spark.createDataFrame(data, "k int, t array<string>")
    vectors = spark.createDataFrame([(w, d, float(i + d)) for i, w in enumerate("abcdef") for d in (i % 3, 3)], "word string, dim int, value double")
    known = defaultdict(dict)
    for r in vectors.collect():
        known[r.word][r.dim] = r.value
    expected = defaultdict(float)
    for k, t in data:
        for w in t:
            for d, x in known[w].items():
                expected[k, len(t), d] += x / len(t)
    found = features.counted_embedding(df, ["k"], "t", vectors)
    got = sorted((str(r.k), r.dim, round(r.value, 9)) for r in found.collect())
    assert got == sorted((str(k), d, round(x, 9)) for (k, _, d), x in expected.items())
    plan = plan_of(features.counted_vectors(df, "t", 8, 2))
    assert "Join" not in plan and "explode(concat" not in plan


def test_one_text_larger_than_a_step(spark, monkeypatch):
    monkeypatch.setattr(blocks, "AT_ONCE", 4)
    df = spark.createDataFrame([(1, ["a", "b", None] * 7), (2, ["a"]), (3, ["?"]), (4, None)], "k int, t array<string>")
    vectors = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [3.0, 0.0])], "word string, v array<double>")
    found = blocks.vector_sums(df, ["k"], "t", vectors, 2)
    assert sorted(tuple(r) for r in found.collect()) == [(1, 21, pytest.approx([28.0, 14.0])), (2, 1, [1.0, 2.0])]


def test_words_that_stand_alike_get_like_vectors_in_any_order(spark):
    rng = random.Random(5)
    data = [([rng.choice(w) for w in ([("a", "b"), ("x",), ("c", "d")] if i % 2 else [("e",), ("y", "z"), ("f",)]) for _ in range(8)],) for i in range(400)]
    df = spark.createDataFrame([*data, ([],), (None,), ([None, "a"],)], "t array<string>")
    made = [features.fit_embedding(part, "t", "e", size=8, num_partitions=2) for part in (df.repartition(1), df.repartition(5))]
    first, second = ({r.word: np.array(r.vector) for r in m.getVectors().collect()} for m in made)
    assert set(first) == set("abcdefxyz") and all(first[w] == pytest.approx(second[w]) for w in first)
    cosine = lambda u, v: first[u] @ first[v] / np.linalg.norm(first[u]) / np.linalg.norm(first[v])
    assert cosine("a", "b") > cosine("a", "y") and cosine("y", "z") > cosine("z", "b")
    assert "BroadcastExchange" not in plan_of(made[0].table)


def test_codes_are_no_beginnings_of_others(spark):
    counts = spark.createDataFrame([(f"w{i}", 1 + 1000 // (i + 1)) for i in range(300)], "word string, n long")
    found = word_vectors.word_codes(counts).collect()
    codes = [f"{r.code:b}".zfill(r.bits) for r in found]
    assert len(set(codes)) == 300 and not any(a != b and b.startswith(a) for a in codes for b in codes)


def many_rounds(monkeypatch):
    monkeypatch.setattr(blocks, "BLOCKS_A_CORE", 1e-6)
    monkeypatch.setattr(blocks, "TOKENS_A_VECTOR", 15)


def test_sums_of_rounds_are_those_of_all_blocks(spark, monkeypatch):
    rng = random.Random(4)
    data = [(i % 7 or None, [rng.choice(["a", "b", "c", "?", None]) for _ in range(i % 6)]) for i in range(60)]
    df = spark.createDataFrame([*data, (1, None)], "k int, t array<string>")
    vectors = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [3.0, 0.0]), ("c", [0.5, 4.0])], "word string, v array<double>")
    at_once = sorted(map(str, blocks.vector_sums(df, ["k"], "t", vectors, 2).collect()))
    many_rounds(monkeypatch)
    assert len(blocks.rounds_of(blocks.dealt(df, ["k"], "t", 150), 150, vectors)) == 4
    assert sorted(map(str, blocks.vector_sums(df, ["k"], "t", vectors, 2).collect())) == at_once


def test_vectors_trained_in_rounds_are_those_of_all_blocks(spark, monkeypatch):
    rng = random.Random(6)
    data = [([rng.choice("abcdefg") + str(i % 3) for _ in range(9)],) for i in range(80)]
    df = spark.createDataFrame([*data, ([],), (None,)], "t array<string>")
    at_once = {r.word: np.array(r.v) for r in features.fit_embedding(df, "t", "e", size=4).table.collect()}
    many_rounds(monkeypatch)
    in_rounds = {r.word: np.array(r.v) for r in features.fit_embedding(df, "t", "e", size=4).table.collect()}
    assert len(at_once) == len(in_rounds) == 21
    assert all(at_once[w] == pytest.approx(in_rounds[w]) for w in at_once)


def test_equal_texts_in_many_rows_and_empty_ones_get_their_mean(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, ["a", "b"]), (None, ["a", None]), (3, []), (4, None)], "k int, t array<string>")
    vectors = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [3.0, 0.0])], "word string, v array<double>")
    found = word_vectors.WordVectors(vectors, "t", "e", 2).transform(df)
    assert found.columns == ["k", "t", "e"]
    got = {r.k: list(r.e) for r in found.collect()}
    assert got == {1: [2.0, 1.0], 2: [2.0, 1.0], None: [0.5, 1.0], 3: [0.0, 0.0], 4: [0.0, 0.0]}


def test_written_tables_leave_no_shuffles(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    shuffles = lambda: {f.getName() for f in map(files.getAllFiles().apply, range(files.getAllFiles().size())) if f.getName().startswith("shuffle_")}
    before, setting = shuffles(), spark.conf.get(rounds.CLEANUP, None)
    found = rounds.written(spark.range(1000).groupBy((F.col("id") % 100).alias("x")).count())
    assert found.count() == 100 and spark.conf.get(rounds.CLEANUP, None) == setting
    end = time.time() + 20
    while (left := {f for f in shuffles() - before if f.endswith(".data")}) and time.time() < end:
        time.sleep(0.2)
    # What counting the rows has shuffled stays; it is one partition, those of the groups are eight.
    assert len(left) <= 1
