"""Many subjects by an automaton, and frequent words by bounded counters, against plain forms."""

import random
from collections import Counter

import pytest

from helpers import plan_of, rows
from textsignal.operators.heavy_words import heavy_words, task_counters
from textsignal.operators.subjects import subject_mentions, token_subjects
from textsignal.operators.vocabulary import top_vocab

SCHEMA = "id int, t array<string>"


def plain_mentions(data, subjects, exact=False):
    found = {}
    for key, tokens in data:
        for place, token in enumerate(tokens or [], 1):
            for s in set(subjects):
                if token is not None and (token == s if exact else s in token):
                    n, first = found.get((key, s), (0, place))
                    found[key, s] = (n + 1, first)
    return sorted((k, s, n, first) for (k, s), (n, first) in found.items())


@pytest.mark.parametrize("match", ["substring", "exact"])
def test_mentions_equal_plain_form(spark, match):
    rng = random.Random(1)
    subjects = ["a", "ab", "abc", "bca", "ccc", "cab", "b", "b"]
    data = [
        (i, None if i % 17 == 0 else [rng.choice([None, "", *("".join(rng.choices("abcd", k=rng.randrange(1, 6))) for _ in range(3))]) for _ in range(rng.randrange(0, 30))])
        for i in range(80)
    ]
    got = subject_mentions(spark.createDataFrame(data, SCHEMA).repartition(5), ["id"], "t", subjects, match)
    assert got.columns == ["id", "subject", "n", "first_position"]
    assert rows(got) == sorted(plain_mentions(data, subjects, match == "exact"), key=repr)


def test_five_thousand_subjects_and_none(spark):
    subjects = [f"w{i}x" for i in range(5000)]
    data = [(i, [f"aw{i}xb", f"w{i}", "w7xw8x"]) for i in range(300)]
    df = spark.createDataFrame(data, SCHEMA)
    assert rows(subject_mentions(df, ["id"], "t", subjects)) == sorted(plain_mentions(data, [s for s in subjects if int(s[1:-1]) < 300]), key=repr)
    assert subject_mentions(df, ["id"], "t", []).count() == 0
    assert subject_mentions(df.limit(0), ["id"], "t", subjects).count() == 0
    with pytest.raises(ValueError):
        token_subjects(df.selectExpr("explode(t) AS t"), "t", ["a", ""])
    with pytest.raises(ValueError):
        subject_mentions(df, ["id"], "t", ["a"], "fuzzy")


def test_mentions_send_no_tokens(spark):
    data = [(i % 7 or None, ["ab", None, f"x{i}", "cab", "ab"]) for i in range(1200)]
    df = spark.createDataFrame(data, SCHEMA).coalesce(1)
    found = subject_mentions(df, ["id"], "t", ["ab", "b", "x1"])
    expected = Counter()
    for key, tokens in data:
        for s in ("ab", "b", "x1"):
            expected[key, s] += sum(s in t for t in tokens if t is not None)
    assert {(r.id, r.subject): r.n for r in found.collect()} == {k: n for k, n in expected.items() if n}
    assert {r.first_position for r in found.collect() if r.subject == "ab"} == {1}
    plan = plan_of(found)
    assert "Join" not in plan and "Generate" not in plan


@pytest.mark.parametrize("capacity", [1, 3, 20, 1000])
def test_heavy_words_equal_exact_counts(spark, capacity):
    rng = random.Random(capacity)
    data = [
        (i, None if i % 31 == 0 else [rng.choice([None, f"w{int(rng.paretovariate(0.7)) % 400}"]) for _ in range(rng.randrange(0, 40))])
        for i in range(200)
    ]
    # One word that is very frequent in a single row.
    data.append((999, ["only here"] * 500))
    df = spark.createDataFrame(data, SCHEMA).repartition(6)
    clean = df.selectExpr("id", "coalesce(t, array()) AS t")
    for k, min_df in ((1, 1), (5, 3), (12, 2), (1000, 1)):
        expected = [tuple(r) for r in top_vocab(clean, "t", k, min_df).collect()]
        got = [tuple(r) for r in heavy_words(clean, "t", k, min_df, capacity).collect()]
        assert sorted(got) == sorted(expected)


def test_counters_are_bounded_and_miss_at_most_the_error(spark):
    words = [f"w{i % 97}" for i in range(3000)] + ["hot"] * 500 + [f"rare{i}" for i in range(2000)]
    random.Random(2).shuffle(words)
    true = Counter(words)
    df = spark.createDataFrame([(i, words[i : i + 50]) for i in range(0, len(words), 50)], SCHEMA).repartition(3)
    found = task_counters(df, "t", 40).collect()
    assert sum(r.word is not None for r in found) <= 3 * 40
    lost = sum(r.lost for r in found)
    assert 0 < lost <= len(words) / 40
    held = Counter()
    for r in found:
        if r.word is not None:
            held[r.word] += r.n
    assert all(held[w] <= n <= held[w] + lost for w, n in true.items())


def test_no_rows(spark):
    assert heavy_words(spark.createDataFrame([], SCHEMA), "t", 5, 1).count() == 0
