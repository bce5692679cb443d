from collections import Counter

from pyspark.ml.feature import CountVectorizer
from pyspark.sql import functions as F

from helpers import plan_of, rows
from textsignal.operators.features import term_counts
from textsignal.operators.lexicon import lexicon_score
from textsignal.operators.sized import broadcast_if_small
from textsignal.operators.vocabulary import top_vocab, used_words, word_counts
from textsignal.plans import inputs

TEXTS = [
    (1, ["good", "good", "bad", "x"]),
    (2, []),
    (3, ["x", "y"]),
    (4, ["good", "x", "z"]),
    (5, None),
]


def frame(spark):
    return spark.createDataFrame(TEXTS, "k int, t array<string>")


def test_lexicon_score(spark):
    lexicon = spark.createDataFrame([("good", 3), ("bad", -2), ("unused", 9)], "word string, score int")
    got = lexicon_score(frame(spark), ["k"], "t", lexicon)
    assert rows(got) == [(1, 4), (2, 0), (3, 0), (4, 3), (5, 0)]
    got = lexicon_score(frame(spark), ["k"], "t", lexicon, default=1)
    assert rows(got) == [(1, 5), (2, 0), (3, 2), (4, 5), (5, 0)]


def test_lexicon_score_without_broadcast_is_the_same(spark, monkeypatch):
    lexicon = spark.createDataFrame([("good", 3), ("bad", -2)], "word string, score int")
    sent = lexicon_score(frame(spark), ["k"], "t", lexicon)
    assert "BroadcastHashJoin" in plan_of(sent)
    monkeypatch.setattr("textsignal.operators.lexicon.broadcast_if_small", lambda df, text: df)
    shuffled = lexicon_score(frame(spark), ["k"], "t", lexicon)
    assert "BroadcastHashJoin" not in plan_of(shuffled)
    assert rows(shuffled) == rows(sent)


def test_only_measured_frames_are_broadcast(spark):
    df = spark.createDataFrame([("ab", 1), ("c", 2)], "word string, score int")
    assert "hint" in plan_of(broadcast_if_small(df, "word", rows=2, size=3)).lower()
    assert broadcast_if_small(df, "word", rows=1) is df
    assert broadcast_if_small(df, "word", size=2) is df


def test_word_counts(spark):
    assert rows(word_counts(frame(spark), "t")) == [
        ("bad", 1, 1), ("good", 3, 2), ("x", 3, 3), ("y", 1, 1), ("z", 1, 1),
    ]


def test_top_vocab_order_and_minimum(spark):
    assert rows(top_vocab(frame(spark), "t", k=10, min_df=3)) == [("x", 3, 3, 1)]
    assert [r[0] for r in top_vocab(frame(spark), "t", k=3, min_df=1).orderBy("rank").collect()] == [
        "good", "x", "bad",
    ]


def test_term_counts_agree_with_the_count_vectorizer(spark):
    tokens = inputs.tokens(spark, "/root/testdata/sf0.001")
    theirs = CountVectorizer(inputCol="tokens", outputCol="v", vocabSize=100, minDF=3.0).fit(tokens)
    ours = term_counts(tokens, "tokens", "v")
    counts = Counter(w for r in tokens.select("tokens").collect() for w in r[0])
    # The order of ties is free there, so words are compared by their counts.
    assert [counts[w] for w in theirs.vocabulary] == [counts[w] for w in ours.vocabulary]
    lowest = counts[ours.vocabulary[-1]]
    assert {w for w in theirs.vocabulary if counts[w] > lowest} == {
        w for w in ours.vocabulary if counts[w] > lowest
    }
    for r in ours.transform(tokens).select("tokens", "v").collect():
        found = {ours.vocabulary[i]: n for i, n in zip(r["v"].indices, r["v"].values)}
        assert found == {w: n for w, n in Counter(r["tokens"]).items() if w in ours.vocabulary}


def test_used_words(spark):
    vocab = spark.createDataFrame([("x", 1), ("good", 2), ("z", 3)], "word string, rank int")
    got = used_words(frame(spark), ["k"], "t", vocab)
    assert rows(got) == [(1, ["x", "good"]), (2, []), (3, ["x"]), (4, ["x", "good", "z"]), (5, [])]


def test_used_words_are_the_indices_of_the_count_vector(spark):
    tokens = inputs.tokens(spark, "/root/testdata/sf0.001")
    model = term_counts(tokens, "tokens")
    vocab = spark.createDataFrame(
        [(w, i) for i, w in enumerate(model.vocabulary)], "word string, rank int"
    )
    ours = {r[0]: r[1] for r in used_words(tokens, ["doc_id"], "tokens", vocab).collect()}
    for r in model.transform(tokens).select("doc_id", "term_counts").collect():
        assert ours[r[0]] == [model.vocabulary[i] for i in r[1].indices]
    assert len(ours) == tokens.agg(F.count("*")).first()[0]
