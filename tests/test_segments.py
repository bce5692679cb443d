import random

import pytest

from helpers import segments
from textsignal.operators.segments import document_spans, segment_tokens


def as_dict(df):
    return {(r[0], r[1]): r[2] for r in df.collect()}


@pytest.mark.parametrize("n, expected", [(0, 0), (1, 1), (199, 1), (200, 1), (201, 2), (400, 2)])
def test_number_of_segments(spark, n, expected):
    df = spark.createDataFrame([("a", 1, [f"w{i}" for i in range(n)])], "show string, doc int, t array<string>")
    got = as_dict(segment_tokens(df, "show", ["doc"], "t"))
    assert len(got) == expected
    assert sum(len(s) for s in got.values()) == n


@pytest.mark.parametrize("n", [1, 7, 50])
def test_equals_plain_form_for_any_partitioning(spark, n):
    rng = random.Random(n)
    data = [
        (
            "hot" if rng.random() < 0.4 else f"s{rng.randrange(6)}",
            i,
            [rng.choice(["a", "b", "", " ", "\t", "c", None]) for _ in range(rng.choice([0, 1, 3, 40, 120]))],
        )
        for i in range(150)
    ]
    rng.shuffle(data)
    schema = "show string, doc int, t array<string>"
    expected = segments(data, n)
    for parts in (1, 7):
        df = spark.createDataFrame(data, schema).repartition(parts)
        assert as_dict(segment_tokens(df, "show", ["doc"], "t", n)) == expected


def test_order_over_two_documents_of_one_show(spark):
    data = [("a", 2, ["d", "e"]), ("a", 1, ["a", "b", "c"])]
    df = spark.createDataFrame(data, "show string, doc int, t array<string>")
    assert as_dict(segment_tokens(df, "show", ["doc"], "t", 2)) == {
        ("a", 0): ["a", "b"], ("a", 1): ["c", "d"], ("a", 2): ["e"],
    }


def test_document_spans(spark):
    data = [("a", 2, ["d", "e"]), ("a", 1, ["a", " ", "c"]), ("b", 3, [])]
    df = spark.createDataFrame(data, "show string, doc int, t array<string>")
    got = sorted(tuple(r) for r in document_spans(df, "show", ["doc"], "t").collect())
    assert got == [("a", 1, 0, 2), ("a", 2, 2, 4), ("b", 3, 0, 0)]


def test_repeated_document_keys_fail(spark):
    data = [("a", 1, ["x"]), ("a", 1, ["x"]), ("b", 1, ["y"])]
    df = spark.createDataFrame(data, "show string, doc int, t array<string>")
    with pytest.raises(Exception, match="more than one row with the key"):
        segment_tokens(df, "show", ["doc"], "t").collect()
