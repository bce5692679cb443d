"""Stitched segments: equal to the plain form, and what is shuffled."""

import os
import random

import pytest

from helpers import plan_of, segments
from textsignal.operators import rounds
from textsignal.operators.stitching import stitch_segments, store_tokens, stored_spans
from textsignal.plans import inputs

SCHEMA = "show string, doc int, t array<string>"


def stitched(df, n):
    stored = store_tokens(df, "show", ["doc"], "t")
    return stitch_segments(stored, stored_spans(stored, "show", ["doc"]), "show", "t", n)


def as_dict(df):
    found = [((r[0], r[1]), r[2]) for r in df.collect()]
    assert len(found) == len(dict(found))
    return dict(found)


@pytest.mark.parametrize("n", [1, 7, 50])
def test_equals_plain_form(spark, n):
    rng = random.Random(n)
    data = [
        (
            "hot" if rng.random() < 0.4 else f"s{rng.randrange(6)}",
            i,
            [rng.choice(["a", "b", "", " ", "c", None]) for _ in range(rng.choice([0, 1, 3, 40, 49, 50, 51, 300]))],
        )
        for i in range(150)
    ]
    rng.shuffle(data)
    assert as_dict(stitched(spark.createDataFrame(data, SCHEMA), n)) == segments(data, n)


@pytest.mark.parametrize("sizes", [[5], [4, 1], [10, 5], [3, 3, 3, 6], [0, 0], [5, 5], [1, 13, 1], []])
def test_whole_segments_and_ends(spark, sizes):
    data = [("a", i, [f"{i}.{j}" for j in range(size)]) for i, size in enumerate(sizes)]
    assert as_dict(stitched(spark.createDataFrame(data, SCHEMA), 5)) == segments(data, 5)


def test_null_shows_keys_and_tokens(spark):
    data = [(None, 1, ["a", "b", "c"]), (None, None, ["x"]), ("a", None, ["y"]), ("a", 1, None)]
    # Nulls come first, and a null show is a show.
    assert as_dict(stitched(spark.createDataFrame(data, SCHEMA), 2)) == {
        (None, 0): ["x", "a"], (None, 1): ["b", "c"], ("a", 0): ["y"],
    }


def test_repeated_document_keys_fail(spark):
    data = [("a", 1, ["x"]), ("a", 1, ["x"]), ("b", 1, ["y"])]
    with pytest.raises(Exception, match="more than one row with the key"):
        stitched(spark.createDataFrame(data, SCHEMA), 5).collect()


def test_inner_tokens_are_not_shuffled_and_cleaning_runs_once(spark):
    tokens = inputs.tokens(spark, "/root/testdata/sf0.001")
    stored = store_tokens(tokens, "source", ["doc_id"], "tokens")
    cut = stitch_segments(stored, stored_spans(stored, "source", ["doc_id"]), "source", "tokens")
    plan = plan_of(cut)
    assert "regexp_replace" not in plan
    physical = plan.split("== Physical Plan ==")[1]
    # Up to the join, the tokens come from their bucket; the other side is narrow.
    scans = [line for line in physical.split("\n") if "FileScan" in line and ",tokens#" in line]
    assert len(scans) == 2 and all("Bucketed: true" in line for line in scans)
    # A shuffle of tokens before the pieces would be an exchange right above such a scan's rows.
    above = [physical.split(line)[0].rstrip().split("\n")[-3:] for line in scans]
    assert not any("Exchange" in line for lines in above for line in lines)


def test_written_tables_are_deleted(spark):
    rounds.drop_written(spark)
    store_tokens(spark.createDataFrame([("a", 1, ["x"])], SCHEMA), "show", ["doc"], "t")
    path = rounds._written[spark.sparkContext.applicationId][0]
    assert os.path.isdir(path)
    assert rounds.drop_written(spark) == 1 and not os.path.exists(path)
    assert rounds.drop_written(spark) == 0
