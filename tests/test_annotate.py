import os
import re
import time
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from helpers import rows
from textsignal.functions import replies
from textsignal.operators.annotate import annotate, annotate_into, build_prompts, committed, parse_reply
from textsignal.plans.rule_scorer import rule_scorer

INSTRUCTION = "Rate it.\nNow."


def test_prompts_and_budget(spark):
    df = spark.createDataFrame([(1, "Don't  stop 9 times!"), (2, "")], "k int, text string")
    got = build_prompts(df, "text", INSTRUCTION).select("k", "prompt", "budget")
    first = "Rate it.\nNow.\n        Segment: Dont stop times"
    assert rows(got) == [
        (1, first, len(first.split()) + 400), (2, "Rate it.\nNow.\n        Segment: ", 404),
    ]


def test_parse_reply_examples(spark):
    texts = [
        "0.7 Trump. Because", "Rating: 1", "neutral, 0.5", "Neutral", "Biden 1.25 Trump",
        "nothing", "10.5 both",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "reply string")
    got = [
        (r["rating"], r["sentiment"])
        for r in parse_reply(df, "reply", ["Biden", "Trump"]).collect()
    ]
    expected = []
    for t in texts:
        rating = re.search(r"(\d\.\d+)", t)
        subject = re.search(r"(Biden|Trump|Neutral|both|neutral)", t)
        expected.append((rating and float(rating[1]), subject and subject[1]))
    assert got == expected


def test_normalise_reply(spark):
    given = ["<echo> \n 0.5 . Yes .  ", "0.5 . . \u00a0", "a . b . c", "", " .  . "]
    df = spark.createDataFrame([(r, "<echo>") for r in given], "r string, e string")
    got = [r[0] for r in df.select(replies.normalise_reply(F.col("r"), F.col("e"))).collect()]
    assert got == [r.replace("<echo>", "").replace(" . ", ". ").strip() for r in given]


def test_annotate_retries_with_a_larger_budget(spark):
    words = ["w"] * 700
    df = spark.createDataFrame([(1, "tion tion la"), (2, " ".join(words))], "k int, text string")
    asked = build_prompts(df, "text", INSTRUCTION)
    got = annotate(asked, ["k"], rule_scorer(["tion", "la"])).orderBy("k").collect()
    prompt_words = 704
    needed = 2 * prompt_words - (prompt_words + 400)
    assert [r["attempts"] for r in got] == [1, 1 + -(-needed // 100)]
    assert all(r["seconds"] >= 0 for r in got)
    assert "0.7 tion" in got[0]["reply"] and "0.5 neutral" in got[1]["reply"]


def test_annotate_keeps_rows_that_never_succeed(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, text string")
    asked = build_prompts(df, "text", INSTRUCTION)

    def fails_on_b(prompts, budgets):
        return [None if p.endswith("b") else "0.5" for p in prompts]

    got = annotate(asked, ["k"], fails_on_b, max_attempts=3).select(
        "k", "reply", "attempts", "gave_up"
    )
    assert rows(got) == [(1, "0.5", 1, False), (2, None, 3, True)]


def test_annotate_goes_on_after_errors_and_without_a_bound(spark):
    asked = build_prompts(spark.createDataFrame([(1, "a")], "k int, text string"), "text", "Rate.")

    def fails_at_first(prompts, budgets):
        if budgets[0] < 400 + 3 + 150 * 100:
            raise RuntimeError("busy")
        return ["0.5"] * len(prompts)

    got = annotate(asked, ["k"], fails_at_first).select("reply", "attempts", "gave_up").first()
    assert tuple(got) == ("0.5", 151, False)
    with pytest.raises(Exception, match="busy"):
        annotate(asked, ["k"], fails_at_first, max_attempts=2).collect()


def test_annotate_counts_the_replies(spark):
    asked = build_prompts(spark.createDataFrame([(1, "a"), (2, "b")], "k int, text string"), "text", "Rate.")
    with pytest.raises(Exception, match="3 replies"):
        annotate(asked.repartition(1), ["k"], lambda p, b: ["0.5"] * 3).collect()


def counted(folder, stop=None):
    """A scorer that notes each prompt it answers, and fails on one until a file is there."""

    def score(prompts, budgets):
        for p in prompts:
            if stop and p.endswith(stop) and not os.path.exists(f"{folder}/go"):
                raise RuntimeError("stopped")
        for p in prompts:
            with open(f"{folder}/{uuid.uuid4().hex}.asked", "w") as note:
                note.write(p)
        return ["0.5 trump"] * len(prompts)

    return score


def noted(folder):
    return Counter(p.read_text() for p in folder.glob("*.asked"))


def test_a_stopped_run_goes_on(spark, tmp_path):
    df = spark.createDataFrame([(i, f"text x{chr(97 + i % 26)}{chr(97 + i // 26)}") for i in range(200)], "k int, text string")
    asked = build_prompts(df, "text", "Rate.").select("k", "prompt", "budget")
    path, notes = str(tmp_path / "replies"), tmp_path / "notes"
    notes.mkdir()
    scorer = counted(str(notes), stop="xza")
    with pytest.raises(Exception, match="stopped"):
        annotate_into(asked, ["k"], scorer, path, max_attempts=1, commit_rows=2)
    kept = {r["k"] for r in committed(asked, ["k"], path).collect()}
    assert 0 < len(kept) < 200
    first = noted(notes)
    (notes / "go").write_text("")
    found = annotate_into(asked, ["k"], scorer, path, max_attempts=1, commit_rows=2)
    assert sorted(r["k"] for r in found.collect()) == list(range(200))
    prompts = {r["k"]: r["prompt"] for r in asked.collect()}
    twice = {p for p, n in noted(notes).items() if n > 1}
    # No prompt with a reply is asked again; what was in work at the stop may be.
    assert not twice & {prompts[k] for k in kept}
    assert all(first[prompts[k]] == 1 for k in kept)
    before = noted(notes)
    again = annotate_into(asked, ["k"], scorer, path, max_attempts=1)
    assert again.count() == 200 and noted(notes) == before


def test_new_and_null_keys_are_asked(spark, tmp_path):
    notes = tmp_path / "notes"
    notes.mkdir()
    path = str(tmp_path / "replies")
    rows_ = [(1, "a"), (None, "b")]
    for more in ([], [(2, "c")]):
        df = spark.createDataFrame(rows_ + more, "k int, text string")
        asked = build_prompts(df, "text", "Rate.")
        found = annotate_into(asked, ["k"], counted(str(notes)), path)
        assert {r["k"] for r in found.collect()} == {k for k, _ in rows_ + more}
    assert set(noted(notes).values()) == {1}


def test_no_prompts(spark, tmp_path):
    df = build_prompts(spark.createDataFrame([], "k int, text string"), "text", "Rate.")
    found = annotate_into(df, ["k"], counted(str(tmp_path)), str(tmp_path / "replies"))
    assert found.count() == 0 and "reply" in found.columns


def test_mistakes_end_the_job_at_once(spark):
    asked = build_prompts(spark.createDataFrame([(1, "a")], "k int, text string"), "text", "Rate.")
    with pytest.raises(Exception, match="NameError"):
        annotate(asked, ["k"], lambda p, b: undefined_name).collect()  # noqa: F821


def test_one_error_for_ever_ends_the_job(spark):
    asked = build_prompts(spark.createDataFrame([(1, "a")], "k int, text string"), "text", "Rate.")

    def busy(prompts, budgets):
        raise RuntimeError("always busy")

    with pytest.raises(Exception, match="always busy"):
        annotate(asked, ["k"], busy).collect()


def test_pauses_grow(spark):
    asked = build_prompts(spark.createDataFrame([(1, "a")], "k int, text string"), "text", "Rate.")

    def fails_at_first(prompts, budgets):
        if budgets[0] < 400 + 3 + 3 * 100:
            raise RuntimeError("busy")
        return ["0.5"]

    started = time.perf_counter()
    assert annotate(asked, ["k"], fails_at_first, pause=0.2).first()["attempts"] == 4
    assert time.perf_counter() - started > 0.2 + 0.4 + 0.8
