"""The five steps on a small folder of transcripts, from files to a report."""

import os
import random

import helpers
import pytest
from helpers import clean, rows, segments
from pyspark import cloudpickle

from textsignal import __main__ as command
from textsignal import fixed_values as fixed
from textsignal import steps
from textsignal.operators.annotate import parse_reply
from textsignal.operators.labels import attach_labels
from textsignal.sources.readers import read_parquet
from textsignal.sources.writers import write_parquet

SHOWS = ["Show One", "Other Show"]
WORDS = ["trump", "biden", "vote", "house", "economy", "people", "state", "good", "bad", "news"]


@pytest.fixture(scope="module")
def study(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("study")
    rng = random.Random(7)
    files = []
    for show in SHOWS:
        for episode in range(4):
            folder = root / "transcripts" / "app" / show
            os.makedirs(folder, exist_ok=True)
            lines = [
                "[00:01:02] " + ", ".join(rng.choice(WORDS) for _ in range(30)) + " and 12 more."
                for _ in range(60)
            ]
            path = folder / f"ep{episode}.txt"
            path.write_text("\n".join(lines) + "\n")
            files.append((show, str(path), "\n".join(lines)))
    lexicon = root / "lexicon.csv"
    lexicon.write_text("word,score\ngood,3\nbad,-3\n")
    paths = {n: str(root / n) for n in ("cleaned", "segments", "contexts", "features", "labelled")}
    command.main(
        ["segments", str(root / "transcripts"), paths["cleaned"], paths["segments"],
         "--subjects", "trump", "biden"]
    )
    command.main(["contexts", paths["cleaned"], paths["contexts"], "--subjects", "trump"])
    command.main(["features", paths["segments"], str(lexicon), paths["features"]])
    labels = root / "labels.csv"
    found = rows(read_parquet(spark, paths["segments"]).select("podcast_name_cleaned", "segment_id"))
    with open(labels, "w") as f:
        f.write("segment_id,podcast_name_cleaned,label\n")
        for show, segment in found:
            for _ in range(3):
                f.write(f"{segment},{show},{rng.choice([0, 0.2, 0.5, 0.8, 1])}\n")
    command.main(["label", paths["features"], str(labels), paths["labelled"]])
    return root, paths, files, len(found)


def test_segments_equal_plain_form(spark, study):
    _, paths, files, _ = study
    stop = set(fixed.STOP_WORDS)
    documents = [
        (show, path, [w for w in clean(text.replace("\n", " ")).split() if w not in stop])
        for show, path, text in files
    ]
    expected = {
        key: tokens for key, tokens in segments(documents, 200).items()
        if "trump" in tokens or "biden" in tokens
    }
    stored = read_parquet(spark, paths["segments"]).collect()
    assert {(r[0], r[1]): r[2] for r in stored} == expected
    assert all(r["trump_mention"] == int("trump" in r["segment"]) for r in stored)


def test_first_contexts_of_cleaned_documents(spark, study):
    _, paths, _, _ = study
    found = steps.with_first_contexts(read_parquet(spark, paths["cleaned"]), ["trump"])
    for r in found.select("filtered_tokens", "trump_index", "trump_context").collect():
        at = r[0].index("trump")
        assert r[1] == at and r[2] == r[0][max(0, at - 100) : at + 101]


def test_features_and_labels(spark, study):
    _, paths, _, n = study
    found = read_parquet(spark, paths["features"])
    assert found.columns == [
        "podcast_name_cleaned", "segment_id", "trump_mention", "biden_mention", "features",
    ]
    assert found.count() == n
    assert {len(r[0]) for r in found.select("features").collect()} == {201}
    assert read_parquet(spark, paths["labelled"]).count() == 3 * n


def test_labels_of_a_segment_stay_on_one_side(spark, study):
    _, paths, _, _ = study
    train, test = steps.split_rows(read_parquet(spark, paths["labelled"]), neutral="zero")
    left = {(r[0], r[1]) for r in train.select(*steps.SEGMENT).collect()}
    right = {(r[0], r[1]) for r in test.select(*steps.SEGMENT).collect()}
    assert left and right and not left & right


@pytest.mark.parametrize(
    "task, options",
    [
        ("regression", {"regParam": 0.1}),
        ("regression", {"kind": "forest", "scaled": True, "numTrees": 3}),
        ("classification", {"kind": "logistic", "regParam": 0.1}),
        ("classification", {"kind": "forest", "neutral": "one", "numTrees": 3}),
    ],
)
def test_model_and_report(spark, study, task, options):
    root, paths, _, _ = study
    path = str(root / f"model_{task}_{options.get('kind', 'linear')}")
    steps.store_model(spark, paths["labelled"], path, task, **options)
    tables = steps.report(spark, paths["labelled"], path, ("trump", "biden"), task, options.get("neutral", "drop"))
    for table in tables.values():
        assert table.count() > 0
    if task == "classification":
        shares = {r["subject"]: r["share"] for r in tables["win_report"].collect()}
        assert shares["trump"] + shares["biden"] == pytest.approx(1)


def test_command_line_reports(spark, study, capsys):
    root, paths, _, _ = study
    path = str(root / "model_cli")
    command.main(["train", paths["labelled"], path, "--task", "classification", "--kind", "forest"])
    command.main(["report", paths["labelled"], path, "--task", "classification", "--subjects", "trump", "biden"])
    assert "auc_roc" in capsys.readouterr().out


def test_a_report_is_written_whole(spark, study, capsys):
    root, paths, _, _ = study
    path, out = str(root / "model_out"), str(root / "report")
    command.main(["train", paths["labelled"], path, "--set", "regParam=0.1", "--seed", "7"])
    command.main(["report", paths["labelled"], path, "--subjects", "trump", "biden", "--out", out, "--rows", "1", "--seed", "7"])
    printed = capsys.readouterr().out
    pairs = read_parquet(spark, f"{out}/actual_against_predicted").count()
    assert f"actual_against_predicted: {pairs} rows" in printed and pairs > 1
    assert read_parquet(spark, f"{out}/label_histogram").count() > 1
    with pytest.raises(ValueError, match="search"):
        steps.store_model(spark, paths["labelled"], path, "regression", "forest", search=True)


def test_segments_to_labels_to_model_by_command_line(spark, study):
    root, paths, _, n = study
    cloudpickle.register_pickle_by_value(helpers)  # executors don't have the folder of the tests
    at = {name: str(root / f"asked_{name}") for name in ("prompts", "replies", "labels", "labelled", "model", "csv", "terms", "mixture", "first")}
    command.main(["prompts", paths["segments"], at["prompts"], "--instruction", "Rate it."])
    command.main(["annotate", at["prompts"], at["replies"], "--scorer", "helpers:answer"])
    command.main(["parse", at["replies"], at["labels"], "--subjects", "trump", "biden"])
    labels = read_parquet(spark, at["labels"])
    assert labels.count() == n and labels.where("label is null").count() == 0
    command.main(["label", paths["features"], at["labels"], at["labelled"]])
    command.main(["train", at["labelled"], at["model"], "--set", "regParam=0.5"])
    command.main(["export", paths["segments"], at["csv"]])
    command.main(["topics", paths["segments"], at["terms"], at["mixture"], "--k", "2"])
    command.main(["contexts", paths["cleaned"], at["first"], "--subjects", "trump", "--first"])
    assert read_parquet(spark, at["labelled"]).count() == n
    assert read_parquet(spark, at["mixture"]).count() == 2 * n
    assert "trump_context" in read_parquet(spark, at["first"]).columns


def test_parsed_replies_serve_as_labels(spark, study, tmp_path):
    _, paths, _, n = study
    found = read_parquet(spark, paths["features"])
    replies = found.selectExpr(*steps.SEGMENT, "concat('0.', segment_id % 10, ' Trump. So.') AS reply")
    parsed = parse_reply(replies, "reply", ["Biden", "Trump"]).withColumnRenamed("rating", "label")
    write_parquet(parsed.select(*steps.SEGMENT, "label"), f"{tmp_path}/labels")
    joined = attach_labels(found, read_parquet(spark, f"{tmp_path}/labels"), steps.SEGMENT)
    assert joined.count() == n
    assert all(r["label"] == (r["segment_id"] % 10) / 10 for r in joined.collect())
