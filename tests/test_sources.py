import os

from helpers import rows
from textsignal.sources.readers import (
    read_documents,
    read_exported_segments,
    read_labels,
    read_lexicon,
    read_parquet,
)
from textsignal.sources.writers import export_csv, write_parquet


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write(text)


def test_read_documents_from_nested_folders(spark, tmp_path):
    write(f"{tmp_path}/app/My Show! 2/ep1.txt", "first line\nsecond line\n")
    write(f"{tmp_path}/app/deep/er/Other/ep.txt", "one\r\ntwo")
    got = read_documents(spark, str(tmp_path)).select("show", "text")
    assert rows(got) == [("My Show 2", "first line second line"), ("Other", "one two")]


def test_lines_stay_in_order_in_long_files(spark, tmp_path):
    write(f"{tmp_path}/s/long.txt", "".join(f"line{i}\n" for i in range(50000)))
    text = read_documents(spark, str(tmp_path)).first()["text"]
    assert text == " ".join(f"line{i}" for i in range(50000))


def test_read_lexicon_and_labels(spark, tmp_path):
    write(f"{tmp_path}/lex.csv", "word,score\ngood,3\nbad,-3\n")
    assert rows(read_lexicon(spark, f"{tmp_path}/lex.csv")) == [("bad", -3), ("good", 3)]
    write(f"{tmp_path}/lab.csv", "segment_id,podcast_name_cleaned,label\n0,a,0.8\n0,a,1\nx,b,-\n")
    assert rows(read_labels(spark, f"{tmp_path}/lab.csv")) == sorted(
        [(0, "a", 0.8), (0, "a", 1.0), (None, "b", None)], key=repr
    )


def test_parquet_round_trip_replaces(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, ["x", "y"]), ("b", 2, [])], "show string, n int, t array<string>")
    for _ in range(2):
        write_parquet(df, f"{tmp_path}/out", ["show"])
    got = read_parquet(spark, f"{tmp_path}/out").select("show", "n", "t")
    assert rows(got) == rows(df)
    assert os.path.isdir(f"{tmp_path}/out/show=a")


def test_csv_round_trip_with_arrays(spark, tmp_path):
    df = spark.createDataFrame(
        [("a", 'say "hi", you', ["x", "y"]), ("b", "plain", [])],
        "show string, note string, t array<string>",
    )
    export_csv(df, f"{tmp_path}/csv", gap="|")
    got = read_exported_segments(spark, f"{tmp_path}/csv", {"t": "|"})
    assert rows(got) == rows(df)
