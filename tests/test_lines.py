"""Files in byte ranges against plain reading and the whole-text reader."""

import io

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import rows
from textsignal.functions.text import clean_text, unwrap, words
from textsignal.operators.segments import segment_tokens
from textsignal.sources.lines import lines_of, ranges, read_lines, read_parts
from textsignal.sources.readers import read_documents


def plain(data):
    found, at = [], 0
    for line in data.split(b"\n"):
        found.append((at, line.removesuffix(b"\r")))
        at += len(line) + 1
    return found[:-1] if found[-1][1] == b"" and data[-1:] in (b"\n", b"") else found


@settings(max_examples=300, deadline=None)
@given(
    st.lists(st.sampled_from([b"a", b"bc", b"\n", b"\r\n", b"\n\n", b"\xc3\xa9", b"long line "]), max_size=30),
    st.integers(1, 20),
    st.integers(1, 9),
)
def test_ranges_give_each_line_once(pieces, size, block):
    data = b"".join(pieces)
    found = []
    for a in range(0, len(data), size):
        found += lines_of(io.BytesIO(data), a, min(len(data), a + size), block)
    assert found == plain(data)


@pytest.fixture()
def folder(tmp_path):
    (tmp_path / "Show One").mkdir()
    (tmp_path / ".hidden").mkdir()
    lines = [f"line {i} of a talk, with words and 0{i % 10}:30 marks" for i in range(400)]
    (tmp_path / "Show One" / "a.txt").write_text("\n".join(lines) + "\n")
    (tmp_path / "Show One" / "b.txt").write_bytes(b"first\r\nsecond \xff\r\n\r\nlast")
    (tmp_path / "Show One" / "empty.txt").write_text("")
    (tmp_path / "Show One" / "_SUCCESS").write_text("no")
    (tmp_path / ".hidden" / "c.txt").write_text("no")
    return tmp_path


def test_lines_of_a_folder(spark, folder):
    assert len(ranges(str(folder), 1000)) > 10
    found = read_lines(spark, str(folder), range_bytes=1000)
    assert found.rdd.getNumPartitions() > 10
    got = {}
    for r in found.collect():
        got.setdefault(r["file_name"].rsplit("/", 1)[1], []).append((r["offset"], r["line"]))
    data = (folder / "Show One" / "a.txt").read_bytes()
    assert set(got) == {"a.txt", "b.txt"}
    assert sorted(got["a.txt"]) == [(at, line.decode()) for at, line in plain(data)]
    assert [x for _, x in sorted(got["b.txt"])] == ["first", "second �", "", "last"]


def test_parts_have_the_text_of_the_whole_file(spark, folder):
    whole = {r["file_name"].rsplit("/", 1)[1]: (r["show"], r["text"]) for r in read_documents(spark, str(folder)).collect()}
    for size in (500, 1 << 30):
        parts = {}
        for r in read_parts(spark, str(folder), part_bytes=size, range_bytes=700).orderBy("file_name", "part").collect():
            parts.setdefault(r["file_name"].rsplit("/", 1)[1], []).append((r["show"], r["text"]))
        assert (len(parts["a.txt"]) > 5) == (size == 500)
        for name, found in parts.items():
            show, text = whole[name]
            assert {s for s, _ in found} == {show}
            assert " ".join(t for _, t in found) == text
    names = {r["file_name"] for r in read_documents(spark, str(folder)).collect()}
    assert {r["file_name"] for r in read_parts(spark, str(folder)).collect()} == names


def test_segments_of_parts_are_those_of_files(spark, folder):
    def cut(frame, order):
        tokens = frame.withColumn("tokens", words(clean_text(unwrap(F.col("text")))))
        return rows(segment_tokens(tokens, "show", order, "tokens", n=50))

    files = cut(read_documents(spark, str(folder)), ["file_name"])
    assert cut(read_parts(spark, str(folder), part_bytes=900), ["file_name", "part"]) == files


def test_no_files(spark, tmp_path):
    assert read_lines(spark, str(tmp_path)).count() == 0
    with pytest.raises(Exception, match="nowhere"):
        read_lines(spark, str(tmp_path / "nowhere")).count()
