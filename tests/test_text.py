import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from helpers import clean, rows
from textsignal import fixed_values as fixed
from textsignal.functions import text as T
from textsignal.operators.tokens import clean_documents, gather_lines, tokenize

ASCII = "aZ09 .,:'[]!-_\t\nms5"


def apply(spark, values, function):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]


@pytest.mark.parametrize(
    "given_text, expected",
    [
        ("[01:02:03] 12:34:56 1:23", ""),
        ("Don't a-b", "dont ab"),
        ("it's 5m 30s, 3stars", "its  tars"),
        ("in the 1990s", "in the "),
        ("Émile café", "mile caf"),
        ("", ""),
    ],
)
def test_clean_text_examples(spark, given_text, expected):
    assert apply(spark, [given_text], T.clean_text) == [expected]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(ASCII, max_size=40), min_size=20, max_size=60))
def test_clean_text_equals_plain_form(spark, values):
    assert apply(spark, values, T.clean_text) == [clean(v) for v in values]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=40), min_size=20, max_size=60))
def test_fast_classes_equal_the_fixed_ones(spark, values):
    def slow(v):
        return F.regexp_replace(v, fixed.NOT_WORD_CHARACTERS, "")

    def fast(v):
        return F.regexp_replace(v, T._NOT_WORD, "")

    assert apply(spark, values, fast) == apply(spark, values, slow)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=40), min_size=20, max_size=60))
def test_letters_only_equals_plain_form(spark, values):
    def plain(v):
        kept = "".join(c for c in v if (c.isascii() and c.isalpha()) or c.isspace())
        return " ".join(kept.split())

    assert apply(spark, values, T.letters_only) == [plain(v) for v in values]


@pytest.mark.parametrize(
    "path, name",
    [
        ("file:/d/My%20Show!%202/ep.txt", "My Show 2"),
        ("/d/x/README", "README"),
        ("/a/b/c/Some%20Name/part%2001.md", "Some Name"),
        ("/a/Show%20A/EP.TXT", "EPTXT"),
        ("plain", ""),
    ],
)
def test_name_from_path(spark, path, name):
    assert apply(spark, [path], T.name_from_path) == [name]


def test_words_drop_blanks_and_stop_words(spark):
    df = spark.createDataFrame([(" a  The cat ",), ("",), ("dont ill THE",)], "v string")
    got = [r[0] for r in tokenize(df, "v", "t", fixed.STOP_WORDS).select("t").collect()]
    assert got == [["cat"], [], ["dont", "ill"]]
    kept = [r[0] for r in tokenize(df, "v", "t").select("t").collect()]
    assert kept == [["a", "the", "cat"], [], ["dont", "ill", "the"]]


def test_stop_words_are_those_of_spark(spark):
    assert list(fixed.STOP_WORDS) == StopWordsRemover.loadDefaultStopWords("english")


def test_words_equal_the_ml_transformers(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(
        T.clean_text(F.col("text")).alias("c")
    )
    ml = StopWordsRemover(inputCol="all", outputCol="kept").transform(
        Tokenizer(inputCol="c", outputCol="all").transform(df)
    )
    ours = T.words(F.col("c"), fixed.STOP_WORDS)
    differing = ml.where(~F.filter("kept", lambda t: t != "").eqNullSafe(ours))
    assert differing.count() == 0


def test_without_blanks(spark):
    tokens = ["a", "", " ", "\t\n", None, " b", "\x01", "\x0b\x0c\r", "\x1f ", "é", "\u00a0", "!"]
    df = spark.createDataFrame([(tokens,)], "t array<string>")
    kept = ["a", " b", "\x01", "\x1f ", "é", "\u00a0", "!"]
    assert df.select(T.without_blanks(F.col("t"))).first()[0] == kept


def test_unwrap_equals_joined_lines(spark):
    for text in ["a\nb\n", "a\r\nb\r\n\r\nc", "a\rb", "\n\n", "a", "a\n\n"]:
        lines = text.replace("\r\n", "\n").replace("\r", "\n")
        lines = lines[:-1] if lines.endswith("\n") else lines
        assert apply(spark, [text], T.unwrap) == [" ".join(lines.split("\n"))]


def test_clean_documents_and_gather_lines(spark):
    df = spark.createDataFrame([("Hello,\nWorld 12\n",)], "v string")
    assert clean_documents(df, "v").first()["cleaned"] == "hello world"
    lines = [("k", 2, "c"), ("k", 0, "a"), ("k", 1, "b"), ("j", 0, "x")]
    gathered = gather_lines(
        spark.createDataFrame(lines, "k string, n int, line string").repartition(4),
        ["k"], "n", "line",
    )
    assert rows(gathered) == [("j", "x"), ("k", "a b c")]
