"""The test tables as the relations the library works on, in Spark and in SQL.

A document is one transcript file, its source is the source, and the document number is the
order of the files of a show.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textsignal import fixed_values as fixed
from textsignal.functions.text import clean_text
from textsignal.functions.vectors import as_vector
from textsignal.operators.rounds import drop_path, new_path, written
from textsignal.operators.segments import document_spans, segment_tokens
from textsignal.operators.split import spread_if_few
from textsignal.operators.tokens import tokenize

SUBJECTS = ("rewh", "tion")
LEXICON = [("de", -1), ("la", 2), ("tion", 3), ("rewh", -2), ("on", 1), ("der", -3)]
INSTRUCTION = (
    "Rate the segment from 0 for against to 1 for in favour, 0.5 is neutral.\n"
    "Put the rating first, then who it is for."
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return spread_if_few(found, ["doc_id"])


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = documents(spark, sf_dir).select(
        "doc_id", "source", clean_text(F.col("text")).alias("cleaned")
    )
    return tokenize(cleaned, "cleaned", "tokens", fixed.STOP_WORDS, lowered=True).drop("cleaned")


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment_tokens(tokens(spark, sf_dir), "source", ["doc_id"], "tokens")


def stored_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The segments, cut once and written, for queries that read them several times.

    Cutting reads the tokens twice, so they are written, too, for as long as it takes.
    """
    path = new_path(spark)
    cut = written(segment_tokens(written(tokens(spark, sf_dir), path), "source", ["doc_id"], "tokens"))
    drop_path(spark, path)
    return cut


def lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LEXICON, "word string, score int")


def continuous_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels 0, 0.5 and 1 as text, as a label file would hold them."""
    label = (F.col("quality") + 1 - F.col("toxic")) / 2
    return table(spark, sf_dir, "labels").select("doc_id", label.cast("string").alias("label"))


def segment_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The label of a document counts for the segment in which the document starts."""
    spans = document_spans(tokens(spark, sf_dir), "source", ["doc_id"], "tokens")
    segment = F.floor(F.col("first") / fixed.SEGMENT_TOKENS).cast("int")
    return spans.join(continuous_labels(spark, sf_dir), "doc_id").select(
        "source", segment.alias("segment_id"), "label"
    )


def scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actual class, score in (0, 1) and predicted class of every labelled document."""
    score = F.col("n_chars") / (F.col("n_chars") + 1500)
    return (
        table(spark, sf_dir, "documents")
        .select("doc_id", score.alias("score"))
        .join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")
        .select(
            "doc_id",
            F.col("quality").cast("double").alias("label"),
            "score",
            (F.col("score") >= 0.5).cast("double").alias("prediction"),
        )
    )


def scored_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A continuous label and a prediction per line item, and a class with many scores."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_extendedprice") / 105000).alias("label"),
        (F.col("l_quantity") / 50).alias("prediction"),
        (F.col("l_returnflag") == "R").cast("double").alias("returned"),
    )


def embedded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature vectors with a continuous and a binary label."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id",
        as_vector(F.col("embedding")).alias("features"),
        (F.col("label") / 9).alias("label"),
        (F.col("label") >= 5).cast("int").alias("binary_label"),
    )


# --- the same relations in SQL, as common table expressions ----------------------------

STOP_LIST = ", ".join("'" + word.replace("'", "''") + "'" for word in fixed.STOP_WORDS)


# The characters of `fixed.ANY_SPACE`, one by one.
ANY_SPACE_SQL = (
    r"\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)


def clean_sql(text: str) -> str:
    steps = f"lower({text})"
    for pattern in (fixed.CLOCK_MARK, fixed.FREE_NUMBER, fixed.NOT_WORD_CHARACTERS):
        steps = f"regexp_replace({steps}, '{pattern}', '', 'g')"
    return f"regexp_replace(trim({steps}), '{fixed.SPOKEN_DURATION}', '', 'g')"


def words_sql(text: str) -> str:
    return (
        rf"list_filter(string_split_regex(lower({text}), '\s'), lambda t: t <> '' "
        f"AND t NOT IN ({STOP_LIST}))"
    )


TOKENS_SQL = f"""
cleaned AS (SELECT doc_id, source, {clean_sql("text")} AS cleaned FROM documents),
tokens AS (SELECT doc_id, source, {words_sql("cleaned")} AS tokens FROM cleaned)"""

# One row per token with its place in the token stream of its source, from 0.
STREAM_SQL = f"""{TOKENS_SQL},
places AS (
  SELECT doc_id, source, tokens[p] AS token, p
  FROM (SELECT doc_id, source, tokens, unnest(range(1, len(tokens) + 1)) AS p FROM tokens)),
stream AS (
  SELECT doc_id, source, token, p,
         row_number() OVER (PARTITION BY source ORDER BY doc_id, p) - 1 AS place
  FROM places)"""

SEGMENTS_SQL = f"""{STREAM_SQL},
segments AS (
  SELECT source, CAST(place // 200 AS INTEGER) AS segment_id,
         list(token ORDER BY place) AS segment
  FROM stream GROUP BY source, place // 200)"""

LEXICON_SQL = "lexicon(word, score) AS (VALUES " + ", ".join(
    f"('{word}', {score})" for word, score in LEXICON
) + ")"

LABELS_SQL = """
doc_labels AS (
  SELECT doc_id, CAST(quality + 1 - toxic AS DOUBLE) / 2 AS label FROM labels)"""

SEGMENT_LABELS_SQL = f"""{SEGMENTS_SQL}, {LABELS_SQL},
lengths AS (
  SELECT doc_id, source, coalesce(sum(len(tokens)) OVER (
    PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first
  FROM tokens),
segment_labels AS (
  SELECT source, CAST(first // 200 AS INTEGER) AS segment_id, label
  FROM lengths JOIN doc_labels USING (doc_id))"""

SCORED_DOCUMENTS_SQL = """
scored AS (
  SELECT doc_id, CAST(quality AS DOUBLE) AS label, n_chars / (n_chars + 1500.0::DOUBLE) AS score,
         CASE WHEN n_chars / (n_chars + 1500.0::DOUBLE) >= 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
           AS prediction
  FROM documents JOIN labels USING (doc_id))"""

SCORED_ITEMS_SQL = """
items AS (
  SELECT l_orderkey, l_linenumber, l_extendedprice / 105000.0::DOUBLE AS label,
         l_quantity / 50.0::DOUBLE AS prediction,
         CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS returned
  FROM lineitem)"""
