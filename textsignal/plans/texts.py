"""Queries on texts: cleaning, tokens, segments, mentions, lexicon and vocabulary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textsignal.functions.mentions import first_context, first_position
from textsignal.functions.text import clean_text, name_from_path, words
from textsignal.operators.features import attach_by_array, mean_vector
from textsignal.operators import tokens
from textsignal.operators.heavy_words import heavy_words
from textsignal.operators.lexicon import lexicon_score
from textsignal.operators.mentions import mention_contexts, mention_flags
from textsignal.operators.running import row_numbers
from textsignal.operators.stitching import stitch_segments, store_tokens, stored_spans
from textsignal.operators.subjects import subject_mentions
from textsignal.operators.summaries import distinct_count, distribution, shape
from textsignal.operators.vocabulary import top_vocab, used_words
from textsignal.plans import inputs
from textsignal.plans.registry import query
from textsignal import fixed_values as fixed

FIRST, SECOND = inputs.SUBJECTS


@query(rf"""
SELECT doc_id, source,
       {inputs.clean_sql("regexp_replace(regexp_replace(text, '(?:\r\n|\n|\r)$', ''), '\r\n|\n|\r', ' ', 'g')")}
         AS cleaned
FROM documents""")
def clean_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = tokens.clean_documents(inputs.documents(spark, sf_dir), "text")
    return cleaned.select("doc_id", "source", "cleaned")


@query(rf"""
WITH {inputs.TOKENS_SQL}
SELECT doc_id, CAST(len(list_filter(string_split_regex(cleaned, '\s'), lambda t: t <> ''))
         AS INTEGER) AS n_words,
       CAST(len(tokens) AS INTEGER) AS n_tokens, array_to_string(tokens, ' ') AS tokens
FROM tokens JOIN cleaned USING (doc_id)""")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = inputs.documents(spark, sf_dir).select(
        "doc_id", clean_text(F.col("text")).alias("cleaned")
    )
    split = cleaned.select(
        "doc_id",
        F.size(words(F.col("cleaned"), lowered=True)).alias("n_words"),
        words(F.col("cleaned"), fixed.STOP_WORDS, lowered=True).alias("tokens"),
    )
    return split.select(
        "doc_id",
        "n_words",
        F.size("tokens").alias("n_tokens"),
        F.array_join("tokens", " ").alias("tokens"),
    )


@query(f"""
WITH {inputs.SEGMENTS_SQL}
SELECT source, segment_id, array_to_string(segment, ' ') AS segment FROM segments""")
def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.segments(spark, sf_dir).select(
        "source", "segment_id", F.array_join("segment", " ").alias("segment")
    )


@query(f"""
WITH {inputs.SEGMENTS_SQL}
SELECT source, segment_id, array_to_string(segment, ' ') AS segment FROM segments""")
def stitched_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal to `segments`; its texts are cleaned once and inner segments are not shuffled."""
    stored = store_tokens(inputs.tokens(spark, sf_dir), "source", ["doc_id"], "tokens")
    spans = stored_spans(stored, "source", ["doc_id"])
    cut = stitch_segments(stored, spans, "source", "tokens")
    return cut.withColumn("segment", F.array_join("segment", " "))


@query(f"""
WITH {inputs.SEGMENTS_SQL}
SELECT source, segment_id,
       CAST(list_contains(segment, '{FIRST}') AS INTEGER) AS {FIRST}_mention,
       CAST(list_contains(segment, '{SECOND}') AS INTEGER) AS {SECOND}_mention
FROM segments
WHERE list_contains(segment, '{FIRST}') OR list_contains(segment, '{SECOND}')""")
def mention_flags_per_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = mention_flags(inputs.segments(spark, sf_dir), "segment", inputs.SUBJECTS)
    return flagged.drop("segment")


@query(f"""
WITH {inputs.SEGMENTS_SQL}
SELECT source, count(*) AS n_segments,
       CAST(sum(CASE WHEN list_contains(segment, '{FIRST}') THEN 1 ELSE 0 END) AS BIGINT)
         AS n_{FIRST},
       CAST(sum(CASE WHEN list_contains(segment, '{SECOND}') THEN 1 ELSE 0 END) AS BIGINT)
         AS n_{SECOND}
FROM segments
WHERE list_contains(segment, '{FIRST}') OR list_contains(segment, '{SECOND}')
GROUP BY source""")
def mentions_per_show(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = mention_flags(inputs.segments(spark, sf_dir), "segment", inputs.SUBJECTS)
    return flagged.groupBy("source").agg(
        F.count("*").alias("n_segments"),
        *[F.sum(f"{s}_mention").alias(f"n_{s}") for s in inputs.SUBJECTS],
    )


@query(f"""
WITH {inputs.TOKENS_SQL}
SELECT doc_id,
       CAST(coalesce(nullif(list_position(tokens, '{FIRST}'), 0), -1) AS BIGINT) AS {FIRST}_position,
       CAST(coalesce(nullif(list_position(tokens, '{SECOND}'), 0), -1) AS BIGINT) AS {SECOND}_position
FROM tokens""")
def first_position_one_based(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.tokens(spark, sf_dir).select(
        "doc_id",
        *[
            first_position(F.col("tokens"), s).alias(f"{s}_position")
            for s in inputs.SUBJECTS
        ],
    )


@query(f"""
WITH {inputs.TOKENS_SQL}
SELECT doc_id,
       CAST(coalesce(list_position(tokens, '{FIRST}'), 0) - 1 AS BIGINT) AS {FIRST}_index,
       CAST(coalesce(list_position(tokens, '{SECOND}'), 0) - 1 AS BIGINT) AS {SECOND}_index
FROM tokens""")
def first_position_zero_based(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.tokens(spark, sf_dir).select(
        "doc_id",
        *[
            first_position(F.col("tokens"), s, base=0).alias(f"{s}_index")
            for s in inputs.SUBJECTS
        ],
    )


def _first_window_sql(subject: str, absent: str) -> str:
    position = f"list_position(tokens, '{subject}')"
    return (
        f"array_to_string(CASE WHEN list_contains(tokens, '{subject}') "
        f"THEN tokens[greatest(1, {position} - 100):least(len(tokens), {position} + 100)] "
        f"ELSE {absent} END, ' ')"
    )


@query(f"""
WITH {inputs.TOKENS_SQL}
SELECT doc_id, {_first_window_sql(FIRST, "[]")} AS {FIRST}_context,
       {_first_window_sql(SECOND, "[]")} AS {SECOND}_context
FROM tokens""")
def first_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.tokens(spark, sf_dir).select(
        "doc_id",
        *[
            F.array_join(first_context(F.col("tokens"), s), " ").alias(f"{s}_context")
            for s in inputs.SUBJECTS
        ],
    )


@query(f"""
WITH {inputs.TOKENS_SQL}
SELECT doc_id, {_first_window_sql(FIRST, "tokens[1:100]")} AS {FIRST}_context,
       {_first_window_sql(SECOND, "tokens[1:100]")} AS {SECOND}_context
FROM tokens""")
def first_contexts_or_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.tokens(spark, sf_dir).select(
        "doc_id",
        *[
            F.array_join(first_context(F.col("tokens"), s, absent="head"), " ").alias(
                f"{s}_context"
            )
            for s in inputs.SUBJECTS
        ],
    )


def _length_window_sql(subject: str) -> str:
    position = f"coalesce(nullif(list_position(tokens, '{subject}'), 0), -1)"
    start = f"greatest(1, {position} - 100)"
    length = f"least(len(tokens), {position} + 100)"
    return f"array_to_string(tokens[{start}:{start} + {length} - 1], ' ')"


@query(f"""
WITH {inputs.TOKENS_SQL}
SELECT doc_id, {_length_window_sql(FIRST)} AS {FIRST}_context,
       {_length_window_sql(SECOND)} AS {SECOND}_context
FROM tokens""")
def context_length_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.tokens(spark, sf_dir).select(
        "doc_id",
        *[
            F.array_join(first_context(F.col("tokens"), s, mode="length"), " ").alias(
                f"{s}_context"
            )
            for s in inputs.SUBJECTS
        ],
    )


def _mentions_sql(condition: str) -> str:
    return f"""
WITH {inputs.TOKENS_SQL},
hits AS (
  SELECT doc_id, tokens, unnest(list_filter(range(1, len(tokens) + 1), lambda i: {condition})) AS p
  FROM tokens)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY p) AS INTEGER) AS mention_no,
       CAST(p AS INTEGER) AS position,
       array_to_string(tokens[greatest(1, p - 100):least(len(tokens), p + 100)], ' ') AS context
FROM hits"""


@query(_mentions_sql(f"contains(tokens[i], '{FIRST}') OR contains(tokens[i], '{SECOND}')"))
def mention_contexts_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mention_contexts(inputs.tokens(spark, sf_dir), ["doc_id"], "tokens", inputs.SUBJECTS)
    return found.withColumn("context", F.array_join("context", " "))


@query(_mentions_sql(f"tokens[i] IN ('{FIRST}', '{SECOND}')"))
def mention_contexts_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mention_contexts(
        inputs.tokens(spark, sf_dir), ["doc_id"], "tokens", inputs.SUBJECTS, match="exact"
    )
    return found.withColumn("context", F.array_join("context", " "))


#: Many subjects: each consonant, vowel, consonant.
MANY_SUBJECTS = [a + v + b for a in "bcdfglmnprst" for v in "aeiou" for b in "lnrst"]


@query(f"""
WITH {inputs.TOKENS_SQL},
subjects(subject) AS (VALUES {", ".join(f"('{s}')" for s in MANY_SUBJECTS)}),
each AS (SELECT doc_id, source, unnest(tokens) AS token, unnest(range(1, len(tokens) + 1)) AS p FROM tokens),
hits AS (
  SELECT token, subject FROM (SELECT DISTINCT token FROM each) JOIN subjects ON contains(token, subject))
SELECT doc_id, source, subject, count(*) AS n, CAST(min(p) AS INTEGER) AS first_position
FROM each JOIN hits USING (token) GROUP BY doc_id, source, subject""")
def many_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = inputs.tokens(spark, sf_dir)
    return subject_mentions(found, ["doc_id", "source"], "tokens", MANY_SUBJECTS)


def _name_sql(path: str) -> str:
    found = f"regexp_extract({path}, '{fixed.PATH_NAME}', 1)"
    return (
        f"regexp_replace(replace({found}, '{fixed.ESCAPED_SPACE}', ' '), "
        f"'{fixed.NOT_NAME_CHARACTER}', '', 'g')"
    )


@query(f"""
SELECT page_id, {_name_sql("url")} AS name, {_name_sql("url || '/part%201.txt'")} AS folder
FROM pages""")
def name_from_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return inputs.table(spark, sf_dir, "pages").select(
        "page_id",
        name_from_path(url).alias("name"),
        name_from_path(F.concat(url, F.lit("/part%201.txt"))).alias("folder"),
    )


@query("SELECT count(DISTINCT source) AS n_distinct, count(*) AS n FROM documents")
def source_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_count(inputs.table(spark, sf_dir, "documents"), "source")


@query("SELECT DISTINCT source FROM documents")
def distinct_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.table(spark, sf_dir, "documents").select("source").distinct()


@query("SELECT count(*) AS rows, CAST(5 AS INTEGER) AS columns FROM documents")
def table_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape(inputs.table(spark, sf_dir, "documents"))


@query("""
SELECT source, count(*) AS n,
       count(*) / CAST((SELECT count(*) FROM documents) AS DOUBLE) * 100 AS share
FROM documents GROUP BY source""")
def show_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distribution(inputs.table(spark, sf_dir, "documents"), "source")


@query(f"""
WITH {inputs.TOKENS_SQL}, {inputs.LEXICON_SQL}
SELECT doc_id, CAST(coalesce(sum(score), 0) AS BIGINT) AS score
FROM (SELECT doc_id FROM tokens) d
LEFT JOIN (SELECT doc_id, unnest(tokens) AS word FROM tokens) t USING (doc_id)
LEFT JOIN lexicon USING (word)
GROUP BY doc_id""")
def lexicon_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexicon_score(
        inputs.tokens(spark, sf_dir), ["doc_id"], "tokens", inputs.lexicon(spark)
    )


_VOCAB_SQL = f"""{inputs.SEGMENTS_SQL},
counts AS (
  SELECT word, count(*) AS n, count(DISTINCT (source, segment_id)) AS documents
  FROM (SELECT source, segment_id, unnest(segment) AS word FROM segments) GROUP BY word),
vocab AS (
  SELECT word, n, documents, CAST(row_number() OVER (ORDER BY n DESC, word) AS INTEGER) AS rank
  FROM counts WHERE documents >= 3 ORDER BY n DESC, word LIMIT 100)"""


@query(f"WITH {_VOCAB_SQL} SELECT word, n, documents, rank FROM vocab")
def top_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_vocab(inputs.segments(spark, sf_dir), "segment")


@query(f"WITH {_VOCAB_SQL} SELECT word, n, documents, rank FROM vocab")
def heavy_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal to `top_vocabulary`, with counters whose number does not grow with the words."""
    return heavy_words(inputs.stored_segments(spark, sf_dir), "segment")


@query(f"""
WITH {_VOCAB_SQL},
used AS (
  SELECT source, segment_id, string_agg(word, ' ' ORDER BY rank) AS used_words
  FROM (SELECT DISTINCT source, segment_id, unnest(segment) AS word FROM segments)
  JOIN vocab USING (word) GROUP BY source, segment_id)
SELECT source, segment_id, coalesce(used_words, '') AS used_words
FROM (SELECT source, segment_id FROM segments) LEFT JOIN used USING (source, segment_id)""")
def used_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = inputs.segments(spark, sf_dir)
    used = used_words(cut, ["source", "segment_id"], "segment", top_vocab(cut, "segment"))
    return used.withColumn("used_words", F.array_join("used_words", " "))


@query(f"""
WITH {inputs.TOKENS_SQL}
SELECT t.doc_id, e.n_tokens
FROM tokens t JOIN (SELECT DISTINCT tokens, CAST(len(tokens) AS INTEGER) AS n_tokens FROM tokens) e
  ON t.tokens = e.tokens""")
def array_key_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = inputs.tokens(spark, sf_dir).select("doc_id", "tokens")
    extra = inputs.tokens(spark, sf_dir).select("tokens", F.size("tokens").alias("n_tokens"))
    return attach_by_array(documents, extra, "tokens").select("doc_id", "n_tokens")


@query(r"""
SELECT doc_id, array_to_string(string_split(text, chr(10)), ' ') AS text FROM documents""")
def lines_to_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = inputs.documents(spark, sf_dir).select(
        "doc_id", F.posexplode_outer(F.split("text", "\n")).alias("line_no", "line")
    )
    return tokens.gather_lines(lines, ["doc_id"], "line_no", "line")


@query("SELECT doc_id, row_number() OVER (ORDER BY source, doc_id) AS row_num FROM documents")
def global_row_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.table(spark, sf_dir, "documents").select("source", "doc_id")
    return row_numbers(rows, ["source", "doc_id"]).select("doc_id", "row_num")


@query("""
SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS row_num
FROM documents""")
def row_number_per_show(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.table(spark, sf_dir, "documents").select("source", "doc_id")
    return row_numbers(rows, ["doc_id"], ["source"])


@query("SELECT doc_id, source FROM documents ORDER BY doc_id LIMIT 20")
def first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.table(spark, sf_dir, "documents").select("doc_id", "source").orderBy("doc_id").limit(20)


@query("""
SELECT label, CAST(dim - 1 AS INTEGER) AS dim, round(avg(embedding[dim]::DOUBLE), 6) AS mean
FROM (SELECT label, embedding, unnest(range(1, len(embedding) + 1)) AS dim FROM embeddings)
GROUP BY label, dim""")
def mean_vector_per_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = mean_vector(inputs.table(spark, sf_dir, "embeddings"), ["label"], "embedding")
    return means.withColumn("mean", F.round("mean", 6))
