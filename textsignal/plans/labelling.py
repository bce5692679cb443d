"""Queries on labels, splits, prompts and replies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textsignal import fixed_values as fixed
from textsignal.functions import replies
from textsignal.functions.text import letters_only
from textsignal.operators.annotate import annotate, build_prompts, parse_reply
from textsignal.operators.labels import attach_labels, binarize, mean_labels, random_label
from textsignal.operators.lexicon import lexicon_score
from textsignal.operators.running import row_numbers
from textsignal.operators.split import key_hash, shuffle, split_number, spread
from textsignal.operators.summaries import distribution, histogram, summary
from textsignal.plans import inputs
from textsignal.plans.registry import query
from textsignal.plans.rule_scorer import rule_scorer


@query(f"""
WITH {inputs.SEGMENT_LABELS_SQL}, {inputs.LEXICON_SQL},
scores AS (
  SELECT source, segment_id, CAST(coalesce(sum(score), 0) AS BIGINT) AS score
  FROM (SELECT source, segment_id, unnest(segment) AS word FROM segments) LEFT JOIN lexicon USING (word)
  GROUP BY source, segment_id)
SELECT source, segment_id, score, label
FROM scores JOIN segment_labels USING (source, segment_id)""")
def label_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = ["source", "segment_id"]
    features = lexicon_score(
        inputs.segments(spark, sf_dir), key, "segment", inputs.lexicon(spark)
    )
    return attach_labels(features, inputs.segment_labels(spark, sf_dir), key)


@query(f"""
WITH {inputs.SEGMENT_LABELS_SQL}
SELECT source, segment_id, round(avg(label), 6) AS label, count(label) AS label_count,
       round(stddev_samp(label), 6) AS label_stddev
FROM segment_labels GROUP BY source, segment_id""")
def label_mean_per_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = inputs.segment_labels(spark, sf_dir).withColumn(
        "label", F.col("label").try_cast("double")
    )
    means = mean_labels(labels, ["source", "segment_id"])
    return means.withColumns(
        {c: F.round(c, 6) for c in ("label", "label_stddev")}
    )


@query(f"""
WITH {inputs.LABELS_SQL}
SELECT doc_id, CAST(label > 0.5 AS INTEGER) AS binary_label FROM doc_labels WHERE label <> 0.5""")
def binarize_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binarize(inputs.continuous_labels(spark, sf_dir)).select("doc_id", "binary_label")


@query(f"""
WITH {inputs.LABELS_SQL}
SELECT doc_id, CAST(label >= 0.5 AS INTEGER) AS binary_label FROM doc_labels""")
def binarize_inclusive(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = inputs.continuous_labels(spark, sf_dir)
    return binarize(labels, neutral="one").select("doc_id", "binary_label")


@query(f"""
WITH {inputs.LABELS_SQL}
SELECT label, count(*) AS n,
       count(*) / CAST((SELECT count(*) FROM doc_labels) AS DOUBLE) * 100 AS share
FROM doc_labels GROUP BY label""")
def label_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = inputs.continuous_labels(spark, sf_dir)
    return distribution(labels.select(F.col("label").try_cast("double").alias("label")), "label")


@query(f"""
WITH {inputs.SCORED_ITEMS_SQL}
SELECT count(label) AS n, round(avg(label), 6) AS mean, round(stddev_samp(label), 6) AS stddev,
       round(min(label), 6) AS min, round(max(label), 6) AS max
FROM items""")
def label_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = summary(inputs.scored_items(spark, sf_dir), "label")
    return found.withColumns({c: F.round(c, 6) for c in ("mean", "stddev", "min", "max")})


@query(f"""
WITH {inputs.SCORED_ITEMS_SQL},
ends AS (SELECT min(label) AS lo, max(label) AS hi FROM items),
counts AS (
  SELECT least(floor((label - lo) / ((hi - lo) / 50.0::DOUBLE)), 49)::BIGINT AS bin, count(*) AS n
  FROM items, ends GROUP BY 1)
SELECT b.bin, round(lo + b.bin * ((hi - lo) / 50.0::DOUBLE), 6) AS low,
       round(lo + (b.bin + 1) * ((hi - lo) / 50.0::DOUBLE), 6) AS high, coalesce(n, 0) AS n
FROM (SELECT unnest(range(50)) AS bin) b CROSS JOIN ends LEFT JOIN counts USING (bin)""")
def label_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    bins = histogram(inputs.scored_items(spark, sf_dir), "label")
    return bins.withColumns({c: F.round(c, 6) for c in ("low", "high")})


@query(f"""
WITH {inputs.LABELS_SQL}, digits AS (
  SELECT doc_id, substr(md5('42:' || doc_id), 1, 8) AS d FROM doc_labels)
SELECT doc_id, CASE WHEN d < 'b3333333' THEN 0 ELSE 1 END::INTEGER AS part FROM digits""")
def split_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = inputs.continuous_labels(spark, sf_dir)
    return labels.select("doc_id", split_number(["doc_id"], [0.7, 0.3]).alias("part"))


@query("""
SELECT CASE WHEN substr(md5('42:' || doc_id), 1, 8) < 'cccccccc' THEN 0 ELSE 1 END::INTEGER AS part,
       count(*) AS n
FROM documents GROUP BY 1""")
def split_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = inputs.table(spark, sf_dir, "documents")
    part = split_number(["doc_id"], [0.8, 0.2]).alias("part")
    return documents.groupBy(part).agg(F.count("*").alias("n"))


@query("""
SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS place
FROM documents""")
def shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.table(spark, sf_dir, "documents").select(
        "doc_id", key_hash(["doc_id"], 42).alias("hash")
    )
    return row_numbers(rows, ["hash", "doc_id"], out="place").select("doc_id", "place")


@query("SELECT doc_id, source FROM documents")
def shuffled_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.table(spark, sf_dir, "documents").select("doc_id", "source")
    return shuffle(spread(rows, ["doc_id"]), ["doc_id"])


@query("""
SELECT doc_id, CAST(substr(md5('0:' || doc_id), 1, 1) < '8' AS INTEGER) AS label FROM documents""")
def random_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return random_label(inputs.table(spark, sf_dir, "documents").select("doc_id"), ["doc_id"])


# --- prompts and replies ----------------------------------------------------------------


def _letters_sql(text: str) -> str:
    space = inputs.ANY_SPACE_SQL
    return (
        f"trim(regexp_replace(regexp_replace({text}, '[^a-zA-Z{space}]+', '', 'g'), "
        f"'[{space}]+', ' ', 'g'))"
    )


_PROMPT_SQL = f"""
prompts AS (
  SELECT conv_id, turn, '{inputs.INSTRUCTION}' || chr(10) || '        Segment: '
         || {_letters_sql("text")} AS prompt
  FROM conversations),
budgets AS (
  SELECT conv_id, turn, prompt,
         CAST(len(string_split_regex(trim(prompt), '\\s+')) + 400 AS INTEGER) AS budget
  FROM prompts)"""


@query(f"SELECT doc_id, {_letters_sql('text')} AS letters FROM documents")
def letters_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.documents(spark, sf_dir).select(
        "doc_id", letters_only(F.col("text")).alias("letters")
    )


@query(f"WITH {_PROMPT_SQL} SELECT conv_id, turn, prompt, budget FROM budgets")
def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = inputs.table(spark, sf_dir, "conversations")
    return build_prompts(turns, "text", inputs.INSTRUCTION).select(
        "conv_id", "turn", "prompt", "budget"
    )


# A reply made from each turn: a rating that depends on the turn, a subject and the text.
_BEFORE, _AFTER = fixed.REPLY_FRAME
_REPLY_SQL = f"""
replies AS (
  SELECT conv_id, turn, '{_BEFORE}' || role || '{_AFTER}' AS echo,
         '{_BEFORE}' || role || '{_AFTER}  ' ||
         CASE turn % 3 WHEN 0 THEN '0.' || (conv_id % 10) || ' Trump . '
                       WHEN 1 THEN 'Rating: 1 both . '
                       ELSE 'neutral 1.25 . ' END || text || ' ' AS reply
  FROM conversations)"""


def _replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    turn, conv = F.col("turn") % 3, (F.col("conv_id") % 10).cast("string")
    opening = (
        F.when(turn == 0, F.concat(F.lit("0."), conv, F.lit(" Trump . ")))
        .when(turn == 1, F.lit("Rating: 1 both . "))
        .otherwise(F.lit("neutral 1.25 . "))
    )
    echo = F.concat(F.lit(_BEFORE), F.col("role"), F.lit(_AFTER))
    return inputs.table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        "role",
        echo.alias("echo"),
        F.concat(echo, F.lit("  "), opening, F.col("text"), F.lit(" ")).alias("reply"),
    )


_NORMAL_SQL = f"""{_REPLY_SQL},
normal AS (
  SELECT conv_id, turn, regexp_replace(
    replace(replace(reply, echo, ''), ' . ', '. '),
    '^[{inputs.ANY_SPACE_SQL}]+|[{inputs.ANY_SPACE_SQL}]+$', '', 'g') AS text
  FROM replies)"""


@query(f"WITH {_NORMAL_SQL} SELECT conv_id, turn, text FROM normal")
def normalise_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _replies(spark, sf_dir).select(
        "conv_id", "turn", replies.normalise_reply(F.col("reply"), F.col("echo")).alias("text")
    )


@query(rf"""
WITH {_NORMAL_SQL}
SELECT conv_id, turn,
       TRY_CAST(nullif(regexp_extract(text, '{fixed.REPLY_RATING}', 1), '') AS DOUBLE) AS rating,
       nullif(regexp_extract(text, '(Biden|Trump|Neutral|both|neutral)', 1), '') AS sentiment
FROM normal""")
def parse_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_reply(_replies(spark, sf_dir), "reply", ["Biden", "Trump"], echo="role")
    return parsed.select("conv_id", "turn", "rating", "sentiment")


@query(f"""
WITH {_PROMPT_SQL},
counted AS (
  SELECT conv_id, turn, budget, string_split_regex(trim(prompt), '\\s+') AS words FROM budgets),
found AS (
  SELECT conv_id, turn,
         len(list_filter(words, lambda w: w = 'tion')) AS first_n,
         len(list_filter(words, lambda w: w = 'la')) AS second_n,
         1 + greatest(0, CAST(ceil((2 * len(words) - budget) / 100.0) AS INTEGER)) AS attempts
  FROM counted)
SELECT conv_id, turn, CAST(attempts AS INTEGER) AS attempts,
       CASE WHEN first_n = 0 AND second_n = 0 THEN 0.5
            ELSE (5 + least(greatest(first_n, second_n), 4)) / 10.0 END::DOUBLE AS rating,
       CASE WHEN first_n = 0 AND second_n = 0 THEN 'neutral'
            WHEN first_n >= second_n THEN 'tion' ELSE 'la' END AS sentiment
FROM found""")
def annotate_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    subjects = ["tion", "la"]
    key = ["conv_id", "turn"]
    asked = build_prompts(
        inputs.table(spark, sf_dir, "conversations"), "text", inputs.INSTRUCTION
    ).select(*key, "prompt", "budget")
    answered = annotate(asked, [*key, "prompt"], rule_scorer(subjects))
    return parse_reply(answered, "reply", subjects, echo="prompt").select(
        *key, "attempts", "rating", "sentiment"
    )
