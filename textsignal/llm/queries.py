"""One query for each operator, over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textsignal.llm import (
    alignment,
    decontamination,
    exact_dedup,
    hard_negatives,
    html_extract,
    jaccard_join,
    language,
    mixing,
    passage_dedup,
    pii,
    sharding,
    token_files,
    toxicity,
)
from textsignal.llm.registry import QUERIES, SQL, query, table

__all__ = ["QUERIES", "SQL"]

#: Words per document, and per source its size, weight, target and cut, as DuckDB says it.
MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '')) || '|'
      || coalesce(CAST(doc_id AS VARCHAR), '') AS k,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, 3 * source_size AS cap, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
    WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM sources),
placed AS (
  SELECT *, row_number() OVER w AS place,
    CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
    / CAST(sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS unit
  FROM weighed WINDOW w AS (ORDER BY cap / weight, source NULLS LAST)),
share AS (SELECT unit FROM placed WHERE cap > weight * unit ORDER BY place LIMIT 1),
targets AS (
  SELECT source, source_size, CASE WHEN cap <= weight * coalesce((SELECT unit FROM share), 0)
    THEN CAST(cap AS DOUBLE) ELSE weight * coalesce((SELECT unit FROM share), 0) END AS target
  FROM placed),
plans AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE CAST(floor(target) AS BIGINT) // source_size END AS epochs,
    CASE WHEN source_size = 0 THEN 0 ELSE CAST(floor(target) AS BIGINT) % source_size END AS rest
  FROM targets),
run AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY k ROWS UNBOUNDED PRECEDING) AS total FROM sized)
SELECT r.doc_id, r.size, p.source_size, p.target,
  CAST(p.epochs * r.size + greatest(least(p.rest - (r.total - r.size), r.size), 0) AS BIGINT) AS taken,
  CAST(CASE WHEN r.size = 0 THEN 0 ELSE p.epochs + CASE WHEN r.total < p.rest THEN 1 ELSE 0 END END AS BIGINT) AS copies,
  CAST(CASE WHEN r.total >= p.rest THEN greatest(p.rest - (r.total - r.size), 0) ELSE 0 END AS BIGINT) AS part
FROM run r JOIN plans p ON r.source IS NOT DISTINCT FROM p.source
"""


@query(MIX_SQL)
def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


DEDUP_SQL = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm,
    length(coalesce(text, '')) AS points FROM documents),
r AS (
  SELECT doc_id, norm, first_value(doc_id) OVER w AS keep_id,
    count(*) OVER (PARTITION BY norm) AS group_size, row_number() OVER w AS place
  FROM t WINDOW w AS (PARTITION BY norm ORDER BY points DESC, doc_id))
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, place = 1 AS kept,
  sha256(norm) AS text_sha256 FROM r
"""


@query(DEDUP_SQL)
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(table(spark, sf_dir, "documents"))


SHARD_SIZE = sharding.table_size(sharding.SHARDS)
SHARD_OWNERS = sharding.lookup_table(
    [f"shard-{i}" for i in range(sharding.SHARDS)], SHARD_SIZE
)
SHARD_SQL = f"""
WITH s AS (
  SELECT doc_id, CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT)
    % {SHARD_SIZE} AS BIGINT) AS slot FROM documents)
SELECT doc_id, slot, CAST(string_split('{",".join(map(str, SHARD_OWNERS))}', ',')[slot + 1] AS INTEGER)
  AS shard FROM s
"""


@query(SHARD_SQL)
def op7_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(table(spark, sf_dir, "documents").select("doc_id"))


def _part(key: str, parts: int) -> Column:
    """crc32 of the key's text, modulo `parts`; a null key counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % parts


@query()
def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = language.fit(documents.where(_part("doc_id", 4) != 2))
    asked = documents.select("doc_id", (_part("doc_id", 4) == 2).alias("held_out"), "text")
    return language.predict(asked, model).drop("text")


@query()
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(_part("doc_id", 5) != 0)
    model = toxicity.fit(documents.where(_part("doc_id", 5) != 0), labels)
    asked = documents.select("doc_id", (_part("doc_id", 5) == 0).alias("held_out"), "text")
    return toxicity.score(asked, model).drop("text")


def _seed_sql(source: str, ids: str) -> str:
    """Every mask at every position of the words `w`, as one text."""
    parts = []
    for name in decontamination.MASKS:
        chosen = [i for i, c in enumerate(name) if c == "1"]
        words = " || ' ' || ".join(f"w[i + {p + 1}]" for p in chosen)
        parts.append(
            f"SELECT {ids}, i, '{name} ' || {words} AS seed FROM (SELECT {ids}, w, "
            f"unnest(range(0, len(w) - {len(name) - 1})) AS i FROM {source})"
        )
    return " UNION ALL ".join(parts)


#: The items of the test tables have 15 words or more.
OVERLAP_SQL = rf"""
WITH items AS (
  SELECT item_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') AS w FROM benchmark),
docs AS (
  SELECT doc_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') AS w FROM documents
  WHERE text IS NOT NULL),
marks AS ({_seed_sql("items", "item_id")}),
seeds AS ({_seed_sql("docs", "doc_id")}),
hits AS (
  SELECT DISTINCT doc_id, item_id, s.i - m.i AS shift FROM seeds s JOIN marks m ON s.seed = m.seed),
laid AS (
  SELECT h.doc_id, h.item_id, h.shift, len(t.w) AS n, d.w AS said, t.w AS w
  FROM hits h JOIN docs d ON h.doc_id = d.doc_id JOIN items t ON h.item_id = t.item_id),
each AS (
  SELECT doc_id, item_id, shift, n, k, CASE WHEN shift + k >= 0 AND shift + k < len(said)
      AND said[shift + k + 1] = w[k + 1] THEN 1 ELSE 0 END AS equal
  FROM (SELECT *, unnest(range(0, n)) AS k FROM laid)),
sums AS (
  SELECT doc_id, item_id, shift, n, k, sum(equal) OVER whole AS matched,
    sum(equal) OVER (whole ORDER BY k ROWS BETWEEN {decontamination.WINDOW - 1} PRECEDING AND CURRENT ROW) AS best
  FROM each WINDOW whole AS (PARTITION BY doc_id, item_id, shift))
SELECT doc_id, item_id, CAST(max(n) AS BIGINT) AS item_words, CAST(max(matched) AS BIGINT) AS matched,
  CAST(max(best) AS BIGINT) AS window_matched
FROM (SELECT doc_id, item_id, shift, n, max(matched) AS matched, max(best) AS best FROM sums
  GROUP BY ALL HAVING max(best) * 100 >= {decontamination.SHARE} * least(n, {decontamination.WINDOW}))
GROUP BY doc_id, item_id
"""


@query(OVERLAP_SQL)
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.overlaps(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


@query()
def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_extract.extract(pages, html_extract.fit(pages))


@query()
def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


@query()
def op10_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passage_dedup.dedup_passages(table(spark, sf_dir, "documents"))


@query()
def op3_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replaced(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query()
def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return token_files.token_digests(table(spark, sf_dir, "documents"), path, end=2)


@query()
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.align(table(spark, sf_dir, "documents"), *paths)


NEGATIVES_SQL = """
WITH v AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.id AS anchor_id, v.id AS id, a.label = v.label AS same,
    CAST(list_inner_product(a.q, v.q) AS BIGINT) AS score
  FROM v AS a JOIN v ON a.id <> v.id WHERE a.id % 50 = 0),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (
  SELECT p.*, s.id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) AS place
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same
    AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE place <= 3
"""


@query(NEGATIVES_SQL)
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(vectors["vec_id"] % 7 == 0, (vectors["label"] + 1) % 10)
    label = moved.otherwise(vectors["label"])
    return hard_negatives.mine(vectors, F.col("id") % 50 == 0, label=label)
