"""Queries that fit models on whole tables. Learned values have no SQL form."""

from __future__ import annotations

from itertools import product

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textsignal import fixed_values as fixed
from textsignal.functions.vectors import as_array, as_vector
from textsignal.operators import features, gram, models, topics, word_factors
from textsignal.operators.evaluation import regression_metrics
from textsignal.operators.mentions import mention_flags
from textsignal.operators.split import bounds, hash_split
from textsignal.operators.summaries import class_shares, win_score
from textsignal.plans import inputs
from textsignal.plans.registry import query
from textsignal.steps import features_of_segments

SEGMENT = ["source", "segment_id"]


@query()
def topic_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    counter, fitted = features.topic_model(inputs.stored_segments(spark, sf_dir), "segment")
    return features.topic_terms(counter, fitted)


@query()
def topic_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = inputs.stored_segments(spark, sf_dir)
    counter, fitted = features.topic_model(cut, "segment")
    mixed = features.topic_mixture(cut, counter, fitted)
    return features.elements(mixed, SEGMENT, "mixture", "share")


FACTOR_ROUNDS = 3


def _factors_sql(rounds: int, k: int = fixed.TOPICS) -> str:
    """Tables `texts_<rounds>` and `words_<rounds>` with columns t0, t1, ... after that many rounds."""

    def start(name: str, i: int) -> str:
        digits = f"substr(md5('topic:{i}:' || {name}), 1, 8)"
        return f"1 + CAST(CAST('0x' || {digits} AS BIGINT) AS DOUBLE) / 4294967296 AS t{i}"

    product = " + ".join(f"a.t{i} * b.t{i}" for i in range(k))
    parts = [
        f"{inputs.SEGMENTS_SQL}",
        """said AS (SELECT source || ':' || segment_id AS id, source, segment_id, unnest(segment) AS word FROM segments)""",
        f"""vocab AS MATERIALIZED (
  SELECT word FROM said GROUP BY word HAVING count(DISTINCT id) >= {fixed.VOCABULARY_MIN_DOCUMENTS}
  ORDER BY count(*) DESC, word LIMIT {fixed.VOCABULARY_SIZE})""",
        """counts AS MATERIALIZED (
  SELECT id, source, segment_id, word, count(*)::DOUBLE AS n FROM said JOIN vocab USING (word) GROUP BY ALL)""",
        f"""texts_0 AS MATERIALIZED (
  SELECT *, {", ".join(start("id", i) for i in range(k))}
  FROM (SELECT DISTINCT id, source, segment_id FROM counts))""",
        f"words_0 AS MATERIALIZED (SELECT word, {', '.join(start('word', i) for i in range(k))} FROM vocab)",
    ]
    for r in range(rounds):
        sums = ", ".join(f"sum(n / ({product}) * b.t{i}) * any_value(a.t{i}) / any_value(s{i}) AS t{i}" for i in range(k))
        word_sums = ", ".join(f"sum(n / ({product}) * a.t{i}) * any_value(b.t{i}) / any_value(s{i}) AS t{i}" for i in range(k))
        totals = ", ".join(f"sum(t{i}) AS s{i}" for i in range(k))
        parts.append(
            f"""texts_{r + 1} AS MATERIALIZED (
  SELECT c.id, c.source, c.segment_id, {sums} FROM counts AS c JOIN texts_{r} AS a ON c.id = a.id
  JOIN words_{r} AS b ON c.word = b.word, (SELECT {totals} FROM words_{r}) GROUP BY c.id, c.source, c.segment_id)"""
        )
        parts.append(
            f"""words_{r + 1} AS MATERIALIZED (
  SELECT c.word, {word_sums}
  FROM counts AS c JOIN texts_{r + 1} AS a ON c.id = a.id
  JOIN words_{r} AS b ON c.word = b.word, (SELECT {totals} FROM texts_{r + 1}) GROUP BY c.word)"""
        )
    return ",\n".join(parts)


FACTORS_SQL = _factors_sql(FACTOR_ROUNDS)
TOTALS_SQL = ", ".join(f"sum(t{i}) AS s{i}" for i in range(fixed.TOPICS))


def _factors(spark: SparkSession, sf_dir: str) -> topics.Topics:
    cut = inputs.stored_segments(spark, sf_dir)
    return topics.factor_topics(cut, SEGMENT, "segment", rounds=FACTOR_ROUNDS)


@query(f"""
WITH {FACTORS_SQL},
each AS (
  SELECT word, unnest(range(0, {fixed.TOPICS})) AS topic,
    unnest([{", ".join(f"t{i} / s{i}" for i in range(fixed.TOPICS))}]) AS weight
  FROM words_{FACTOR_ROUNDS}, (SELECT {TOTALS_SQL} FROM words_{FACTOR_ROUNDS})),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY topic ORDER BY round(weight, 9) DESC, word) AS place FROM each)
SELECT CAST(topic AS INTEGER) AS topic, CAST(place AS INTEGER) AS place, word, round(weight, 6) AS weight
FROM placed WHERE place <= {fixed.TOPIC_TERMS}""")
def factor_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _factors(spark, sf_dir).terms().withColumn("weight", F.round("weight", 6))


@query(f"""
WITH {FACTORS_SQL},
weighed AS (
  SELECT source, segment_id, [{", ".join(f"t{i} * s{i}" for i in range(fixed.TOPICS))}] AS parts
  FROM texts_{FACTOR_ROUNDS}, (SELECT {TOTALS_SQL} FROM words_{FACTOR_ROUNDS}))
SELECT source, segment_id, CAST(unnest(range(0, {fixed.TOPICS})) AS INTEGER) AS topic,
  round(unnest([p / list_sum(parts) FOR p IN parts]), 6) AS share FROM weighed""")
def factor_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _factors(spark, sf_dir).mixture().withColumn("share", F.round("share", 6))


@query()
def segment_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    embedded = features.embed(inputs.stored_segments(spark, sf_dir), "segment", "embedding")
    return features.elements(embedded, SEGMENT, "embedding", "value")


COUNTED_SIZE = 32
COUNTED_WINDOW = 2


@query(rf"""
WITH {inputs.SEGMENTS_SQL},
near AS (
  SELECT segment[i] AS a, segment[i + d] AS b, {COUNTED_WINDOW} + 1 - d AS w
  FROM (SELECT segment, d, unnest(range(1, len(segment) - d + 1)) AS i
        FROM segments, (SELECT unnest(range(1, {COUNTED_WINDOW} + 1)) AS d))),
both_ways AS (SELECT a, b, w FROM near UNION ALL SELECT b, a, w FROM near),
hashed AS (
  SELECT a AS word, CAST(CAST('0x' || substr(md5(b), 1, 8) AS BIGINT) AS BIGINT) AS h, w FROM both_ways),
sums AS (
  SELECT word, h % {COUNTED_SIZE} AS dim,
    sum(CASE WHEN (h // {COUNTED_SIZE}) % 2 = 0 THEN w ELSE -w END) AS total
  FROM hashed GROUP BY word, h % {COUNTED_SIZE}),
words AS (SELECT source, segment_id, len(segment) AS size, unnest(segment) AS word FROM segments),
counts AS (SELECT word, count(*) AS n FROM words GROUP BY word),
vectors AS (SELECT word, dim, total / n::DOUBLE AS value FROM sums JOIN counts USING (word) WHERE total <> 0)
SELECT source, segment_id, CAST(dim AS INTEGER) AS dim, round(sum(value) / size + 0.0, 6) AS value
FROM words JOIN vectors USING (word) GROUP BY source, segment_id, size, dim""")
def counted_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = inputs.stored_segments(spark, sf_dir)
    vectors = features.counted_vectors(cut, "segment", COUNTED_SIZE, COUNTED_WINDOW)
    found = features.counted_embedding(cut, SEGMENT, "segment", vectors, COUNTED_SIZE)
    return found.withColumn("value", F.round(F.col("value") + 0.0, 6))


WORD_SIZE = 2
WORD_ROUNDS = 2


def _word_factors_sql(rounds: int) -> str:
    """Tables `ratios` and `columns_<rounds>` (word, x, y) after that many rounds."""
    hashed = [
        f"CAST(CAST('0x' || substr(md5('word:{i}:' || a), 1, 8) AS BIGINT) AS DOUBLE) / 2147483648 - 1" for i in (0, 1)
    ]
    parts = [
        inputs.SEGMENTS_SQL,
        f"""near AS (
  SELECT segment[i] AS a, segment[i + d] AS b, {fixed.CONTEXT_WORDS} + 1 - d AS w
  FROM (SELECT segment, d, unnest(range(1, len(segment) - d + 1)) AS i
        FROM segments, (SELECT unnest(range(1, {fixed.CONTEXT_WORDS} + 1)) AS d)))""",
        """together AS MATERIALIZED (
  SELECT a, b, sum(w)::DOUBLE AS w FROM (SELECT a, b, w FROM near UNION ALL SELECT b, a, w FROM near) GROUP BY a, b)""",
        "weights AS MATERIALIZED (SELECT a, sum(w) AS s FROM together GROUP BY a)",
        """ratios AS MATERIALIZED (
  SELECT t.a, t.b, ln(t.w * (SELECT sum(s) FROM weights) / (p.s * q.s)) AS value
  FROM together AS t JOIN weights AS p ON t.a = p.a JOIN weights AS q ON t.b = q.a
  WHERE ln(t.w * (SELECT sum(s) FROM weights) / (p.s * q.s)) > 0)""",
        f"columns_0 AS MATERIALIZED (SELECT a AS word, {hashed[0]} AS x, {hashed[1]} AS y FROM (SELECT DISTINCT a FROM ratios))",
    ]
    for r in range(rounds):
        parts.append(
            f"""made_{r} AS MATERIALIZED (
  SELECT a AS word, sum(value * x) AS x, sum(value * y) AS y FROM ratios JOIN columns_{r} ON b = word GROUP BY a)"""
        )
        parts.append(f"gram_{r} AS MATERIALIZED (SELECT sum(x * x) AS xx, sum(x * y) AS xy, sum(y * y) AS yy FROM made_{r})")
        parts.append(
            f"""columns_{r + 1} AS MATERIALIZED (
  SELECT word, x / sqrt(xx) AS x, (y - x * xy / xx) / sqrt(yy - xy * xy / xx) AS y FROM made_{r}, gram_{r})"""
        )
    return ",\n".join(parts)


@query(f"""
WITH {_word_factors_sql(WORD_ROUNDS)},
said AS (SELECT source, segment_id, len(segment) AS size, unnest(segment) AS word FROM segments),
means AS (
  SELECT source, segment_id, sum(x) / any_value(size) AS x, sum(y) / any_value(size) AS y
  FROM said JOIN columns_{WORD_ROUNDS} USING (word) GROUP BY source, segment_id)
SELECT source, segment_id, 0 AS dim, round(x, 6) + 0.0 AS value FROM means
UNION ALL SELECT source, segment_id, 1, round(y, 6) + 0.0 FROM means""")
def factored_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = inputs.stored_segments(spark, sf_dir)
    found = word_factors.factor_words(cut, "segment", WORD_SIZE, WORD_ROUNDS)
    means = word_factors.mean_vectors(cut, SEGMENT, "segment", found.columns, WORD_SIZE)
    each = means.select(*SEGMENT, F.posexplode("v").alias("dim", "value"))
    return each.withColumn("value", F.round("value", 6) + 0.0)


@query()
def assembled_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = mention_flags(inputs.stored_segments(spark, sf_dir), "segment", inputs.SUBJECTS)
    found = features_of_segments(flagged, inputs.lexicon(spark), SEGMENT)
    return features.elements(found, SEGMENT, "features", "value")


@query("""
WITH items AS (
  SELECT vec_id, unnest(range(1, len(embedding) + 1)) AS dim, embedding FROM embeddings),
spread AS (
  SELECT dim, stddev_samp(embedding[dim]::DOUBLE) AS s FROM items GROUP BY dim)
SELECT vec_id, CAST(dim - 1 AS INTEGER) AS dim,
       round(CASE WHEN s > 0 THEN embedding[dim]::DOUBLE / s ELSE 0 END, 6) AS scaled
FROM items JOIN spread USING (dim)""")
def scaled_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = inputs.embedded(spark, sf_dir)
    scaled = features.fit_scaler(vectors, "features").transform(vectors)
    return features.elements(scaled, ["vec_id"], "scaled", "scaled").withColumn(
        "scaled", F.round("scaled", 6)
    )


@query(f"""
WITH {inputs.SCORED_ITEMS_SQL}
SELECT -1 AS dim, round(regr_intercept(label, prediction), 6) AS coefficient FROM items
UNION ALL
SELECT 0, round(regr_slope(label, prediction), 6) FROM items""")
def ols_one_feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = inputs.scored_items(spark, sf_dir).select("label", F.col("prediction").alias("x"))
    model = models.fit_regression(features.assemble(items, ["x"]))
    found = models.coefficients(spark, model)
    return found.withColumn("coefficient", F.round("coefficient", 6))


# Linear fits as SQL says them: sums of products, then steps down the gradient of all coordinates, each
# followed by a soft threshold, in a recursion.
STEPS = 400
DIMS = 64


def _split_sql(seed: str, weights: list[float], key: str = "vec_id") -> str:
    """Number of the part that a key falls into."""
    digits = f"substr(md5('{seed}:' || {key}), 1, 8)"
    return " + ".join(["0", *(f"CAST({digits} >= '{b}' AS INTEGER)" for b in bounds(weights))])


def _fits_sql(weights: list[float], settings: list[dict], folds: int) -> str:
    """Tables `train`, `test`, `sums` and `fits` (setting, held, beta, mean_x, mean_y, intercept).

    `held` is the fold that a fit leaves out, or `folds` for none.
    """
    values = ", ".join(
        f"({i}, {s['regParam']}::DOUBLE, {s['elasticNetParam']}::DOUBLE, {str(s['fitIntercept']).lower()})"
        for i, s in enumerate(settings)
    )
    return f"""
items AS (
  SELECT vec_id, [1.0::DOUBLE] || [CAST(x AS DOUBLE) FOR x IN embedding] || [label / 9.0::DOUBLE] AS z,
    {_split_sql("42", weights)} AS part, {_split_sql("fold 42", [1.0] * folds)} AS fold
  FROM embeddings),
train AS (SELECT * FROM items WHERE part = 0),
test AS (SELECT * FROM items WHERE part = 1),
pairs AS (SELECT i, unnest(range(1, {DIMS + 3})) AS j FROM (SELECT unnest(range(1, {DIMS + 3})) AS i)),
fold_sums AS (
  SELECT fold, i, j, sum(z[i] * z[j]) AS s FROM train, pairs GROUP BY fold, i, j),
helds AS (SELECT unnest(range({0 if folds > 1 else 1}, {folds} + 1)) AS held),
sums AS (
  SELECT held, i, j, sum(s) FILTER (WHERE fold <> held) AS s, sum(s) FILTER (WHERE fold = held) AS own
  FROM fold_sums, helds GROUP BY held, i, j),
firsts AS (
  SELECT held, any_value(s) FILTER (WHERE i = 1 AND j = 1) AS n,
    list(s ORDER BY j) FILTER (WHERE i = 1) AS first, list(s ORDER BY j) FILTER (WHERE i = j) AS second
  FROM sums GROUP BY held),
shapes AS (
  SELECT held, n, [a / n FOR a IN first] AS mean,
    [sqrt(second[k] / n - (first[k] / n) * (first[k] / n)) FOR k IN range(1, {DIMS + 3})] AS spread
  FROM firsts),
settings(setting, reg, mix, icpt) AS (VALUES {values}),
cells AS (
  SELECT setting, held, i, j, (s / n - CASE WHEN icpt THEN mean[i] * mean[j] ELSE 0 END)
    / spread[i] / spread[j] AS q, reg / spread[{DIMS + 2}] AS strength, mix
  FROM sums JOIN shapes USING (held), settings WHERE i > 1 AND j > 1),
rows_of AS (
  SELECT setting, held, i, list(q ORDER BY j) FILTER (WHERE j < {DIMS + 2}) AS row_q,
    any_value(q) FILTER (WHERE j = {DIMS + 2}) AS aim, sum(abs(q)) FILTER (WHERE j < {DIMS + 2}) AS bound,
    any_value(strength) * any_value(mix) AS l1, any_value(strength) * (1 - any_value(mix)) AS l2
  FROM cells WHERE i < {DIMS + 2} GROUP BY setting, held, i),
systems AS (
  SELECT setting, held, list(row_q ORDER BY i) AS q, list(aim ORDER BY i) AS aims,
    any_value(l1) / (max(bound) + any_value(l2)) AS cut, any_value(l2) AS l2, max(bound) + any_value(l2) AS curve
  FROM rows_of GROUP BY setting, held),
steps AS (
  SELECT setting, held, 0 AS step, [0.0::DOUBLE FOR k IN range(0, {DIMS})] AS b FROM settings, helds
  UNION ALL
  SELECT setting, held, step + 1, [sign(x) * greatest(0, abs(x) - cut) FOR x IN moved]
  FROM (
    SELECT c.setting, c.held, step, cut,
      [b[k] + (aims[k] - list_dot_product(q[k], b) - l2 * b[k]) / curve FOR k IN range(1, {DIMS + 1})] AS moved
    FROM steps AS c JOIN systems AS s ON c.setting = s.setting AND c.held = s.held WHERE step < {STEPS}) AS c),
scaled AS (
  SELECT setting, held, [b[k] * spread[{DIMS + 2}] / spread[k + 1] FOR k IN range(1, {DIMS + 1})] AS beta, mean
  FROM steps JOIN shapes USING (held) WHERE step = {STEPS}),
fits AS (
  SELECT setting, held, beta, CASE WHEN icpt THEN mean[{DIMS + 2}] - list_dot_product(mean[2:{DIMS + 1}], beta)
    ELSE 0 END AS intercept FROM scaled JOIN settings USING (setting))"""


def _results_sql(weights: list[float]) -> str:
    """The table `results` (setting, metric, metric_stddev, place) besides those of `_fits_sql`."""
    grid = fixed.LINEAR_GRID
    settings = [dict(zip(grid, values, strict=True)) for values in product(*grid.values())]
    return f"""WITH RECURSIVE {_fits_sql(weights, settings, fixed.FOLDS)},
errors AS (
  SELECT setting, held, sqrt(avg(pow(z[{DIMS + 2}] - intercept - list_dot_product(z[2:{DIMS + 1}], beta), 2))) AS rmse
  FROM fits JOIN train ON held = fold GROUP BY setting, held),
results AS (
  SELECT setting, avg(rmse) AS metric, stddev_pop(rmse) AS metric_stddev,
    row_number() OVER (ORDER BY round(avg(rmse), 9), setting) AS place FROM errors GROUP BY setting)"""


NET = {"regParam": 0.01, "elasticNetParam": 0.5, "fitIntercept": True}


@query(f"""
WITH RECURSIVE {_fits_sql([0.8, 0.2], [NET], 1)}
SELECT CAST(dim AS INTEGER) AS dim, round(coefficient, 6) + 0.0 AS coefficient FROM (
  SELECT -1 AS dim, intercept AS coefficient FROM fits WHERE held = 1
  UNION ALL
  SELECT unnest(range(0, {DIMS})), unnest(beta) FROM fits WHERE held = 1)""")
def elastic_net(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = hash_split(inputs.embedded(spark, sf_dir), ["vec_id"], [0.8, 0.2])
    fitted = gram.fit(gram.moments(train)[0], **NET)
    return gram.coefficients(spark, fitted).withColumn("coefficient", F.round("coefficient", 6) + 0.0)


@query()
def logistic_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = hash_split(inputs.embedded(spark, sf_dir), ["vec_id"], [0.7, 0.3])
    predictions = models.fit_classifier(train).transform(test)
    return models.class_probabilities(predictions, ["b", "a"]).select(
        "vec_id", "binary_label", "prediction", "prob_b", "prob_a"
    )


@query()
def forest_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = hash_split(inputs.embedded(spark, sf_dir), ["vec_id"], [0.8, 0.2])
    predictions = models.fit_classifier(train, "forest", seed=42).transform(test)
    return class_shares(predictions, "prediction", {0.0: "b", 1.0: "a"})


@query()
def forest_regressor(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = hash_split(inputs.embedded(spark, sf_dir), ["vec_id"], [0.8, 0.2])
    model = models.fit_regression(
        train, "forest", scaled=True, numTrees=20, maxDepth=5, seed=42
    )
    return regression_metrics(model.transform(test), "label", "prediction")


@query()
def evaluator_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = hash_split(inputs.embedded(spark, sf_dir), ["vec_id"], [0.7, 0.3])
    predictions = models.fit_classifier(train).transform(test)
    names = [
        "areaUnderROC", "areaUnderPR", "accuracy", "weightedPrecision", "weightedRecall", "f1",
        "precisionByLabel", "recallByLabel",
    ]
    with features.kept(predictions) as scored:
        return models.evaluate(spark, scored, "binary_label", names)


NAMES_SQL = "CASE setting " + " ".join(
    f"WHEN {i} THEN '{name}'"
    for i, name in enumerate(
        ", ".join(f"{n}={v}" for n, v in sorted(zip(fixed.LINEAR_GRID, values, strict=True)))
        for values in product(*fixed.LINEAR_GRID.values())
    )
) + " END"


@query(f"""
{_results_sql([0.7, 0.3])}
SELECT {NAMES_SQL} AS setting, round(metric, 6) AS metric, round(metric_stddev, 6) AS metric_stddev,
  place = 1 AS best FROM results""")
def grid_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = hash_split(inputs.embedded(spark, sf_dir), ["vec_id"], [0.7, 0.3])
    found = gram.search(train, ["vec_id"]).results(spark)
    return found.withColumns({c: F.round(c, 6) for c in ("metric", "metric_stddev")})


@query()
def grid_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = hash_split(inputs.embedded(spark, sf_dir), ["vec_id"], [0.8, 0.2])
    return models.search_results(spark, models.search_forest(train, key=["vec_id"]))


@query(f"""
{_results_sql([0.7, 0.3])},
scores AS (
  SELECT avg(intercept + list_dot_product(z[2:{DIMS + 1}], beta)) AS score
  FROM test, fits JOIN results USING (setting) WHERE place = 1 AND held = {fixed.FOLDS})
SELECT round(score, 6) AS score_a, round(1 - score, 6) AS score_b FROM scores""")
def best_model_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = hash_split(inputs.embedded(spark, sf_dir), ["vec_id"], [0.7, 0.3])
    best = gram.search(train, ["vec_id"]).best
    scored = test.withColumn("prediction", best.predicted(F.col("features")))
    found = win_score(scored, "prediction", ("a", "b"))
    return found.withColumns({c: F.round(c, 6) for c in found.columns})


@query(f"""
{_results_sql([0.7, 0.3])}
SELECT split_part(entry, '=', 1) AS param, split_part(entry, '=', 2) AS value
FROM (SELECT unnest(string_split({NAMES_SQL}, ', ')) AS entry FROM results WHERE place = 1)""")
def best_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = hash_split(inputs.embedded(spark, sf_dir), ["vec_id"], [0.7, 0.3])
    return gram.search(train, ["vec_id"]).parameters(spark)


# --- forms with a known answer, to check the fits by SQL ---------------------------------


@query(f"""
WITH {inputs.SEGMENTS_SQL},
counts AS (
  SELECT word, count(*) AS n, count(DISTINCT (source, segment_id)) AS documents
  FROM (SELECT source, segment_id, unnest(segment) AS word FROM segments) GROUP BY word),
vocab AS (
  SELECT word, row_number() OVER (ORDER BY n DESC, word) - 1 AS dim
  FROM counts WHERE documents >= 3 ORDER BY n DESC, word LIMIT 100)
SELECT source, segment_id, CAST(dim AS INTEGER) AS dim, CAST(count(*) AS DOUBLE) AS n
FROM (SELECT source, segment_id, unnest(segment) AS word FROM segments) JOIN vocab USING (word)
GROUP BY source, segment_id, dim""")
def count_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = inputs.segments(spark, sf_dir)
    counted = features.term_counts(cut, "segment").transform(cut)
    return features.elements(counted, SEGMENT, "term_counts", "n").where(F.col("n") > 0)


@query(f"""
WITH {inputs.SEGMENTS_SQL},
words AS (SELECT source, segment_id, unnest(segment) AS word FROM segments),
counts AS (
  SELECT word, count(*) AS n, count(DISTINCT (source, segment_id)) AS documents FROM words GROUP BY word),
vocab AS (SELECT word FROM counts WHERE documents >= 3 ORDER BY n DESC, word LIMIT 100)
SELECT s.source, s.segment_id, CASE WHEN count(v.word) > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS total
FROM segments s LEFT JOIN words w ON s.source = w.source AND s.segment_id = w.segment_id
LEFT JOIN vocab v ON w.word = v.word GROUP BY s.source, s.segment_id""")
def topic_shares_add_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = topic_mixture(spark, sf_dir)
    return shares.groupBy(*SEGMENT).agg(F.round(F.sum("share"), 6).alias("total"))


@query(f"""
WITH {inputs.SEGMENTS_SQL}, {inputs.LEXICON_SQL}
SELECT source, segment_id, 201 AS size, CAST(sum(coalesce(score, 0)) AS DOUBLE) AS score
FROM (SELECT source, segment_id, unnest(segment) AS word FROM segments
  WHERE {" OR ".join(f"list_contains(segment, '{s}')" for s in inputs.SUBJECTS)}) LEFT JOIN lexicon USING (word)
GROUP BY source, segment_id""")
def assembled_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = assembled_features(spark, sf_dir)
    return found.groupBy(*SEGMENT).agg(
        F.count("*").cast("int").alias("size"),
        F.max(F.when(F.col("dim") == 0, F.col("value"))).alias("score"),
    )


@query("""
SELECT count(*) AS n, CAST(sum(CAST(label >= 5 AS INTEGER)) AS BIGINT) AS ones,
       CAST(sum(CAST(label >= 5 AS INTEGER)) AS DOUBLE) AS total
FROM embeddings WHERE substr(md5('42:' || vec_id), 1, 8) < 'b3333333'""")
def logistic_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without a penalty, the probabilities of the training rows add up to their ones."""
    train, _ = hash_split(inputs.embedded(spark, sf_dir), ["vec_id"], [0.7, 0.3])
    model = models.fit_classifier(train, maxIter=200, tol=1e-12)
    scored = models.class_probabilities(model.transform(train), ["b", "a"])
    return scored.agg(
        F.count("*").alias("n"),
        F.sum("binary_label").cast("long").alias("ones"),
        F.round(F.sum("prob_a"), 2).alias("total"),
    )


@query(f"""
WITH {inputs.SCORED_ITEMS_SQL}
SELECT 'mae' AS metric, round(avg(abs(label - prediction)), 6) AS value FROM items
UNION ALL SELECT 'mse', round(avg((label - prediction) * (label - prediction)), 6) FROM items
UNION ALL SELECT 'rmse', round(sqrt(avg((label - prediction) * (label - prediction))), 6) FROM items""")
def evaluator_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = inputs.scored_items(spark, sf_dir)
    found = models.evaluate(spark, items, "label", ["mae", "mse", "rmse"])
    return found.withColumn("value", F.round("value", 6))
