"""The study as five steps, each from stored tables to a stored table or model.

1. transcripts to cleaned documents and flagged segments
2. segments to feature vectors
3. features and labels to labelled features
4. labelled features to a fitted model, or the best of a search
5. model and labelled features to a report
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textsignal import fixed_values as fixed
from textsignal.functions.mentions import first_context, first_position
from textsignal.operators import evaluation, features, models
from textsignal.operators.annotate import Scorer, annotate_into, build_prompts, parse_reply
from textsignal.operators.labels import attach_labels, binarize
from textsignal.operators.lexicon import lexicon_score
from textsignal.operators.mentions import mention_contexts, mention_flags
from textsignal.operators.rounds import drop_path, new_path, written
from textsignal.operators.split import hash_split
from textsignal.operators.stitching import stitch_segments, store_tokens, stored_spans
from textsignal.operators.summaries import (
    class_shares,
    complement_scores,
    distribution,
    histogram,
    summary,
    win_report,
    win_score,
)
from textsignal.operators.tokens import clean_documents, tokenize
from textsignal.operators.vocabulary import top_vocab, used_words
from textsignal.sources.readers import (
    read_documents,
    read_labels,
    read_lexicon,
    read_parquet,
)
from textsignal.sources.writers import export_csv, write_parquet

SHOW = "podcast_name_cleaned"
SEGMENT = [SHOW, "segment_id"]


def clean_transcripts(
    documents: DataFrame, stop_words: Sequence[str] = fixed.STOP_WORDS
) -> DataFrame:
    """`[file_name, podcast_name_cleaned, cleaned_transcript, filtered_tokens]` of read files."""
    cleaned = clean_documents(documents, "text", "cleaned_transcript")
    tokens = tokenize(cleaned, "cleaned_transcript", "filtered_tokens", stop_words, lowered=True)
    return tokens.select(
        "file_name", F.col("show").alias(SHOW), "cleaned_transcript", "filtered_tokens"
    )


def with_first_contexts(cleaned: DataFrame, subjects: Sequence[str]) -> DataFrame:
    """Adds `<subject>_index` (from 0) and `<subject>_context` per subject."""
    tokens = F.col("filtered_tokens")
    return cleaned.withColumns(
        {
            **{f"{s}_index": first_position(tokens, s, base=0) for s in subjects},
            **{f"{s}_context": first_context(tokens, s, absent="head") for s in subjects},
        }
    )


def store_segments(
    spark: SparkSession, transcripts: str, cleaned_path: str, segments_path: str,
    subjects: Sequence[str], n: int = fixed.SEGMENT_TOKENS,
) -> None:
    """Step 1. The cleaned documents are stored first, so texts are cleaned only once.

    Transcripts are long: whole segments are cut where a document lies, only its ends are shuffled.
    """
    write_parquet(clean_transcripts(read_documents(spark, transcripts)), cleaned_path)
    cleaned = read_parquet(spark, cleaned_path)
    stored = store_tokens(cleaned, SHOW, ["file_name"], "filtered_tokens")
    spans = stored_spans(stored, SHOW, ["file_name"])
    cut = stitch_segments(stored, spans, SHOW, "filtered_tokens", n)
    write_parquet(mention_flags(cut, "segment", subjects), segments_path)


def store_contexts(
    spark: SparkSession, cleaned_path: str, contexts_path: str, subjects: Sequence[str],
    radius: int = fixed.CONTEXT_RADIUS, first: bool = False,
) -> None:
    """All passages of the cleaned documents that mention a subject, one row per mention.

    With `first`, the documents with their first position and context per subject instead.
    """
    cleaned = read_parquet(spark, cleaned_path)
    if first:
        write_parquet(with_first_contexts(cleaned, subjects), contexts_path)
        return
    found = mention_contexts(
        cleaned, [SHOW, "file_name"], "filtered_tokens", subjects, radius
    )
    write_parquet(found, contexts_path)


def features_of_segments(
    segments: DataFrame, lexicon: DataFrame, key: Sequence[str] = SEGMENT, seed: int = 42
) -> DataFrame:
    """Segments with one vector: lexicon score, embedding, embedding of the frequent words.

    Columns other than the tokens are kept; each part is joined by key, never by its array. Segments,
    and then those with their parts, are written once and read by the fits.
    """
    key = list(key)
    path = new_path(segments.sparkSession)
    cut = written(segments, path)
    # The k words, counted once: a bounded table that the driver holds.
    words = top_vocab(cut, "segment").select("word", "rank").collect()
    vocabulary = cut.sparkSession.createDataFrame(words, "word string, rank int")
    used = used_words(cut, key, "segment", vocabulary)
    scores = lexicon_score(cut, key, "segment", lexicon)
    described = written(cut.join(scores, key).join(used, key))
    of_segment = features.fit_embedding(cut, "segment", "embedding", seed=seed)
    drop_path(segments.sparkSession, path)
    of_words = features.fit_embedding(described, "used_words", "word_embedding", seed=seed)
    embedded = of_words.transform(of_segment.transform(described))
    assembled = features.assemble(embedded, ["score", "embedding", "word_embedding"])
    return assembled.drop("segment", "used_words", "score", "embedding", "word_embedding")


def store_features(
    spark: SparkSession, segments_path: str, lexicon_path: str, features_path: str
) -> None:
    """Step 2."""
    found = features_of_segments(
        read_parquet(spark, segments_path), read_lexicon(spark, lexicon_path)
    )
    write_parquet(found, features_path)


def store_topics(
    spark: SparkSession, segments_path: str, terms_path: str, mixture_path: str,
    k: int = fixed.TOPICS, seed: int = 42,
) -> None:
    """The heaviest words of the topics of all segments, and each segment's share of them."""
    cut = read_parquet(spark, segments_path)
    counter, topics = features.topic_model(cut, "segment", k, seed=seed)
    write_parquet(features.topic_terms(counter, topics), terms_path)
    mixed = features.topic_mixture(cut, counter, topics)
    write_parquet(features.elements(mixed, SEGMENT, "mixture", "share"), mixture_path)


def store_prompts(
    spark: SparkSession, segments_path: str, prompts_path: str, instruction: str
) -> None:
    """Labelling, first part: a prompt and its budget for each segment."""
    cut = read_parquet(spark, segments_path)
    text = cut.select(*SEGMENT, F.array_join("segment", " ").alias("text"))
    asked = build_prompts(text, "text", instruction)
    write_parquet(asked.select(*SEGMENT, "prompt", "budget"), prompts_path)


def store_replies(
    spark: SparkSession, prompts_path: str, replies_path: str, scorer: Scorer,
    max_attempts: int | None = None,
) -> None:
    """Second part: the scorer's replies; without `max_attempts` each prompt is asked until it has one.

    Replies that the table already has are kept, so that a run goes on where one before it stopped.
    """
    asked = read_parquet(spark, prompts_path)
    annotate_into(asked, [*SEGMENT, "prompt"], scorer, replies_path, max_attempts=max_attempts)


def store_parsed_labels(
    spark: SparkSession, replies_path: str, labels_path: str, subjects: Sequence[str]
) -> None:
    """Third part: the ratings as a label table. Replies without a rating have a null label."""
    parsed = parse_reply(read_parquet(spark, replies_path), "reply", subjects, echo="prompt")
    write_parquet(
        parsed.select(*SEGMENT, F.col("rating").alias("label"), "sentiment"), labels_path
    )


def store_export(spark: SparkSession, segments_path: str, csv_path: str) -> None:
    """The segments as a CSV file that a person can label."""
    export_csv(read_parquet(spark, segments_path), csv_path)


def store_labelled(
    spark: SparkSession, features_path: str, labels_path: str, labelled_path: str,
    mode: str = "all",
) -> None:
    """Step 3. Labels are a CSV file, or a table of `store_parsed_labels`."""
    csv = labels_path.endswith(".csv")
    labels = read_labels(spark, labels_path) if csv else read_parquet(spark, labels_path)
    labelled = attach_labels(read_parquet(spark, features_path), labels, SEGMENT, mode=mode)
    write_parquet(labelled, labelled_path)


def split_rows(
    labelled: DataFrame, neutral: str = "drop", train_share: float = 0.7, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Training and test rows with a binary label; all labels of a segment on one side."""
    rows = binarize(labelled.where(F.col("label").isNotNull()), neutral=neutral)
    train, test = hash_split(rows, SEGMENT, [train_share, 1 - train_share], seed)
    return train, test


def store_model(
    spark: SparkSession, labelled_path: str, model_path: str, task: str = "regression",
    kind: str = "linear", neutral: str = "drop", scaled: bool = False, search: bool = False,
    train_share: float = 0.7, split_seed: int = 42, **params,
) -> None:
    """Step 4. With `search`, the best of the default grid (linear regression, forest classes).

    A search keeps `scaled` and all settings, and its folds keep a segment together; for another
    kind of model there is no grid, and a search is refused.
    """
    searched = {"regression": "linear", "classification": "forest"}.get(task)
    if search and kind != searched:
        raise ValueError(f"a search for {task} is over {searched!r} models, not {kind!r}")
    labelled = read_parquet(spark, labelled_path)
    if task == "regression":
        train, _ = split_rows(labelled, "zero", train_share, split_seed)
        if search:
            found = models.search_linear(train, key=SEGMENT, scaled=scaled, **params)
            model = models.as_pipeline(found.bestModel)
        else:
            model = models.fit_regression(train, kind, scaled=scaled, **params)
    elif task == "classification":
        train, _ = split_rows(labelled, neutral, train_share, split_seed)
        if search:
            found = models.search_forest(train, key=SEGMENT, scaled=scaled, **params)
            model = models.as_pipeline(found.bestModel)
        else:
            model = models.fit_classifier(train, kind, scaled=scaled, **params)
    else:
        raise ValueError(f"task must be 'regression' or 'classification', not {task!r}")
    models.save(model, model_path)


def report(
    spark: SparkSession, labelled_path: str, model_path: str, subjects: tuple[str, str],
    task: str = "regression", neutral: str = "drop", train_share: float = 0.7,
    split_seed: int = 42,
) -> dict[str, DataFrame]:
    """Step 5. Tables by name, on the test rows.

    `roc`, `pr` and the pair counts have a row for each distinct score or pair, up to one a test row.
    """
    labelled = read_parquet(spark, labelled_path)
    first, second = subjects
    if task == "regression":
        _, test = split_rows(labelled, "zero", train_share, split_seed)
        scored = models.load(model_path).transform(test)
        missed = evaluation.residuals(scored, "label", "prediction")
        return {
            "metrics": evaluation.regression_metrics(scored, "label", "prediction"),
            "win_score": win_score(
                complement_scores(scored, "prediction", subjects), "prediction", subjects
            ),
            "actual_against_predicted": evaluation.pair_counts(scored, "label", "prediction", 0.02),
            "residuals": evaluation.pair_counts(missed, "prediction", "residual", 0.02),
            "labels": distribution(labelled, "label"),
            "label_summary": summary(labelled, "label"),
            "label_histogram": histogram(labelled, "label"),
        }
    _, test = split_rows(labelled, neutral, train_share, split_seed)
    predicted = models.load(model_path).transform(test)
    scored = models.class_probabilities(predicted, [second, first])
    positive = f"prob_{first}"
    return {
        "metrics": evaluation.classification_metrics(scored, "binary_label", "prediction"),
        "class_metrics": evaluation.class_metrics(scored, "binary_label", "prediction"),
        "confusion": evaluation.confusion_wide(scored, "binary_label", "prediction"),
        "areas": evaluation.areas(scored, "binary_label", positive),
        "roc": evaluation.roc_points(scored, "binary_label", positive),
        "pr": evaluation.pr_points(scored, "binary_label", positive),
        "classes": class_shares(scored, "prediction", {0.0: second, 1.0: first}),
        "win_report": win_report(
            scored, "prediction", {first: (1.0, positive), second: (0.0, f"prob_{second}")}
        ),
    }
