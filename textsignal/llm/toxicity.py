"""Toxic passages by maximum-scoring segments.

1. Counts of the words, and of beginnings of words, of toxic and other training texts, with a Dirichlet prior proportional to the
   counts of both, give each word a log-odds ratio and its standard error. A word between the same
   two words counts once a class, so that near copies of a text add little: contexts are rows, which
   Spark makes distinct and counts. Words with a ratio of at least `LEAST_RATIO`, `LEAST_Z` errors
   above 0, are kept. A word scores the largest ratio kept for it; all other words cost `DRIFT`.
2. A linear scan (Ruzzo and Tompa) finds every maximal segment of a text. Only kept words can begin
   or end one, so the words between two of them are added up in one step.
3. Extreme-value theory tells how many segments of a score a clean text of that length would have
   (Karlin and Altschul): E = n exp(-lambda S). Segments with E below `LEAST_E` are passages.
4. A text's evidence is the sum of -ln E over its segments with E below 1; a logistic curve fitted on the training
   texts turns it into a score.

Training reads a bounded sample: at most `PER_CLASS` labelled texts a class, each distinct text
once. Scoring reads all texts whole, in batches, and shuffles nothing.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textsignal.llm.language import labelled_sample
from textsignal.llm.store import stored

PER_CLASS = 5_000
#: Tasks that read the words of the sample; results don't depend on it.
READ_PARTS = 64
LEAST_Z = 4.0
LEAST_RATIO = 1.0
PRIOR = 0.05
DRIFT = 0.25
LEAST_E = 0.05
#: Letters of the beginnings of words that are counted like words, and the mark of a beginning.
BEGINNINGS = (4, 5, 6)
HEAD = min(BEGINNINGS)
STEM = "*"
WORDS = re.compile(r"[^\W\d_]+")

RESULTS = ("score", "predicted", "n_passages", "passages")
RESULT_TYPES = (
    "score double, predicted int, n_passages int, "
    "passages array<struct<first:int,last:int,score:double,expected:double>>"
)


@dataclass
class Model:
    """Scores of words, lambda, and the logistic curve (slope, intercept)."""

    scores: dict[str, float]
    rate: float
    slope: float = 1.0
    intercept: float = 0.0
    heads: set[str] = field(init=False)

    def __post_init__(self) -> None:
        self.heads = {unit.rstrip(STEM)[:HEAD] for unit in self.scores}


def units(word: str) -> list[str]:
    """A word and its beginnings, which stand for its inflected forms."""
    return [word, *[word[:n] + STEM for n in BEGINNINGS if len(word) > n]]


def segments(hits: list[tuple[int, float]], drift: float = DRIFT) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first word, last word, score) of a text, in order.

    `hits` are the places and scores of the words with positive scores; each word between them
    scores -`drift`. Segments are kept in a list in which each one knows the sums before its first
    word and after its last one, and the nearest earlier one with a smaller sum before it. Those in
    between are never looked at again, so the time is linear.
    """
    # first, last, sum before, sum after, place of the nearest one with a smaller sum before
    found: list[tuple[int, int, float, float, int]] = []
    total, at = 0.0, 0
    for place, score in hits:
        total -= drift * (place - at)
        first, before, total = place, total, total + score
        at = place + 1
        k = len(found) - 1
        while True:
            while k >= 0 and found[k][2] >= before:
                k = found[k][4]
            if k < 0 or found[k][3] >= total:
                break
            first, _, before, _, link = found[k]
            del found[k:]
            k = link
        found.append((first, place, before, total, k))
    return [(a, b, after - before) for a, b, before, after, _ in found]


def decay_rate(share: np.ndarray, score: np.ndarray, drift: float = DRIFT) -> float:
    """lambda > 0 with sum of share x exp(lambda x score) = 1 over all words of clean texts."""
    rest = max(0.0, 1.0 - float(share.sum()))

    def excess(x: float) -> float:
        return float((share * np.exp(np.minimum(x * score, 500))).sum()) + rest * math.exp(-x * drift) - 1

    if not len(score) or excess(1e-9) >= 0:
        return 1e-3
    low, high = 1e-9, 1.0
    while excess(high) < 0 and high < 64:
        low, high = high, high * 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return low


def passages(text: str, model: Model) -> tuple[list[tuple[int, int, float, float]], float]:
    """Significant passages (first word, last word, score, expected number), and the evidence."""
    words = WORDS.findall(text.lower())
    scores, heads = model.scores, model.heads
    near = [(i, w) for i, w in enumerate(words) if w[:HEAD] in heads]
    hits = [
        (i, max(known)) for i, w in near if (known := [scores[u] for u in units(w) if u in scores])
    ]
    if not hits:
        return [], 0.0
    kept, evidence = [], 0.0
    for first, last, score in segments(hits):
        log_expected = math.log(len(words)) - model.rate * score
        evidence += max(0.0, -log_expected)
        if log_expected < math.log(LEAST_E):
            kept.append((first, last, score, math.exp(max(log_expected, -700))))
    return kept, math.log1p(evidence)


def _curve(evidence: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Logistic regression with one feature, by Newton steps with a small penalty."""
    x = np.stack([evidence, np.ones_like(evidence)], axis=1)
    b = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        slope = x.T @ (weight * (label - p)) - 1e-3 * b
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(bend, slope)
        b = b + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(b[0]), float(b[1])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    per_class: int = PER_CLASS,
) -> Model:
    """Word scores, rate and curve from the texts that `labels` marks 0 or 1 under their key.

    A key with both labels, a null label or a null key doesn't count. Without texts of both
    classes nothing is toxic.
    """
    marked = labels.select(labels[key].alias("key"), labels[label].cast("int").alias("label"))
    marked = (
        marked.where(F.col("label").isin(0, 1) & F.col("key").isNotNull())
        .groupBy("key")
        .agg(F.min("label").alias("label"), F.max("label").alias("_other"))
        .where(F.col("label") == F.col("_other"))
        .drop("_other")
    )
    sizes = {r["label"]: r["count"] for r in marked.groupBy("label").count().collect()}
    # At most 2 x per_class rows of two numbers: bounded by a parameter.
    chosen = F.broadcast(stored(labelled_sample(marked, "label", "key", per_class, "toxicity")))
    rows = docs.select(docs[key].alias("_key"), docs[text].alias("text"))
    texts = stored(
        rows.join(chosen, F.col("_key") == F.col("key"))
        .where(F.col("text").isNotNull())
        .groupBy(F.md5("text").alias("_copy"))
        .agg(F.first("text").alias("text"), F.max("label").alias("label"))
        .drop("_copy")
    )

    def contexts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for text, value in zip(frame["text"], frame["label"], strict=True):
                ws = ["", *WORDS.findall(text.lower()), ""]
                if len(ws) > 2:
                    yield pd.DataFrame(
                        {"label": value, "before": ws[:-2], "word": ws[1:-1], "after": ws[2:]}
                    )

    shown = "label int, before string, word string, after string"
    spread = texts.repartition(READ_PARTS, "text").mapInPandas(contexts, shown)
    known = spread.distinct().groupBy("label", "word").count()
    long = F.length("word")
    forms = [F.when(long > n, F.concat(F.substring("word", 1, n), F.lit(STEM))) for n in BEGINNINGS]
    each = known.select("label", "count", F.explode(F.array("word", *forms)).alias("unit"))
    count = F.col("count")
    words = stored(
        each.where(F.col("unit").isNotNull())
        .groupBy("unit")
        .agg(
            F.sum(F.when(F.col("label") == 1, count).otherwise(0)).alias("y1"),
            F.sum(F.when(F.col("label") == 0, count).otherwise(0)).alias("y0"),
        )
    )
    whole = words.where(~F.col("unit").endswith(STEM))
    n = whole.agg(F.sum("y1").alias("n1"), F.sum("y0").alias("n0")).first()
    n1, n0 = float(n["n1"] or 0), float(n["n0"] or 0)
    if not n1 or not n0:  # texts of one class only, or none
        return Model({}, 1e-3, 0.0, -5.0)
    y1, y0 = F.col("y1"), F.col("y0")
    prior = F.lit(PRIOR) * (y1 + y0)
    all_prior = PRIOR * (n1 + n0)
    ratio = F.log((y1 + prior) / (F.lit(n1 + all_prior) - y1 - prior)) - F.log(
        (y0 + prior) / (F.lit(n0 + all_prior) - y0 - prior)
    )
    error = F.sqrt(1 / (y1 + prior) + 1 / (y0 + prior))
    kept = (
        words.select("unit", ratio.alias("ratio"), (ratio / error).alias("z"), (y0 + prior).alias("clean"))
        .where((F.col("z") >= LEAST_Z) & (F.col("ratio") >= LEAST_RATIO))
        .collect()
    )
    # Of a bounded sample, so a bounded number. Units with one head are forms of one another: the most frequent and the worst stand for all.
    heads: dict[str, tuple[float, float]] = {}
    for r in kept:
        head = r["unit"].rstrip(STEM)[:HEAD]
        clean, ratio = heads.get(head, (0.0, 0.0))
        heads[head] = (max(clean, r["clean"]), max(ratio, r["ratio"]))
    shares = np.array([clean for clean, _ in heads.values()]) / (n0 + all_prior)
    rate = decay_rate(shares, np.array([ratio for _, ratio in heads.values()]))
    model = Model({r["unit"]: float(r["ratio"]) for r in kept}, rate)

    def evidence(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [passages(t, model)[1] for t in frame["text"]]
            yield pd.DataFrame({"x": found, "label": frame["label"]})

    # Equal evidence is added up: two numbers a text, of a bounded number of texts.
    points = (
        texts.mapInPandas(evidence, "x double, label int").groupBy("x", "label").count().collect()
    )
    x = np.array([p["x"] for p in points])
    y = np.array([p["label"] for p in points], float)
    part = {c: max(1.0, sizes.get(c, 0) / max(1, min(per_class, sizes.get(c, 0)))) for c in (0, 1)}
    weight = np.array([p["count"] * part[p["label"]] for p in points], float)
    model.slope, model.intercept = _curve(x, y, weight)
    return model


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Adds `score` (0 to 1), `predicted` (1 from 0.5 on), `n_passages` and `passages`.

    Columns of these names are replaced. A null or empty text has no passage and the score of a text without evidence. Passages give the
    first and last word (from 0, words are runs of letters), score and expected number.
    """
    docs = docs.select(*[docs[c] for c in docs.columns if c.lower() not in RESULTS])
    place = docs.columns.index(text)
    fields = [("first", pa.int32()), ("last", pa.int32()), ("score", pa.float64()), ("expected", pa.float64())]
    kind = pa.list_(pa.struct(fields))
    schema = T.StructType([*docs.schema.fields])
    for field in T.StructType.fromDDL(RESULT_TYPES):
        schema = schema.add(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [passages(t.as_py() or "", model) for t in batch.column(place)]
            logit = [model.slope * x + model.intercept for _, x in found]
            scores = [1 / (1 + math.exp(-max(-30.0, min(30.0, v)))) for v in logit]
            spans = [[dict(zip(("first", "last", "score", "expected"), p)) for p in ps] for ps, _ in found]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(scores, pa.float64()),
                    pa.array([int(s >= 0.5) for s in scores], pa.int32()),
                    pa.array([len(s) for s in spans], pa.int32()),
                    pa.array(spans, kind),
                ],
                names=[*batch.schema.names, *RESULTS],
            )

    return docs.mapInArrow(run, schema)
