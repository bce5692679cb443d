"""Language of texts by the nearest of several centroids per language.

A text becomes a vector of its letter n-grams (1 to 3 letters, words set apart by one space, hashed
to `DIMS` places): 1 + ln(count), times the inverse document frequency, normalised to length 1. For
each language a spherical k-means gives `CLUSTERS` centroids. A text has the language of the
centroid with the largest cosine. It is rejected if it has no letter, or if it is farther from
that centroid than (practically) all texts of its language were in training.

Training reads a bounded sample, at most `PER_LANGUAGE` labelled texts of each language, chosen by a
hash of the text and its key; repeated rows count once. The model has languages x `CLUSTERS` x `DIMS` numbers. Prediction reads all
texts whole, in batches, and shuffles nothing.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textsignal.llm.common import measured_broadcast
from textsignal.llm.store import stored

DIMS = 8192
ORDERS = (1, 2, 3)
CLUSTERS = 4
PER_LANGUAGE = 1000
ROUNDS = 12
#: A text is rejected below this part of the least similarity that training texts had.
REJECT = 0.5
#: How sharply differences of cosine turn into a score.
SHARPNESS = 25.0
UNKNOWN = "und"

#: Letters handled at once, and texts in a block of vectors.
PIECE = 1 << 20
BLOCK = 256
_FACTORS = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35))


_letter_table: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Whether a code point is a letter; made once in each Python process."""
    if not _letter_table:
        _letter_table.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    return _letter_table[0]


def _clean(text: str) -> np.ndarray:
    """Code points of the lower-cased letters; other runs become one space, at both ends, too."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = _letters()[points]
    follows = np.empty(len(points), bool)
    follows[0] = True
    follows[1:] = is_letter[:-1]
    return np.where(is_letter, points, np.uint32(32))[is_letter | follows]


def _grams(points: np.ndarray) -> Iterator[np.ndarray]:
    """Places of the n-grams that start in a run of code points, by order."""
    for order in ORDERS:
        n = len(points) - order + 1
        if n <= 0:
            return
        code = np.full(n, order, np.uint32)
        for i in range(order):
            code = (code ^ points[i : i + n]) * _FACTORS[i]
            code ^= code >> np.uint32(15)
        yield code & np.uint32(DIMS - 1)


def counts(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """N-gram counts of texts (rows), and their numbers of letters."""
    made = np.zeros((len(texts), DIMS), np.float32)
    letters = np.zeros(len(texts), np.int64)
    longest = max(ORDERS)
    for row, text in enumerate(texts):
        points = _clean(text)
        letters[row] = np.count_nonzero(points != 32)
        if not letters[row]:
            continue
        for start in range(0, len(points), PIECE):
            # An n-gram is counted in the piece in which it starts.
            piece = points[start : start + PIECE + longest - 1]
            for places in _grams(piece):
                made[row] += np.bincount(places[:PIECE], minlength=DIMS)
    return made, letters


def _vectors(made: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weighed = np.log1p(made, out=made)
    weighed *= idf
    length = np.sqrt(np.einsum("ij,ij->i", weighed, weighed))
    weighed /= np.maximum(length, 1e-12)[:, None]
    return weighed


@dataclass
class Model:
    """Languages of the centroids, centroids, least similarities accepted, and idf."""

    languages: list[str]
    centroids: np.ndarray
    least: np.ndarray
    idf: np.ndarray


def uniform(salt: str, *of: Column) -> Column:
    """A number in [0, 1) that depends on the given columns alone."""
    hashed = F.xxhash64(F.lit(salt), *[F.coalesce(c.cast("string"), F.lit("")) for c in of])
    return (hashed.cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)


def labelled_sample(
    rows: DataFrame, label: str, key: str, most: int, salt: str, text: str | None = None
) -> DataFrame:
    """At most `most` rows of each label, those whose keys have the least hashes.

    With `text`, those whose keys and texts have, and repeated rows are one: so a label whose rows
    share a key, or are null there, has its sample, too.
    """
    named = [F.col(key)] if text is None else [F.col(key), F.col(text)]
    known = rows.where(F.col(label).isNotNull()).withColumn("_u", uniform(salt, *named))
    n = F.count(F.lit(1)) if text is None else F.approx_count_distinct("_u", 0.02)
    sizes = stored(known.groupBy(F.col(label).alias("_label")).agg(n.alias("_n")))
    # About a tenth more than wanted come near the window, however large the table is.
    near = known.join(measured_broadcast(sizes, 64), F.col(label) == F.col("_label")).where(
        F.col("_u") * F.col("_n") < most * 1.1 + 30
    )
    if text is not None:
        near = near.dropDuplicates([label, "_u"])
    place = F.row_number().over(Window.partitionBy(label).orderBy("_u", key))
    return near.withColumn("_row", place).where(F.col("_row") <= most).drop(
        "_u", "_n", "_label", "_row"
    )


def _document_frequencies(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total, n = np.zeros(DIMS), 0
    for frame in frames:
        for start in range(0, len(frame), BLOCK):
            made, _ = counts(frame["text"].iloc[start : start + BLOCK].tolist())
            total += (made > 0).sum(axis=0)
            n += len(made)
    yield pd.DataFrame({"n": [n], "df": [total.tobytes()]})


def _cluster(vectors: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means; starts from texts that are far from one another."""
    chosen = [int(np.argmax(vectors @ vectors.mean(axis=0)))]
    nearest = vectors @ vectors[chosen[0]]
    for _ in range(1, min(k, len(vectors))):
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, vectors @ vectors[chosen[-1]])
    centres = vectors[chosen].copy()
    for _ in range(ROUNDS):
        own = np.argmax(vectors @ centres.T, axis=1)
        for c in range(len(centres)):
            if np.any(own == c):
                mean = vectors[own == c].sum(axis=0)
                centres[c] = mean / max(np.linalg.norm(mean), 1e-12)
    return centres


def fit(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "lang",
    clusters: int = CLUSTERS,
    per_language: int = PER_LANGUAGE,
) -> Model:
    """Centroids of the languages of the labelled rows; rows without text or label don't count."""
    rows = docs.select(docs[key].alias("key"), docs[text].alias("text"), docs[label].alias("label"))
    known = rows.where(F.col("text").rlike(r"\p{L}"))
    sample = stored(labelled_sample(known, "label", "key", per_language, "language", "text"))
    frequencies = sample.select("text").mapInPandas(_document_frequencies, "n long, df binary")
    df, n = np.zeros(DIMS), 0
    for row in frequencies.toLocalIterator():
        df += np.frombuffer(row["df"])
        n += row["n"]
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)

    def of_language(frame: pd.DataFrame) -> pd.DataFrame:
        texts = frame.sort_values(["key", "text"])["text"].tolist()
        blocks = [counts(texts[i : i + BLOCK])[0] for i in range(0, len(texts), BLOCK)]
        vectors = np.concatenate([_vectors(b, idf) for b in blocks])
        centres = _cluster(vectors, clusters)
        near = (vectors @ centres.T).max(axis=1)
        return pd.DataFrame(
            {
                "label": [str(frame["label"].iloc[0])] * len(centres),
                "centre": [c.astype(np.float32).tobytes() for c in centres],
                "least": [float(near.min()) * REJECT] * len(centres),
            }
        )

    found = sample.groupBy("label").applyInPandas(
        of_language, "label string, centre binary, least double"
    )
    centres = sorted(map(tuple, found.collect()))
    return Model(
        [c[0] for c in centres],
        np.array([np.frombuffer(c[1], np.float32) for c in centres]).reshape(len(centres), DIMS),
        np.array([c[2] for c in centres]),
        idf,
    )


def _predict(model: Model, texts: list[str]) -> tuple[list, list, list, list]:
    languages = sorted(set(model.languages))
    of = np.array([languages.index(x) for x in model.languages], int)
    named, scores, near, rejected = [], [], [], []
    for start in range(0, len(texts), BLOCK):
        made, letters = counts(texts[start : start + BLOCK])
        cosines = _vectors(made, model.idf) @ model.centroids.T
        for row, n in zip(cosines, letters, strict=True):
            if not n or not languages:
                named.append(UNKNOWN)
                scores.append(0.0)
                near.append(0.0)
                rejected.append(True)
                continue
            best = int(np.argmax(row))
            by = np.full(len(languages), -1.0)
            np.maximum.at(by, of, row)
            weights = np.exp(SHARPNESS * (by - by.max()))
            named.append(model.languages[best])
            scores.append(float(weights[of[best]] / weights.sum()))
            near.append(float(row[best]))
            rejected.append(bool(row[best] < model.least[best]))
    return named, scores, near, rejected


def predict(docs: DataFrame, model: Model, text: str = "text", prefix: str = "") -> DataFrame:
    """Adds `lang_pred`, `score` (0 to 1), `similarity` (cosine) and `rejected` to every row.

    `und`, score 0 and rejected stand for a null or empty text, one without letters, and any text
    if nothing was learned. `prefix` goes before the four names; columns of `docs` that are named so
    are replaced.
    """
    names = [f"{prefix}{n}" for n in ("lang_pred", "score", "similarity", "rejected")]
    docs = docs.select(*[docs[c] for c in docs.columns if c.lower() not in names])
    place = docs.columns.index(text)
    kinds = ("string", "double", "double", "boolean")
    schema = T.StructType([*docs.schema.fields])
    for name, kind in zip(names, kinds, strict=True):
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(place).to_pylist()]
            made = _predict(model, texts)
            types = (pa.string(), pa.float64(), pa.float64(), pa.bool_())
            new = [pa.array(m, t) for m, t in zip(made, types, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *new], names=[*batch.schema.names, *names]
            )

    return docs.mapInArrow(run, schema)


def recognised(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows whose text is not rejected, with the columns of `docs`."""
    return predict(docs, model, text, "_llm_").where(~F.col("_llm_rejected")).select(*docs.columns)
