"""Feature vectors: term counts, topics, word embeddings, assembling and scaling."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.ml.clustering import LDA, LDAModel
from pyspark.ml.feature import (
    CountVectorizerModel,
    StandardScaler,
    StandardScalerModel,
    VectorAssembler,
)
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textsignal import fixed_values as fixed
from textsignal.functions.vectors import as_array, as_vector
from textsignal.operators.blocks import vector_sums
from textsignal.operators.rounds import written
from textsignal.operators.vocabulary import top_vocab, word_counts
from textsignal.operators.word_vectors import WordVectors, skip_grams

#: Numbers that word vectors may have in all.
MOST_VALUES = 2**40
#: Rows whose near words are added up together.
ROWS_AT_ONCE = 500


@contextmanager
def kept(df: DataFrame):
    """Holds a frame on the executors, spilling to disk, for a fit that reads it repeatedly.

    Blocks lost with an executor are computed again from the sources.
    """
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def term_counts(
    df: DataFrame,
    tokens: str,
    out: str = "term_counts",
    k: int = fixed.VOCABULARY_SIZE,
    min_df: int = fixed.VOCABULARY_MIN_DOCUMENTS,
) -> CountVectorizerModel:
    """Sparse vectors of word counts over the `k` most frequent words of at least `min_df` rows.

    The words are chosen by `top_vocab`: the choice of Spark's count vectorizer, but with a
    fixed order of ties, and counted without leaving Spark SQL. Only the `k` words are fetched.
    """
    chosen = top_vocab(df, tokens, k, min_df).orderBy("rank").select("word").collect()
    return CountVectorizerModel.from_vocabulary([row["word"] for row in chosen], tokens, out)


def topic_model(
    df: DataFrame,
    tokens: str,
    k: int = fixed.TOPICS,
    max_iter: int = fixed.TOPIC_ITERATIONS,
    seed: int = 42,
    vocabulary_size: int = fixed.VOCABULARY_SIZE,
    min_df: int = fixed.VOCABULARY_MIN_DOCUMENTS,
) -> tuple[CountVectorizerModel, LDAModel]:
    """Fits term counts and a topic model on them."""
    with kept(df.select(tokens)) as texts:
        counter = term_counts(texts, tokens, "term_counts", vocabulary_size, min_df)
        with kept(counter.transform(texts).select("term_counts")) as counts:
            lda = LDA(k=k, maxIter=max_iter, seed=seed, featuresCol="term_counts")
            return counter, lda.fit(counts)


def topic_terms(
    counter: CountVectorizerModel, topics: LDAModel, n: int = fixed.TOPIC_TERMS
) -> DataFrame:
    """The heaviest words of each topic: `[topic, place, word, weight]`."""
    described = topics.describeTopics(n)
    words = described.sparkSession.createDataFrame(
        list(enumerate(counter.vocabulary)), "_index int, word string"
    )
    terms = described.select(
        "topic", F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("_at", "_term")
    )
    return terms.join(words, F.col("_term.termIndices") == F.col("_index")).select(
        "topic",
        (F.col("_at") + 1).alias("place"),
        "word",
        F.col("_term.termWeights").alias("weight"),
    )


def topic_mixture(
    df: DataFrame, counter: CountVectorizerModel, topics: LDAModel, out: str = "mixture"
) -> DataFrame:
    """Adds the share of every topic in each text, as a vector."""
    return topics.setTopicDistributionCol(out).transform(counter.transform(df))


def fit_embedding(
    df: DataFrame,
    tokens: str,
    out: str,
    size: int = fixed.EMBEDDING_SIZE,
    min_count: int = 0,
    num_partitions: int = fixed.EMBEDDING_PARTITIONS,
    seed: int = 42,
) -> WordVectors:
    """Fits word vectors by skip-grams, with the method and the defaults of Spark's estimator.

    Parts of the texts are trained on their own and averaged: at least `num_partitions`, and as many as
    keep a part bounded. Neither the driver nor a task holds the vectors of all words. More than
    `MOST_VALUES` numbers in them are an error. Words are left out by `min_count` alone.
    """
    counts = written(word_counts(df, tokens).where(F.col("n") >= min_count).select("word", "n"))
    n = counts.count()
    if n * size > MOST_VALUES:
        raise ValueError(
            f"{n} words x {size} are more than word vectors may have: "
            "give a larger min_count, or use counted_vectors"
        )
    found = skip_grams(df.select(tokens), tokens, counts, size, num_partitions, seed)
    return WordVectors(found, tokens, out, size)


def pairs_of_words(df: DataFrame, tokens: str, window: int = fixed.CONTEXT_WORDS) -> DataFrame:
    """Each pair of words up to `window` places apart, in their order: `[a, b, w]`, weights `window` + 1 -
    distance. One row a pair of places."""
    words = F.col(tokens)

    def pairs_at(d: int) -> Column:
        return F.transform(
            F.slice(words, 1, F.greatest(F.size(words) - d, F.lit(0))),
            lambda word, i: F.struct(
                word.alias("a"), F.get(words, i + d).alias("b"), F.lit(window + 1 - d).alias("w")
            ),
        )

    pairs = [pairs_at(d) for d in range(1, window + 1)]
    near = df.select(F.explode_outer(F.concat(*pairs)).alias("_p")).where(F.col("_p").isNotNull())
    return near.select("_p.a", "_p.b", "_p.w")


def near_words(df: DataFrame, tokens: str, window: int = fixed.CONTEXT_WORDS) -> DataFrame:
    """Words up to `window` places apart, both ways: `[a, b, w]`, weights `window` + 1 - distance.

    The rows of both ways are not added up where a and b are one word.
    """
    both = pairs_of_words(df, tokens, window).groupBy("a", "b").agg(F.sum("w").alias("w"))
    return both.select("a", "b", "w").union(both.select("b", "a", "w"))


def _near_sums(
    batches: Iterator[pa.RecordBatch], size: int, window: int
) -> Iterator[pa.RecordBatch]:
    """`[word, n, v]` of token lists: occurrences, and sums of the signed weights of near words."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_AT_ONCE):
            lists = batch.column(0).slice(start, ROWS_AT_ONCE)
            values = lists.flatten().dictionary_encode()
            words = values.dictionary.to_pylist()
            codes = values.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            row = pc.list_parent_indices(lists).to_numpy()
            digits = np.array([int(md5(w.encode()).hexdigest()[:8], 16) for w in words] + [0], np.int64)
            dim, sign = digits % size, 1 - 2 * (digits // size % 2)
            sums = np.zeros(len(words) * size)
            for d in range(1, window + 1):
                a, b = codes[:-d], codes[d:]
                near = (row[:-d] == row[d:]) & (a >= 0) & (b >= 0)
                a, b = a[near], b[near]
                for to, by in ((a, b), (b, a)):
                    sums += np.bincount(to * size + dim[by], (window + 1 - d) * sign[by], len(sums))
            cuts = pa.array(np.arange(0, len(sums) + 1, size, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    values.dictionary,
                    pa.array(np.bincount(codes[codes >= 0], minlength=len(words)), pa.int64()),
                    pa.ListArray.from_arrays(cuts, pa.array(sums.astype(np.int64))),
                ],
                names=["word", "n", "v"],
            )


def counted_vectors(
    df: DataFrame, tokens: str, size: int, window: int = fixed.CONTEXT_WORDS
) -> DataFrame:
    """Word vectors from counts, as rows `[word, dim, value]` without zeros.

    Every word up to `window` places away adds to the dimension of its hash, with the sign of its
    hash and the weight `window` + 1 - distance; the value is the mean over the word's occurrences.
    Null words are left out. Tasks add up what stands near a word, so one row a word leaves them and
    no pair of words; words are never held together, neither on the driver nor in a task, and the
    same rows give the same vectors however they are partitioned.
    """
    part = df.select(tokens).mapInArrow(
        lambda batches: _near_sums(batches, size, window), "word string, n long, v array<long>"
    )
    sums = [F.sum(F.get("v", F.lit(i))).alias(f"_v{i}") for i in range(size)]
    total = part.groupBy("word").agg(F.sum("n").alias("n"), *sums)
    each = total.select("word", "n", F.posexplode(F.array(*(F.col(f"_v{i}") for i in range(size)))).alias("dim", "_sum"))
    return each.where(F.col("_sum") != 0).select("word", "dim", (F.col("_sum") / F.col("n")).alias("value"))


def counted_embedding(
    df: DataFrame, key: Sequence[str], tokens: str, vectors: DataFrame, size: int | None = None
) -> DataFrame:
    """The mean of the counted vectors of each row's tokens: `[key, dim, value]` without zeros.

    `size` is the number of dimensions; without it, it is looked up in the vectors.
    """
    if size is None:
        size = (vectors.agg(F.max("dim")).first()[0] or 0) + 1
    entries = [F.sum(F.when(F.col("dim") == i, F.col("value"))).alias(f"_v{i}") for i in range(size)]
    packed = vectors.groupBy("word").agg(*entries)
    packed = written(packed.select("word", F.array(*(F.col(f"_v{i}") for i in range(size))).alias("v")))
    summed = vector_sums(df, key, tokens, packed, size, counted=True)
    held = F.transform(F.slice("v", size + 1, size), lambda n, i: F.when(n > 0, F.get("v", i)))
    each = summed.select(*key, "_size", F.posexplode(held).alias("dim", "_sum"))
    return each.where(F.col("_sum").isNotNull()).select(*key, "dim", (F.col("_sum") / F.col("_size")).alias("value"))


def embed(
    df: DataFrame,
    tokens: str,
    out: str,
    size: int = fixed.EMBEDDING_SIZE,
    min_count: int = 0,
    num_partitions: int = fixed.EMBEDDING_PARTITIONS,
    seed: int = 42,
) -> DataFrame:
    """Adds the mean of the fitted word vectors of each token array; zeros for an empty one."""
    model = fit_embedding(df, tokens, out, size, min_count, num_partitions, seed)
    return model.transform(df)


def assemble(df: DataFrame, inputs: Sequence[str], out: str = "features") -> DataFrame:
    """Adds one vector made of the given numbers and vectors, in order."""
    return VectorAssembler(inputCols=list(inputs), outputCol=out, handleInvalid="error").transform(
        df
    )


def fit_scaler(train: DataFrame, features: str, out: str = "scaled") -> StandardScalerModel:
    """Fits a division by the standard deviation of each element, without centring."""
    return StandardScaler(inputCol=features, outputCol=out, withStd=True, withMean=False).fit(train)


def scale(
    train: DataFrame, other: DataFrame, features: str, out: str = "scaled"
) -> tuple[DataFrame, DataFrame]:
    """Scales both frames with what was learned from the first."""
    model = fit_scaler(train, features, out)
    return model.transform(train), model.transform(other)


def elements(df: DataFrame, key: Sequence[str], vector: str, out: str = "value") -> DataFrame:
    """One row per element of a vector column: `[key, dim, value]`, `dim` from 0."""
    array = as_array(F.col(vector), "float64")
    return df.select(*key, F.posexplode(array).alias("dim", out))


def mean_vector(df: DataFrame, key: Sequence[str], vector: str | Column) -> DataFrame:
    """Mean of an array column per key: `[key, dim, mean]`.

    Whole vectors are added up in the tasks before the shuffle, so a hot key costs no more
    than any other and nothing is exploded before it is averaged.
    """
    values = F.col(vector) if isinstance(vector, str) else vector
    means = df.groupBy(*key).agg(Summarizer.mean(as_vector(values)).alias("_mean"))
    return elements(means, key, "_mean", "mean")


def attach_by_array(df: DataFrame, extra: DataFrame, array: str) -> DataFrame:
    """Joins columns of another frame where the arrays are equal, without multiplying rows.

    Only for frames that share no key. The other frame is reduced to one row per array first;
    equal arrays must carry equal values there. Rows are brought together by a digest of the array,
    and then the arrays are compared; an array that very many rows share is split by Spark, because
    both sides are shuffled for the join alone.
    """
    digest = F.xxhash64(array)
    once = extra.dropDuplicates([array]).withColumn("_digest", digest)
    named = once.withColumnRenamed(array, "_array")
    found = df.withColumn("_digest", digest).join(named, "_digest")
    same = found.where(F.col(array).eqNullSafe(F.col("_array")))
    return same.select(array, *[c for c in df.columns if c != array], *[c for c in extra.columns if c != array])
