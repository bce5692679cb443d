"""Word vectors by factorisation of how much more often words stand together than by chance.

1. Words near one another are counted with weights; the logarithm of the ratio of a pair's weight to
   what its words would have by chance, less that of `shift`, is kept where it is positive: a
   symmetric sparse matrix as rows (a, b, value).
2. Subspace iteration finds its main directions: a round multiplies the matrix by a table of one
   dense array a word (a join on b, and a sum of arrays by a, added up in the tasks first), and makes
   the columns orthonormal, for which the driver gets products of columns only, size x size numbers.
3. `vectors` turns the columns into eigenvectors, each times the root of its value's size.

Neither the vocabulary nor the vectors are held on the driver or in a task. The first table is made
of hashes of the words, so that the same rows give the same vectors however they are partitioned.
Null words are left out; words without a kept pair have no vector and count as zeros in a mean.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textsignal import fixed_values as fixed
from textsignal.operators.blocks import vector_sums
from textsignal.operators.features import pairs_of_words
from textsignal.operators.rounds import drop_path, new_path, written

SEED = "word"
#: Rows that a step joins at once.
SLICE_ROWS = 50_000_000
#: A column whose part outside the columns before it is smaller than this share of it is dropped.
DEPENDENT = 1e-10


def shifted_ratios(
    df: DataFrame, tokens: str, window: int = fixed.CONTEXT_WORDS, shift: float = 1.0
) -> DataFrame:
    """`[a, b, value]`: positive logarithms of w(a, b) x total / (w(a) x w(b) x shift).

    The matrix is symmetric: one row is counted, written and joined for a pair of words, and both ways
    are made from it as it is read.
    """
    spark, path = df.sparkSession, new_path(df.sparkSession)
    near = pairs_of_words(df, tokens, window).where(F.col("a").isNotNull() & F.col("b").isNotNull())
    first, last = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    # A word near itself is so both ways.
    weight = F.when(F.col("a") == F.col("b"), 2 * F.col("w")).otherwise(F.col("w")).alias("w")
    pairs = near.select(first, last, weight).groupBy("a", "b").agg(F.sum("w").cast("double").alias("w"))
    pairs = written(pairs, path)
    sums = written(both_ways(pairs).groupBy("a").agg(F.sum("w").alias("sum")))
    total = sums.agg(F.sum("sum")).first()[0] or 1.0
    left = sums.select("a", F.col("sum").alias("_of_a"))
    right = sums.select(F.col("a").alias("b"), F.col("sum").alias("_of_b"))
    ratio = F.col("w") * F.lit(total) / (F.col("_of_a") * F.col("_of_b") * F.lit(float(shift)))

    def kept(part: DataFrame) -> DataFrame:
        rows = part.join(left, "a").join(right, "b").select("a", "b", F.log(ratio).alias("value"))
        return written(rows.where(F.col("value") > 0))

    found = reduce(DataFrame.union, [kept(part) for part in slices(pairs, "a", pairs.count())])
    drop_path(spark, path)
    return both_ways(found)


def slices(rows: DataFrame, word: str, n: int) -> list[DataFrame]:
    """The n rows in parts by a hash of the word, so that what is shuffled for a part is bounded."""
    parts = math.ceil(n / SLICE_ROWS)
    return [rows.where(F.pmod(F.hash(word), F.lit(parts)) == i) for i in range(parts)] if parts > 1 else [rows]


def both_ways(pairs: DataFrame) -> DataFrame:
    """Rows (a, b, x) and (b, a, x); one row where a and b are one word."""
    a, b, x = pairs.columns
    swapped = pairs.where(F.col(a) != F.col(b)).select(F.col(b).alias(a), F.col(a).alias(b), x)
    return pairs.union(swapped)


def _summed(rows: DataFrame, key: Sequence[str], vector: str, by: str, size: int) -> DataFrame:
    """Sums of arrays times a number by key, added up in the tasks before they are sent: `[key, v]`."""
    sums = [F.sum(F.get(vector, F.lit(i)) * F.col(by)).alias(f"_v{i}") for i in range(size)]
    total = rows.groupBy(*key).agg(*sums)
    return total.select(*key, F.array(*(F.col(f"_v{i}") for i in range(size))).alias("v"))


def _rows_of(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def _products(pairs: DataFrame, size: int) -> np.ndarray:
    """Sum of u v' over rows `[u, v]` of arrays: size x size numbers, a row of them a task."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            if batch.num_rows:
                total += _rows_of(batch.column(0)).T @ _rows_of(batch.column(1))
        yield pa.RecordBatch.from_pydict({"p": pa.array([total.ravel()], pa.list_(pa.float64()))})

    each = pairs.select("u", "v").mapInArrow(add, "p array<double>")
    found = each.select(F.posexplode("p").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x"))
    total = np.zeros(size * size)
    for r in found.collect():
        total[r["i"]] = r["x"]
    return total.reshape(size, size)


def _times(table: DataFrame, matrix: np.ndarray) -> DataFrame:
    """`[word, v]` with each array multiplied by the matrix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = _rows_of(batch.column(1)) @ matrix
                cuts = np.arange(0, made.size + 1, made.shape[1], dtype=np.int32)
                lists = pa.ListArray.from_arrays(pa.array(cuts), pa.array(made.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["word", "v"])

    return table.select("word", "v").mapInArrow(run, "word string, v array<double>")


def orthonormal(gram: np.ndarray) -> np.ndarray:
    """The upper triangular matrix that makes columns with these products orthonormal.

    A column that depends on those before it becomes 0.
    """
    size = len(gram)
    made = np.zeros((size, size))
    for j in range(size):
        column = np.zeros(size)
        column[j] = 1.0
        for _ in range(2):  # the second time takes off what rounding has left
            column -= made @ (made.T @ gram @ column)
        norm = column @ gram @ column
        if norm > DEPENDENT * max(gram[j, j], 0.0) and norm > 0:
            made[:, j] = column / np.sqrt(norm)
    return made


@dataclass
class WordFactors:
    """The matrix `[a, b, value]` and orthonormal columns as `[word, v]`."""

    ratios: DataFrame
    columns: DataFrame
    size: int

    def product(self) -> DataFrame:
        """The matrix times the columns: `[word, v]`, written."""
        parts = slices(self.ratios, "a", self.ratios.count())
        cells = [part.join(self.columns, F.col("b") == F.col("word")) for part in parts]
        found = [written(_summed(c, ["a"], "v", "value", self.size).withColumnRenamed("a", "word")) for c in cells]
        return reduce(DataFrame.union, found)

    def round(self) -> WordFactors:
        made = self.product()
        gram = _products(made.select(F.col("v").alias("u"), "v"), self.size)
        return WordFactors(self.ratios, written(_times(made, orthonormal(gram))), self.size)

    def _ritz(self) -> tuple[np.ndarray, np.ndarray, DataFrame]:
        """Values and directions of the matrix within the columns, and its product with them."""
        made = self.product()
        both = self.columns.select("word", F.col("v").alias("u")).join(made, "word")
        inner = _products(both, self.size)
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        order = np.argsort(-np.abs(values), kind="stable")
        values, turn = values[order], turn[:, order]
        # The largest entry of a direction is positive.
        turn = turn * np.where(turn[np.abs(turn).argmax(axis=0), np.arange(self.size)] < 0, -1.0, 1.0)
        return values, turn, made

    def vectors(self) -> DataFrame:
        """Eigenvectors, each times the root of its value's size, the largest first: `[word, v]`."""
        values, turn, _ = self._ritz()
        return _times(self.columns, turn * np.sqrt(np.abs(values)))

    def residual(self) -> float:
        """How far the matrix moves the columns out of their own space, as a share of what it gives."""
        values, turn, made = self._ritz()
        inner = turn @ np.diag(values) @ turn.T
        own = _times(self.columns, inner).withColumnRenamed("v", "u")
        square = lambda x: F.aggregate(F.transform(x, lambda y: y * y), F.lit(0.0), lambda s, y: s + y)
        off = F.zip_with("u", "v", lambda x, y: x - y)
        found = own.join(made, "word").agg(F.sum(square(off)).alias("off"), F.sum(square(F.col("v"))).alias("all")).first()
        return float(np.sqrt((found["off"] or 0.0) / found["all"])) if found["all"] else 0.0


def factor_words(
    df: DataFrame,
    tokens: str,
    size: int = fixed.EMBEDDING_SIZE,
    rounds: int = 4,
    window: int = fixed.CONTEXT_WORDS,
    shift: float = 1.0,
) -> WordFactors:
    """Columns after `rounds` rounds from a start of hashes."""
    ratios = shifted_ratios(df, tokens, window, shift)

    def entry(i: Column) -> Column:
        digest = F.md5(F.concat_ws(":", F.lit(SEED), i.cast("string"), F.col("a")))
        return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / 2**31 - 1

    words = ratios.select("a").distinct()
    start = words.select(
        F.col("a").alias("word"), F.transform(F.sequence(F.lit(0), F.lit(size - 1)), entry).alias("v")
    )
    found = WordFactors(ratios, written(start), size)
    for _ in range(rounds):
        found = found.round()
    return found


def mean_vectors(
    df: DataFrame, key: Sequence[str], tokens: str, vectors: DataFrame, size: int
) -> DataFrame:
    """The mean of the vectors of each row's tokens: `[key, v]`.

    Vectors come once for each word and block of texts. Rows without a known word have none.
    """
    summed = vector_sums(df, key, tokens, vectors, size)
    return summed.select(*key, F.transform("v", lambda x: x / F.col("_size")).alias("v"))
