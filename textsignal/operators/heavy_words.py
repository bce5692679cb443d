"""The most frequent words in two passes, with counters whose number does not grow with the words.

First pass: each task keeps at most `capacity` counters. When there are more words, the count of the
largest word that is left out is taken from every counter (and added to the task's error), so a word
misses at most the error, and what a task sends is bounded. Second pass: only words that can be
among the wanted ones are counted exactly. If the bound of the errors cannot rule out all others,
the pass is repeated with more counters, so the result is always exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textsignal import fixed_values as fixed
from textsignal.operators.rounds import written
from textsignal.operators.sized import broadcast_if_small

CAPACITY = 20_000
GROWTH = 8


def _shrunk(counts: pd.Series, capacity: int) -> tuple[pd.Series, int]:
    """At most `capacity` counters, and what was taken from each."""
    if len(counts) <= capacity:
        return counts, 0
    lost = int(np.partition(counts.to_numpy(), len(counts) - capacity - 1)[len(counts) - capacity - 1])
    left = counts - lost
    return left[left > 0], lost


def task_counters(df: DataFrame, tokens: str, capacity: int) -> DataFrame:
    """`[word, n, lost]`: counters of each task, and one row without a word for its error."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, error = pd.Series(dtype="int64"), 0
        for batch in batches:
            seen = pc.value_counts(pc.list_flatten(batch.column(0)).drop_null())
            new = pd.Series(
                seen.field("counts").to_numpy(), index=seen.field("values").to_pylist(), dtype="int64"
            )
            held, lost = _shrunk(held.add(new, fill_value=0).astype("int64"), capacity)
            error += lost
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([*held.index, None], pa.string()),
                pa.array([*held.tolist(), 0], pa.int64()),
                pa.array([0] * len(held) + [error], pa.int64()),
            ],
            names=["word", "n", "lost"],
        )

    return df.select(tokens).mapInArrow(count, "word string, n long, lost long")


def heavy_words(
    df: DataFrame,
    tokens: str,
    k: int = fixed.VOCABULARY_SIZE,
    min_df: int = fixed.VOCABULARY_MIN_DOCUMENTS,
    capacity: int = CAPACITY,
) -> DataFrame:
    """`[word, n, documents, rank]`, the same rows as `top_vocab`, for vocabularies of any size.

    The frame is read twice, or more often where `capacity` counters a task are too few to decide.
    """
    while True:
        counters = written(task_counters(df, tokens, capacity))
        lost = counters.agg(F.coalesce(F.sum("lost"), F.lit(0)).alias("lost")).first()["lost"]
        at_least = counters.where(F.col("word").isNotNull()).groupBy("word").agg(F.sum("n").alias("_n"))
        kth = at_least.orderBy(F.desc("_n")).limit(k).agg(F.min("_n"), F.count("*")).first()
        # k words occur at least so often; one that can't reach that is only wanted if some of these
        # are in too few documents, and then all counted words are candidates.
        floor = max(1, kth[0] - lost) if kth[1] == k else 1
        for least in sorted({floor, 1}, reverse=True):
            words = written(at_least.where(F.col("_n") >= least).select("word"))
            counted = _exact(df, tokens, broadcast_if_small(words, "word"))
            top = written(
                counted.where(F.col("documents") >= min_df).orderBy(F.desc("n"), "word").limit(k)
            )
            last = top.agg(F.min("n"), F.count("*")).first()
            most_of_others = least - 1 + lost
            if not most_of_others or last[1] == k and last[0] > most_of_others:
                ranked = F.row_number().over(Window.orderBy(F.desc("n"), "word"))
                return top.withColumn("rank", ranked)
        capacity *= GROWTH


def _exact(df: DataFrame, tokens: str, candidates: DataFrame) -> DataFrame:
    entries = df.select(
        F.size(tokens).alias("_size"),
        F.posexplode_outer(F.concat(F.col(tokens), F.array_distinct(tokens))).alias("_place", "word"),
    ).join(candidates, "word", "left_semi")
    occurrence = F.col("_place") < F.col("_size")
    return entries.groupBy("word").agg(
        F.count_if(occurrence).alias("n"), F.count_if(~occurrence).alias("documents")
    )
