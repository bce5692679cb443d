"""Mentions of thousands of subjects: each distinct token of a batch is searched once, by one automaton.

The time per token does not depend on the number of subjects. Texts are searched where they lie: only
counts by text and subject are shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Rows whose tokens are searched together.
ROWS_AT_ONCE = 500


def _automaton(subjects: Iterable[str]) -> ahocorasick.Automaton:
    machine = ahocorasick.Automaton()
    for subject in subjects:
        machine.add_word(subject, subject)
    machine.make_automaton()
    return machine


def token_subjects(tokens: DataFrame, token: str, subjects: Sequence[str]) -> DataFrame:
    """`[token, subject]` for each distinct token that contains a subject as a substring.

    A token that contains a subject several times gives one row; null tokens give none.
    """
    names = sorted(set(subjects))
    if not all(names):
        raise ValueError("a subject must have a letter")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _automaton(names)
        for batch in batches:
            held, found = [], []
            for text in batch.column(0).to_pylist():
                for name in {name for _, name in machine.iter(text)}:
                    held.append(text)
                    found.append(name)
            yield pa.RecordBatch.from_arrays(
                [pa.array(held, pa.string()), pa.array(found, pa.string())], names=["token", "subject"]
            )

    distinct = tokens.select(F.col(token).alias("token")).where(F.col("token").isNotNull()).distinct()
    if not names:
        return distinct.select("token", F.col("token").alias("subject")).limit(0)
    return distinct.mapInArrow(search, "token string, subject string")


def _hits(texts: pa.Array, found: Callable[[str], Iterable[int]], names: int) -> tuple[np.ndarray, ...]:
    """Rows, subjects, counts and first places of the mentions in lists of tokens."""
    values = texts.flatten().dictionary_encode()
    codes = values.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    row = pc.list_parent_indices(texts).to_numpy().astype(np.int64)
    place = np.arange(len(row)) - np.searchsorted(row, row)
    each = [() if token is None else sorted(set(found(token))) for token in values.dictionary.to_pylist()]
    sizes = np.array([len(e) for e in each] + [0], np.int64)  # the last for null tokens, whose code is -1
    starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    subjects = np.array([s for e in each for s in e], np.int64)
    times = sizes[codes]
    at = np.repeat(np.arange(len(codes)), times)
    inside = np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
    pair = row[at] * names + subjects[np.repeat(starts[codes], times) + inside]
    # Tokens come in order, so the first of a pair is its first place.
    pairs, first, n = np.unique(pair, return_index=True, return_counts=True)
    return pairs // names, pairs % names, n, place[at[first]] + 1


def subject_mentions(
    df: DataFrame,
    key: Sequence[str],
    tokens: str,
    subjects: Sequence[str],
    match: str = "substring",
) -> DataFrame:
    """`[key, subject, n, first_position]`: tokens of a row that mention a subject, and the first.

    One row for each pair of a row of `df` and a subject that it mentions; positions count from 1.
    `match` is `substring` or `exact`, as in `mention_contexts`. Repeated keys count together. A task
    searches each distinct token of a batch once and sends what it has found, never tokens.
    """
    names = sorted(set(subjects))
    if match not in ("substring", "exact"):
        raise ValueError(f"match must be 'substring' or 'exact', not {match!r}")
    if match == "substring" and not all(names):
        raise ValueError("a subject must have a letter")
    keys = df.select(*key).schema
    made = StructType([*keys, *StructType.fromDDL("subject string, n long, first_position int")])
    rows = df.select(*key, tokens)
    if not names:
        return df.sparkSession.createDataFrame([], made)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {name: i for i, name in enumerate(names)}
        machine = _automaton(names) if match == "substring" else None

        def found(token: str) -> Iterable[int]:
            if machine is None:
                return (number[token],) if token in number else ()
            return (number[name] for _, name in machine.iter(token))

        labels = pa.array(names, pa.string())
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                row, subject, n, first = _hits(part.column(len(keys)), found, len(names))
                columns = [part.column(i).take(pa.array(row)) for i in range(len(keys))]
                columns += [labels.take(pa.array(subject)), pa.array(n, pa.int64()), pa.array(first, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, names=made.names)

    found = rows.mapInArrow(search, made)
    return found.groupBy(*key, "subject").agg(
        F.sum("n").alias("n"), F.min("first_position").alias("first_position")
    )
