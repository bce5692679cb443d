"""From texts to arrays of tokens."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textsignal.functions.text import clean_text, join_lines, unwrap, words


LINES_PER_BLOCK = 1000


def tokenize(
    df: DataFrame,
    text: str,
    out: str = "tokens",
    stop_words: Iterable[str] = (),
    lowered: bool = False,
) -> DataFrame:
    """Adds the words of a text column as an array, in order."""
    return df.withColumn(out, words(F.col(text), stop_words, lowered))


def clean_documents(df: DataFrame, text: str, out: str = "cleaned") -> DataFrame:
    """Adds the cleaned text of a whole file."""
    return df.withColumn(out, clean_text(unwrap(F.col(text))))


def gather_lines(
    df: DataFrame, key: Sequence[str], position: str, line: str, out: str = "text"
) -> DataFrame:
    """One text per key from one row per line, in the order of the line positions.

    Lines are joined in blocks first, so that a key with very many lines is put together from
    few pieces.
    """
    blocks = _joined(df.withColumn("_block", F.floor(F.col(position) / LINES_PER_BLOCK)),
                     [*key, "_block"], position, line, "_lines")
    return _joined(blocks, key, "_block", "_lines", out)


def _joined(df: DataFrame, key: Sequence[str], position: str, text: str, out: str) -> DataFrame:
    ordered = F.array_sort(F.collect_list(F.struct(F.col(position).alias("at"), F.col(text).alias("text"))))
    gathered = df.groupBy(*key).agg(ordered.alias("_pieces"))
    texts = F.transform("_pieces", lambda piece: piece["text"])
    return gathered.select(*key, join_lines(texts).alias(out))
