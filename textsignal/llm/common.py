"""Column expressions and joins that several operators use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space and words as the queries of this folder define them (fixed values).
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"

#: A frame is broadcast only if it was measured and is not larger than this.
BROADCAST_BYTES = 24 * 1024 * 1024


def n_words(text: Column) -> Column:
    """Number of words; 0 for null. Each word with the space before it becomes one letter."""
    marks = F.regexp_replace(text, f"{SPACE}*+{WORD}++", "x")
    return F.coalesce(
        F.length(F.regexp_replace(marks, f"{SPACE}++", "")).cast("long"), F.lit(0).cast("long")
    )


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word, with the white space before each word."""
    words = F.regexp_extract_all(text, F.lit(f"{SPACE}*{WORD}+"), F.lit(0))
    return F.array_join(F.slice(words, F.lit(1), n.cast("int")), "")


def same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    """Condition of an equi-join in which nulls equal nulls."""
    found = F.lit(True)
    for name in names:
        found = found & left[name].eqNullSafe(right[name])
    return found


def measured_broadcast(
    df: DataFrame, row_bytes: int, binary: str | None = None, most: int = BROADCAST_BYTES
) -> DataFrame:
    """Marks a stored frame for broadcast if its measured size is at most `most` bytes.

    The size is rows x `row_bytes` plus the bytes of the column `binary`. A larger frame is left
    as it is, and Spark joins it by a shuffle.
    """
    n = F.count(F.lit(1)) * row_bytes
    if binary is not None:
        n = n + F.coalesce(F.sum(F.octet_length(binary)), F.lit(0))
    return F.broadcast(df) if df.agg(n.alias("n")).first()["n"] <= most else df
