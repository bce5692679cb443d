"""Repeatable random splits and orders, decided by a hash of the key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASH_DIGITS = 8


def key_hash(key: Sequence[str], seed: int | str) -> Column:
    """Hex digest of seed and key; the same on every engine that has md5."""
    parts = [F.col(k).cast("string") for k in key]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))


def bounds(weights: Sequence[float]) -> list[str]:
    """Upper bounds, as hex digits, of all parts but the last."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    total, reached, found = sum(weights), 0.0, []
    for weight in weights[:-1]:
        reached += weight
        found.append(f"{int(reached / total * 16**HASH_DIGITS):0{HASH_DIGITS}x}")
    return found


def split_number(key: Sequence[str], weights: Sequence[float], seed: int | str = 42) -> Column:
    """Number, from 0, of the part that the key falls into."""
    digits = F.substring(key_hash(key, seed), 1, HASH_DIGITS)
    number = F.lit(0)
    for bound in bounds(weights):
        number = number + (digits >= bound).cast("int")
    return number


def hash_split(
    df: DataFrame, key: Sequence[str], weights: Sequence[float], seed: int = 42
) -> list[DataFrame]:
    """Splits rows by key: disjoint, complete, and the same for any partitioning of the rows.

    Rows with the same key stay together, so give the key of a segment and not of a label to
    keep several labels of one segment on one side.
    """
    number = split_number(key, weights, seed)
    return [df.where(number == i) for i in range(len(weights))]


def shuffle(df: DataFrame, key: Sequence[str], seed: int = 42) -> DataFrame:
    """Rows in a random order that is fixed by key and seed (a distributed range sort)."""
    return df.orderBy(key_hash(key, seed), *key)


def spread(df: DataFrame, key: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Rows spread over tasks by their key; without a number, Spark picks one by size."""
    return df.repartition(*([partitions] if partitions else []), *key)


def spread_if_few(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows spread over all cores if they come in fewer pieces than there are cores.

    For work that is heavy per row on an input of one or a few files. A large input already
    comes in more pieces and is left as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return spread(df, key, cores) if df.rdd.getNumPartitions() < cores else df
