"""Labels on a scale from 0 to 1, and two classes made from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textsignal import fixed_values as fixed


def attach_labels(
    features: DataFrame,
    labels: DataFrame,
    key: Sequence[str],
    label: str = "label",
    mode: str = "all",
) -> DataFrame:
    """Joins labels to features on the whole key, whose types are aligned first.

    `mode='all'` gives one row per feature row and label. `mode='mean'` averages the labels of
    a key before the join and adds `<label>_count` and `<label>_stddev`. A label that is not a
    number becomes null.
    """
    types = {field.name: field.dataType for field in features.schema.fields}
    typed = labels.select(
        *[F.col(k).try_cast(types[k]).alias(k) for k in key],
        F.col(label).try_cast("double").alias(label),
    )
    if mode == "mean":
        typed = mean_labels(typed, key, label)
    elif mode != "all":
        raise ValueError(f"mode must be 'all' or 'mean', not {mode!r}")
    return features.join(typed, list(key))


def mean_labels(labels: DataFrame, key: Sequence[str], label: str = "label") -> DataFrame:
    """One row per key: mean, number and standard deviation of its labels."""
    return labels.groupBy(*key).agg(
        F.avg(label).alias(label),
        F.count(label).alias(f"{label}_count"),
        F.stddev_samp(label).alias(f"{label}_stddev"),
    )


def binarize(
    df: DataFrame,
    label: str = "label",
    threshold: float = fixed.NEUTRAL_LABEL,
    neutral: str = "drop",
    out: str = "binary_label",
) -> DataFrame:
    """Adds 1 for labels above the threshold and 0 for labels below it.

    A label equal to the threshold is neutral: `'drop'` removes its row (and rows without a
    label), `'one'` and `'zero'` put it into that class. Without a label the class is 0.
    """
    value = F.col(label).try_cast("double")
    if neutral == "drop":
        return df.where(value != threshold).withColumn(out, (value > threshold).cast("int"))
    if neutral == "one":
        above = value >= threshold
    elif neutral == "zero":
        above = value > threshold
    else:
        raise ValueError(f"neutral must be 'drop', 'one' or 'zero', not {neutral!r}")
    return df.withColumn(out, F.when(above, 1).otherwise(0))


def random_label(
    df: DataFrame, key: Sequence[str], seed: int = 0, out: str = "label"
) -> DataFrame:
    """Adds a stand-in label, 0 or 1 with equal chance, fixed by the key and the seed."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]))
    return df.withColumn(out, (F.substring(digest, 1, 1) < "8").cast("int"))
