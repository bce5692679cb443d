"""Counts, shares, summaries and histograms of a column."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textsignal import fixed_values as fixed


def shape(df: DataFrame) -> DataFrame:
    """Number of rows and columns."""
    return df.agg(F.count("*").alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def distinct_count(df: DataFrame, column: str) -> DataFrame:
    """Number of distinct values and of rows: `[n_distinct, n]`.

    Rows are counted per value before the values are, so a hot value is one row of the shuffle.
    """
    per_value = df.groupBy(column).agg(F.count("*").alias("_n"))
    return per_value.agg(
        F.count(column).alias("n_distinct"), F.coalesce(F.sum("_n"), F.lit(0)).alias("n")
    )


def distribution(df: DataFrame, column: str, scale: float = 100) -> DataFrame:
    """Rows per value with their share of all rows: `[column, n, share]`, `scale` is the whole."""
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.withColumn("share", F.col("n") / total.scalar() * F.lit(float(scale)))


def summary(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, standard deviation, minimum and maximum, as numbers."""
    value = F.col(column)
    return df.agg(
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("stddev"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )


def histogram(df: DataFrame, column: str, n: int = fixed.HISTOGRAM_BINS) -> DataFrame:
    """`n` equal bins from minimum to maximum: `[bin, low, high, n]`, also the empty ones.

    The last bin includes the maximum. If all values are equal, the bins cover one unit around
    the value.
    """
    value = F.col(column).cast("double")
    ends = df.agg(
        F.struct(F.min(value).alias("low"), F.max(value).alias("high")).alias("ends")
    )
    flat = F.col("ends.low") == F.col("ends.high")
    low = F.when(flat, F.col("ends.low") - 0.5).otherwise(F.col("ends.low"))
    high = F.when(flat, F.col("ends.high") + 0.5).otherwise(F.col("ends.high"))
    edges = ends.select(F.struct(low.alias("low"), high.alias("high")).alias("edges"))

    def width() -> Column:
        return (F.col("edges.high") - F.col("edges.low")) / F.lit(float(n))

    counts = (
        df.select(value.alias("_value"), edges.scalar().alias("edges"))
        .where(F.col("_value").isNotNull())
        .groupBy(
            F.least(
                F.floor((F.col("_value") - F.col("edges.low")) / width()), F.lit(n - 1)
            ).alias("bin")
        )
        .agg(F.count("*").alias("n"))
    )
    bins = df.sparkSession.range(n).select(
        F.col("id").alias("bin"), edges.scalar().alias("edges")
    )
    return bins.join(counts, "bin", "left").select(
        "bin",
        (F.col("edges.low") + F.col("bin") * width()).alias("low"),
        (F.col("edges.low") + (F.col("bin") + 1) * width()).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def win_score(df: DataFrame, prediction: str, subjects: tuple[str, str]) -> DataFrame:
    """Mean prediction for the first subject, and its complement for the second."""
    mean = F.avg(prediction)
    first, second = subjects
    return df.agg(mean.alias(f"score_{first}"), (1 - mean).alias(f"score_{second}"))


def complement_scores(
    df: DataFrame, prediction: str, subjects: tuple[str, str]
) -> DataFrame:
    """Adds the prediction as the score of the first subject and the rest to 1 for the second."""
    first, second = subjects
    return df.withColumns(
        {f"p_{first}": F.col(prediction), f"p_{second}": 1 - F.col(prediction)}
    )


def mean_probabilities(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Mean of each probability column: `{new name: column}`."""
    return df.agg(*[F.avg(column).alias(out) for out, column in columns.items()])


def class_shares(
    df: DataFrame, prediction: str, subjects: Mapping[float, str]
) -> DataFrame:
    """Rows and share per predicted class, named: `[subject, prediction, n, share]`."""
    counts = distribution(df, prediction, scale=1)
    named = F.lit(None).cast("string")
    for value, subject in subjects.items():
        named = F.when(F.col(prediction) == value, F.lit(subject)).otherwise(named)
    return counts.select(named.alias("subject"), prediction, "n", "share")


def win_report(
    df: DataFrame, prediction: str, probabilities: Mapping[str, tuple[float, str]]
) -> DataFrame:
    """Per subject: share of predicted rows and mean probability.

    `probabilities` maps a subject to its class and probability column. One pass.
    """
    cases = F.array(
        *[
            F.struct(
                F.lit(subject).alias("subject"),
                (F.col(prediction) == value).cast("double").alias("hit"),
                F.col(column).alias("p"),
            )
            for subject, (value, column) in probabilities.items()
        ]
    )
    return (
        df.select(F.explode(cases).alias("case"))
        .groupBy(F.col("case.subject").alias("subject"))
        .agg(F.avg("case.hit").alias("share"), F.avg("case.p").alias("mean_probability"))
    )
