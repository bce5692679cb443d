"""Summaries that are kept: small states by group and day, folded without reading old rows.

A state is what its rows add to a summary, so states of different days add up to the state of all
rows. New days are summarised alone and written beside the old ones; a day that is written again
replaces its own state only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def value_states(
    df: DataFrame, keys: Sequence[str], value: str, distinct: str | None = None
) -> DataFrame:
    """`[keys, n, mean, spread, least, most]` and a distinct-value sketch, `named`, if asked.

    `spread` is the sum of squared differences from the mean. Null values don't count; a group with
    no others has n 0 and nulls.
    """
    number = F.col(value).cast("double")
    parts = [
        F.count(number).alias("n"),
        F.avg(number).alias("mean"),
        (F.var_pop(number) * F.count(number)).alias("spread"),
        F.min(number).alias("least"),
        F.max(number).alias("most"),
    ]
    if distinct is not None:
        parts.append(F.hll_sketch_agg(F.col(distinct).cast("string")).alias("named"))
    return df.groupBy(*keys).agg(*parts)


def folded_values(states: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """`[keys, n, mean, stddev, least, most]` and `n_distinct` (approximate) of folded states."""
    n, mean = F.col("n"), F.col("mean")
    # States of a group are as many as its days; the mean of all is needed for each.
    group = Window.partitionBy(*keys)
    whole = F.sum(n * mean).over(group) / F.nullif(F.sum(n).over(group), F.lit(0))
    states = states.withColumn("_off", n * (mean - whole) * (mean - whole))
    total = F.sum(n * mean)
    spread = F.sum("spread") + F.sum("_off")
    parts = [
        F.coalesce(F.sum(n), F.lit(0)).alias("n"),
        (total / F.nullif(F.sum(n), F.lit(0))).alias("mean"),
        F.when(F.sum(n) > 1, F.sqrt(spread / (F.sum(n) - 1))).alias("stddev"),
        F.min("least").alias("least"),
        F.max("most").alias("most"),
    ]
    if "named" in states.columns:
        parts.append(F.hll_sketch_estimate(F.hll_union_agg("named")).alias("n_distinct"))
    return states.groupBy(*keys).agg(*parts)


def keep_states(states: DataFrame, path: str, day: str) -> None:
    """Writes states, a folder a day; the days among them replace what is there, others stay."""
    writer = states.repartition(day).write.mode("overwrite").partitionBy(day)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def kept_states(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


# --- areas under curves from counts of scores -------------------------------------------


def _cell(score: Column, cells: int) -> Column:
    at = F.floor(score * cells).cast("long")
    return F.when(F.isnan(score), cells - 1).otherwise(
        F.greatest(F.lit(0), F.least(F.lit(cells - 1), at))
    ).cast("int")


def score_states(
    df: DataFrame, label: str, score: str, keys: Sequence[str] = (), cells: int = 1024
) -> DataFrame:
    """`[keys, cell, pos, neg]`: rows of each class in each of `cells` equal cells from 0 to 1.

    Scores beyond the ends count in the outer cells. Rows without label or score don't count.
    """
    positive, at = F.col(label) > 0, F.col(score).cast("double")
    known = df.where(positive.isNotNull() & at.isNotNull())
    return known.groupBy(*keys, _cell(at, cells).alias("cell")).agg(
        F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg")
    )


def area_bounds(states: DataFrame) -> DataFrame:
    """`[auc_low, auc_high]`: between them lies the area under the ROC curve of all rows.

    Two rows of different cells are in a known order; pairs within a cell count in full or not at
    all, so the bounds are at most as far apart as the share of such pairs. Null without both classes.
    """
    merged = states.groupBy("cell").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    # Over at most as many rows as there are cells.
    below = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    ranked = merged.withColumn("below", F.coalesce(F.sum("neg").over(below), F.lit(0)))
    pos, neg, before = (F.col(c).cast("double") for c in ("pos", "neg", "below"))
    pairs = F.nullif(F.sum(pos) * F.sum(neg), F.lit(0.0))
    return ranked.agg(
        (F.sum(pos * before) / pairs).alias("auc_low"),
        (F.sum(pos * (before + neg)) / pairs).alias("auc_high"),
    )
