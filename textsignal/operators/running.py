"""Exact running totals and row numbers over a whole table, without a one-task window.

A window ordered over a whole table, or over one hot group, sorts all its rows in one task.
Here the rows are first cut into contiguous key ranges. Each range is summed by its own task,
the totals of the ranges are added up (one row per range and group), and every row gets the
total of the ranges before its own.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLE_PER_RANGE = 100


def _split_points(keys: DataFrame, key: Column, ranges: int) -> DataFrame:
    """One row with the sorted keys that separate the ranges.

    The keys come from a sample of about `SAMPLE_PER_RANGE` distinct keys per range. A key is
    in the sample if its hash is low, and the share is set by a count that does not depend on
    the order of rows, so every run of the plan picks the same points. Neither step shuffles
    more than one small row per task.
    """
    wanted = float(SAMPLE_PER_RANGE * ranges)
    distinct = keys.agg(
        F.greatest(F.approx_count_distinct(F.xxhash64(key)), F.lit(1)).alias("n")
    )
    uniform = (F.xxhash64(key).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    sample = keys.where(uniform < F.lit(wanted) / distinct.scalar()).agg(
        F.sort_array(F.collect_set(key)).alias("keys")
    )
    size = F.size("keys")
    picks = F.sequence(F.lit(1), F.lit(max(ranges - 1, 1)))
    points = F.transform(
        picks, lambda i: F.get("keys", F.floor(i * size / F.lit(ranges)).cast("int"))
    )
    return sample.select(F.filter(points, lambda point: point.isNotNull()).alias("points"))


def _block(ranges: int) -> int:
    return max(1, math.isqrt(ranges))


def _range_of(points: Column, lasts: Column, key: Column, ranges: int) -> Column:
    """How many of the sorted points are below the key, by two short scans.

    The points are taken in blocks of about the root of their number: first the last point of each
    block is compared, then the points of the one block that is left.
    """
    block = _block(ranges)
    full = F.size(F.filter(lasts, lambda point: point < key))
    rest = F.slice(points, full * block + 1, F.lit(block))
    return full * block + F.size(F.filter(rest, lambda point: point < key))


def running_total(
    df: DataFrame,
    order: Sequence[str],
    totals: dict[str, str],
    partition: Sequence[str] = (),
    ranges: int | None = None,
    keys: DataFrame | None = None,
    unique: bool = False,
) -> DataFrame:
    """Adds one running total per entry of `totals` (new column -> column of counts).

    Rows are ordered by the `order` columns inside each group of the `partition` columns; the
    total includes the row itself. The counts must not be negative. Pass a narrow frame: with
    only these columns, the totals of the ranges are read from the same shuffle as the rows.

    `ranges` defaults to the number of shuffle partitions, so it grows with the cluster.
    `keys` may name a cheaper frame with the same keys, repeated or not, to
    sample from. Rows that share a key follow one another in any order; with `unique` they
    make the query fail instead.
    """
    if ranges is None:
        ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = (df if keys is None else keys).select(*partition, *order)
    sorted_by = [*partition, *order]
    key = F.struct(*sorted_by) if len(sorted_by) > 1 else F.col(sorted_by[0])
    block = _block(ranges)
    lasts = F.filter("points", lambda _, i: i % block == block - 1)
    points = _split_points(keys, key, ranges).select(F.struct("points", lasts.alias("lasts")))
    group = F.struct(*partition) if partition else F.lit(0)
    others = [c for c in df.columns if c not in partition]
    placed = df.select(
        *others, group.alias("_group"), key.alias("_key"), points.scalar().alias("_points")
    ).select(
        *others,
        "_group",
        # Never null, and known to be, so that both readers below keep one and the same shuffle.
        F.coalesce(
            _range_of(F.col("_points.points"), F.col("_points.lasts"), F.col("_key"), ranges),
            F.lit(0),
        ).alias("_range"),
    )
    in_order = Window.partitionBy("_group", "_range").orderBy(*order)
    inside = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = {out: F.sum(column).over(inside) for out, column in totals.items()}
    if unique:
        this = F.struct(*order)
        repeated = F.raise_error(F.concat(F.lit("more than one row with the key "), this.cast("string")))
        again = F.lag(this).over(in_order).eqNullSafe(this)
        sums = {out: F.when(again, repeated).otherwise(total) for out, total in sums.items()}
    summed = placed.select("*", *[total.alias(f"_in_{out}") for out, total in sums.items()])
    # At most one row per group, and one more per split point.
    per_range = summed.groupBy("_group", "_range").agg(
        *[F.max(f"_in_{out}").alias(f"_all_{out}") for out in totals]
    )
    before = (
        Window.partitionBy("_group")
        .orderBy("_range")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = per_range.select(
        "_group",
        "_range",
        *[
            F.coalesce(F.sum(f"_all_{out}").over(before), F.lit(0)).alias(f"_before_{out}")
            for out in totals
        ],
    )
    return summed.join(offsets, ["_group", "_range"]).select(
        *[F.col(f"_group.{c}").alias(c) if c in partition else c for c in df.columns],
        *[(F.col(f"_in_{out}") + F.col(f"_before_{out}")).alias(out) for out in totals],
    )


def row_numbers(
    df: DataFrame,
    order: Sequence[str],
    partition: Sequence[str] = (),
    out: str = "row_num",
    ranges: int | None = None,
) -> DataFrame:
    """Adds consecutive numbers from 1 by the `order` columns, inside each `partition`."""
    counted = df.withColumn("_one", F.lit(1).cast("long"))
    return running_total(counted, order, {out: "_one"}, partition, ranges).drop("_one")
