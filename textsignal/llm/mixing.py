"""Mixing of sources to target weights, by the number of words.

1. Every document gets a hash-random key, and per source the sizes of its documents are added up.
2. The sources share all words by weight. A target stops at `limit` times its source's size, and
   what is above it is shared by weight among the others, until none is above.
3. Per source, documents stand in the order of their keys. Ranges of equal hash width cut that
   order; each range is summed in its own task, and the totals of the ranges before a range are
   added to its running sums. The document in which the running sum reaches the budget is the cut.
4. A source repeats whole epochs while its budget lasts; the last epoch ends at the cut, inside a
   document. So a document is taken `epochs` times, once more if it stands before the cut, and in
   part if it is the cut.

Only one row a source (the cut) is joined back to the documents, whose texts are never shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textsignal.llm.common import first_words, measured_broadcast, n_words
from textsignal.llm.store import stored

WEIGHTS = (5, 2, 1)
LIMIT = 3
SEED = "mix"
ROWS_PER_RANGE = 2_000
RESULTS = ("size", "source_size", "target", "taken", "copies", "part")


def _source(column: Column) -> list[Column]:
    """Sources as two columns that are never null, in code point order with null last."""
    return [
        column.isNull().alias("_no_source"),
        F.coalesce(column.cast("string"), F.lit("")).alias("_source"),
    ]


SOURCE = ["_no_source", "_source"]


def _order_key(key: Column, seed: str) -> Column:
    name = F.coalesce(key.cast("string"), F.lit(""))
    return F.concat(F.md5(F.concat(F.lit(f"{seed}|"), name)), F.lit("|"), name)


def targets(
    sources: DataFrame, weights: Sequence[int] = WEIGHTS, limit: int = LIMIT
) -> DataFrame:
    """Adds `target` (double) to one row a source, with `source_size`.

    Sources that reach their limit are those with the least limit a unit of weight. In that order,
    what the sources before have taken is known, and the first source that its share does not fill
    gives the share of all that follow. The table has one row a source.
    """
    cycle = F.array(*[F.lit(w).cast("long") for w in weights])
    turn = (F.row_number().over(Window.orderBy(*SOURCE)) - 1) % F.lit(len(weights))
    weighed = sources.select(
        "*",
        F.get(cycle, turn.cast("int")).alias("_weight"),
        (F.col("source_size") * limit).alias("_limit"),
    )
    by_need = Window.orderBy(F.col("_limit") / F.col("_weight"), *SOURCE)
    before = by_need.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_need.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everywhere = Window.partitionBy()
    unit = (
        F.sum("source_size").over(everywhere)
        - F.coalesce(F.sum("_limit").over(before), F.lit(0))
    ).cast("double") / F.sum("_weight").over(rest).cast("double")
    shared = weighed.select("*", unit.alias("_unit"))
    open_unit = F.min(
        F.when(F.col("_limit") > F.col("_weight") * F.col("_unit"), F.struct("_place", "_unit"))
    ).over(everywhere)
    placed = shared.select("*", F.row_number().over(by_need).alias("_place"))
    share = F.col("_weight") * F.col("_open._unit")
    return placed.select("*", open_unit.alias("_open")).select(
        *sources.columns,
        F.when(F.col("_limit") <= share, F.col("_limit").cast("double"))
        .otherwise(F.coalesce(share, F.lit(0.0)))
        .alias("target"),
    )


def source_cuts(
    sized: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    limit: int = LIMIT,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """One row a source: its size, target, whole epochs, and the cut of the last one.

    `sized` has the two columns of the source, `_key` and `size`. Rows that share a key share the
    words up to the cut evenly (`_peers` is their number).
    """
    totals = stored(
        sized.groupBy(*SOURCE).agg(
            F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_rows")
        )
    )
    budget = F.floor("target").cast("long")
    empty = F.col("source_size") == 0
    plans = stored(
        targets(totals, weights, limit).select(
            "*",
            F.when(empty, 0).otherwise(F.expr("floor(target) div source_size")).alias("_epochs"),
            F.when(empty, 0).otherwise(budget % F.col("source_size")).alias("_left"),
            F.ceil(F.col("_rows") / rows_per_range).alias("_ranges"),
        )
    )
    known = measured_broadcast(plans, 64, "_source")
    share = F.conv(F.substring("_key", 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    placed = sized.join(known.select(*SOURCE, "_ranges", "_left"), SOURCE).select(
        *SOURCE, "_key", "size", "_left", F.floor(share * F.col("_ranges")).alias("_range")
    )
    units = placed.groupBy(*SOURCE, "_range", "_key").agg(
        F.sum("size").alias("_size"),
        F.count(F.lit(1)).alias("_peers"),
        F.first("_left").alias("_left"),
    )
    inside = (
        Window.partitionBy(*SOURCE, "_range")
        .orderBy("_key")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranges = placed.groupBy(*SOURCE, "_range").agg(F.sum("size").alias("_all"))
    before = (
        Window.partitionBy(*SOURCE).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = ranges.select(
        *SOURCE, "_range", F.coalesce(F.sum("_all").over(before), F.lit(0)).alias("_offset")
    )
    run = units.select("*", F.sum("_size").over(inside).alias("_run"))
    end = F.col("_offset") + F.col("_run")
    cuts = (
        run.join(offsets, [*SOURCE, "_range"])
        .where((end >= F.col("_left")) & (end - F.col("_size") < F.col("_left")))
        .select(
            *SOURCE,
            F.col("_key").alias("_cut"),
            (F.col("_left") - end + F.col("_size")).alias("_part"),
            "_peers",
        )
    )
    return stored(plans.join(cuts, SOURCE, "left"))


def _taken(rows: DataFrame, cuts: DataFrame, columns: list[Column]) -> DataFrame:
    found = measured_broadcast(cuts, 128, "_source").select(
        *[F.col(c).alias(f"_of{c}") for c in SOURCE],
        F.col("source_size").alias("_s_size"),
        F.col("target").alias("_s_target"),
        "_epochs",
        "_cut",
        "_part",
        "_peers",
    )
    on = (F.col("_no_source") == F.col("_of_no_source")) & (F.col("_source") == F.col("_of_source"))
    size = F.col("_size")
    before = F.coalesce(F.col("_key") < F.col("_cut"), F.lit(False))
    at = F.coalesce(F.col("_key") == F.col("_cut"), F.lit(False))
    copies = F.when(size == 0, 0).otherwise(F.col("_epochs") + before.cast("long"))
    part = F.when(
        at, F.least(size, F.floor(F.col("_part") / F.col("_peers")).cast("long"))
    ).otherwise(0)
    return rows.join(found, on).select(
        *columns,
        size.alias("size"),
        F.col("_s_size").alias("source_size"),
        F.col("_s_target").alias("target"),
        (copies * size + part).cast("long").alias("taken"),
        copies.cast("long").alias("copies"),
        part.cast("long").alias("part"),
    )


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    limit: int = LIMIT,
    seed: str = SEED,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """How much of each document a mix takes: one row for every row of `docs`.

    Columns: the key, `size` (words; 0 for null or empty text), `source_size` and `target` of its
    source, `taken` = `copies` x `size` + `part`, where `part` words are taken of the document in
    which the budget ends. A null source is a source of its own. A source without words takes
    nothing. Repeated keys are allowed: their rows stand at one place and are cut alike. Reruns
    agree, whatever the partitioning. An empty table gives an empty table.
    """
    sized = stored(
        docs.select(
            docs[key].alias(key),
            *_source(docs[source]),
            _order_key(docs[key], seed).alias("_key"),
            n_words(docs[text]).alias("size"),
        )
    )
    cuts = source_cuts(sized.drop(key), weights, limit, rows_per_range)
    return _taken(sized.withColumnRenamed("size", "_size"), cuts, [F.col(key)])


def mixed(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    limit: int = LIMIT,
    seed: str = SEED,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """The mix itself, with the columns of `docs`: a row for each time a document is taken.

    The document in which a budget ends comes once more with its first words only. A document
    without words adds nothing to a mix and is not in it.
    """
    named = docs.select(*[docs[c].alias(f"_d{i}") for i, c in enumerate(docs.columns)])
    at = {c: F.col(f"_d{i}") for i, c in enumerate(docs.columns)}
    rows = named.select(
        "*",
        *_source(at[source]),
        _order_key(at[key], seed).alias("_key"),
        n_words(at[text]).alias("_size"),
    )
    sized = stored(rows.select(*SOURCE, "_key", F.col("_size").alias("size")))
    cuts = source_cuts(sized, weights, limit, rows_per_range)
    taken = _taken(rows, cuts, [F.col(f"_d{i}") for i in range(len(docs.columns))])
    whole = F.array_repeat(F.lit(False), F.col("copies").cast("int"))
    cut = F.when(F.col("part") > 0, F.array(F.lit(True))).otherwise(
        F.array().cast("array<boolean>")
    )
    each = taken.select("*", F.explode(F.concat(whole, cut)).alias("_cut_here"))
    shown = F.when(F.col("_cut_here"), first_words(at[text], F.col("part"))).otherwise(at[text])
    return each.select(*[(shown if c == text else at[c]).alias(c) for c in docs.columns])
