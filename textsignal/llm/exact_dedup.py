"""Exact dedup by naming blocks with integers.

A normalised text is cut into blocks of fixed length. All blocks of all texts are sorted, and the
name of a block is its place among the distinct blocks, so that equal blocks, and no others, have
equal names. Then adjacent names form pairs, pairs are sorted and named in the same way, and so on,
until every text has one name. Texts of unlike numbers of blocks are unlike, and equal numbers of
blocks need equally many rounds; so the round and the name identify a text without collisions.

Sorting is distributed: rows are cut into ranges of (digest, row), so that a block of which there
are very many copies fills several ranges; each range names its own blocks, and one row a range
tells how many names the ranges before it have used and whether its first block goes on from there.
The digest only spreads the rows evenly; names compare the blocks themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textsignal.llm.common import SPACE, measured_broadcast
from textsignal.llm.store import stored

BLOCK = 4096


def _namer(n_keys: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Names the rows of a sorted partition: its first columns are the keys, its last the range.

    Rows come out without keys, with the place of their key in the range. A last row, with nulls
    elsewhere, has the number of keys and the first and the last key.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = part = schema = None
        place = 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            keys = [batch.column(i) for i in range(n_keys)]
            n = batch.num_rows
            # The first row differs from the one before it, or starts the range.
            here = [k[0].as_py() for k in keys]
            starts = pa.array([last != here])
            if n > 1:
                unlike = pc.not_equal(keys[0].slice(1), keys[0].slice(0, n - 1))
                for k in keys[1:]:
                    unlike = pc.or_(unlike, pc.not_equal(k.slice(1), k.slice(0, n - 1)))
                starts = pa.concat_arrays([starts, unlike])
            places = pc.add(pc.cumulative_sum(pc.cast(starts, pa.int64())), place)
            place = places[n - 1].as_py()
            first = here if first is None else first
            last = [k[n - 1].as_py() for k in keys]
            part = batch.column(batch.num_columns - 1)[0].as_py()
            fields = [*batch.schema][n_keys:]
            ends = [
                pa.field(f"_{end}{i}", batch.schema.field(i).type)
                for end in ("first", "last")
                for i in range(n_keys)
            ]
            schema = pa.schema([*fields, pa.field("_place", pa.int64()), *ends])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[n_keys:], places, *[pa.nulls(n, f.type) for f in ends]],
                schema=schema,
            )
        if schema is not None:
            values = [None] * (len(schema) - 2 - 2 * n_keys) + [part, place, *first, *last]
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], f.type) for v, f in zip(values, schema, strict=True)], schema=schema
            )

    return run


def named(rows: DataFrame, keys: list[str], spread: Column, order: list[str]) -> DataFrame:
    """Adds `_name`, the place of the keys among all distinct keys, and drops the keys.

    `spread` is a function of the keys; `order` names columns, never null, that tell rows of one
    key apart. Keys are never null.
    """
    others = [c for c in rows.columns if c not in keys]
    ranged = (
        rows.select(*keys, *others, spread.alias("_spread"))
        .repartitionByRange("_spread", *order)
        .sortWithinPartitions("_spread", *keys, *order)
        .select(*keys, *others, F.spark_partition_id().alias("_part"))
    )
    kinds = dict(rows.dtypes)
    schema = ", ".join(
        [f"{c} {kinds[c]}" for c in others]
        + ["_part int", "_place bigint"]
        + [f"_{end}{i} {kinds[k]}" for end in ("first", "last") for i, k in enumerate(keys)]
    )
    local = stored(ranged.mapInArrow(_namer(len(keys)), schema))
    is_end = F.col("_first0").isNotNull()
    in_order = Window.orderBy("_part")
    goes_on = F.lit(True)
    for i in range(len(keys)):
        goes_on = goes_on & (F.lag(f"_last{i}").over(in_order) == F.col(f"_first{i}"))
    steps = local.where(is_end).select(
        "_part", "_place", F.coalesce(goes_on, F.lit(False)).cast("long").alias("_shared")
    )
    used = F.coalesce(
        F.sum("_place").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    ) - F.sum("_shared").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # One row a range.
    offsets = stored(steps.select("_part", used.alias("_used")))
    return (
        local.where(~is_end)
        .join(measured_broadcast(offsets, 16), "_part")
        .select(*others, (F.col("_place") + F.col("_used")).alias("_name"))
    )


TEXT = ["_id", "_digest", "_points"]


def identities(docs: DataFrame, key: str, text: str, block: int) -> DataFrame:
    """Rows (_id, _digest, _points, _rows, _round, _name): texts with their identity.

    `_round` and `_name` identify the text; `_rows` rows have this key and text.
    """
    plain = F.coalesce(docs[text], F.lit(""))
    norm = F.regexp_replace(plain, f"{SPACE}++", "")
    cut = (
        docs.select(docs[key].alias("_id"), norm.alias("_norm"), F.length(plain).alias("_points"))
        .select(
            "_id",
            F.unhex(F.sha2("_norm", 256)).alias("_digest"),
            "_points",
            "_norm",
            F.greatest(F.ceil(F.length("_norm") / block).cast("int"), F.lit(1)).alias("_names"),
        )
        .select("*", F.explode(F.sequence(F.lit(0), F.col("_names") - 1)).alias("_i"))
    )
    block_text = F.substring("_norm", F.col("_i") * block + 1, F.lit(block))
    # Ids may be null, the columns that order rows may not.
    place_key = F.coalesce(F.hash("_id"), F.lit(0)).alias("_id_hash")
    one = F.lit(1).cast("long").alias("_rows")
    blocks = cut.select(*TEXT, "_names", one, "_i", place_key, block_text.alias("_block"))
    order = ["_id_hash", "_digest", "_points", "_i"]
    level = stored(named(blocks, ["_block"], F.unhex(F.sha2("_block", 256)), order))
    even = F.col("_i") % 2 == 0
    finished: list[DataFrame] = []
    while True:
        done = level.where(F.col("_names") == 1)
        if not finished:
            # Longer texts have been counted at their pairs.
            done = done.groupBy(*TEXT, "_name").agg(F.sum("_rows").alias("_rows"))
        finished.append(
            done.select(*TEXT, "_rows", F.lit(len(finished)).alias("_round"), "_name")
        )
        more = level.where(F.col("_names") > 1)
        if more.isEmpty():
            break
        # Repeated rows meet here and are counted; an odd last name has no partner.
        pairs = more.groupBy(
            *TEXT, "_names", "_id_hash", F.floor(F.col("_i") / 2).cast("int").alias("_j")
        ).agg(
            F.sum(F.when(even, F.col("_rows"))).alias("_rows"),
            F.max(F.when(even, F.col("_name"))).alias("_left"),
            F.coalesce(F.max(F.when(~even, F.col("_name"))), F.lit(0)).alias("_right"),
        )
        pairs = pairs.select(
            *TEXT,
            F.ceil(F.col("_names") / 2).cast("int").alias("_names"),
            "_rows",
            F.col("_j").alias("_i"),
            "_id_hash",
            "_left",
            "_right",
        )
        spread = F.xxhash64("_left", "_right")
        level = stored(named(pairs, ["_left", "_right"], spread, order))
    found = finished[0]
    for more in finished[1:]:
        found = found.union(more)
    return found


def dedup(
    docs: DataFrame, key: str = "doc_id", text: str = "text", block: int = BLOCK
) -> DataFrame:
    """One row for every row of `docs`: which text it equals, and which row of those stays.

    Texts are equal when identical after white space is deleted; null counts as empty, and empty
    texts equal one another. Of equal texts, the row with the most code points in the original
    text stays, then the smallest key (null last), and of repeated rows with that key one. Columns:
    the key, `keep_id`, `group_size` (rows), `kept`, `text_sha256`. An empty table gives an empty
    table.
    """
    texts = identities(docs, key, text, block).select(
        "*", (F.col("_name") * 64 + F.col("_round")).alias("_uid")
    )
    best = F.min(F.struct((-F.col("_points")).alias("p"), F.col("_id").isNull().alias("n"), "_id"))
    groups = (
        texts.groupBy("_round", "_name")
        .agg(best.alias("_best"), F.sum("_rows").alias("_all"))
        .where(F.col("_all") > 1)
        # Grouped by two columns and joined by one of them: both sides of the join are shuffled
        # for it, so that Spark can split the rows of a text with very many copies.
        .select((F.col("_name") * 64 + F.col("_round")).alias("_group"), "_best", "_all")
    )
    rows = texts.join(groups, F.col("_uid") == F.col("_group"), "left")
    keep = F.when(F.col("_all").isNull(), F.col("_id")).otherwise(F.col("_best._id"))
    is_best = F.col("_all").isNull() | (
        F.col("_id").eqNullSafe(F.col("_best._id")) & (F.col("_points") == -F.col("_best.p"))
    )
    return rows.select("*", F.explode(F.sequence(F.lit(1), F.col("_rows"))).alias("_copy")).select(
        F.col("_id").alias(key),
        keep.alias("keep_id"),
        F.coalesce("_all", F.lit(1)).cast("long").alias("group_size"),
        (is_best & (F.col("_copy") == 1)).alias("kept"),
        F.lower(F.hex("_digest")).alias("text_sha256"),
    )
