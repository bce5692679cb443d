"""Near duplicates: a self-join of documents by the Jaccard similarity of their word shingles.

Equal sets are one class. Links between classes are found in these steps.

1. All shingles stand in one global order: sampled ones first (those whose hash is in a fixed part
   of the range, so that it is known in how many classes each of them occurs), rare before
   frequent, then the others by hash. Two linked sets share a shingle among the first
   n - ceil(share x n) + 1 of each. Shingles that a bounded sample of documents shows in many sets
   count as the most frequent, and need no counting.
2. So every set sends its sampled shingles, or its least ones if these are too few, to be counted,
   grouped by ranges of the hash. Shingles of one class only come back to nobody, but take up
   places at the front: a set with more of them than the prefix has places links with nothing.
3. The sets that share a place of their prefix get an edge to the least of them: connected, they
   are the candidates of one another.
4. Candidates that are connected are written as a prefix tree, and a walk over it finds the links
   (`prefix_tree`). Groups that are too large for a task are cut into blocks: each block meets the
   same few sets, which connects what belongs together, and then only the sets outside the main
   part of their group meet all blocks of it. So no pair is left out, and none is written but
   those that connect.

Sets and classes are identified by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textsignal.llm.common import measured_broadcast
from textsignal.llm.components import components
from textsignal.llm.prefix_tree import links
from textsignal.llm.shingles import digest, shingle_sets
from textsignal.llm.store import stored

SHARE = 80
#: The sampled part of all shingles, in 64ths; more than 100 - `SHARE` per cent.
SAMPLED = 32
#: Shingles in a group that counts them.
PER_GROUP = 250_000
#: Documents that tell frequent shingles, and the part of them, in per mille, that makes one so.
PROBE = 10_000
FREQUENT = 20
#: Sets, and shingles, that one task compares; and sets that all blocks of a group meet.
BLOCK_SETS = 1500
BLOCK_SHINGLES = 1_500_000
MEET = 64

NEVER = 2**31 - 1


def _least(n: int, share: int) -> int:
    """The length of the prefix of a set of n shingles."""
    return n - (-(-share * n // 100)) + 1


def sized(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Rows (_id, _tag, _set, _n, _few): the set of each row, its size, and its sampled shingles.

    `_tag` is a hash of the text; `_set` is null for a text without words.
    """
    limit = np.uint64(SAMPLED << 58)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, sizes, few = [], [], []
            for _, sets in shingle_sets(batch.column(2).to_pylist()):
                for s in sets:
                    names.append(digest(s) if len(s) else None)
                    sizes.append(len(s))
                    few.append(int(np.searchsorted(s, limit)))
            made = [pa.array(c, pa.int64()) for c in (names, sizes, few)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *made],
                names=["_id", "_tag", "_set", "_n", "_few"],
            )

    rows = docs.select(
        docs[key].alias("_id"), F.xxhash64(docs[text]).alias("_tag"), docs[text].alias("_text")
    )
    kind = rows.schema["_id"].dataType
    schema = T.StructType([T.StructField("_id", kind)])
    for name in ("_tag", "_set", "_n", "_few"):
        schema = schema.add(name, "long")
    return rows.mapInArrow(run, schema)


def _frequent(docs: DataFrame, key: str, text: str, n_docs: int) -> np.ndarray:
    """Shingles that occur in many different sets of a bounded sample of the documents."""
    share = min(1.0, PROBE / max(1, n_docs))
    place = F.xxhash64(F.lit("probe"), F.coalesce(docs[key].cast("string"), F.lit("")))
    sample = docs.where((place.cast("double") + 2.0**63) / 2.0**64 < share)
    limit = np.uint64(SAMPLED << 58)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, sets in shingle_sets(batch.column(0).to_pylist()):
                known = {digest(s): s[: np.searchsorted(s, limit)] for s in sets if len(s)}
                if known:
                    names = np.repeat(list(known), [len(s) for s in known.values()])
                    values = np.concatenate(list(known.values())).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(values), pa.array(names, pa.int64())], names=["shingle", "set"]
                    )

    seen = sample.select(sample[text]).mapInArrow(run, "shingle long, set long").distinct()
    least = max(20, FREQUENT * min(PROBE, n_docs) // 1000)
    # At most 1000 / FREQUENT times the sampled shingles of a mean set.
    many = seen.groupBy("shingle").count().where(F.col("count") >= least).select("shingle")
    return np.sort(np.array([r[0] for r in many.collect()], np.int64).view(np.uint64))


def _sent(docs: DataFrame, text: str, groups: int, frequent: np.ndarray, share: int) -> DataFrame:
    """Rows (group, shingles, sets, counted): what is to be counted, as packed numbers.

    Equal sets near one another are sent once.
    """
    limit = np.uint64(SAMPLED << 58)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, sets in shingle_sets(batch.column(0).to_pylist()):
                known = {digest(s): s for s in sets if len(s)}
                if not known:
                    continue
                parts = [
                    s[: max(int(np.searchsorted(s, limit)), _least(len(s), share))]
                    for s in known.values()
                ]
                values = np.concatenate(parts)
                names = np.repeat(np.array(list(known), np.int64), [len(p) for p in parts])
                often = np.zeros(len(values), bool)
                if len(frequent):
                    at = np.minimum(np.searchsorted(frequent, values), len(frequent) - 1)
                    often = frequent[at] == values
                group = ((values >> np.uint64(20)) % np.uint64(groups)).astype(np.int64)
                order = np.argsort(group * 2 + often, kind="stable")
                values, names, group, often = values[order], names[order], group[order], often[order]
                cuts = np.flatnonzero(np.diff(group * 2 + often)) + 1
                bounds = [0, *cuts.tolist(), len(values)]
                rows = [
                    (
                        int(group[a]) if not often[a] else (first + a) % groups,
                        values[a:b].tobytes(),
                        names[a:b].tobytes(),
                        not often[a],
                    )
                    for a, b in zip(bounds, bounds[1:])
                ]
                types = (pa.int32(), pa.binary(), pa.binary(), pa.bool_())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), types)],
                    names=["group", "shingles", "sets", "counted"],
                )

    return docs.select(docs[text]).mapInArrow(
        run, "group int, shingles binary, sets binary, counted boolean"
    )


def _count(frame: pd.DataFrame) -> pd.DataFrame:
    """Shingles of several sets, in a group: rows (set, rank, shingle)."""
    limit = np.uint64(SAMPLED << 58)
    made = []
    for counted, part in frame.groupby("counted"):
        values = np.frombuffer(b"".join(part["shingles"]), np.uint64)
        names = np.frombuffer(b"".join(part["sets"]), np.int64)
        order = np.lexsort((names, values))
        values, names = values[order], names[order]
        new = np.ones(len(values), bool)
        new[1:] = (values[1:] != values[:-1]) | (names[1:] != names[:-1])
        values, names = values[new], names[new]
        starts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
        n = np.diff(np.concatenate([starts, [len(values)]]))
        each = np.repeat(n, n)
        keep = each > 1 if counted else np.ones(len(values), bool)
        values, names, each = values[keep], names[keep], each[keep]
        rank = np.minimum(each, NEVER - 2) if counted else np.full(len(values), NEVER - 1)
        rank = np.where(values < limit, rank, NEVER)
        made.append(pd.DataFrame({"set": names, "rank": rank, "shingle": values.view(np.int64)}))
    return pd.concat(made)


def _walk(share: int, names: list[str]):
    """Compares the sets of each group of a partition sorted by group: connecting pairs (a, b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, ids, sets = None, [], []

        def done() -> Iterator[pa.RecordBatch]:
            if len(ids) > 1:
                pairs = links(sets, share)
                if pairs:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([ids[a] for a, _ in pairs], pa.int64()),
                            pa.array([ids[b] for _, b in pairs], pa.int64()),
                        ],
                        names=["a", "b"],
                    )

        for batch in batches:
            keys = [batch.column(i).to_pylist() for i in range(len(names))]
            of, data = batch.column(len(names)).to_pylist(), batch.column(len(names) + 1)
            for i, key in enumerate(zip(*keys)):
                if key != group:
                    yield from done()
                    group, ids, sets = key, [], []
                if not ids or ids[-1] != of[i]:
                    ids.append(of[i])
                    sets.append(np.frombuffer(data[i].as_buffer(), np.uint64))
        yield from done()

    return run


def _linked(rows: DataFrame, names: list[str], share: int) -> DataFrame:
    """Connecting pairs (a, b) of the groups of rows (names, set, shingles)."""
    parts = rows.select(*names, "set", "shingles").repartition(*names)
    ordered = parts.sortWithinPartitions(*names, "set")
    return ordered.mapInArrow(_walk(share, names), "a long, b long")


def _candidates(docs: DataFrame, text: str, known: DataFrame, frequent: np.ndarray, share: int) -> DataFrame:
    """Rows (node, component): candidates of one another, for the sets that have any."""
    total = known.agg(F.sum("_few").alias("few")).first()["few"] or 0
    groups = int(total // PER_GROUP) + 1
    shared = (
        _sent(docs, text, groups, frequent, share)
        .groupBy("group")
        .applyInPandas(_count, "set long, rank int, shingle long")
    )
    each = shared.groupBy("set").agg(
        F.sort_array(F.collect_set(F.struct("rank", "shingle"))).alias("shared"),
        F.count_distinct(F.when(F.col("rank") < NEVER, F.col("shingle"))).alias("sampled"),
    )
    sizes = known.where(F.col("_set").isNotNull()).groupBy(F.col("_set").alias("set")).agg(
        F.first("_n").alias("n"), F.first("_few").alias("few")
    )
    prefix = F.col("n") - F.ceil(F.col("n") * share / 100) + 1
    alone = F.col("few") - F.col("sampled")  # sampled shingles that no other set has
    places = (prefix - alone).cast("int")
    index = stored(
        each.join(sizes, "set")
        .where(places > 0)
        .select("set", F.explode(F.slice("shared", F.lit(1), places)).alias("place"))
        .select("set", F.col("place.shingle").alias("shingle"))
    )
    least = index.groupBy("shingle").agg(F.min("set").alias("b"), F.count(F.lit(1)).alias("_k"))
    edges = index.join(least.where(F.col("_k") > 1).drop("_k"), "shingle").select(
        F.col("set").alias("a"), "b"
    )
    return components(edges)


def set_links(docs: DataFrame, known: DataFrame, key: str, text: str, share: int) -> DataFrame:
    """Pairs (a, b) of sets that connect all that links connect. `known` is what `sized` made."""
    n_docs = known.count()
    frequent = _frequent(docs, key, text, n_docs)
    near = _candidates(docs, text, known, frequent, share)
    first = known.where(F.col("_set").isNotNull()).groupBy(F.col("_set").alias("node")).agg(
        F.min(F.struct(F.col("_id").isNull(), "_id")).alias("_first"), F.first("_n").alias("n")
    )
    members = stored(near.join(first, "node").select("node", "component", "n", "_first._id"))
    wanted = measured_broadcast(
        members.select(F.col("_id").alias("_wanted")).distinct(), 24
    )
    rows = docs.select(docs[key].alias("_id"), docs[text].alias("_text"))
    texts = rows.join(wanted, F.col("_id").eqNullSafe(F.col("_wanted")), "left_semi").select("_text")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, sets in shingle_sets(batch.column(0).to_pylist()):
                full = {digest(s): s for s in sets if len(s)}
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(list(full), pa.int64()),
                        pa.array([s.tobytes() for s in full.values()], pa.binary()),
                    ],
                    names=["set", "shingles"],
                )

    groups = members.groupBy("component").agg(
        F.count(F.lit(1)).alias("_sets"), F.sum("n").alias("_shingles")
    )
    blocks = F.greatest(
        F.ceil(F.col("_sets") / BLOCK_SETS), F.ceil(F.col("_shingles") / BLOCK_SHINGLES)
    ).cast("int")
    placed = members.join(groups, "component").select("node", "component", blocks.alias("blocks"))
    sets = stored(
        texts.mapInArrow(whole, "set long, shingles binary")
        .dropDuplicates(["set"])
        .join(placed, F.col("set") == F.col("node"))
        .drop("node")
    )
    found = [_linked(sets.where(F.col("blocks") == 1), ["component"], share)]
    large = sets.where(F.col("blocks") > 1)
    if not large.isEmpty():
        found += _large(large, share)
    all_found = found[0]
    for more in found[1:]:
        all_found = all_found.union(more)
    return stored(all_found)


def _large(large: DataFrame, share: int) -> list[DataFrame]:
    """Connecting pairs in groups of several blocks."""
    block = F.pmod(F.xxhash64("set"), F.col("blocks")).cast("int")
    order = F.xxhash64(F.lit("meet"), F.col("set"))
    in_blocks = large.withColumn("block", block)
    # Some sets of each group meet all its blocks: those whose hashes are in the least part.
    few = (order.cast("double") + 2.0**63) / 2.0**64 * F.col("blocks") < MEET / BLOCK_SETS
    meeting = in_blocks.where(few).withColumnRenamed("block", "_own").withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    ).where(F.col("block") != F.col("_own"))
    columns = ["component", "block", "set", "shingles"]
    first = stored(
        _linked(
            in_blocks.select(*columns).union(meeting.select(*columns)), ["component", "block"], share
        )
    )
    parts = components(first).select(F.col("node").alias("set"), F.col("component").alias("part"))
    labelled = large.select("component", "set").join(parts, "set", "left").select(
        "component", "set", F.coalesce("part", "set").alias("part")
    )
    sizes = labelled.groupBy("component", "part").count()
    main = sizes.groupBy("component").agg(F.max_by("part", F.struct("count", "part")).alias("main"))
    outside = stored(
        labelled.join(main, "component").where(F.col("part") != F.col("main")).select("component", "set")
    )
    rest = large.join(outside, ["component", "set"], "left_semi")
    many = outside.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK_SETS).cast("int").alias("chunks"))
    chunk = F.pmod(F.xxhash64(F.lit("chunk"), F.col("set")), F.col("chunks")).cast("int")
    to_blocks = (
        rest.join(many, "component")
        .withColumn("chunk", chunk)
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    )
    to_chunks = in_blocks.join(many, "component").withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    )
    columns = ["component", "block", "chunk", "set", "shingles"]
    second = _linked(
        to_blocks.select(*columns).union(to_chunks.select(*columns)),
        ["component", "block", "chunk"],
        share,
    )
    return [first, second]


def _components(known: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rows (_of_set, _component): a name of the component of every set."""
    names = components(pairs)
    sets = known.where(F.col("_set").isNotNull()).select("_set").distinct()
    return sets.join(names, F.col("_set") == F.col("node"), "left").select(
        F.col("_set").alias("_of_set"), F.coalesce("component", "_set").alias("_component")
    )


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", share: int = SHARE
) -> DataFrame:
    """Rows (key, `n_shingles`, `component_id`), one for every row of `docs`.

    A set has the distinct five-word shingles of the text (words are runs without white space, A-Z
    lower-cased), the whole text if it has fewer words, and nothing for a null text or one without
    words. Rows link if 100 x intersection >= `share` x union of their sets; empty sets link with
    nothing. `component_id` is the least key reachable by links, itself included; null only where
    all keys are. Repeated rows link with one another. An empty table gives an empty table.
    """
    known = stored(sized(docs, key, text))
    of = stored(_components(known, set_links(docs, known, key, text, share)))
    classes = known.where(F.col("_set").isNotNull()).groupBy("_set").agg(F.min("_id").alias("_least"))
    least = (
        classes.join(of, F.col("_set") == F.col("_of_set"))
        .groupBy("_component")
        .agg(F.min("_least").alias("_all"))
    )
    final = stored(of.join(least, "_component").select("_of_set", "_all"))
    # Both sides come from tables, so that Spark can split a set with very many copies.
    return known.join(final, F.col("_set") == F.col("_of_set"), "left").select(
        F.col("_id").alias(key),
        F.col("_n").alias("n_shingles"),
        F.when(F.col("_set").isNull(), F.col("_id")).otherwise(F.col("_all")).alias("component_id"),
    )


def keep_one(
    docs: DataFrame, key: str = "doc_id", text: str = "text", share: int = SHARE
) -> DataFrame:
    """The rows of `docs` of which one of each component stays: the one with the least key.

    Of rows with that key the one whose text has the least hash stays, and of repeated rows one.
    Rows without words all stay.
    """
    known = stored(sized(docs, key, text))
    of = stored(_components(known, set_links(docs, known, key, text, share)))
    rows = known.join(of, F.col("_set") == F.col("_of_set")).select("_id", "_tag", "_component")
    first = F.min(F.struct(F.col("_id").isNull().alias("n"), "_id", "_tag"))
    stays = stored(rows.groupBy("_component").agg(first.alias("_stays")))
    rows = stored(rows)
    gone = rows.join(stays, "_component").where(
        ~(F.col("_id").eqNullSafe(F.col("_stays._id")) & (F.col("_tag") == F.col("_stays._tag")))
    )
    gone = stored(gone.select("_id", "_tag").distinct())
    again = stored(rows.groupBy("_id", "_tag").count().where(F.col("count") > 1).drop("count"))

    def without(frame: DataFrame, those: DataFrame, how: str) -> DataFrame:
        those = measured_broadcast(those, 24)
        on = frame[key].eqNullSafe(those["_id"]) & (F.xxhash64(frame[text]) == those["_tag"])
        return frame.join(those, on, how)

    kept = without(docs, gone, "left_anti")
    if again.isEmpty():
        return kept
    # Repeated rows that stay: one of each.
    once = without(kept, again, "left_semi")
    tag = next(f"_tag{i}" for i in range(99) if f"_tag{i}" not in docs.columns)
    once = once.withColumn(tag, F.xxhash64(once[text])).dropDuplicates([key, tag]).drop(tag)
    return without(kept, again, "left_anti").union(once)
