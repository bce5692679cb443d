"""Repeated passages: every byte that a window of 100 bytes covers which also begins earlier.

Texts are bytes of UTF-8. Windows that are equal have to meet; all windows are far too many to be
sent. So each window names the gram of 24 bytes in it that has the least hash: equal windows name
equal grams, and neighbouring windows mostly the same one. A run of windows with one gram is a
record: its gram, a hash of the bytes it spans, and its place.

1. Records with one gram meet. Those that span equal bytes are copies: all but the first are covered.
   Copies in one task meet before anything is sent, so a passage that very many texts share sends few
   records a task; covered records are dealt evenly over the groups.
2. Where spans of one gram differ, or a gram repeats within a window, the first record of each
   span is open: its bytes are fetched. Open
   records with one gram go to one shard, whose suffix array (Larsson and Sadakane) and common
   prefixes (Kasai) tell which of their windows are equal; all but the first are covered.
3. A range of grams with too many open records for one task fills several shards. What each has found
   to be first is sent on, by a hash of the window, in sorted lists, and the lists of the shards are
   merged by binary search.
4. Per document, covered windows become ranges of bytes.

Nothing is sampled: the number of groups follows the number of records.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textsignal.llm.common import measured_broadcast
from textsignal.llm.store import stored
from textsignal.llm.suffixes import LOW, repeated, window_keys, window_names

WINDOW = 100
#: Bytes of text handled at once.
PIECE = 1 << 20
#: Bytes of text whose records are one group, and open records of a group and of a shard.
GROUP_BYTES = 8 << 20
OPEN_GROUP = 4_000
#: Covered records that travel together, and spans that a task remembers.
DEAL = 1_024
SEEN = 50_000
SHARD = 8_000

#: A record: the document (key and a hash of its text), its first window, how many follow, and
#: whether its gram occurs in a window more than once.
RECORD = np.dtype(
    [("doc", "<i8"), ("tag", "<i8"), ("low", "<i4"), ("more", "<i2"), ("tied", "<i2")]
)
NULL_KEY = -(1 << 63)


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Rows (_doc, _tag, _text): a null key comes before all others."""
    plain = F.coalesce(docs[text], F.lit(""))
    return docs.select(
        F.coalesce(docs[key].cast("long"), F.lit(NULL_KEY)).alias("_doc"),
        F.xxhash64(plain).alias("_tag"),
        plain.alias("_text"),
    )


def _pieces(texts: list[bytes]) -> Iterator[list[tuple[int, int, int]]]:
    """Groups of (text, first byte, last byte + 1) of about `PIECE` bytes.

    The pieces of a long text overlap, so that each window is whole in the piece it begins in.
    """
    group, size = [], 0
    for i, text in enumerate(texts):
        for start in range(0, max(1, len(text)), PIECE):
            end = min(len(text), start + PIECE + WINDOW - 1)
            if end - start < WINDOW:
                continue
            if group and size + end - start > PIECE + WINDOW:
                yield group
                group, size = [], 0
            group.append((i, start, end))
            size += end - start
    if group:
        yield group


def records(
    texts: list[bytes], docs: np.ndarray, tags: np.ndarray, group: list[tuple[int, int, int]]
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Grams, span hashes and records of the windows that begin in a group of pieces, in order."""
    data = np.frombuffer(b"".join(texts[i][a:b] for i, a, b in group), np.uint8)
    keys, tied, sums = window_keys(data, WINDOW)
    sizes = np.array([b - a for _, a, b in group])
    begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    # Windows that lie in one piece.
    n = sizes - WINDOW + 1
    at = np.repeat(begins - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
    piece = np.repeat(np.arange(len(group)), n)
    own = keys[at]
    new = np.concatenate([[True], (own[1:] != own[:-1]) | (piece[1:] != piece[:-1])])
    heads = np.flatnonzero(new)
    count = np.diff(np.concatenate([heads, [len(at)]]))
    first, of = at[heads], piece[heads]
    spans = sums.of(first, first + count - 1 + WINDOW)
    made = np.empty(len(heads), RECORD)
    text = np.array([i for i, _, _ in group])[of]
    made["doc"], made["tag"] = docs[text], tags[text]
    made["low"] = first - begins[of] + np.array([a for _, a, _ in group])[of]
    made["more"] = count - 1
    made["tied"] = np.maximum.reduceat(tied[at], heads)
    return own[heads] & ~LOW, spans, made


def _firsts(grams: np.ndarray, spans: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by gram, span and place, and whether a record is the first of its span in it.

    Repeated rows are one document, so the order has one of records with the same place.
    """
    order = np.lexsort((found["low"], found["tag"], found["doc"], spans, grams))
    columns = [grams[order], spans[order], *(found[c][order] for c in ("doc", "tag", "low"))]
    other = np.ones(len(order), bool)
    other[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    order = order[other]
    g, s = grams[order], spans[order]
    first = np.ones(len(order), bool)
    first[1:] = (g[1:] != g[:-1]) | (s[1:] != s[:-1])
    return order, first


class _Seen:
    """Spans that a task has met more than once, with the first place of each that it has sent.

    A span that is forgotten is sent again: the memory bounds what is spared, not what is found.
    """

    def __init__(self) -> None:
        self.first: dict[tuple[int, int], tuple[int, int, int]] = {}
        self.grams = np.empty(0, np.uint64)

    def covered(self, grams: np.ndarray, spans: np.ndarray, found: np.ndarray, again: np.ndarray) -> np.ndarray:
        """Whether an earlier place of the same span has been sent. Of spans that are not known, those
        marked as met `again` are remembered."""
        done = np.zeros(len(grams), bool)
        known = self.first
        size = len(known)
        for i in np.flatnonzero(again | np.isin(grams, self.grams)).tolist():
            name = (int(grams[i]), int(spans[i]))
            place = (int(found["doc"][i]), int(found["tag"][i]), int(found["low"][i]))
            before = known.get(name)
            if before is not None and before < place:
                done[i] = True
            elif before is not None or again[i] and len(known) < SEEN:
                known[name] = place
        if len(known) > size:
            self.grams = np.unique(np.fromiter((gram for gram, _ in known), np.uint64, len(known)))
        return done


def _sent(rows: DataFrame, groups: int) -> DataFrame:
    """Rows (group, covered, grams, spans, records), packed; copies in one task meet here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, dealt = _Seen(), 0
        for batch in batches:
            docs = batch.column(0).to_numpy(zero_copy_only=False)
            tags = batch.column(1).to_numpy(zero_copy_only=False)
            texts = [t.encode("utf-8", "surrogatepass") for t in batch.column(2).to_pylist()]
            for group in _pieces(texts):
                grams, spans, found = records(texts, docs, tags, group)
                order, first = _firsts(grams, spans, found)
                keep = order[first]
                followed = np.append(~first[1:], False)[first]
                done = seen.covered(grams[keep], spans[keep], found[keep], followed)
                covered = np.concatenate([found[order[~first]], found[keep[done]]])
                keep = keep[~done]
                grams, spans, found = grams[keep], spans[keep], found[keep]
                to = ((grams >> np.uint64(7)) % np.uint64(groups)).astype(np.int64)
                by = np.argsort(to, kind="stable")
                to, grams, spans, found = to[by], grams[by], spans[by], found[by]
                cuts = np.flatnonzero(np.diff(to)) + 1
                bounds = [0, *cuts.tolist(), len(to)] if len(to) else [0]
                out = [
                    (int(to[a]), False, grams[a:b].tobytes(), spans[a:b].tobytes(), found[a:b].tobytes())
                    for a, b in zip(bounds, bounds[1:])
                ]
                for a in range(0, len(covered), DEAL):
                    # From a place that differs by text, so that tasks don't begin at one group.
                    begin = int(tags[group[0][0]]) + dealt
                    out.append((begin % groups, True, b"", b"", covered[a : a + DEAL].tobytes()))
                    dealt += 1
                if not out:
                    continue
                types = (pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), types)],
                    names=["group", "covered", "grams", "spans", "records"],
                )

    return rows.mapInArrow(
        run, "group int, covered boolean, grams binary, spans binary, records binary"
    )


PLACE = "doc long, tag long, low int, high int"


def _frame(found: np.ndarray) -> pd.DataFrame:
    last = found["low"] + found["more"]
    return pd.DataFrame({"doc": found["doc"], "tag": found["tag"], "low": found["low"], "high": last})


def _meet(frame: pd.DataFrame) -> pd.DataFrame:
    """Covered and open records of a group: rows (place, gram); the gram of covered ones is null."""
    done = frame[frame["covered"]]
    rest = frame[~frame["covered"]]
    made = [_frame(np.frombuffer(b"".join(done["records"]), RECORD)).assign(gram=pd.NA)]
    grams = np.frombuffer(b"".join(rest["grams"]), np.uint64)
    if len(grams):
        spans = np.frombuffer(b"".join(rest["spans"]), np.uint64)
        found = np.frombuffer(b"".join(rest["records"]), RECORD)
        order, first = _firsts(grams, spans, found)
        made.append(_frame(found[order[~first]]).assign(gram=pd.NA))
        kept = order[first]
        own = grams[kept]
        same = np.zeros(len(own) + 1, bool)
        same[1:-1] = own[1:] == own[:-1]
        several = same[1:] | same[:-1] | (found["tied"][kept] > 0)
        made.append(_frame(found[kept[several]]).assign(gram=own[several].view(np.int64)))
    # Integers that may be null: as floating point, hashes would lose digits.
    return pd.concat([m.astype({"gram": "Int64"}) for m in made])


def _runs(again: np.ndarray, where: np.ndarray, docs: np.ndarray, tags: np.ndarray, lows: np.ndarray, begins: np.ndarray) -> pd.DataFrame:
    """Runs of covered windows as rows of places. `where` is the record of each byte."""
    at = np.flatnonzero(again)
    if not len(at):
        return pd.DataFrame({"doc": [], "tag": [], "low": [], "high": []}, dtype="int64")
    new = np.concatenate([[True], (np.diff(at) != 1) | (where[at[1:]] != where[at[:-1]])])
    heads = np.flatnonzero(new)
    last = at[np.concatenate([heads[1:] - 1, [len(at) - 1]])]
    record = where[at[heads]]
    shift = lows[record] - begins[record]
    return pd.DataFrame(
        {"doc": docs[record], "tag": tags[record], "low": at[heads] + shift, "high": last + shift}
    )


EMPTY = {"names": None, "docs": None, "tags": None, "lows": None, "part": None}


def _shard(frame: pd.DataFrame) -> pd.DataFrame:
    """Covered windows of a shard, and, if its group has several, the first ones by their hashes."""
    frame = frame.sort_values(["doc", "tag", "low"])
    spans = frame["bytes"].tolist()
    data = np.frombuffer(b"".join(spans), np.uint8)
    lengths = np.array([len(s) for s in spans])
    begins = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    where = np.repeat(np.arange(len(spans)), lengths)
    docs, tags, lows = (frame[c].to_numpy() for c in ("doc", "tag", "low"))
    again, whole = repeated(data, begins, lengths, WINDOW)
    # Nullable integers from here on: as floating point, hashes would lose digits.
    places = {c: "Int64" for c in ("doc", "tag", "low", "high")}
    made = _runs(again, where, docs, tags, lows, begins).astype(places).assign(**EMPTY)
    shards = int(frame["shards"].iloc[0])
    if shards > 1:
        firsts = np.flatnonzero(whole & ~again)
        names = window_names(data, firsts, WINDOW)
        part = (names[:, 0] >> np.uint64(8)) % np.uint64(shards)
        rows = []
        for p in range(shards):
            some = np.flatnonzero(part == p)
            some = some[np.lexsort((names[some, 1], names[some, 0]))]
            at = firsts[some]
            record = where[at]
            rows.append(
                {
                    "names": names[some].tobytes(),
                    "docs": docs[record].tobytes(),
                    "tags": tags[record].tobytes(),
                    "lows": (lows[record] + at - begins[record]).astype(np.int64).tobytes(),
                    "part": p,
                }
            )
        none = {c: pd.array([None] * len(rows), "Int64") for c in places}
        made = pd.concat([made, pd.DataFrame(rows).assign(**none)])
    return made.assign(group=int(frame["group"].iloc[0])).astype(places | {"part": "Int64"})


NAME = np.dtype([("a", "<u8"), ("b", "<u8")])


def _merge(frame: pd.DataFrame) -> pd.DataFrame:
    """Windows that are first in their shard, but not in their group.

    The sorted lists are merged one after the other: each name of a list is looked up in what the
    lists before it hold, by binary search, and the earlier window of two stays.
    """
    names = np.zeros(0, NAME)
    places = np.zeros((0, 3), np.int64)
    covered = []
    lists = sorted(zip(frame["names"], frame["docs"], frame["tags"], frame["lows"]))
    for packed, docs, tags, lows in lists:
        new = np.frombuffer(packed, NAME)
        at = np.stack([np.frombuffer(x, np.int64) for x in (docs, tags, lows)], axis=1)
        slot = np.searchsorted(names, new)
        known = np.zeros(len(new), bool)
        inside = slot < len(names)
        known[inside] = names[slot[inside]] == new[inside]
        old, mine = slot[known], np.flatnonzero(known)
        a, b = places[old], at[mine]
        earlier = np.lexsort((np.r_[a[:, 2], b[:, 2]], np.r_[a[:, 1], b[:, 1]], np.r_[a[:, 0], b[:, 0]]))
        rank = np.empty(len(earlier), np.int64)
        rank[earlier] = np.arange(len(earlier))
        wins = rank[len(a) :] < rank[: len(a)]
        covered += [a[wins], b[~wins]]
        places[old[wins]] = b[wins]
        names = np.insert(names, slot[~known], new[~known])
        places = np.insert(places, slot[~known], at[~known], axis=0)
    found = np.concatenate(covered) if covered else np.zeros((0, 3), np.int64)
    return pd.DataFrame(
        {"doc": found[:, 0], "tag": found[:, 1], "low": found[:, 2], "high": found[:, 2]}
    )


def _fetched(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Open records with their bytes: (group, shard, shards, doc, tag, low, bytes)."""
    of = wanted.groupBy("doc", "tag").agg(
        F.collect_list(F.struct("low", "high", "group", "shard", "shards")).alias("_each")
    )
    near = rows.join(of, (F.col("_doc") == F.col("doc")) & (F.col("_tag") == F.col("tag")))
    cut = near.select(
        "doc", "tag", F.col("_text").cast("binary").alias("_bytes"), F.explode("_each").alias("_of")
    )
    size = F.col("_of.high") - F.col("_of.low") + WINDOW
    return cut.select(
        "_of.group",
        "_of.shard",
        "_of.shards",
        "doc",
        "tag",
        "_of.low",
        F.substring("_bytes", F.col("_of.low") + 1, size).alias("bytes"),
    ).dropDuplicates(["group", "shard", "doc", "tag", "low"])


def covered_windows(rows: DataFrame) -> DataFrame:
    """Runs of windows (doc, tag, low, high) that also begin earlier, in any order."""
    size = rows.agg(F.sum(F.octet_length("_text")).alias("n")).first()["n"] or 0
    groups = int(size // GROUP_BYTES) + 1
    met = stored(
        _sent(rows, groups).groupBy("group").applyInPandas(_meet, f"{PLACE}, gram long")
    )
    done = met.where(F.col("gram").isNull()).drop("gram")
    waiting = met.where(F.col("gram").isNotNull())
    n_open = waiting.count()
    if not n_open:
        return done
    ranges = n_open // OPEN_GROUP + 1
    placed = waiting.select(
        "doc", "tag", "low", "high",
        F.pmod(F.shiftrightunsigned("gram", 7), F.lit(ranges)).cast("int").alias("group"),
    )
    shards = stored(
        placed.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / SHARD).cast("int").alias("shards"))
    )
    wanted = placed.join(measured_broadcast(shards, 16), "group").withColumn(
        "shard", F.pmod(F.xxhash64("doc", "tag", "low"), F.col("shards")).cast("int")
    )
    schema = (
        f"{PLACE}, names binary, docs binary, tags binary, lows binary, part int, group int"
    )
    found = stored(
        _fetched(rows, wanted).groupBy("group", "shard").applyInPandas(_shard, schema)
    )
    inside = found.where(F.col("part").isNull()).select("doc", "tag", "low", "high")
    lists = found.where(F.col("part").isNotNull())
    across = lists.groupBy("group", "part").applyInPandas(_merge, PLACE)
    return done.union(inside).union(across)


def _merge_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joins the ranges of bytes of each document, in a partition sorted by document and start."""
    open_range = None
    for batch in batches:
        doc, tag, low, high = (batch.column(i).to_numpy() for i in range(4))
        if not len(doc):
            continue
        end = high.astype(np.int64) + WINDOW
        low = low.astype(np.int64)
        if open_range is not None:
            doc, tag, low, end = (
                np.concatenate([[v], x]) for v, x in zip(open_range, (doc, tag, low, end), strict=True)
            )
        other = np.concatenate([[True], (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])])
        document = np.cumsum(other)
        far = np.maximum.accumulate(document * (1 << 40) + end)
        new = other.copy()
        new[1:] |= document[1:] * (1 << 40) + low[1:] > far[:-1]
        heads = np.flatnonzero(new)
        last = np.concatenate([heads[1:] - 1, [len(doc) - 1]])
        ends = far[last] - document[last] * (1 << 40)
        open_range = (doc[heads[-1]], tag[heads[-1]], low[heads[-1]], ends[-1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc[heads[:-1]]), pa.array(tag[heads[:-1]]), pa.array(low[heads[:-1]]), pa.array(ends[:-1])],
            names=["doc", "tag", "start", "end"],
        )
    if open_range is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array([v], pa.int64()) for v in map(int, open_range)], names=["doc", "tag", "start", "end"]
        )


def repeated_ranges(rows: DataFrame) -> DataFrame:
    """Rows (doc, tag, ranges): per text, the maximal ranges of bytes that are repeated."""
    merged = (
        covered_windows(rows)
        .repartition("doc", "tag")
        .sortWithinPartitions("doc", "tag", "low")
        .mapInArrow(_merge_ranges, "doc long, tag long, start long, end long")
    )
    return merged.groupBy("doc", "tag").agg(
        F.sort_array(F.collect_list(F.struct("start", "end"))).alias("ranges")
    )


def dedup_passages(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, `n_bytes`, `n_removed`, `n_spans`, `kept_sha256`), one for every row of `docs`.

    A byte is removed if a window of 100 bytes that covers it equals one that begins earlier: in a
    document with a smaller key, or earlier in the same one. Keys are integers; a null key comes
    first. Texts with one key come in the order of a hash, and repeated rows are one document. A
    null text is empty; texts shorter than a window keep all their bytes. An empty table gives an
    empty table.
    """
    rows = _rows(docs, key, text)
    found = stored(repeated_ranges(rows))
    n = found.agg(F.coalesce(F.sum(F.size("ranges")), F.lit(0)).alias("n")).first()["n"]
    known = found.withColumnsRenamed({"doc": "_of", "tag": "_of_tag"})
    # Each range is two numbers.
    known = measured_broadcast(known, 48 + 16 * n // max(1, found.count()))
    plain = F.coalesce(docs[text], F.lit(""))
    own = docs.select(
        docs[key].alias(key),
        F.coalesce(docs[key].cast("long"), F.lit(NULL_KEY)).alias("_doc"),
        F.xxhash64(plain).alias("_tag"),
        plain.alias("_text"),
    )
    near = own.join(
        known, (F.col("_doc") == F.col("_of")) & (F.col("_tag") == F.col("_of_tag")), "left"
    )
    schema = T.StructType([T.StructField(key, docs.schema[key].dataType)])
    for name in ("n_bytes", "n_removed", "n_spans"):
        schema = schema.add(name, "long")
    schema = schema.add("kept_sha256", "string")
    return near.select(key, "_text", "ranges").mapInArrow(_kept(key), schema)


def _kept(key: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Measures and hashes what is left of the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            ranges_of = batch.column(2)
            for text, ranges in zip(batch.column(1).to_pylist(), ranges_of.to_pylist(), strict=True):
                data = text.encode("utf-8", "surrogatepass")
                digest, at, removed = hashlib.sha256(), 0, 0
                for r in ranges or ():
                    digest.update(data[at : r["start"]])
                    at = r["end"]
                    removed += r["end"] - r["start"]
                digest.update(data[at:])
                out.append((len(data), removed, len(ranges or ()), digest.hexdigest()))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            columns = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(list(c), t) for c, t in zip(columns, types, strict=True)]],
                names=[key, "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    return run
