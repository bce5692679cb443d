"""Hard negatives by coordinate pruning over length buckets (after LEMP).

1. Vectors become integers. Those of one label are sorted by length, the longest first, and cut into
   buckets of at most `BUCKET` rows. A bucket keeps, for each coordinate, its rows in the order of
   that coordinate of their unit vectors.
2. Anchors come in slabs of at most `SLAB` rows, which bounds what is broadcast and what the driver
   holds. Each task takes its buckets one after the other, and keeps for each anchor the lists that
   it looks for: the best rows with a score of `low` to `upper`. `low` rises as a list fills.
3. An anchor skips a bucket whose longest vector is too short for `low`. Else the angle that `low`
   leaves bounds each coordinate of a row's unit vector. The ranges of the anchor's `FOCUS` largest
   coordinates, found by binary search in the sorted lists, are intersected, and what is left is
   verified by its exact score. Where a range leaves more than `DENSE` of a bucket, the whole bucket
   is verified.
4. Lists of all tasks are merged by Spark: first those of the positives, whose scores then bound
   the lists of the negatives.

The slabs are a stated query set against all rows; no row and no candidate is left out.

Rows without an id, label or vector, or with a null or non-finite component, take no part. A vector
that ends early has zeros for what it lacks; an empty one scores 0. Rows with the anchor's id are
never its positives; other repeated rows count as often as they occur, and a repeated anchor is
mined once a row. Scores must fit 62 bits, larger ones are an error. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textsignal.llm.grammar import _runs as runs
from textsignal.llm.store import stored

BUCKET = 4096
SLAB = 1 << 16
#: Anchors whose scores with a bucket are held at once.
ANCHORS = 1024
#: Rows of a bucket that are verified first, so that `low` is known for the rest.
FIRST = 256
FOCUS = 3
DENSE = 0.125
#: Width that rounding adds to a range of a unit vector's coordinate.
ROUNDING = 1e-6
NONE = -(1 << 62)

BUCKETS = "label long, rows int, width int, ids binary, vectors binary, orders binary"
FOUND = "anchor int, list int, score long, id long"


@dataclass
class Bucket:
    """Rows of one label, the longest first, with the sorted lists of their coordinates."""

    label: int
    ids: np.ndarray
    vectors: np.ndarray  # rows x coordinates
    orders: np.ndarray  # coordinates x rows
    lengths: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.lengths = np.sqrt((self.vectors.astype(np.float64) ** 2).sum(axis=1))
        self.unit = self.vectors / np.maximum(self.lengths, 1e-300)[:, None]
        self.sorted: dict[int, np.ndarray] = {}

    def values(self, f: int) -> np.ndarray:
        """Coordinate `f` of all unit vectors, sorted."""
        if f not in self.sorted:
            self.sorted[f] = self.unit[self.orders[f], f]
        return self.sorted[f]


def sorted_lists(vectors: np.ndarray) -> np.ndarray:
    """For each coordinate, the rows in the order of that coordinate of their unit vectors."""
    lengths = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
    unit = vectors / np.maximum(lengths, 1e-300)[:, None]
    return np.argsort(unit.T, axis=1, kind="stable").astype(np.int32)


@dataclass
class Lists:
    """For each anchor some lists; each has the best `k` rows with a score of `low` to `upper`."""

    count: np.ndarray  # lists of each anchor
    low: np.ndarray
    upper: np.ndarray
    k: int

    def __post_init__(self) -> None:
        self.start = np.cumsum(self.count) - self.count
        self.scores = np.full((len(self.low), self.k), NONE, np.int64)
        self.ids = np.zeros((len(self.low), self.k), np.int64)

    def least(self, anchors: np.ndarray) -> np.ndarray:
        """The lowest score that any list of the anchors, which have some, still wants."""
        at = runs(self.start[anchors], self.count[anchors])
        begin = np.cumsum(self.count[anchors]) - self.count[anchors]
        return np.minimum.reduceat(self.low[at], begin) if len(at) else self.low[:0]

    def most(self, anchors: np.ndarray) -> np.ndarray:
        """The highest score that any list of the anchors wants."""
        at = runs(self.start[anchors], self.count[anchors])
        begin = np.cumsum(self.count[anchors]) - self.count[anchors]
        return np.maximum.reduceat(self.upper[at], begin) if len(at) else self.upper[:0]

    def add(self, anchors: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Takes rows that were found for anchors into their lists: higher scores, then smaller ids."""
        n = self.count[anchors]
        at = runs(self.start[anchors], n)
        scores, ids = scores.repeat(n), ids.repeat(n)
        wanted = (scores <= self.upper[at]) & (scores >= self.low[at])
        at, scores, ids = at[wanted], scores[wanted], ids[wanted]
        if not len(at):
            return
        changed = np.unique(at)
        held = self.scores[changed].ravel()
        real = held > NONE
        at = np.concatenate([at, changed.repeat(self.k)[real]])
        scores = np.concatenate([scores, held[real]])
        ids = np.concatenate([ids, self.ids[changed].ravel()[real]])
        order = np.lexsort((ids, -scores, at))
        at, scores, ids = at[order], scores[order], ids[order]
        new = np.concatenate([[True], at[1:] != at[:-1]])
        first = np.flatnonzero(new)
        place = np.arange(len(at)) - first[np.cumsum(new) - 1]
        kept = place < self.k
        self.scores[at[kept], place[kept]] = scores[kept]
        self.ids[at[kept], place[kept]] = ids[kept]
        last = self.scores[changed, self.k - 1]
        self.low[changed] = np.maximum(self.low[changed], last)


@dataclass
class Slab:
    """Anchors, in the order of their labels."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray

    def __post_init__(self) -> None:
        self.lengths = np.sqrt((self.vectors.astype(np.float64) ** 2).sum(axis=1))
        self.unit = self.vectors / np.maximum(self.lengths, 1e-300)[:, None]
        n = min(FOCUS, self.vectors.shape[1])
        self.focus = np.argsort(-np.abs(self.unit), axis=1, kind="stable")[:, :n]


def exact_kind(longest: float) -> type:
    """A type in which sums of products up to this length are exact."""
    if longest < 1 << 24:
        return np.float32
    if longest < 1 << 53:
        return np.float64
    if longest < 1 << 62:
        return np.int64
    raise ValueError("scores beyond 62 bits")


def feasible(cosine: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Range of a coordinate of unit vectors that lie within the angle of cosine `least` to one whose
    coordinate is `cosine`."""
    angle, most = np.arccos(np.clip(cosine, -1, 1)), np.arccos(np.clip(least, -1, 1))
    low = np.cos(np.minimum(np.pi, angle + most)) - ROUNDING
    return low, np.cos(np.maximum(0, angle - most)) + ROUNDING


def search(lists: Lists, slab: Slab, bucket: Bucket, same: bool) -> None:
    """Takes the rows of a bucket into the lists of the anchors with its label, or with another one."""
    wide = min(slab.vectors.shape[1], bucket.vectors.shape[1])
    alike = (slab.labels == bucket.label) == same
    longest = float(bucket.lengths.max(initial=0))
    kind = exact_kind(longest * float(slab.lengths[alike].max(initial=0)))
    rows = bucket.vectors[:, :wide].astype(kind)
    asked = np.flatnonzero(alike & (lists.count > 0))
    for i in range(0, len(asked), ANCHORS):
        block = asked[i : i + ANCHORS]
        low, reach = lists.least(block), slab.lengths[block] * longest
        # Nothing in the bucket is long enough, or nothing is wanted.
        open_ = low <= reach * (1 + ROUNDING)
        block, low, reach = block[open_], low[open_], reach[open_]
        dense = np.ones(len(block), bool)
        narrow = np.flatnonzero(low > 0)
        if len(narrow) and slab.focus.shape[1]:
            least = low[narrow] / reach[narrow]
            focus = slab.focus[block[narrow]]
            ranges = np.zeros((*focus.shape, 2), np.int64)
            bounds = np.zeros((*focus.shape, 2))
            for j in range(focus.shape[1]):
                cosine = slab.unit[block[narrow], focus[:, j]]
                bounds[:, j, 0], bounds[:, j, 1] = feasible(cosine, least)
                for f in np.unique(focus[:, j]).tolist():
                    at = np.flatnonzero(focus[:, j] == f)
                    if f >= wide:  # zero in all rows of the bucket
                        ranges[at, j] = [0, len(rows)]
                        continue
                    values = bucket.values(f)
                    ranges[at, j, 0] = np.searchsorted(values, bounds[at, j, 0], "left")
                    ranges[at, j, 1] = np.searchsorted(values, bounds[at, j, 1], "right")
            size = ranges[:, :, 1] - ranges[:, :, 0]
            best = size.argmin(axis=1)
            sparse = size.min(axis=1) <= DENSE * len(rows)
            dense[narrow[sparse]] = False
            for x in np.flatnonzero(sparse).tolist():
                j = best[x]
                if focus[x, j] >= wide:
                    continue
                found = bucket.orders[focus[x, j], ranges[x, j, 0] : ranges[x, j, 1]]
                for other in range(focus.shape[1]):
                    if other != j and focus[x, other] < wide and len(found):
                        value = bucket.unit[found, focus[x, other]]
                        found = found[(value >= bounds[x, other, 0]) & (value <= bounds[x, other, 1])]
                if len(found):
                    anchor = block[narrow[x]]
                    score = (rows[found] @ slab.vectors[anchor, :wide].astype(kind)).astype(np.int64)
                    _take(lists, np.full(len(found), anchor), score, bucket.ids[found], slab)
        block = block[dense]
        if not len(block):
            continue
        vectors = slab.vectors[block, :wide].astype(kind)
        most = lists.most(block)
        for a, b in ((0, FIRST), (FIRST, len(rows))):
            if a >= len(rows):
                continue
            scores = vectors @ rows[a:b].T
            low = lists.least(block)
            x, y = np.nonzero((scores >= low[:, None]) & (scores <= most[:, None]))
            _take(lists, block[x], scores[x, y].astype(np.int64), bucket.ids[a:b][y], slab)


def _take(lists: Lists, anchors: np.ndarray, scores: np.ndarray, ids: np.ndarray, slab: Slab) -> None:
    other = slab.ids[anchors] != ids
    lists.add(anchors[other], scores[other], ids[other])


def _matrix(column: pa.ListArray) -> np.ndarray:
    """Vectors as rows, with zeros for what a short one lacks."""
    n = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    wide = int(n.max(initial=0))
    if (n == wide).all():
        return values.reshape(len(n), wide)
    full = np.zeros((len(n), wide), np.int64)
    full[np.repeat(np.arange(len(n)), n), runs(np.zeros(len(n), np.int64), n)] = values
    return full


def usable(
    vectors: DataFrame, key: str, label: Column | str, vector: str, scale: float
) -> DataFrame:
    """Rows (id, label, q): integers of the vectors that take part."""
    bad = F.exists(vectors[vector], lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(vectors[vector], lambda x: F.floor(F.lit(scale) * x.cast("double")))
    label = vectors[label] if isinstance(label, str) else label
    return vectors.where(
        vectors[key].isNotNull() & label.isNotNull() & vectors[vector].isNotNull() & ~bad
    ).select(vectors[key].cast("long").alias("id"), label.cast("long").alias("label"), whole.alias("q"))


def buckets(rows: DataFrame) -> DataFrame:
    """Rows of `BUCKETS`: those of one label by length, the longest first."""
    squares = F.aggregate("q", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ("label", F.desc("square"), F.xxhash64("id"), "id")
    placed = rows.withColumn("square", squares).repartitionByRange(n, *order[:3])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column(1).to_numpy()
            cuts = np.flatnonzero(np.concatenate([[True], labels[1:] != labels[:-1]])).tolist()
            for a, end in zip(cuts, [*cuts[1:], len(labels)]):
                for x in range(a, end, BUCKET):
                    part = batch.slice(x, min(BUCKET, end - x))
                    matrix = _matrix(part.column(2))
                    row = (
                        int(labels[x]), len(matrix), matrix.shape[1],
                        part.column(0).to_numpy().astype("<i8").tobytes(),
                        matrix.astype("<i8").tobytes(), sorted_lists(matrix).tobytes(),
                    )
                    kinds = (pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 3)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([v], k) for v, k in zip(row, kinds)],
                        names=["label", "rows", "width", "ids", "vectors", "orders"],
                    )

    return placed.sortWithinPartitions(*order).drop("square").mapInArrow(run, BUCKETS)


def _bucket(row: dict) -> Bucket:
    shape = (row["rows"], row["width"])
    return Bucket(
        row["label"],
        np.frombuffer(row["ids"], "<i8"),
        np.frombuffer(row["vectors"], "<i8").reshape(shape),
        np.frombuffer(row["orders"], np.int32).reshape(shape[::-1]),
    )


def _searched(index: DataFrame, slab: Slab, wanted: tuple, k: int, same: bool) -> DataFrame:
    """The best `k` of each list of the slab's anchors: `FOUND`, with `place` from 1."""
    sent = index.sparkSession.sparkContext.broadcast((slab, wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slab, (count, low, upper) = sent.value
        lists = Lists(count, low.copy(), upper, k)
        for batch in batches:
            for i in range(batch.num_rows):
                search(lists, slab, _bucket(batch.slice(i, 1).to_pylist()[0]), same)
        at, place = np.nonzero(lists.scores > NONE)
        owner = np.repeat(np.arange(len(count)), count)[at]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(owner, pa.int32()),
                pa.array(at - lists.start[owner], pa.int32()),
                pa.array(lists.scores[at, place]),
                pa.array(lists.ids[at, place]),
            ],
            names=["anchor", "list", "score", "id"],
        )

    found = index.mapInArrow(run, FOUND)
    place = F.expr("row_number() OVER (PARTITION BY anchor, list ORDER BY score DESC, id)")
    return found.withColumn("place", place).where(F.col("place") <= k)


def mine(
    vectors: DataFrame,
    anchors: Column,
    key: str = "vec_id",
    label: Column | str = "label",
    vector: str = "embedding",
    positives: int = 5,
    negatives: int = 3,
    least: int = 50,
    most: int = 95,
    scale: float = 256.0,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    `anchors` is a condition on the column `id`. A negative has another label and `least` to `most`
    hundredths of the positive's score; the best `negatives` of them are returned.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, key, label, vector, scale)
    index = stored(buckets(rows))
    chosen = stored(rows.where(anchors).withColumn("_hash", F.xxhash64("id")))
    n = chosen.count()
    slabs = max(1, -(-n // (SLAB // 2)))
    out = []
    for number in range(slabs):
        part = chosen.where(F.pmod("_hash", F.lit(slabs)) == number)
        # At most about SLAB rows: half of that on average, and a slab's share is a binomial one.
        table = part.select("id", "label", "q").orderBy("label", "id", F.col("q")).toArrow()
        if not table.num_rows:
            continue
        column = table["q"].combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
        slab = Slab(table["id"].to_numpy(), table["label"].to_numpy(), _matrix(column))
        ones = np.ones(len(slab.ids), np.int64)
        wanted = (ones, np.full(len(ones), NONE + 1), np.full(len(ones), -NONE))
        found = _searched(index, slab, wanted, positives, True).orderBy("anchor", "place").toArrow()
        anchor, score, named = (found[c].to_numpy() for c in ("anchor", "score", "id"))
        low, upper = -(-score * least // 100), score * most // 100
        # A list that can hold nothing wants nothing.
        low = np.where(low <= upper, low, -NONE)
        upper = np.where(low <= upper, upper, NONE)
        count = np.bincount(anchor, minlength=len(ones)).astype(np.int64)
        place = np.arange(len(anchor)) - (np.cumsum(count) - count)[anchor]
        # One row an anchor and positive, of one slab.
        pairs = spark.createDataFrame(
            pa.table(
                {
                    "anchor": pa.array(anchor, pa.int32()),
                    "list": pa.array(place, pa.int32()),
                    "anchor_id": pa.array(slab.ids[anchor]),
                    "positive_id": pa.array(named),
                    "positive_score": pa.array(score),
                }
            ).to_pandas(),
            "anchor int, list int, anchor_id long, positive_id long, positive_score long",
        )
        kept = _searched(index, slab, (count, low, upper), negatives, False)
        out.append(
            stored(
                kept.join(pairs, ["anchor", "list"]).select(
                    "anchor_id",
                    "positive_id",
                    F.col("place").cast("int").alias("rank"),
                    F.col("id").alias("negative_id"),
                    "positive_score",
                    F.col("score").alias("negative_score"),
                )
            )
        )
    if not out:
        names = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        return spark.createDataFrame([], names)
    whole = out[0]
    for frame in out[1:]:
        whole = whole.unionAll(frame)
    return whole
