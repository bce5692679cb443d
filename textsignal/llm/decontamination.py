"""Benchmark passages in documents, found by spaced seeds.

A mask names the places of a window of words that count; the others may hold any word. The words
that a mask selects, at every position of every item and of every document, are hashed, and equal
hashes of an item and a document are hits: two windows that agree in the selected places. Around a
hit the two texts are laid on one another, word by word, and compared: there is an overlap if some
stretch of `WINDOW` words has at least `SHARE` of its words in common. So replaced words are
tolerated. An item with fewer words than `WINDOW` is compared whole. Masks are added to the given
ones until every way in which words can be replaced leaves a seed: for a window, and for each length
of the shorter items that there are.

Words are runs of letters and digits, lower-cased. The hashes of the items are broadcast if they
are measured to be small, so that the documents' hashes, one for each word and mask, need no
shuffle; with a larger benchmark they are joined by one. Only hits go on.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textsignal.llm.common import measured_broadcast
from textsignal.llm.store import stored

#: The masks to begin with; `completed` adds what they miss.
MASKS = ("101100111", "110101011")
WINDOW = 13
SHARE = 80  # per cent


def words(text: Column) -> Column:
    return F.regexp_extract_all(
        F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)
    )


def _seeds(hashes: str, size: Column, places: list[int], name: str) -> Column:
    """The hash of the selected words at each position; an empty array if the window doesn't fit."""
    span = max(places) + 1
    each = F.transform(
        F.sequence(F.lit(0), F.greatest(size - span, F.lit(0))),
        lambda i: F.xxhash64(F.lit(name), *[F.get(F.col(hashes), i + p) for p in places]),
    )
    return F.when(size >= span, each).otherwise(F.array().cast("array<bigint>"))


def _places(masks: tuple[str, ...]) -> list[list[int]]:
    return [[i for i, c in enumerate(m) if c == "1"] for m in masks]


def replaceable(size: int, share: int) -> int:
    """How many of so many words may be replaced."""
    return size - (size * share + 99) // 100


def hit(mask: str, size: int, replaced: tuple[int, ...]) -> bool:
    """Whether a mask has a position in `size` words where it selects no replaced one."""
    chosen = [i for i, c in enumerate(mask) if c == "1"]
    return any(
        all(start + p not in replaced for p in chosen) for start in range(size - len(mask) + 1)
    )


@lru_cache
def completed(masks: tuple[str, ...], size: int, n_replaced: int) -> tuple[str, ...]:
    """The masks that fit, and more until each choice of replaced words is hit by one.

    All choices are tried, so `size` is that of a sentence. New masks select as many words as the
    given ones, or all that are left, and are spread as wide as they can be.
    """
    fit = [m for m in masks if len(m) <= size]
    weight = min([size - n_replaced, *(m.count("1") for m in masks)])
    missed = [
        x for x in combinations(range(size), n_replaced) if not any(hit(m, size, x) for m in fit)
    ]
    others = sorted(
        {
            "".join("01"[i in c] for i in range(c[0], c[-1] + 1))
            for c in combinations(range(size), weight)
        }
    ) if missed else []
    while missed:
        best = max(others, key=lambda m: (sum(hit(m, size, x) for x in missed), len(m)))
        fit.append(best)
        missed = [x for x in missed if not hit(best, size, x)]
    return tuple(fit)


def _placed(
    rows: DataFrame, ids: list[str], masks: dict[str, list[int]], window: int, items: bool
) -> DataFrame:
    """Rows (ids, _seed, _at): every seed with its position. `rows` has the ids and _words.

    `masks` names the lengths of items that a mask is for; `window` stands for all from there on.
    """
    size = F.size("_words")
    sets = []
    for m, places in zip(masks, _places(tuple(masks))):
        seeds = _seeds("_hashes", F.col("_size"), places, f"mask {m}")
        fits = F.least(F.col("_size"), F.lit(window)).isin(masks[m]) | F.lit(not items)
        sets.append(F.when(fits, seeds).otherwise(F.array().cast("array<bigint>")))
    hashed = rows.select(
        *ids, size.alias("_size"), F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes")
    )
    # A seed and its position in one value: arrays of different masks are laid end to end.
    numbered = [
        F.transform(s, lambda seed, i: F.struct(seed.alias("s"), i.alias("i"))) for s in sets
    ]
    # The outer form, or Spark adds a filter that makes all seeds a second time.
    each = hashed.select(*ids, F.explode_outer(F.concat(*numbered)).alias("_each"))
    return each.where(F.col("_each").isNotNull()).select(
        *ids, F.col("_each.s").alias("_seed"), F.col("_each.i").alias("_at")
    )


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    masks: tuple[str, ...] = MASKS,
    window: int = WINDOW,
    share: int = SHARE,
) -> DataFrame:
    """The pairs of document and item that overlap, one row each.

    Columns: the two keys, `item_words`, `matched` (most words in common along the item, laid on
    the document in one way) and `window_matched` (most in one window). Texts that are null or
    without words overlap with nothing. Repeated keys count as one document or item with several
    texts, a null key as a key. Empty tables give an empty table.
    """
    items = stored(
        benchmark.select(
            benchmark[item].alias("_item"), words(benchmark[item_text]).alias("_words")
        )
        .where(F.size("_words") > 0)
        .distinct()
    )
    # At most `window` lengths.
    lengths = items.select(F.least(F.size("_words"), F.lit(window)).alias("n")).distinct()
    masks = completed(masks, window, replaceable(window, share))
    for_lengths: dict[str, list[int]] = {}
    for n in sorted(r["n"] for r in lengths.collect()):
        for m in completed(masks, n, replaceable(n, share)):
            for_lengths.setdefault(m, []).append(n)
    if not for_lengths:
        for_lengths = {m: [window] for m in masks}
    marks = stored(
        _placed(items, ["_item"], for_lengths, window, items=True).select(
            "_item", F.col("_seed").alias("_mark"), F.col("_at").alias("_in_item")
        )
    )
    texts = docs.select(docs[key].alias("_doc"), docs[text].alias("_text"))
    said = texts.select("_doc", words(F.col("_text")).alias("_words"))
    seeds = _placed(said, ["_doc"], for_lengths, window, items=False)
    hits = stored(
        seeds.join(measured_broadcast(marks, 32), F.col("_seed") == F.col("_mark"))
        .select("_doc", "_item", (F.col("_at") - F.col("_in_item")).alias("_shift"))
        .distinct()
    )
    # Items of equal keys and words are one row, so that a hit meets each of its texts once.
    laid = (
        texts.alias("t")
        .join(
            measured_broadcast(
                hits.withColumnsRenamed({"_doc": "_hit_doc", "_item": "_hit_item"}), 24
            ),
            F.col("_doc").eqNullSafe(F.col("_hit_doc")),
        )
        .select("_doc", "_hit_item", "_shift", words(F.col("_text")).alias("_said"))
        .join(measured_broadcast(items, 1024), F.col("_hit_item").eqNullSafe(F.col("_item")))
    )
    n = F.size("_words")
    equal = F.transform(
        "_words",
        lambda word, i: F.when(
            (F.col("_shift") + i >= 0) & F.get("_said", F.col("_shift") + i).eqNullSafe(word), 1
        ).otherwise(0),
    )
    compared = laid.select("_doc", "_item", n.alias("_n"), equal.alias("_equal"))
    wide = F.least(F.col("_n"), F.lit(window))
    best = F.array_max(
        F.transform(
            F.sequence(F.lit(0), F.col("_n") - wide),
            lambda i: F.aggregate(
                F.slice("_equal", i + 1, wide), F.lit(0), lambda total, x: total + x
            ),
        )
    )
    in_all = F.aggregate("_equal", F.lit(0), lambda total, x: total + x)
    return (
        compared.select("_doc", "_item", "_n", in_all.alias("_all"), best.alias("_best"))
        .where(F.col("_best") * 100 >= share * wide)
        .groupBy(F.col("_doc").alias(key), F.col("_item").alias(item))
        .agg(
            F.max("_n").cast("long").alias("item_words"),
            F.max("_all").cast("long").alias("matched"),
            F.max("_best").cast("long").alias("window_matched"),
        )
    )


def clean(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", **settings: object
) -> DataFrame:
    """The documents that overlap with no item, with their columns."""
    found = stored(overlaps(docs, benchmark, key, **settings).select(F.col(key).alias("_found")).distinct())
    found = measured_broadcast(found, 16)
    return docs.join(found, docs[key].eqNullSafe(found["_found"]), "left_anti")
