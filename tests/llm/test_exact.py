"""Mixing, exact dedup, sharding."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from tests.llm import plain
from tests.llm.conftest import rows_of
from textsignal.llm import exact_dedup, mixing, sharding
from textsignal.llm.store import drop_stored, stored


def words(n, seed):
    chance = random.Random(seed)
    return " ".join(chance.choice(["la", "de", "on", "tion", "ré"]) for _ in range(n))


def test_dedup_equals_plain_grouping(documents):
    chance = random.Random(1)
    texts = [words(chance.randint(1, 40), i % 25) for i in range(60)]
    texts += [t.replace(" ", "\n \t") for t in texts[:20]] + [None, "", " \n", "x" * 50, "x" * 49]
    rows = list(enumerate(texts))
    got = exact_dedup.dedup(documents(rows), block=7)
    wanted = plain.exact_groups(rows)
    assert rows_of(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == sorted(wanted, key=repr)


def test_dedup_of_long_texts_that_differ_in_one_block(documents):
    base = words(30_000, 3)
    rows = [(1, base), (2, base[:-1] + "!"), (3, base + " "), (4, "!" + base), (5, base)]
    got = {r.doc_id: r for r in exact_dedup.dedup(documents(rows), block=1000).collect()}
    assert [got[i].keep_id for i in (1, 2, 3, 4, 5)] == [3, 2, 3, 4, 3]
    assert got[3].group_size == 3 and got[3].kept and not got[5].kept


def test_dedup_of_many_copies_in_few_ranges(documents):
    rows = [(i, "a b c d" * 3) for i in range(200)] + [(1000 + i, f"text {i}") for i in range(20)]
    got = exact_dedup.dedup(documents(rows), block=4)
    assert got.where("doc_id < 1000").select("keep_id", "group_size").distinct().collect() == [(0, 200)]
    assert got.where("kept").count() == 21


def test_dedup_of_repeated_rows_null_keys_and_no_rows(documents):
    rows = [(1, "same"), (1, "same"), (None, "same"), (None, "other"), (2, "sa me")]
    got = exact_dedup.dedup(documents(rows))
    assert got.count() == 5
    same = got.where(F.col("group_size") == 4)
    assert {r.keep_id for r in same.collect()} == {2} and same.where("kept").count() == 1
    assert got.where("group_size = 1").first().kept
    assert exact_dedup.dedup(documents([])).count() == 0


def test_dedup_keeps_one_of_repeated_rows_that_are_best(documents):
    rows = [(1, "same")] * 3 + [(2, "same"), (3, "sa me"), (3, "sa me"), (None, "x"), (None, "x")]
    rows += [(7, "y" * 9), (7, "y" * 9), (8, "alone")]
    for block in (4, 4096):
        got = exact_dedup.dedup(documents(rows), block=block)
        assert got.count() == len(rows)
        kept = rows_of(got.where("kept"), "doc_id", "keep_id", "group_size")
        assert kept == sorted([(3, 3, 6), (None, None, 2), (7, 7, 2), (8, 8, 1)], key=repr)


def test_mix_takes_the_targets(documents):
    chance = random.Random(2)
    rows = []
    for i in range(300):
        source = chance.choice(["a", "a", "a", "a", "b", "c", "d", None])
        rows.append((i, words(chance.randint(0, 30), i) or None, None, source))
    got = mixing.mix(documents(rows), rows_per_range=20).join(documents(rows), "doc_id")
    sizes, target = plain.mix([(r[0], len((r[1] or "").split()), r[3]) for r in rows])
    taken, seen = collections.Counter(), set()
    for r in got.collect():
        assert r.size == len((r.text or "").split()) and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(target[r.source])
        assert r.taken == r.copies * r.size + r.part <= 3 * r.size
        taken[r.source] += r.taken
        seen.add(r.doc_id)
    assert len(seen) == 300
    for source, wanted in target.items():
        assert taken[source] == int(wanted + 1e-6)


def test_mix_does_not_depend_on_partitions_or_ranges(documents):
    rows = [(i, words(i % 17, i), None, "ab"[i % 2]) for i in range(100)]
    first = rows_of(mixing.mix(documents(rows), rows_per_range=7), "doc_id", "taken")
    assert first == rows_of(mixing.mix(documents(rows).repartition(1)), "doc_id", "taken")


def test_mixed_rows_are_the_copies(documents):
    rows = [(i, words(5 + i % 11, i), "en", "a" if i < 80 else "b") for i in range(100)]
    docs = documents(rows).withColumn("size", F.lit("mine")).withColumn("_key", F.lit(1))
    got = mixing.mixed(docs)
    assert got.columns == docs.columns
    wanted = {r.doc_id: r for r in mixing.mix(docs).collect()}
    n, copies = collections.Counter(), collections.Counter()
    for r in got.collect():
        n[r.doc_id] += len(r.text.split())
        copies[r.doc_id] += 1
        assert dict((k, t) for k, t, *_ in rows)[r.doc_id].startswith(r.text)
    for key, row in wanted.items():
        assert n[key] == row.taken
        assert copies[key] == row.copies + (row.part > 0)


def test_mix_of_odd_tables(documents):
    assert mixing.mix(documents([])).count() == 0 and mixing.mixed(documents([])).count() == 0
    empty = mixing.mix(documents([(1, None), (2, ""), (3, " \n")])).collect()
    assert [(r.size, r.taken, r.target) for r in empty] == [(0, 0, 0.0)] * 3
    repeated = documents([(1, "a b c"), (1, "a b c"), (None, "d e"), (2, "f")])
    got = mixing.mix(repeated).collect()
    assert len(got) == 4 and abs(sum(r.taken for r in got) - 9) <= 1


def test_lookup_table_takes_turns():
    names = [f"s{i}" for i in range(7)]
    owner = sharding.lookup_table(names, 101)
    share = collections.Counter(owner)
    assert set(owner) == set(range(7)) and max(share.values()) - min(share.values()) <= 1
    # Each claim in turn is the first free slot of the shard's order.
    free, place = set(range(101)), {}
    at = [sharding._number(f"offset {n}") % 101 for n in names]
    step = [sharding._number(f"step {n}") % 100 + 1 for n in names]
    orders = [[(at[s] + k * step[s]) % 101 for k in range(101)] for s in range(7)]
    while free:
        for s in range(7):
            if free:
                slot = next(x for x in orders[s] if x in free)
                free.discard(slot)
                place[slot] = s
    assert [place[i] for i in range(101)] == owner


def test_fewer_shards_move_little():
    names = [f"s{i}" for i in range(20)]
    size = sharding.table_size(20)
    before, after = sharding.lookup_table(names, size), sharding.lookup_table(names[:-1], size)
    moved = sum(a != b for a, b in zip(before, after) if a != 19)
    assert moved < 0.1 * size


def test_place_replaces_columns_and_takes_null_keys(documents):
    docs = documents([(i, "t") for i in range(500)] + [(None, "n"), (None, None), (7, "t")])
    got = sharding.place(docs.withColumn("shard", F.lit("x")), shards=8)
    assert got.count() == 503 and got.columns[-2:] == ["slot", "shard"]
    assert got.where("doc_id is null").select("shard").distinct().count() == 1
    assert got.where("doc_id = 7").select("shard").distinct().count() == 1
    counts = [r["count"] for r in got.groupBy("shard").count().collect()]
    assert len(counts) == 8 and min(counts) > 25
    assert sharding.place(documents([])).count() == 0
    with pytest.raises(ValueError):
        sharding.lookup_table(["a", "a"], 11)


def test_stored_tables_can_be_dropped(spark):
    kept = stored(spark.range(5))
    assert kept.count() == 5 and drop_stored(spark) >= 1
    assert drop_stored(spark) == 0
