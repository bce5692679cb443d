"""Near duplicates, repeated passages, benchmark overlaps against plain forms."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import plain
from tests.llm.conftest import rows_of
from textsignal.llm import decontamination, jaccard_join, passage_dedup
from textsignal.llm.components import components
from textsignal.llm.prefix_tree import links
from textsignal.llm.shingles import shingle_sets
from textsignal.llm.suffixes import common_prefixes, repeated, suffix_array

CHANCE = random.Random(11)
SYLLABLES = ["la", "de", "on", "tion", "ré", "und", "Ein", "que", "ha", "wh"]


def text(n, chance=CHANCE):
    return " ".join("".join(chance.choices(SYLLABLES, k=chance.randint(1, 3))) for _ in range(n))


def edited(base, n, chance=CHANCE):
    words = base.split(" ")
    for _ in range(n):
        words[chance.randrange(len(words))] = text(1, chance)
    return " ".join(words)


def near_texts():
    made = []
    for size in (4, 6, 12, 40, 150):
        for _ in range(3):
            base = text(size)
            made += [base, base.upper(), base.replace(" ", "\n"), base + " " + text(1 + size // 9)]
            made += [edited(base, k) for k in range(0, 1 + size // 12)]
    common = text(60)
    made += [common + " " + text(n) for n in (2, 5, 10, 100, 100, 100, 100)]
    return [*made, None, "", " \t", "x", "x", "é " * 30]


def test_links_of_sets_equal_all_pairs():
    chance = random.Random(1)
    for _ in range(60):
        bases = [chance.sample(range(200), chance.randint(1, 30)) for _ in range(4)]
        sets = []
        for _ in range(chance.randint(2, 25)):
            own = set(chance.choice(bases))
            own ^= set(chance.sample(range(250), chance.randint(0, 4)))
            sets.append(np.array(sorted(own or {1}), np.uint64))
        pairs = {
            (i, j)
            for i, a in enumerate(map(set, sets))
            for j, b in enumerate(map(set, sets))
            if i != j and 100 * len(a & b) >= 80 * len(a | b)
        }
        got = links(sets, 80)
        assert set(got) <= pairs
        assert grouped(len(sets), got) == grouped(len(sets), pairs)


def grouped(n, pairs):
    label = list(range(n))
    for _ in range(n):
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    return label


def test_shingle_sets_of_long_texts_equal_short_pieces():
    long_text = text(400_000, random.Random(5))
    (_, [whole]) = next(shingle_sets([long_text]))
    assert len(whole) == len(plain.shingles(long_text))
    assert [len(s) for _, sets in shingle_sets(["a b", None, "A  B", "a b c d e f"]) for s in sets] == [1, 0, 1, 2]


@pytest.mark.parametrize("block", [1500, 5])
def test_near_duplicates_equal_all_pairs(documents, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", block)
    monkeypatch.setattr(jaccard_join, "MEET", 1)
    monkeypatch.setattr(jaccard_join, "PER_GROUP", 300)
    texts = near_texts()
    got = jaccard_join.near_duplicates(documents(list(enumerate(texts))))
    wanted = [(i, len(plain.shingles(t)), c) for i, (t, c) in enumerate(zip(texts, plain.components(texts)))]
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == sorted(wanted, key=repr)


def test_one_of_each_component_stays(documents):
    base, other = text(50), text(50)
    rows = [(5, base), (3, edited(base, 1)), (3, edited(base, 1)), (9, other), (9, other), (9, text(50))]
    rows += [(None, other), (None, text(50)), (7, None), (8, ""), (8, "")]
    docs = documents(rows).withColumn("node", F.lit(1)).withColumn("_set", F.lit("s"))
    got = jaccard_join.keep_one(docs)
    assert got.columns == docs.columns
    kept = [(r.doc_id, r.text) for r in got.collect()]
    assert sorted(k for k, _ in kept if k is not None) == [3, 7, 8, 8, 9, 9]
    assert len(kept) == 7 and (9, other) in kept
    assert jaccard_join.keep_one(documents([])).count() == 0
    assert jaccard_join.near_duplicates(documents([])).count() == 0


def test_components_of_a_path_a_star_and_a_ring(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 20)]
    edges += [(200 + i, 200 + (i + 1) % 7) for i in range(7)] + [(300, 300)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(31)} == {0} and {got[i] for i in range(100, 120)} == {100}
    assert {got[i] for i in range(200, 207)} == {200} and 300 not in got


def test_suffix_arrays_and_common_prefixes():
    chance = random.Random(3)
    for _ in range(60):
        window = chance.choice([3, 5, 20])
        strings = [bytes(chance.choices(b"ab", k=chance.randint(window, 40))) for _ in range(chance.randint(1, 9))]
        strings += strings[:2]
        data = np.frombuffer(b"".join(strings), np.uint8)
        lengths = np.array([len(s) for s in strings])
        begins = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        ends = np.repeat(begins + lengths, lengths)
        order = suffix_array(data, ends, int(lengths.max()))
        assert order.tolist() == sorted(range(len(data)), key=lambda i: (bytes(data[i : ends[i]]), i))
        common = common_prefixes(data, begins, lengths, order, window)
        again, _ = repeated(data, begins, lengths, window)
        seen = set()
        for i in range(len(data)):
            part = bytes(data[i : i + window])
            if i + window <= ends[i]:
                assert again[i] == (part in seen)
                seen.add(part)
            else:
                assert not again[i] and common[i] == 0


@pytest.mark.parametrize("shard", [8000, 20])
def test_passages_equal_plain_windows(documents, monkeypatch, shard):
    monkeypatch.setattr(passage_dedup, "SHARD", shard)
    if shard < 100:
        monkeypatch.setattr(passage_dedup, "PIECE", 500)
        monkeypatch.setattr(passage_dedup, "GROUP_BYTES", 3000)
    shared, other = text(40), text(60)
    texts = [text(30) + " " + shared + " " + text(30) for _ in range(12)]
    texts += [shared, other, other, other[3:] + shared, text(10) + other[:120], shared + shared + shared]
    texts += ["ab" * 200, "x" * 99, "x" * 100, "x" * 101, "x" * 300, "é" * 70, "é" * 70, None, "", text(300)]
    got = passage_dedup.dedup_passages(documents(list(enumerate(texts))))
    columns = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]
    found = {r.doc_id: tuple(r[c] for c in columns) for r in got.collect()}
    assert found == dict(enumerate(plain.without_repeats(texts)))


@pytest.mark.parametrize("most", [50_000, 3])
def test_passages_that_many_texts_share_send_few_records_and_are_dealt_evenly(documents, monkeypatch, most):
    monkeypatch.setattr(passage_dedup, "PIECE", 4000)
    monkeypatch.setattr(passage_dedup, "DEAL", 8)
    monkeypatch.setattr(passage_dedup, "SEEN", most)
    common = text(40)
    texts = [common + f" {i} " + text(30) for i in range(600)]
    df = documents(list(enumerate(texts))).coalesce(1)
    sent = passage_dedup._sent(passage_dedup._rows(df, "doc_id", "text"), 6).collect()
    size = passage_dedup.RECORD.itemsize
    grams = [g for row in sent if not row.covered for g in np.frombuffer(row.grams, np.uint64).tolist()]
    # The inner part of the common passage is sent by few of the about 60 pieces that have it.
    inner = passage_dedup.records([common.encode()], np.zeros(1, "i8"), np.zeros(1, "i8"), [(0, 0, len(common))])[0]
    assert most == 3 or min(grams.count(int(g)) for g in inner) < 10
    covered = [0] * 6
    for row in sent:
        if row.covered:
            covered[row.group] += len(row.records) // size
    assert sum(covered) > 600 and max(covered) < 1.5 * min(covered)
    got = passage_dedup.dedup_passages(df)
    columns = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]
    found = {r.doc_id: tuple(r[c] for c in columns) for r in got.collect()}
    assert found == dict(enumerate(plain.without_repeats(texts)))


def test_passages_of_null_keys_and_no_rows(documents):
    passage = text(60)
    got = passage_dedup.dedup_passages(documents([(4, passage), (None, passage), (4, passage)]))
    removed = sorted((r.doc_id is None, r.n_removed == r.n_bytes) for r in got.collect())
    assert removed == [(False, True), (False, True), (True, False)]
    assert passage_dedup.dedup_passages(documents([])).count() == 0


@pytest.mark.parametrize("partitions", [1, 6])
def test_repeated_rows_without_an_earlier_copy_stay(documents, partitions):
    passage, other = text(60), text(60)
    rows = [(4, passage)] * 3 + [(5, other + "x" * 300)] * 2 + [(6, passage + other)]
    got = passage_dedup.dedup_passages(documents(rows).repartition(partitions))
    once = [r[1] for r in (rows[0], rows[3], rows[5])]
    wanted = dict(zip((4, 5, 6), plain.without_repeats(once)))
    assert wanted[4][1] == 0 < wanted[5][1]
    found = [(r.doc_id, (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in got.collect()]
    assert sorted(found) == sorted((r[0], wanted[r[0]]) for r in rows)


def test_overlaps_equal_plain_comparison(spark, documents):
    items = [text(n) for n in (15, 20, 36, 60)] + [text(10), text(4), "", None]
    docs = [text(80) + " " + t + ", " + text(30) for t in items[:5] if t]
    docs += [edited(items[2], 3), items[2].upper(), " ".join(items[3].split()[20:40]), items[5] or ""]
    docs += [text(50) + " " + edited(items[0], 2) + "!", text(200), None, "", "x"]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = decontamination.overlaps(documents(list(enumerate(docs))), benchmark)
    found = {(r.doc_id, r.item_id): tuple(r)[2:] for r in got.collect()}
    assert found == plain.overlaps(docs, items)


def test_replaced_words_are_tolerated(spark, documents):
    chance = random.Random(8)
    items = [text(20, chance) for _ in range(30)]
    docs = [text(30, chance) + " " + edited(t, 2, chance) + " " + text(30, chance) for t in items]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = decontamination.overlaps(documents(list(enumerate(docs))), benchmark)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == {(i, i) for i in range(30)}


def test_every_choice_of_replaced_words_is_hit():
    masks = decontamination.completed(decontamination.MASKS, 13, 2)
    for n in range(1, 14):
        most = decontamination.replaceable(n, decontamination.SHARE)
        assert 100 * (n - most) >= decontamination.SHARE * n > 100 * (n - most - 1)
        own = decontamination.completed(masks, n, most)
        for k in range(most + 1):
            for gone in itertools.combinations(range(n), k):
                assert any(decontamination.hit(m, n, gone) for m in own), (n, gone)


def test_short_items_with_replaced_words(spark, documents):
    chance = random.Random(21)
    items, docs = [], []
    for n in range(5, 15):
        most = decontamination.replaceable(min(n, 13), 80)
        for gone in itertools.combinations(range(n), most):
            if chance.random() < 6 / n / most:
                words = [f"w{chance.randrange(10**6)}" for _ in range(n)]
                items.append(" ".join(words))
                said = ["x" if i in gone else w for i, w in enumerate(words)]
                docs.append(" ".join([text(5, chance), *said, text(5, chance)]))
    words = [f"v{i}" for i in range(13)]
    items.append(" ".join(words))
    docs.append(" ".join("x" if i in (3, 4) else w for i, w in enumerate(words)))
    items += [docs[0].split(" ")[0] + " p q r s"]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = decontamination.overlaps(documents(list(enumerate(docs))), benchmark)
    found = {(r.doc_id, r.item_id): (r.item_words, r.matched, r.window_matched) for r in got.collect()}
    assert found == plain.overlaps(docs, items, least=1)
    assert {(i, i) for i in range(len(docs))} <= set(found)


def test_clean_documents_stay_whole(spark, documents):
    item = text(20)
    benchmark = spark.createDataFrame([(1, item), (1, text(16)), (None, text(18))], "item_id long, text string")
    rows = [(1, item + " more"), (2, text(40)), (2, text(40)), (None, text(9)), (3, None), (4, "")]
    docs = documents(rows).withColumn("_found", F.lit(1)).withColumn("item_id", F.lit(2))
    got = decontamination.clean(docs, benchmark)
    assert got.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in got.collect()) == [0, 2, 2, 3, 4]
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.overlaps(docs, none).count() == 0
    assert decontamination.overlaps(documents([]), benchmark).count() == 0
