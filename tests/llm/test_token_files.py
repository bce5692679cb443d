"""Token files against the tokenizers library, and grammars against plain Re-Pair."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from textsignal.llm import grammar, pieces, queries, token_files
from textsignal.llm.grammar import compress, expand, pack, sizes_of, slice_ids, unpack

PATH = public_tokenizers.path("word_bpe_49k.json")
END = 2


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return token_files.Encoder(PATH)


def plain(texts, library):
    return [library.encode(t or "", add_special_tokens=False).ids for t in texts]


def same_as_library(texts, encoder, library):
    ids, count = encoder.encode(pa.array(texts, pa.string()))
    cuts = np.concatenate([[0], np.cumsum(count)])
    found = [ids[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:])]
    assert found == plain(texts, library)


ODD = [
    None, "", " ", "\n\n x", "It's we'll 'tis o'clock. don't!", "a.b.c ...", "é É. H̱ ẖ",
    "Σίσυφος ΣΑΣ", "<|endoftext|> and <|STARTOFTEXT|>", "x y z \x1c\x1d \x85", "123 4.5, 6!!",
    "日本語 テスト。 العربية", "ÀÉÎ Straße, İstanbul ǅ ﬁ", "🙂🙂 a🙂.", "a" * 3000, "word, " * 500, "ª º µ × ÷ ¼",
]


def test_odd_texts(encoder, library):
    same_as_library(ODD, encoder, library)
    same_as_library([], encoder, library)
    same_as_library([None], encoder, library)


LETTERS = st.text(alphabet=st.sampled_from("aAbé̱́ß.,!?'s tl\n\t  \x1c1<|>endoftxΣ"), max_size=40)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(LETTERS, st.text(max_size=20)), max_size=5))
def test_any_text(texts):
    same_as_library(texts, token_files.Encoder(PATH) if len(texts) == 1 else SHARED, LIBRARY)


SHARED, LIBRARY = token_files.Encoder(PATH), Tokenizer.from_file(PATH)


def test_forgotten_pieces_are_learned_again(library, monkeypatch):
    monkeypatch.setattr(pieces, "KNOWN", 2)
    encoder = token_files.Encoder(PATH)
    for _ in range(3):
        same_as_library(["one two three", "four, one"], encoder, library)


def repair(ids, least, first):
    """Re-Pair as it is defined: the most frequent pair at a time, least pair first, left to right."""
    s, rules = list(ids), []
    while True:
        count = Counter(zip(s, s[1:]))
        if not count or max(count.values()) < least:
            return s, rules
        pair = min(p for p, n in count.items() if n == max(count.values()))
        rules.append(pair)
        out, i = [], 0
        while i < len(s):
            if tuple(s[i : i + 2]) == pair:
                out.append(first + len(rules) - 1)
                i += 2
            else:
                out.append(s[i])
                i += 1
        s = out


def test_equal_to_plain_repair_where_one_pair_leads():
    # Frequencies that differ, so that a round has one pair: the order is that of the definition.
    ids = np.array([1, 2, 3] * 9 + [4, 1, 2] * 5 + [5, 6] * 4)
    last = np.zeros(len(ids), bool)
    last[-1] = True
    made, _ = compress(ids, last, 10, least=4, share=1.0)
    symbols, rules = repair(ids.tolist(), 4, 10)
    assert made.rules[0].tolist() == list(rules[0]) == [1, 2]
    assert len(made.symbols) <= len(symbols) + 4 and (expand(made) == ids).all()


@settings(max_examples=150, deadline=None)
@given(
    st.lists(st.integers(0, 4), min_size=1, max_size=30),
    st.integers(1, 20),
    st.sampled_from([0.1, 0.5, 1.0]),
    st.integers(0, 600),
    st.integers(0, 600),
    st.lists(st.integers(0, 599), max_size=5),
)
def test_round_trip_and_ranges(unit, times, share, a, b, ends):
    ids = np.array(unit * times, np.uint16)
    last = np.zeros(len(ids), bool)
    last[[e for e in ends if e < len(ids)]] = True
    last[-1] = True
    made, marks = compress(ids, last, 5, least=4, share=share)
    made = unpack(pack(made))
    assert (expand(made) == ids).all()
    # No symbol crosses the end of a document.
    assert (np.cumsum(sizes_of(made, made.symbols))[marks] - 1 == np.flatnonzero(last)).all()
    assert (slice_ids(made, min(a, b), max(a, b)) == ids[min(a, b) : max(a, b)]).all()
    # What is left has no frequent pair that lies in one document.
    rest = Counter(
        p for i, p in enumerate(zip(made.symbols.tolist(), made.symbols[1:].tolist())) if not marks[i]
    )
    assert all(n < 8 for p, n in rest.items() if p[0] != p[1])


def test_repetitive_ids_shrink():
    ids = np.tile(np.random.default_rng(1).integers(0, 1000, 50), 2000).astype(np.uint16)
    last = np.zeros(len(ids), bool)
    last[-1] = True
    made, _ = compress(ids, last, 1000)
    assert len(made.symbols) < 3000 and (expand(made) == ids).all()
    with pytest.raises(ValueError):
        compress(ids, last, 1000, least=2)
    with pytest.raises(ValueError):
        unpack(b"other file")


def expected(rows, library):
    """Rows (doc_id, start, n_tokens, ids_crc32) by the library, null keys first."""
    found, at = [], 0
    ids = {r: library.encode(r[1] or "", add_special_tokens=False).ids + [END] for r in set(rows)}
    crc = {r: np.array(i, "<u2").tobytes() for r, i in ids.items()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, zlib.crc32(crc[r]), crc[r]))
    for r in order:
        found.append((r[0], at, len(ids[r]), zlib.crc32(np.array(ids[r], "<u4").tobytes())))
        at += len(ids[r])
    return sorted(found, key=repr)


ROWS = [
    *[(i, f"Document {i}, with words. " * (i % 9)) for i in range(60)],
    (None, "no key"), (None, None), (7, "same key"), (7, "same key"), (7, "other text"),
    (-5, ""), (100, None), (101, "long words " * 40_000), (1 << 40, "<|endoftext|> inside"),
]


def test_documents_with_odd_rows(documents, library):
    docs = documents(ROWS).withColumnRenamed("lang", "ids").withColumnRenamed("source", "shard")
    found = token_files.token_digests(docs, PATH, END).collect()
    assert sorted(map(tuple, found), key=repr) == expected(ROWS, library)


def test_long_blocks_have_several_grammars(documents, library, monkeypatch, tmp_path, spark):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 1000)
    token_files.write_tokens(documents(ROWS), str(tmp_path / "t"), PATH, END)
    blocks = spark.read.parquet(str(tmp_path / "t"))
    rows = blocks.collect()
    assert max(len(r["grammars"]) for r in rows) > 50
    ids = {r["key"]: r for r in token_files.read_tokens(blocks).collect()}
    whole = np.frombuffer(ids[101]["ids"], "<u4")
    assert whole.tolist() == [*library.encode(ROWS[-2][1], add_special_tokens=False).ids, END]
    row = next(r for r in rows if 101 in r["keys"])
    place = row["keys"].index(101)
    for a, b in ((0, 3), (500, 2500), (79_990, 90_000), (5, 5)):
        assert token_files.ids_of(row.asDict(), place, a, b).tolist() == whole[a:b].tolist()


def test_hot_key_fills_several_shards(documents, library, spark):
    rows = [(5, f"text {i}") for i in range(300)] + [(i, "x") for i in range(20)]
    blocks = token_files.token_blocks(documents(rows), PATH, END).cache()
    assert blocks.select("shard").distinct().count() > 3
    found = token_files.read_tokens(blocks)
    n = sum(len(library.encode(t, add_special_tokens=False).ids) + 1 for _, t in rows)
    starts = found.collect()
    assert sum(r["n_tokens"] for r in starts) == n
    places = sorted((r["start"], r["n_tokens"], r["key"]) for r in starts)
    assert all(a + b == c for (a, b, _), (c, _, _) in zip(places, places[1:]))
    assert [k for _, _, k in places] == sorted(k for k, _ in rows)


def test_no_rows(documents):
    assert token_files.token_digests(documents(ROWS).limit(0), PATH, END).collect() == []


def test_query(spark, library):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    found = queries.QUERIES["op12_token_files"](spark, folder)
    assert found.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, found.collect()), key=repr) == expected(rows, library)


def test_hash_bound_is_only_a_bound():
    ids = np.random.default_rng(3).integers(0, 300, 20_000).astype(np.uint16)
    last = np.zeros(len(ids), bool)
    last[-1] = True
    made, _ = compress(ids, last, 300, least=4, share=0.5)
    assert (expand(made) == ids).all()
    assert grammar.HASH_BITS < 32
