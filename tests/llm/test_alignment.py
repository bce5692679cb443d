"""Alignment of two vocabularies against a plain form, token by token."""

import hashlib
import re
from collections import Counter, defaultdict

import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer, decoders

from textsignal.llm import alignment, queries, store

A_PATH = public_tokenizers.path("byte_bpe_50k.json")
B_PATH = public_tokenizers.path("piece_bpe_32k.model")
A = Tokenizer.from_file(A_PATH)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
OWN = alignment.ByteLevel(A_PATH)
LETTERS = sorted({c for token in A.get_vocab() if len(token) == 1 for c in token})


def byte_letters():
    """Letter of each byte, found by encoding: each of the 256 letters decodes to one byte."""
    found = {}
    for b in range(256):
        shown = chr(b) if b in {*range(33, 127), *range(161, 173), *range(174, 256)} else None
        found[b] = shown
    rest = iter(chr(256 + i) for i in range(256))
    return {(found[b] or next(rest)): b for b in range(256)}


BYTES = byte_letters()


def plain(rows):
    """By definition: groups, links and counts of all documents."""
    groups = []
    for _, text in rows:
        if not text:
            groups.append([])
            continue
        data = (" " + text).encode()
        a = A.encode(" " + text, add_special_tokens=False).ids
        b = B.encode(text)
        words_a = [bytes(BYTES[c] for c in A.id_to_token(i)) for i in a]
        words_b = [
            bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) and B.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in ((i, B.id_to_piece(i)) for i in b)
        ]
        if b"".join(words_a) != data or b"".join(words_b) != data:
            groups.append([])
            continue
        ends_a = [sum(map(len, words_a[: i + 1])) for i in range(len(a))]
        ends_b = [sum(map(len, words_b[: i + 1])) for i in range(len(b))]
        cuts = sorted({*ends_a} & {*ends_b})
        groups.append(
            [
                ([i for i, e in zip(a, ends_a) if low < e <= high], [i for i, e in zip(b, ends_b) if low < e <= high])
                for low, high in zip([0, *cuts], cuts)
            ]
        )
    links = [[(x, y) for xs, ys in g for x in xs for y in ys] for g in groups]
    count = Counter(pair for found in links for pair in set(found))
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for (key, _), g, found in zip(rows, groups, links, strict=True):
        text = ";".join(",".join(map(str, xs)) + "|" + ",".join(map(str, ys)) for xs, ys in g)
        out.append(
            (
                key,
                sum(len(xs) for xs, _ in g),
                sum(len(ys) for _, ys in g),
                len(g),
                len(found),
                sum(count[p] == best[p[0]] for p in found),
                sum(count[p] for p in found),
                hashlib.sha256(text.encode()).hexdigest() if g else "",
            )
        )
    return sorted(out, key=repr)


ODD = [
    None, "", " ", "\n\n x\n", "two  spaces   three", "a▁b", "<|endoftext|> <s> <unk>", "It's we'll o'clock.",
    "日本語 テスト。", "🙂🙂 a🙂.", "\x00\x01 \x1c x", "é é ﬁ \xa0 　x", "aaaaaaaaaaaaaaaaaaaaaaaaaaa", "1234567 89",
    "mark \ue000 inside\ue000 ", "x" * 700, "ab" * 400, "tab\there, and\r\nthere; (so).",
]


def same_as_library(texts):
    ids, count = OWN.encode(pa.array(texts, pa.string()))
    at, found = 0, []
    for n in count:
        found.append(ids[at : at + n].tolist())
        at += n
    assert found == [A.encode(t, add_special_tokens=False).ids for t in texts]


def test_pieces_are_encoded_as_texts_are():
    same_as_library([" " + t for t in ODD if t])
    same_as_library([])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.text(alphabet="aBé., '!?\n\t \xa0 1<|>slet", max_size=30), st.text(max_size=20)), max_size=4))
def test_any_text_is_encoded_as_by_the_library(texts):
    same_as_library(texts)


def test_bytes_of_tokens():
    decoder = decoders.ByteLevel()
    for i in (0, 10, 220, 50_000, 50_255):
        assert OWN.tokens[i].as_py().decode("utf-8", "replace") == decoder.decode([A.id_to_token(i)])


ROWS = [
    *[(i, f"Text {i % 7} of many words, said again and again; naturally {i % 3}.") for i in range(40)],
    *[(100 + i, t) for i, t in enumerate(ODD)],
    (None, "no key"), (None, None), (7, "Text of a repeated key"), (7, "Text of a repeated key"),
]


def rows_of(found):
    return sorted(map(tuple, found.collect()), key=repr)


def test_documents_with_odd_rows(documents):
    docs = documents(ROWS).withColumnRenamed("lang", "pair").withColumnRenamed("source", "chunk")
    assert rows_of(alignment.align(docs, A_PATH, B_PATH)) == plain(ROWS)


def test_small_chunks_and_large_groups(documents, monkeypatch):
    monkeypatch.setattr(alignment, "CHUNK_BYTES", 100)
    monkeypatch.setattr(alignment, "LARGE_GROUP", 2)
    assert rows_of(alignment.align(documents(ROWS), A_PATH, B_PATH)) == plain(ROWS)


def test_counts_by_shuffle(documents, monkeypatch, spark):
    """The same without broadcast joins, as for counts too large for one."""
    monkeypatch.setattr(alignment, "measured_broadcast", lambda df, _: df)
    monkeypatch.setattr(alignment, "CHUNK_BYTES", 300)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows_of(alignment.align(documents(ROWS), A_PATH, B_PATH)) == plain(ROWS)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_very_long_text(documents):
    rows = [(1, "long words, often said. " * 20_000), (2, "日本" * 3000)]
    found = {r["doc_id"]: r for r in alignment.align(documents(rows), A_PATH, B_PATH).collect()}
    assert found[1]["n_a"] == len(A.encode(" " + rows[0][1], add_special_tokens=False).ids)
    assert found[2]["n_b"] == len(B.encode(rows[1][1]))


@pytest.mark.parametrize("rows", [[], [(1, None), (None, "")]])
def test_no_tokens(documents, rows):
    docs = documents(rows or [(1, "x")])
    found = alignment.align(docs if rows else docs.limit(0), A_PATH, B_PATH)
    assert rows_of(found) == plain(rows)


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    short = [tuple(r) for r in table.collect()]
    found = queries.QUERIES["op11_token_alignment"](spark, folder)
    assert found.columns == [
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256",
    ]
    assert rows_of(found) == plain(short)


def test_wide_rows_are_written_and_handed_over_few_at_a_time(spark):
    rows = spark.range(40, numPartitions=1).select(F.expr("transform(sequence(1, 100000), i -> xxhash64(id, i))").alias("x"))
    found = store.stored(rows, wide=True)
    metadata = [pq.ParquetFile(f.removeprefix("file:")).metadata for f in found.inputFiles()]
    assert sum(m.num_rows for m in metadata) == 40
    assert max(m.row_group(i).num_rows for m in metadata for i in range(m.num_row_groups)) <= 12

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int32())})

    before = spark.conf.get(store.BATCH_ROWS)
    with store.rows_a_batch(spark, 2):
        assert max(r.n for r in found.mapInArrow(sizes, "n int").collect()) <= 2
    assert spark.conf.get(store.BATCH_ROWS) == before
