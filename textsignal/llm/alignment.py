"""Tokens of two vocabularies aligned by the bytes they cover, as an Arrow pipeline.

A: byte-level BPE of the tokenizers library, over a space and the text. B: a sentencepiece model,
which adds that space itself. Both cover the same bytes; where a token of each ends, a group ends.
A pair of tokens of a group is a link.

1. A task takes texts in chunks. Lists of ids are flattened; parent indices and cumulative sums of
   token lengths, taken within each document, give the end of every token. A hash join of Acero on
   these ends finds the common ones.
2. Links of a document are grouped by their ids (`Table.group_by`), and then those of the chunk:
   in how many documents a pair occurs. A chunk is a row: its documents, their distinct links as
   numbers of pairs of the chunk, and its pairs with their partial counts.
3. Spark adds up the partial counts, and finds the highest of each A id. The counts go back to the
   chunks, one row a chunk and pair, not one a link.
4. A chunk's documents add up the counts of their links.

Chunks are written, read and handed over a few at a time, so that a task's memory depends on the
size of a chunk and not on that of its share of the texts.

Null and empty texts, and those whose tokens of A or B don't make up exactly the space and the text,
have no tokens: all numbers are 0 and the digest is empty. Special tokens in a text are plain text.
Repeated rows are documents of their own, with null keys, too. Other columns are not read. A text
must fit a Spark string (2 GB) and its tokens a task's memory; a group's pairs of ids are made from
its distinct ids, so that a long text in which no ends are common needs no more than those.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textsignal.llm.common import measured_broadcast
from textsignal.llm.grammar import _runs as runs
from textsignal.llm.pieces import Pieces, kept, slices
from textsignal.llm.store import rows_a_batch, stored

#: Bytes of text of a chunk.
CHUNK_BYTES = 2 << 20
#: Pieces that a process remembers for each vocabulary; it holds two.
KNOWN_PIECES = 1 << 19
#: Chunks that Spark hands to Python at once.
CHUNKS_AT_ONCE = 2
#: Links of a group above which they are made from its distinct ids.
LARGE_GROUP = 256

#: White space of Unicode, a mark that no text has (those that have it are encoded whole), and the
#: places where a token of A always ends: before white space, and between a letter and punctuation
#: that can't belong to an apostrophe form.
WHITE = r"\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
MARK = "\ue000"
CUTS = (rf"([^{WHITE}])([{WHITE}])", r"(\p{L})([.,;:!?])")

#: Words that are one token of A's rule, and words to try.
ASCII = "^ ?[A-Za-z]+$"
SAMPLE = ["a", " the", " Unbelievable", "zyxwvut", " abcdefghijklmnopqrstuvwxyz"]

DOCUMENT = "key long, n_a long, n_b long, n_groups long, n_links long, digest string, distinct long"
CHUNKS = (
    f"chunk long, documents array<struct<{DOCUMENT.replace(' ', ':').replace(',:', ',')}>>, "
    "links array<int>, times array<long>, pairs array<int>, held array<long>"
)


class ByteLevel(Pieces):
    """Vocabulary A: its ids of texts, and the bytes of its tokens."""

    kind = np.int32
    most = KNOWN_PIECES

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        # The usual letters of bytes: printable ones stand for themselves, others follow from 256 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        letters = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        vocabulary = self.model.get_vocab(with_added_tokens=True)
        tokens = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            plain = all(c in letters for c in token)
            tokens[i] = bytes(letters[c] for c in token) if plain else token.encode()
        self.tokens = pa.array(tokens, pa.binary())
        self.space = chr(256 + ord(" "))
        self.forget()
        # Whether a word of ASCII letters, with or without a space, reaches the merges whole.
        self.bare = [self._merged(w) for w in SAMPLE] == self._ids(SAMPLE)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def _merged(self, word: str) -> list[int]:
        return [token.id for token in self.model.model.tokenize(word.replace(" ", self.space))]

    def learn(self, pieces: pa.Array) -> None:
        bare = pc.and_(pc.match_substring_regex(pieces, ASCII), self.bare)
        words, odd = pieces.filter(bare), pieces.filter(pc.invert(bare))
        self.add(words, [self._merged(word) for word in words.to_pylist()])
        self.add(odd, self._ids(odd.to_pylist()))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of texts in a row, and the number of ids of each."""
        special = pc.match_substring(texts, MARK)
        cut = pc.if_else(special, "", texts)
        for place in CUTS:
            cut = pc.replace_substring_regex(cut, place, rf"\1{MARK}\2")
        found, count = self.looked_up(pc.split_pattern(cut, MARK))
        whole = {i: self._ids([texts[i].as_py()])[0] for i in pc.indices_nonzero(special).to_pylist()}
        return self.put(found, count, whole)


class PieceModel(Pieces):
    """Vocabulary B: its ids of texts with a space before them, and the bytes of its pieces.

    No piece has a space behind another letter, so texts are cut before spaces.
    """

    kind = np.int32
    most = KNOWN_PIECES

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        tokens = []
        for i in range(self.model.vocab_size()):
            piece = self.model.id_to_piece(i)
            byte = self.model.is_byte(i)
            tokens.append(bytes([int(piece[3:-1], 16)]) if byte else piece.replace("▁", " ").encode())
        if any(b" " in token.lstrip(b" ") for token in tokens):
            raise ValueError(f"{path} has pieces with a space inside")
        self.tokens = pa.array(tokens, pa.binary())
        self.alone = [self.model.piece_to_id("▁")]
        self.forget()

    def learn(self, pieces: pa.Array) -> None:
        # The model adds the first space itself, but to an empty text.
        rest = pc.utf8_slice_codeunits(pieces, 1).to_pylist()
        self.add(pieces, [i if r else self.alone for i, r in zip(self.model.encode(rest, num_threads=1), rest)])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of texts, each of which begins with the added space, and the number of each."""
        special = pc.match_substring(texts, MARK)
        cut = pc.if_else(special, " ", texts)
        cut = pc.replace_substring_regex(cut, "([^ ])( )", rf"\1{MARK}\2")
        found, count = self.looked_up(pc.split_pattern(cut, MARK))
        marked = pc.indices_nonzero(special).to_pylist()
        return self.put(found, count, {i: self.model.encode(texts[i].as_py()[1:]) for i in marked})


def _lists(ids: np.ndarray, count: np.ndarray) -> pa.ListArray:
    cuts = np.concatenate([[0], np.cumsum(count)])
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids, pa.int32()))


def _covers(ids: np.ndarray, count: np.ndarray, tokens: pa.Array, texts: list[bytes]) -> np.ndarray:
    """Whether the joined bytes of each text's tokens are the text."""
    joined = tokens.take(pa.array(ids))
    offsets = np.frombuffer(joined.buffers()[1], np.int32, len(joined) + 1) if len(joined) else np.zeros(1, int)
    data = memoryview(joined.buffers()[2] or b"").cast("B")
    cuts = offsets[np.concatenate([[0], np.cumsum(count)])].tolist()
    return np.array([data[a:b] == t for a, b, t in zip(cuts, cuts[1:], texts)], bool)


def _ends(lists: pa.ListArray, sizes: np.ndarray, bases: np.ndarray) -> pa.Table:
    """Ends of all tokens, counted over the chunk's bytes, and their places.

    The cumulative sum is taken within a document: what stands before its first token goes, and the
    bytes before the document come.
    """
    ids, parents = pc.list_flatten(lists), pc.list_parent_indices(lists)
    total = pc.cumulative_sum(pa.array(sizes[ids.to_numpy()], pa.int64()))
    before = np.concatenate([[0], total.to_numpy()])[lists.offsets.to_numpy()[:-1]]
    end = pc.add(total, pa.array(bases - before).take(parents))
    return pa.table({"end": end, "place": pa.array(np.arange(len(ids)))})


def _texts_of(ids: np.ndarray, cuts: np.ndarray, numbers: pa.Array) -> pa.Array:
    """Decimal ids of each group, with commas."""
    lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), numbers.take(pa.array(ids)))
    return pc.binary_join(lists, ",")


def _links(
    a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, document: np.ndarray
) -> pa.Table:
    """Distinct links of each document with their occurrences: document, pair, times.

    `a`, `b` are the ids of the groups in a row, `n_a`, `n_b` and `document` say how many each group
    has, and whose it is.
    """
    begin_a, begin_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    small = n_a * n_b <= LARGE_GROUP
    g = np.flatnonzero(small)
    # Each A token with all B tokens of its group.
    token = runs(begin_a[g], n_a[g])
    owner = np.repeat(g, n_a[g])
    other = runs(begin_b[owner], n_b[owner])
    pair = np.repeat(a[token].astype(np.int64) << 16, n_b[owner]) | b[other]
    whose = np.repeat(document[owner], n_b[owner])
    parts = [(whose, pair, np.ones(len(pair), np.int64))]
    for k in np.flatnonzero(~small).tolist():
        x, times_x = np.unique(a[begin_a[k] : begin_a[k] + n_a[k]], return_counts=True)
        y, times_y = np.unique(b[begin_b[k] : begin_b[k] + n_b[k]], return_counts=True)
        pair = (x.astype(np.int64)[:, None] << 16 | y[None, :]).ravel()
        parts.append((np.full(len(pair), document[k]), pair, (times_x[:, None] * times_y).ravel()))
    columns = [np.concatenate(c) for c in zip(*parts)]
    links = pa.table(dict(zip(("document", "pair", "n"), columns)))
    return links.group_by(["document", "pair"], use_threads=False).aggregate([("n", "sum")])


def aligned(
    keys: pa.Array, texts: pa.Array, a_model: ByteLevel, b_model: PieceModel, numbers: pa.Array
) -> dict[str, object]:
    """A chunk: numbers of its documents, their distinct links, and its pairs."""
    n = len(texts)
    plain = pc.fill_null(texts, "")
    rows = np.flatnonzero(pc.not_equal(plain, "").to_numpy(zero_copy_only=False))
    asked = plain.take(pa.array(rows))
    spaced = pc.binary_join_element_wise("", asked, " ") if len(rows) else asked
    data = spaced.cast(pa.binary()).to_pylist()
    a, count_a = a_model.encode(spaced)
    b, count_b = b_model.encode(spaced)
    good = _covers(a, count_a, a_model.tokens, data) & _covers(b, count_b, b_model.tokens, data)
    a, b = a[np.repeat(good, count_a)], b[np.repeat(good, count_b)]
    count_a, count_b, rows = count_a[good], count_b[good], rows[good]
    size = np.array([len(t) for t, g in zip(data, good, strict=True) if g], np.int64)
    bases = np.cumsum(size) - size
    size_a, size_b = (pc.binary_length(m.tokens).to_numpy() for m in (a_model, b_model))
    lists_a, lists_b = _lists(a, count_a), _lists(b, count_b)
    ends_a, ends_b = _ends(lists_a, size_a, bases), _ends(lists_b, size_b, bases)
    common = ends_a.join(ends_b, "end", join_type="inner", right_suffix="_b", use_threads=False)
    # In each list only one token ends at a byte, and ends rise with places.
    last_a = np.sort(common["place"].to_numpy())
    last_b = np.sort(common["place_b"].to_numpy())
    cuts_a, cuts_b = (np.concatenate([[0], x + 1]).astype(np.int64) for x in (last_a, last_b))
    n_a, n_b = np.diff(cuts_a), np.diff(cuts_b)
    parent = pc.list_parent_indices(lists_a).to_numpy()
    document = parent[last_a] if len(last_a) else np.zeros(0, np.int64)
    groups = np.bincount(document, minlength=len(rows))
    n_links = np.bincount(document, n_a * n_b, len(rows))
    pairs_text = pc.binary_join_element_wise(
        _texts_of(a, cuts_a, numbers), _texts_of(b, cuts_b, numbers), "|"
    )
    offsets = np.concatenate([[0], np.cumsum(groups)])
    whole = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pairs_text), ";")
    digests = [hashlib.sha256(t.as_buffer()).hexdigest() for t in whole]
    links = _links(a, b, n_a, n_b, document)
    held = links.group_by("pair", use_threads=False).aggregate([([], "count_all")]).sort_by("pair")
    pairs = held["pair"].to_numpy()
    order = np.argsort(links["document"].to_numpy(), kind="stable")
    whose = links["document"].to_numpy()[order]

    def column(values: object, kind: type = np.int64) -> np.ndarray:
        full = np.zeros(n, kind)
        full[rows] = values
        return full

    numbers_of = (count_a, count_b, groups, n_links, np.bincount(whose, minlength=len(rows)))
    full = [column(v) for v in numbers_of]
    text = np.full(n, "", object)
    text[rows] = digests
    return {
        "documents": pa.StructArray.from_arrays(
            [keys, *(pa.array(c) for c in full[:4]), pa.array(text, pa.string()), pa.array(full[4])],
            names=["key", "n_a", "n_b", "n_groups", "n_links", "digest", "distinct"],
        ),
        "links": pa.array(np.searchsorted(pairs, links["pair"].to_numpy()[order]), pa.int32()),
        "times": pa.array(links["n_sum"].to_numpy()[order], pa.int64()),
        # Ids have 16 bits each; a pair may look negative.
        "pairs": pa.array(pairs.astype(np.uint32).view(np.int32), pa.int32()),
        "held": pa.array(held["count_all"].to_numpy(), pa.int64()),
    }


def chunks(
    docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Rows of `CHUNKS`: the documents of a chunk, their links, its pairs and their documents."""
    rows = docs.select(docs[key].cast("long").alias("key"), docs[text].cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_model, b_model = kept(ByteLevel, a_path), kept(PieceModel, b_path)
        most = max(len(a_model.tokens), len(b_model.tokens))
        if most > 1 << 16:
            raise ValueError("ids must fit 16 bits")
        numbers = pa.array([str(i) for i in range(most)], pa.string())
        number = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
        for batch in batches:
            for x, y in slices(batch.column(1), CHUNK_BYTES):
                found = aligned(batch.column(0)[x:y], batch.column(1)[x:y], a_model, b_model, numbers)
                columns = {"chunk": pa.array([number], pa.int64())}
                for name, values in found.items():
                    columns[name] = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
                yield pa.RecordBatch.from_pydict(columns)
                number += 1
                del found, columns
                pa.default_memory_pool().release_unused()

    return rows.mapInArrow(run, CHUNKS)


def pair_counts(made: DataFrame) -> DataFrame:
    """`pair`, `n` (documents that hold it linked) and `best` (highest of its A id)."""
    each = made.select(F.explode(F.arrays_zip("pairs", "held")).alias("p")).select("p.*")
    counts = each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("held").alias("n"))
    # An A id has at most as many pairs as B has ids.
    return counts.select(
        "pair",
        "n",
        F.expr("n = max(n) OVER (PARTITION BY shiftrightunsigned(pair, 16))").alias("best"),
    )


def align(
    docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """A row a document: key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    `n_best` counts the links whose pair has the highest count of its A id, ties included;
    `count_sum` adds up the counts of all links.
    """
    made = stored(chunks(docs, a_path, b_path, key, text), wide=True)
    counts = stored(pair_counts(made))
    asked = made.select("chunk", F.posexplode("pairs").alias("place", "pair"))
    answers = (
        asked.join(measured_broadcast(counts, 32), "pair")
        .groupBy("chunk")
        .agg(F.array_sort(F.collect_list(F.struct("place", "n", "best"))).alias("counts"))
    )
    joined = made.join(answers, "chunk", "left").select(
        "documents", "links", "times", F.col("counts.n").alias("n"), F.col("counts.best").alias("best")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                documents, links, times, n, best = (c[i].values for c in batch.columns)
                distinct = documents.field("distinct").to_numpy()
                whose = np.repeat(np.arange(len(distinct)), distinct)
                if links is None or not len(links):
                    links, times, n, best = (np.zeros(0, np.int64) for _ in range(4))
                else:
                    links, times, n = (x.to_numpy(zero_copy_only=False) for x in (links, times, n))
                    best = best.to_numpy(zero_copy_only=False)
                total, marked = np.zeros((2, len(distinct)), np.int64)
                np.add.at(total, whose, times * n[links])
                np.add.at(marked, whose, times * best[links])
                names = ("key", "n_a", "n_b", "n_groups", "n_links")
                yield pa.RecordBatch.from_arrays(
                    [
                        *(documents.field(name) for name in names),
                        pa.array(marked),
                        pa.array(total),
                        documents.field("digest"),
                    ],
                    names=[*names, "n_best", "count_sum", "groups_sha256"],
                )

    schema = "key long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    # A row is a chunk of megabytes; without the bound a batch would be a task's whole share.
    with rows_a_batch(docs.sparkSession, CHUNKS_AT_ONCE):
        return stored(joined.mapInArrow(run, schema).withColumnRenamed("key", key))
