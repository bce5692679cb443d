"""Documents as token ids in grammar-compressed files, in the order of their keys.

1. Each text is encoded once. White space (ASCII) never lies inside a token of a word-level
   vocabulary, so the pieces between white space are encoded once per task, many words in one call
   of the tokenizers library; `Encoder` says which pieces may be cut further.
2. Ranges of keys, from quantiles, are the shards. Rows meet in their shard as ids, not as texts,
   and are sorted there by key.
3. A shard is written in blocks of at least `BLOCK_IDS` ids; a document is never cut by blocks. A
   block's ids are compressed by Re-Pair (`grammar`); a longer block, which one very long document
   makes, has several grammars of about `BLOCK_IDS` ids, so that memory is bounded by ids, not by
   grammars.
4. `read_tokens` expands the blocks; `ids_of` expands a range of one document only.

File format: a Parquet table with a row a block: `shard`, `block` (from 0 in each shard), `begin`
(ids of the shard before the block), `keys` and `sizes` (key and number of ids of each document),
`pieces` (ids of each grammar) and `grammars` (`grammar.pack`).

Null texts count as empty and have the end id only. A null key comes first. Rows with equal keys
are ordered by a checksum of their ids, then by the ids; repeated rows stay rows of their own. The
key is an integer. Other columns are not read. A text must fit a Spark string (2 GB), and its ids a
task's memory.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textsignal.llm.common import measured_broadcast
from textsignal.llm.grammar import _runs as runs
from textsignal.llm.grammar import compress, expand, pack, slice_ids, unpack
from textsignal.llm.pieces import Pieces, kept, slices
from textsignal.llm.store import stored

BLOCK_IDS = 1 << 18
#: Bytes of text of a shard.
SHARD_BYTES = 64 << 20
#: Words in one line.
LINE = 64

#: Words of letters that no normal form changes; words to try; marks; punctuation that ends a piece after a letter
#: and can't belong to an apostrophe form.
ASCII = "^[a-z]+$"
PLAIN = "^[A-Za-zÀ-ÖØ-öø-ÿ]+$"
SAMPLE = ["abcdefghijklmnopqrstuvwxyz", "zyxwvutsrqponmlkjihgfedcba", "the", "a", "unbelievable", "sst"]
MARKS = r"\p{M}"
SIGNS = "([A-Za-zÀ-ÖØ-öø-ÿ])([.,;:!?]+)([ \t\n\v\f\r]|$)"
BLOCKS = (
    "shard int, block int, begin long, keys array<long>, sizes array<long>, pieces array<long>, "
    "grammars array<binary>"
)


@dataclass
class Encoder(Pieces):
    """Ids of texts by a vocabulary that drops white space and marks the ends of words.

    A piece without ASCII white space is encoded as a whole, but for punctuation that follows a
    letter and ends it, which the vocabulary's own rule separates. ASCII letters are lower-cased
    before pieces are looked up if the vocabulary does it, too; not where marks could have combined
    with the capital only. A text with `<|` may hold special tokens and is encoded whole.
    """

    path: str
    mark: str = "</w>"

    def __post_init__(self) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(self.path)
        vocabulary = self.model.get_vocab(with_added_tokens=True)
        self.first = max(vocabulary.values()) + 1
        self.kind = np.uint16 if self.first <= 1 << 16 else np.uint32
        self.ends = np.zeros(self.first, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(self.mark)]] = True
        self.lower = self._ids(["A"])[0] == self._ids(["a"])[0]
        # Whether words of lower-case ASCII letters reach the merges as they are.
        self.bare = all(
            [token.id for token in self.model.model.tokenize(w)] == i
            for w, i in zip(SAMPLE, self._ids(SAMPLE), strict=True)
        )
        self.forget()

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, pieces: pa.Array) -> None:
        """Adds pieces: ASCII words go to the merges at once, others in lines, what is no word alone."""
        plain = pc.match_substring_regex(pieces, PLAIN)
        words, odd = pieces.filter(plain), pieces.filter(pc.invert(plain))
        bare = pc.and_(pc.match_substring_regex(words, ASCII), self.bare)
        words, rest = words.filter(bare), words.filter(pc.invert(bare))
        merged = self.model.model.tokenize
        found = [[token.id for token in merged(word)] for word in words.to_pylist()]
        listed = rest.to_pylist()
        lines = self._ids([" ".join(listed[i : i + LINE]) for i in range(0, len(listed), LINE)])
        ids = np.fromiter(chain.from_iterable(lines), self.kind)
        after = np.flatnonzero(self.ends[ids]) + 1
        if len(after) != len(rest) or len(ids) and after[-1] != len(ids):
            raise ValueError(f"{self.path} does not mark the ends of words by {self.mark}")
        alone = self._ids(odd.to_pylist())
        self.add(words, found)
        self.add(rest, ids, np.diff(after, prepend=0))
        self.add(odd, alone)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, and the number of ids of each text."""
        texts = pc.fill_null(texts, "")
        special = pc.match_substring(texts, "<|")
        cut = pc.if_else(special, "", texts)
        if self.lower:
            cut = pc.if_else(pc.match_substring_regex(cut, MARKS), cut, pc.ascii_lower(cut))
        lists = pc.ascii_split_whitespace(pc.replace_substring_regex(cut, SIGNS, r"\1 \2\3"))
        found, count = self.looked_up(lists)
        whole = {i: self._ids([texts[i].as_py()])[0] for i in pc.indices_nonzero(special).to_pylist()}
        return self.put(found, count, whole)


def _encoded(
    docs: DataFrame, key: str, text: str, path: str, end: int, shard_bytes: int
) -> tuple[DataFrame, int]:
    """Rows (shard, key, tie, ids), and the number of shards."""
    rows = docs.select(docs[key].cast("long").alias("key"), docs[text].cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // shard_bytes))
    # One number a shard comes to the driver, as many as there are tasks.
    shares = [i / n for i in range(1, n)]
    bounds = rows.agg(F.percentile_approx("key", shares, 20 * n)).first()[0] if shares else None
    bounds = np.array(bounds or [], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = kept(Encoder, path)
        for batch in batches:
            for a, b in slices(batch.column(1)):
                keys, texts = batch.column(0)[a:b], batch.column(1)[a:b]
                ids, count = made.encode(texts)
                stop = np.cumsum(count + 1)
                whole = np.full(int(stop[-1]), end, made.kind)
                inner = np.ones(len(whole), bool)
                inner[stop - 1] = False
                whole[inner] = ids
                data = whole.tobytes()
                wide = whole.itemsize
                cuts = np.concatenate([[0], stop]) * wide
                packed = [data[x:y] for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
                tie = np.array([zlib.crc32(p) for p in packed], np.int64)
                value = pc.fill_null(keys, 0).to_numpy(zero_copy_only=False)
                low = np.searchsorted(bounds, value, "left")
                more = np.searchsorted(bounds, value, "right") - low
                # A key that fills several ranges is spread over them in the order of the ties.
                shard = low + (tie * (more + 1) >> 32)
                shard[keys.is_null().to_numpy(zero_copy_only=False)] = 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard, pa.int32()), keys, pa.array(tie), pa.array(packed, pa.binary())],
                    names=["shard", "key", "tie", "ids"],
                )

    return rows.mapInArrow(run, "shard int, key long, tie long, ids binary"), n


def _block(shard: int, block: int, begin: int, keys: list, texts: list[bytes], first: int, kind: type):
    """A row of the files."""
    sizes = np.array([len(t) for t in texts], np.int64) // np.dtype(kind).itemsize
    ids = np.frombuffer(b"".join(texts), kind)
    last = np.zeros(len(ids), bool)
    last[np.cumsum(sizes) - 1] = True
    n = max(1, len(ids) // BLOCK_IDS)
    cuts = np.linspace(0, len(ids), n + 1).astype(int)
    grammars = [pack(compress(ids[a:b], last[a:b], first)[0]) for a, b in zip(cuts[:-1], cuts[1:])]
    values = (shard, block, begin, keys, sizes, np.diff(cuts), grammars)
    kinds = (pa.int32(), pa.int32(), pa.int64(), *[pa.list_(pa.int64())] * 3, pa.list_(pa.binary()))
    names = ("shard", "block", "begin", "keys", "sizes", "pieces", "grammars")
    return pa.RecordBatch.from_arrays(
        [pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=list(names)
    )


def token_blocks(
    docs: DataFrame,
    path: str,
    end: int,
    key: str = "doc_id",
    text: str = "text",
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """The blocks of all documents, to be written by `write_tokens`. `end` is the id after each."""
    rows, n = _encoded(docs, key, text, path, end, shard_bytes)
    order = ("shard", F.asc_nulls_first("key"), "tie", "ids")
    made = kept(Encoder, path)
    first, kind = made.first, made.kind

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block, begin, size = -1, 0, 0, 0
        keys, texts = [], []
        for batch in batches:
            columns = [batch.column(i) for i in (0, 1, 3)]
            for s, k, t in zip(*columns):
                s, t = s.as_py(), t.as_py()
                if texts and (s != shard or size >= BLOCK_IDS * kind().itemsize):
                    yield _block(shard, block, begin, keys, texts, first, kind)
                    block, begin = block + 1, begin + size // kind().itemsize
                    keys, texts, size = [], [], 0
                if s != shard:
                    shard, block, begin = s, 0, 0
                keys.append(k.as_py())
                texts.append(t)
                size += len(t)
        if texts:
            yield _block(shard, block, begin, keys, texts, first, kind)

    return rows.repartition(n, "shard").sortWithinPartitions(*order).mapInArrow(run, BLOCKS)


def write_tokens(docs: DataFrame, to: str, path: str, end: int, **named) -> None:
    """Writes the blocks to the folder `to`, which all machines must reach."""
    token_blocks(docs, path, end, **named).write.mode("overwrite").parquet(to)


def read_tokens(blocks: DataFrame) -> DataFrame:
    """A row a document: `key`, `start` (ids of all documents before it), `n_tokens`, `ids`
    (unsigned, 32 bits, little endian)."""
    total = blocks.select("shard", F.aggregate("sizes", F.lit(0).cast("long"), lambda a, b: a + b).alias("n"))
    total = total.groupBy("shard").agg(F.sum("n").alias("n"))
    # One row a shard, which is one a task.
    before = total.selectExpr("shard", "sum(n) OVER (ORDER BY shard) - n AS before")
    joined = blocks.join(measured_broadcast(before, 24), "shard").select(
        "keys", "sizes", "grammars", (F.col("before") + F.col("begin")).alias("start")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                keys, sizes, grammars, start = (c[i] for c in batch.columns)
                n = sizes.values.to_numpy(zero_copy_only=False).astype(np.int64)
                parts = [expand(unpack(g.as_py())).astype("<u4") for g in grammars.values]
                data = np.concatenate(parts).tobytes()
                stop = np.cumsum(n)
                cuts = np.concatenate([[0], 4 * stop]).tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.values,
                        pa.array(start.as_py() + stop - n, pa.int64()),
                        pa.array(n, pa.int64()),
                        pa.array([data[a:b] for a, b in zip(cuts, cuts[1:])], pa.binary()),
                    ],
                    names=["key", "start", "n_tokens", "ids"],
                )

    return joined.mapInArrow(run, "key long, start long, n_tokens long, ids binary")


def ids_of(block: dict, document: int, begin: int, end: int) -> np.ndarray:
    """Ids `begin` to `end` - 1 of a block's document, without expanding the rest of the block."""
    before = sum(block["sizes"][:document])
    end = min(end, block["sizes"][document])
    found, at = [], 0
    for n, data in zip(block["pieces"], block["grammars"], strict=True):
        a, b = max(0, before + begin - at), min(n, before + end - at)
        if a < b:
            found.append(slice_ids(unpack(bytes(data)), a, b))
        at += n
    return np.concatenate(found) if found else np.zeros(0, np.uint32)


def token_digests(docs: DataFrame, path: str, end: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes the files to the shared folder and reads them back: key, start, n_tokens, ids_crc32."""
    blocks = stored(token_blocks(docs, path, end, key, text))
    return read_tokens(blocks).select(
        F.col("key").alias(key), "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )
