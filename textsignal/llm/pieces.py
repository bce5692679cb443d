"""Ids of texts by way of their distinct pieces, each of which is encoded once."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from itertools import chain
from types import ModuleType
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from textsignal.llm.grammar import _runs as runs

#: Bytes of text encoded at once, and pieces that a process remembers.
PIECE_BYTES = 8 << 20
KNOWN = 1 << 20


class Pieces:
    """Known pieces with their ids. A subclass has `kind` (type of an id) and `learn`."""

    kind: type
    most = KNOWN

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat = np.zeros(0, self.kind)
        self.sizes = np.zeros(0, np.int64)

    def learn(self, pieces: pa.Array) -> None:
        """Encodes pieces, and adds them."""
        raise NotImplementedError

    def add(self, pieces: pa.Array, ids: list[list[int]] | np.ndarray, sizes: np.ndarray | None = None):
        """Adds pieces, each with a list of ids, or with all their ids in a row and their numbers."""
        if sizes is None:
            sizes = np.array([len(i) for i in ids], np.int64)
            ids = np.fromiter(chain.from_iterable(ids), self.kind)
        self.known.update(zip(pieces.to_pylist(), range(len(self.known), len(self.known) + len(pieces))))
        self.flat = np.concatenate([self.flat, ids])
        self.sizes = np.concatenate([self.sizes, sizes])

    def looked_up(self, lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of lists of pieces in a row, and the number of ids of each list."""
        coded = lists.flatten().dictionary_encode()
        if len(self.known) > self.most:
            self.forget()
        asked = coded.dictionary.to_pylist()
        self.learn(pa.array([piece for piece in asked if piece not in self.known], pa.string()))
        place = np.fromiter(map(self.known.__getitem__, asked), np.int64, len(asked))
        use = place[coded.indices.to_numpy(zero_copy_only=False)]
        begin = np.cumsum(self.sizes) - self.sizes
        found = self.flat[runs(begin[use], self.sizes[use])]
        after = np.concatenate([[0], np.cumsum(self.sizes[use])])
        first = lists.offsets.to_numpy()
        return found, np.diff(after[first - first[0]]).astype(np.int64)

    def put(
        self, ids: np.ndarray, count: np.ndarray, whole: dict[int, list[int]]
    ) -> tuple[np.ndarray, np.ndarray]:
        """The ids with those of some texts put in their places."""
        if not whole:
            return ids, count
        at = np.cumsum(count) - count
        parts = [
            np.array(whole[i], self.kind) if i in whole else ids[at[i] : at[i] + count[i]]
            for i in range(len(count))
        ]
        return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)


def kept(make: type, *named: Any) -> Any:
    """One object in a process for given arguments: tasks that follow know what those before learned."""
    held = sys.modules.setdefault(f"{__name__}.kept", ModuleType("kept")).__dict__
    name = repr((make.__name__, named))
    if name not in held:
        held[name] = make(*named)
    return held[name]


def slices(texts: pa.Array, most: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about `most` bytes."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    group = np.concatenate([[0], np.cumsum(size)[:-1]]) // most
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(size)]
    return ((a, b) for a, b in zip(cuts, cuts[1:]) if a < b)
