"""Suffix arrays of many short byte strings at once, and anchors of their windows."""

from __future__ import annotations

import numpy as np

from textsignal.llm.shingles import mixed

_ROOTS = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}
#: Bytes of the grams that serve as anchors.
GRAM = 24
LOW = np.uint64(127)


def _powers(root: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2^64, and of its inverse, from 0 to n."""
    if root not in _tables or len(_tables[root][0]) <= n:
        made = []
        for base in (root, pow(root, -1, 1 << 64)):
            steps = np.full(max(n, 1 << 16) + 1, base, np.uint64)
            steps[0] = 1
            made.append(np.cumprod(steps, dtype=np.uint64))
        _tables[root] = (made[0], made[1])
    return _tables[root]


class Sums:
    """Hashes of substrings of a text, from running sums."""

    def __init__(self, data: np.ndarray, root: int = _ROOTS[0]) -> None:
        up, self.down = _powers(root, len(data))
        self.total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=self.total[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.total[ends] - self.total[starts]) * self.down[starts])


def _least(values: np.ndarray, span: int, n: int) -> np.ndarray:
    """The least of `span` values, from each of the first n places on."""
    padded = np.full(-(-len(values) // span) * span, np.uint64(2**64 - 1))
    padded[: len(values)] = values
    rows = padded.reshape(-1, span)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[span - 1 : span - 1 + n])


def window_keys(data: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, Sums]:
    """For every window of a text the least gram in it: hash, and in the low bits its place.

    Equal windows have equal hashes, wherever they stand. Also whether the gram occurs in the window
    more than once: only then can a window equal one that overlaps it in the gram.
    """
    sums = Sums(data)
    at = np.arange(len(data) - GRAM + 1)
    grams = sums.of(at, at + GRAM) & ~LOW
    code = at.astype(np.uint64) & LOW
    span, n = window - GRAM + 1, len(data) - window + 1
    keys = _least(grams | code, span, n)
    other = _least(grams | (LOW - code), span, n)
    return keys, (keys & LOW) != LOW - (other & LOW), sums


def suffix_array(data: np.ndarray, ends: np.ndarray, longest: int) -> np.ndarray:
    """All suffixes of the strings in `data`, sorted; `ends` has the end of each byte's string.

    Larsson and Sadakane: suffixes are grouped by their first bytes, and only groups of several
    are sorted on, by the group that the suffix belongs to that begins where the known part ends.
    Each round doubles the known part. Equal suffixes stand in the order of their places.
    """
    n = len(data)
    key = np.zeros(n, np.uint64)
    step = 7
    place = np.arange(n)
    for i in range(step):
        inside = place + i < ends
        byte = np.zeros(n, np.uint64)
        byte[inside] = data[(place + i)[inside]].astype(np.uint64) + np.uint64(1)
        key = (key << np.uint64(9)) | byte
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    group = np.empty(n, np.int64)  # of each suffix: where its group begins in the order
    first = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    group[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    while step < longest:
        starts = np.flatnonzero(first)
        size = np.diff(np.concatenate([starts, [n]]))
        open_slots = np.flatnonzero(np.repeat(size > 1, size))
        if not len(open_slots):
            break
        some = order[open_slots]
        further = some + step
        inside = further < ends[some]
        second = np.zeros(len(some), np.int64)
        second[inside] = group[further[inside]] + 1
        both = group[some] * np.int64(n + 1) + second
        by = np.argsort(both, kind="stable")
        order[open_slots] = some[by]
        both = both[by]
        new = np.concatenate([[True], both[1:] != both[:-1]])
        first[open_slots] = new
        head = np.maximum.accumulate(np.where(first, np.arange(n), 0))
        group[order[open_slots]] = head[open_slots]
        step *= 2
    return order


def common_prefixes(
    data: np.ndarray, begins: np.ndarray, lengths: np.ndarray, order: np.ndarray, most: int
) -> np.ndarray:
    """Of each suffix that has `most` bytes: what it has in common with the one before it, at most
    `most`; 0 for the others.

    Kasai: a suffix has at most one byte less in common with its neighbour than the suffix that
    begins one byte earlier has. The strings are gone through side by side.
    """
    n = len(data)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    ends = begins + lengths
    end_of = np.repeat(ends, lengths)
    common = np.zeros(n, np.int64)
    by_length = np.argsort(-lengths, kind="stable")
    known = np.zeros(len(begins), np.int64)
    last = int(lengths.max()) - most if len(lengths) else -1
    for offset in range(last + 1):
        here = by_length[: np.searchsorted(-lengths[by_length], -(most + offset), side="right")]
        at = begins[here] + offset
        other = before[at]
        has = np.where(other >= 0, np.maximum(known[here] - 1, 0), 0)
        room = np.minimum(most, np.where(other >= 0, end_of[other] - other, 0))
        going = np.flatnonzero(has < room)
        while len(going):
            same = data[at[going] + has[going]] == data[other[going] + has[going]]
            going = going[same]
            has[going] += 1
            going = going[has[going] < room[going]]
        common[at] = has
        known[here] = has
    return common


def repeated(
    data: np.ndarray, begins: np.ndarray, lengths: np.ndarray, window: int
) -> tuple[np.ndarray, np.ndarray]:
    """Whether each window of the strings equals one that begins earlier; and which places have one.

    Both are by the place of the window's first byte.
    """
    ends = np.repeat(begins + lengths, lengths)
    order = suffix_array(data, ends, int(lengths.max()))
    common = common_prefixes(data, begins, lengths, order, window)
    whole = np.arange(len(data)) + window <= ends
    order = order[whole[order]]
    again = np.zeros(len(data), bool)
    if len(order):
        starts = np.flatnonzero(common[order] < window)
        starts = starts if len(starts) and starts[0] == 0 else np.concatenate([[0], starts])
        least = np.minimum.reduceat(order, starts)
        sizes = np.diff(np.concatenate([starts, [len(order)]]))
        again[order] = order != np.repeat(least, sizes)
    return again, whole


def window_names(data: np.ndarray, places: np.ndarray, window: int) -> np.ndarray:
    """128-bit names of windows, as rows of two numbers."""
    return np.stack([Sums(data, r).of(places, places + window) for r in _ROOTS], axis=1)
