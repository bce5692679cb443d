"""Sets of word shingles as hashes, for many texts at once."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

#: Bytes of text handled at once.
PIECE = 1 << 20
WORDS = 5

_ROOT = 0x9E3779B97F4A7C15
_FACTORS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
    np.uint64,
)
_powers: list[np.ndarray] = []


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers; different numbers stay different."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2^64, and of its inverse, from 0 to n."""
    if not _powers or len(_powers[0]) <= n:
        size = max(n, PIECE) + 2
        _powers.clear()
        for root in (_ROOT, pow(_ROOT, -1, 1 << 64)):
            steps = np.full(size, root, np.uint64)
            steps[0] = 1
            _powers.append(np.cumprod(steps, dtype=np.uint64))
    return _powers[0], _powers[1]


def _lowered(data: bytes) -> np.ndarray:
    b = np.frombuffer(data, np.uint8)
    return np.where((b >= 65) & (b <= 90), b + 32, b)


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a text, A-Z lower-cased, and where they start."""
    b = _lowered(data)
    is_word = ~((b == 32) | ((b >= 9) & (b <= 13)))
    edge = np.diff(np.concatenate([[0], is_word.view(np.int8), [0]]))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _power_tables(len(b))
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[: len(b)], out=total[1:])
    return mixed((total[ends] - total[starts]) * down[starts]), starts


def _pieces(data: bytes) -> Iterator[bytes]:
    """A long text cut at white space."""
    at = 0
    while len(data) - at > PIECE:
        cut = max(data.rfind(s, at, at + PIECE) for s in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
        if cut < at:  # one very long word
            found = [data.find(s, at + PIECE) for s in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")]
            cut = min([f for f in found if f >= 0], default=len(data))
        yield data[at:cut]
        at = cut
    yield data[at:]


def _sets(words: np.ndarray, of: np.ndarray, n: int) -> list[np.ndarray]:
    """The shingle sets of n texts; `of` is the text of each word."""
    sizes = np.bincount(of, minlength=n)
    ends = np.cumsum(sizes)
    k = len(words) - WORDS + 1
    shingles = np.zeros(max(k, 0), np.uint64)
    for i in range(WORDS):
        if k > 0:
            shingles += words[i : i + k] * _FACTORS[i]
    shingles = mixed(shingles)
    made = []
    for size, end in zip(sizes.tolist(), ends.tolist(), strict=True):
        if size >= WORDS:
            made.append(np.unique(shingles[end - size : end - WORDS + 1]))
        elif size:
            whole = (words[end - size : end] * _FACTORS[:size]).sum(dtype=np.uint64)
            made.append(mixed(np.array([whole + np.uint64(size)], np.uint64)))
        else:
            made.append(np.zeros(0, np.uint64))
    return made


def shingle_sets(texts: Sequence[str | None]) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The sorted shingle sets of texts, in groups: the place of the first one, and the sets.

    A set has the distinct runs of five words, or the whole text if that is shorter; it is empty
    without words.
    """
    group: list[bytes] = []
    size, first = 0, 0

    def done() -> tuple[int, list[np.ndarray]]:
        joined = b" ".join(group)
        words, starts = word_hashes(joined)
        ends = np.cumsum([len(g) + 1 for g in group])
        return first, _sets(words, np.searchsorted(ends, starts, side="right"), len(group))

    for i, text in enumerate(texts):
        data = (text or "").encode("utf-8", "surrogatepass")
        if len(data) > PIECE:
            if group:
                yield done()
            words = np.concatenate([word_hashes(p)[0] for p in _pieces(data)])
            yield i, _sets(words, np.zeros(len(words), np.int64), 1)
            group, size, first = [], 0, i + 1
            continue
        if size + len(data) > PIECE and group:
            yield done()
            group, size, first = [], 0, i
        group.append(data)
        size += len(data) + 1
    if group:
        yield done()


def digest(shingles: np.ndarray) -> int:
    """A 64-bit hash of a set, as a signed number."""
    values = mixed(shingles + np.uint64(len(shingles)))
    total = mixed(np.array([values.sum(dtype=np.uint64) ^ np.uint64(len(shingles))], np.uint64))
    return int(total.view(np.int64)[0])
