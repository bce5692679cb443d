"""Re-Pair in rounds: frequent pairs of neighbouring symbols become rules until no pair is frequent.

A round counts all pairs and takes those that occur at least `SHARE` times as often as the most
frequent one. Of occurrences that overlap, the one of the more frequent pair is replaced, ties by
the pair itself. A pair has one rule for good. With `share=1` a round takes the most frequent pairs
only, which is Re-Pair's own order.

Symbols below `first` are ids; the others are rules, in the order in which they were made. Pairs
never cross the end of a document, so a document is a range of symbols.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: A pair with fewer occurrences in a sequence is not worth a rule.
LEAST = 32
SHARE = 0.125
#: Bits of the hash under which pairs are counted before they are compared.
HASH_BITS = 16


@dataclass
class Grammar:
    """Rules (two symbols each), their lengths in ids, where rounds end, and the sequence."""

    first: int
    rules: np.ndarray  # rules x 2
    lengths: np.ndarray  # ids that each rule stands for
    rounds: np.ndarray  # number of rules after each round
    symbols: np.ndarray


def _taken(at: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Which of the occurrences (sorted places, ranks of their pairs) are replaced: no two overlap.

    In a run of one pair (aaaa) every second one stands; one with a better neighbour gives way.
    """
    same = np.zeros(len(at), bool)
    near = at[1:] == at[:-1] + 1
    same[1:] = near & (rank[1:] == rank[:-1])
    index = np.arange(len(at))
    start = np.maximum.accumulate(np.where(same, 0, index))
    stands = (index - start) % 2 == 0
    none = np.iinfo(np.int64).max
    weight = np.where(stands, rank, none)
    left = np.full(len(at), none)
    right = np.full(len(at), none)
    left[1:][near] = weight[:-1][near]
    right[:-1][near] = weight[1:][near]
    return stands & (weight < left) & (weight < right)


def _frequent(
    s: np.ndarray, hashed: np.ndarray, bound: np.ndarray, least: int, share: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, ranks and keys of the pairs that a round takes; empty if none is frequent.

    Counts under a hash are at least the true ones, so they only narrow what is compared.
    """

    def counted(limit: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        at = np.flatnonzero((bound >= limit)[hashed])
        key = s[at].astype(np.uint64) << np.uint64(32) | s[at + 1]
        return at, *np.unique(key, return_inverse=True, return_counts=True)

    high = int(bound.max(initial=0))
    while high >= least:
        limit = max(least, share * high)
        at, pairs, which, count = counted(limit)
        most = count.max(initial=0)
        if most >= least and (most >= limit or limit <= least):
            # Bounds may be too high: pairs below the limit that belong to the round are added.
            lower = max(least, share * most)
            if lower < limit:
                at, pairs, which, count = counted(lower)
            order = np.lexsort((pairs, -count))
            rank = np.empty(len(pairs), np.int64)
            rank[order] = np.arange(len(pairs))
            chosen = (count >= lower)[which]
            return at[chosen], rank[which[chosen]], pairs[order]
        if limit <= least:
            break
        high = max(int(most), int(limit) - 1)
    nothing = np.zeros(0, np.int64)
    return nothing, nothing, nothing


def _hashes(s: np.ndarray, last: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A hash of the pair that begins at each place; one of its own for pairs across an end."""
    mixed = s[at] * np.uint32(0x9E3779B1) ^ s[at + 1] * np.uint32(0x85EBCA77)
    found = (mixed >> np.uint32(32 - HASH_BITS)).astype(np.int32)
    found[last[at]] = 1 << HASH_BITS
    return found


def compress(
    ids: np.ndarray, last: np.ndarray, first: int, least: int = LEAST, share: float = SHARE
) -> tuple[Grammar, np.ndarray]:
    """A grammar of the ids, and the mask of the symbols that end a document.

    `last` marks the last id of each document; `first` is larger than every id. Only pairs next to
    a replaced one change, so a round counts those anew.
    """
    if least < 4:
        raise ValueError("a rule needs four occurrences to shorten anything")
    s, last = ids.astype(np.uint32), np.array(last, bool)
    known: dict[int, int] = {}
    rules: list[np.ndarray] = []
    sizes = np.ones(first, np.int64)
    rounds = [0]
    hashed = _hashes(s, last, np.arange(max(0, len(s) - 1)))
    closed = 1 << HASH_BITS
    bound = np.bincount(hashed, minlength=closed + 1)
    bound[closed] = 0
    while len(s) > 1:
        at, rank, pairs = _frequent(s, hashed, bound, least, share)
        if not len(at):
            break
        take = _taken(at, rank)
        at, rank = at[take], rank[take]
        # A pair that others have left with one occurrence gets no rule of its own.
        count = np.bincount(rank, minlength=len(pairs))
        used = np.flatnonzero(count)
        symbol = np.zeros(len(pairs), np.uint32)
        fresh = []
        for r, k in zip(used.tolist(), pairs[used].tolist(), strict=True):
            rule = known.get(k)
            if rule is None and count[r] > 1:
                rule = known[k] = first + len(known)
                fresh.append(k)
            symbol[r] = rule or 0
        keep = symbol[rank] > 0
        at, new = at[keep], symbol[rank[keep]]
        if fresh:
            made = np.array(fresh, np.uint64)
            made = np.stack([made >> np.uint64(32), made & np.uint64(0xFFFFFFFF)], 1).astype(np.uint32)
            rules.append(made)
            sizes = np.concatenate([sizes, sizes[made].sum(axis=1)])
            rounds.append(len(known))
        near = np.zeros(len(s) + 1, bool)
        near[at - 1] = near[at] = near[at + 1] = True
        bound -= np.bincount(hashed[near[: len(hashed)]], minlength=closed + 1)
        s[at] = new
        last[at] = last[at + 1]
        rest = np.ones(len(s), bool)
        rest[at + 1] = False
        s, last = s[rest], last[rest]
        # The pair that began at a dropped symbol is gone; it shares its place with the one before.
        hashed = hashed[rest[: len(hashed)]][: max(0, len(s) - 1)]
        place = at - np.arange(len(at))
        near = np.zeros(len(s) + 1, bool)
        near[place - 1] = near[place] = True
        again = np.flatnonzero(near[: len(hashed)])
        hashed[again] = _hashes(s, last, again)
        bound += np.bincount(hashed[again], minlength=closed + 1)
        bound[closed] = 0
    table = np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32)
    return Grammar(first, table, sizes[first:], np.array(rounds, np.int64), s), last


def _runs(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers start[i] to start[i] + n[i] - 1 of all i, in order."""
    return np.repeat(start - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())


def sizes_of(grammar: Grammar, symbols: np.ndarray) -> np.ndarray:
    """Number of ids that each symbol stands for."""
    n = np.ones(len(symbols), np.int64)
    rule = symbols >= grammar.first
    n[rule] = grammar.lengths[symbols[rule].astype(np.int64) - grammar.first]
    return n


def expand(grammar: Grammar) -> np.ndarray:
    """All ids. Rules are written out once each, round after round, and then copied."""
    first, lengths = grammar.first, grammar.lengths
    begin = first + np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
    flat = np.empty(first + int(lengths.sum()), np.uint32)
    flat[:first] = np.arange(first)
    start = np.concatenate([np.arange(first), begin])
    size = np.concatenate([np.ones(first, np.int64), lengths])
    for a, b in zip(grammar.rounds[:-1], grammar.rounds[1:], strict=True):
        parts = grammar.rules[a:b].ravel()
        if len(parts):
            to = begin[a]
            of = flat[_runs(start[parts], size[parts])]
            flat[to : to + len(of)] = of
    return flat[_runs(start[grammar.symbols], size[grammar.symbols])]


def slice_ids(grammar: Grammar, begin: int, end: int) -> np.ndarray:
    """The ids `begin` to `end` - 1 alone: only symbols that reach into the range are expanded."""
    total = np.cumsum(sizes_of(grammar, grammar.symbols))
    end = min(end, int(total[-1]) if len(total) else 0)
    if begin >= end:
        return np.zeros(0, np.uint32)
    a, b = np.searchsorted(total, [begin, end - 1], side="right")
    before = int(total[a - 1]) if a else 0
    symbols = grammar.symbols[a : b + 1]
    while (rule := symbols >= grammar.first).any():
        place = np.repeat(np.arange(len(symbols)), 1 + rule)
        second = np.zeros(len(place), np.int64)
        second[1:] = place[1:] == place[:-1]
        old = symbols[place]
        split = old >= grammar.first
        old[split] = grammar.rules[old[split].astype(np.int64) - grammar.first, second[split]]
        # What lies outside the range needs no further expansion.
        total = before + np.cumsum(sizes_of(grammar, old))
        a, b = np.searchsorted(total, [begin, end - 1], side="right")
        before = int(total[a - 1]) if a else before
        symbols = old[a : b + 1]
    return symbols[begin - before : end - before]


MAGIC = b"RPG1"


def pack(grammar: Grammar) -> bytes:
    """Little endian: magic, first rule, numbers of rules, rounds and symbols, bytes a symbol (all
    32 bits), then ends of rounds, pairs, lengths (32 bits each) and symbols."""
    top = grammar.first + len(grammar.rules)
    wide = "<u2" if top <= 1 << 16 else "<u4"
    head = [grammar.first, len(grammar.rules), len(grammar.rounds), len(grammar.symbols), int(wide[-1])]
    parts = (head, grammar.rounds, grammar.rules, grammar.lengths)
    return MAGIC + b"".join(
        [*(np.asarray(p, "<u4").tobytes() for p in parts), grammar.symbols.astype(wide).tobytes()]
    )


def unpack(data: bytes) -> Grammar:
    if data[:4] != MAGIC:
        raise ValueError("not a grammar")
    first, rules, rounds, symbols, wide = np.frombuffer(data, "<u4", 5, 4).tolist()
    at = 24
    ends = np.frombuffer(data, "<u4", rounds, at).astype(np.int64)
    pairs = np.frombuffer(data, "<u4", 2 * rules, at + 4 * rounds).reshape(-1, 2)
    at += 4 * rounds + 8 * rules
    lengths = np.frombuffer(data, "<u4", rules, at).astype(np.int64)
    found = np.frombuffer(data, f"<u{wide}", symbols, at + 4 * rules).astype(np.uint32)
    return Grammar(first, pairs, lengths, ends, found)
