"""Links between sets of numbers by a walk over their prefix tree.

The sets are written in one order, most frequent numbers first, so that similar sets begin alike,
and stored in a tree whose branches are runs of numbers. The walk carries, for every set that can
still link, how many numbers it has in common with the path so far. What a branch adds is counted
once, for all sets below it. A set is dropped at a node, with the whole subtree below, if the
numbers that remain on either side can't bring the overlap to what the lengths require.
"""

from __future__ import annotations

import numpy as np


def needed(a: np.ndarray, b: np.ndarray | int, share: int) -> np.ndarray:
    """The least overlap of linked sets of sizes a and b: Jaccard of `share` per cent or more."""
    return -((-share * (a + b)) // (100 + share))


def links(sets: list[np.ndarray], share: int) -> list[tuple[int, int]]:
    """Pairs that connect all sets that are connected by links, at most one less than the sets.

    Sets are sorted, without repeats and not empty. They link if 100 x intersection >= `share` x
    union.
    """
    m = len(sets)
    if m < 2:
        return []
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(m), sizes)
    _, inverse, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(count), np.int64)
    rank[np.argsort(-count, kind="stable")] = np.arange(len(count))
    ranked = rank[inverse]
    # The sets that have a number, by the number's rank.
    by_rank = np.argsort(ranked, kind="stable")
    holders = owner[by_rank]
    ends = np.cumsum(np.bincount(ranked, minlength=len(count)))
    begins = np.concatenate([[0], ends[:-1]])
    rare = int(np.count_nonzero(count > 1))  # from this rank on, numbers are held by one set only
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    paths = [np.sort(ranked[bounds[i] : bounds[i + 1]]).astype(">u4") for i in range(m)]
    order = sorted(range(m), key=lambda i: paths[i].tobytes())
    shared = np.zeros(m + 1, np.int64)  # with the set before, in this order
    for i in range(1, m):
        a, b = paths[order[i - 1]], paths[order[i]]
        k = min(len(a), len(b))
        unlike = np.flatnonzero(a[:k] != b[:k])
        shared[i] = unlike[0] if len(unlike) else k
    lengths = sizes[order]

    parent = list(range(m))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    found: list[tuple[int, int]] = []
    # A node: the sets low..high of the order, the path's length, candidates and their overlaps.
    stack = [(0, m, 0, np.arange(m), np.zeros(m, np.int64))]
    while stack:
        low, high, depth, able, overlap = stack.pop()
        inner = shared[low + 1 : high]
        end = int(inner.min()) if len(inner) else int(lengths[low])
        shortest, longest = int(lengths[low:high].min()), int(lengths[low:high].max())
        run = paths[order[low]][depth:end].astype(np.int64)
        run = run[run < rare]
        if len(run):
            n = ends[run] - begins[run]
            at = np.repeat(begins[run] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            overlap = overlap + np.bincount(holders[at], minlength=m)[able]
        own = sizes[able]
        # Every set below has at least `shortest` numbers, and at most `longest` - `end` to come.
        most = overlap + np.minimum(own - overlap, longest - end)
        keep = most >= needed(own, shortest, share)
        able, overlap = able[keep], overlap[keep]
        if not len(able) or (high - low == 1 and len(able) == 1):
            continue
        if high - low == 1:
            me = order[low]
            near = able[100 * overlap >= share * (sizes[able] + sizes[me] - overlap)]
            for other in near.tolist():
                a, b = root(me), root(other)
                if a != b:
                    parent[a] = b
                    found.append((me, other))
            continue
        cuts = [low, *(np.flatnonzero(inner == end) + low + 1).tolist(), high]
        stack += [(a, b, end, able, overlap) for a, b in zip(cuts, cuts[1:])]
    return found
