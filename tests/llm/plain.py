"""Plain forms of the operators, on small lists of texts."""

import hashlib
import re

SPACE = re.compile(r"[\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    if len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def components(texts, share=80):
    """The least place linked with each text, by all pairs."""
    sets = [shingles(t) for t in texts]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= share * len(a | b):
                low, high = sorted((root(i), root(j)))
                parent[high] = low
    return [root(i) for i in range(len(sets))]


def without_repeats(texts, window=100):
    """Of texts in order: bytes, removed bytes, spans and the hash of what is left."""
    seen, made = set(), []
    for text in texts:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - window + 1):
            part = data[i : i + window]
            if part in seen:
                gone[i : i + window] = b"\1" * window
            seen.add(part)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = len([run for run in bytes(gone).split(b"\0") if run])
        made.append((len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return made


def exact_groups(rows):
    """Of (key, text): (key, key of the row that stays, size, stays, hash)."""
    groups = {}
    for key, text in rows:
        norm = SPACE.sub("", text or "")
        groups.setdefault(norm, []).append((-len(text or ""), key))
    made = []
    for key, text in rows:
        norm = SPACE.sub("", text or "")
        best = min(groups[norm])[1]
        digest = hashlib.sha256(norm.encode()).hexdigest()
        made.append((key, best, len(groups[norm]), key == best, digest))
    return made


def mix(rows, weights=(5, 2, 1), limit=3):
    """Of (key, size, source): target of each source, by sharing the excess until none is left."""
    sizes = {}
    for _, size, source in rows:
        sizes[source] = sizes.get(source, 0) + size
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target = dict.fromkeys(order, 0.0)
    rest, open_ = float(sum(sizes.values())), set(order)
    while open_ and rest > 1e-9:
        total = sum(weight[s] for s in open_)
        for s in open_:
            target[s] += rest * weight[s] / total
        rest = 0.0
        for s in list(open_):
            if target[s] >= limit * sizes[s]:
                rest += target[s] - limit * sizes[s]
                target[s] = float(limit * sizes[s])
                open_.discard(s)
    return sizes, target


def tokens(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def overlaps(docs, items, window=13, share=80, least=9):
    """Pairs of places that overlap, laid on one another in every way."""
    made = {}
    for d, text in enumerate(docs):
        said = tokens(text)
        for i, item in enumerate(items):
            words = tokens(item)
            n = len(words)
            need = 100 if n < least else share
            for shift in range(-n + 1, len(said)) if n else ():
                equal = [0 <= shift + k < len(said) and said[shift + k] == w for k, w in enumerate(words)]
                wide = min(n, window)
                best = max(sum(equal[a : a + wide]) for a in range(n - wide + 1))
                if 100 * best >= need * wide:
                    old = made.get((d, i), (0, 0, 0))
                    made[d, i] = (n, max(old[1], sum(equal)), max(old[2], best))
    return made
