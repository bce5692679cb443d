"""Main text of web pages by a linear-chain conditional random field over their leaf blocks.

Each leaf block of the page's tree is text or boilerplate. Features are the tags and the names
(class, id, role) of all its ancestors, its length, links, punctuation and cue words; the chain has
weights for a block following another. Training maximises the likelihood of labelled pages;
decoding takes the most likely labels of the whole page (Viterbi).

Training pages are a bounded sample of the given pages. The pages label themselves where their
markup names the article; to learn pages that don't, each is set again in other layouts: other
elements and names around the article, and menus, notices, adverts, forms, lists and reader
comments before, after and inside it, with their labels known because they were put there.

Every page is read whole, in batches; nothing is shuffled.
"""

from __future__ import annotations

import html
import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textsignal.llm.html_blocks import DIMS, Block, blocks, features
from textsignal.llm.store import stored

PAGES = 200
LAYOUTS = 4
STEPS = 120
PENALTY = 0.01

#: Names that mark the article, and names that mark what doesn't belong to it, in training pages.
ARTICLE = {"article", "main", "articlebody"}
ASIDE_TAGS = set("nav header footer aside form button select dialog menu".split())
ASIDE_NAMES = set(
    "ad ads advert advertisement banner sponsored promo sidebar widget menu nav navbar navigation "
    "breadcrumb breadcrumbs header footer masthead comment comments respond reply disqus related "
    "recommended share sharing social cookie cookies consent notice gdpr popup modal newsletter "
    "subscribe signup login search pagination tags hidden".split()
)
CONTAINERS = [
    ("article", ""),
    ("main", ""),
    ("article", ' class="post"'),
    ("div", ' id="content"'),
    ("div", ' class="post-content"'),
    ("div", ' class="article-body"'),
    ("div", ' class="entry-content"'),
    ("section", ' class="story"'),
    ("div", ' itemprop="articleBody"'),
    ("div", ' role="main"'),
    ("div", ""),
]
AROUND = [
    ("nav", "", "list"),
    ("ul", ' class="menu"', "list"),
    ("div", ' id="navbar"', "list"),
    ("header", "", "short"),
    ("div", ' class="site-header"', "short"),
    ("footer", "", "short"),
    ("div", ' id="footer"', "short"),
    ("aside", "", "text"),
    ("aside", ' class="sidebar"', "list"),
    ("div", ' class="sidebar widget"', "text"),
    ("div", ' class="ad"', "short"),
    ("div", ' class="advert banner"', "text"),
    ("div", ' class="sponsored"', "short"),
    ("div", ' class="cookie-notice"', "short"),
    ("div", ' id="consent"', "short"),
    ("div", ' class="notice"', "short"),
    ("form", "", "short"),
    ("form", ' class="newsletter subscribe"', "short"),
    ("div", ' class="comments"', "text"),
    ("section", ' id="comments"', "text"),
    ("ol", ' class="comment-list"', "list"),
    ("div", ' class="comment"', "text"),
    ("div", ' class="related"', "list"),
    ("div", ' class="share social"', "list"),
    ("div", ' class="breadcrumbs"', "list"),
    ("div", ' class="popup modal"', "short"),
]


def own_label(block: Block) -> int:
    """1 if the markup puts the block in an article and in nothing that is set apart."""
    tags, names = block.path.tags, block.path.names
    inside = bool((tags | names) & ARTICLE)
    return int(inside and not tags & ASIDE_TAGS and not names & ASIDE_NAMES)


def _aside(chance: random.Random, texts: list[str], kind: str) -> str:
    words = chance.choice(texts).split()
    if kind == "list":
        items = [" ".join(words[i : i + 2]) for i in range(0, min(len(words), 16), 2)]
        return "".join(f"<li><a href='#'>{html.escape(i)}</a></li>" for i in items or ["more"])
    if kind == "short":
        return html.escape(" ".join(words[: chance.randint(1, 14)]))
    chosen = [chance.choice(texts) for _ in range(chance.randint(1, 3))]
    return "".join(f"<p>{html.escape(t)}</p>" for t in chosen)


def laid_out(page: str, chance: random.Random) -> tuple[list[Block], list[int]]:
    """The page's own article in another layout, as labelled blocks."""
    found = blocks(page)
    body = [b.text for b in found if own_label(b)]
    if not body:
        return found, [0] * len(found)
    tag, names = chance.choice(CONTAINERS)
    parts: list[tuple[str, int]] = []
    for text in body:
        kind = chance.choice(["p"] * 8 + ["h2", "li", "blockquote", "div"])
        wrapped = f"<{kind}>{html.escape(text)}</{kind}>"
        parts.append((f"<ul>{wrapped}</ul>" if kind == "li" else wrapped, 1))
        if chance.random() < 0.08:
            parts.append((_set_apart(chance, body), 0))
    before = [(_set_apart(chance, body), 0) for _ in range(chance.randint(1, 4))]
    after = [(_set_apart(chance, body), 0) for _ in range(chance.randint(1, 4))]
    # Labels follow the parts: each is read by itself, inside the elements that hold it.
    made: list[Block] = []
    labels: list[int] = []
    wrap = chance.choice(["", "<div>", "<div class='page'>", "<table><tr><td>"])
    for group, holder in ((before, ""), (parts, f"<{tag}{names}>"), (after, "")):
        for markup, label in group:
            own = blocks(f"<html><body>{wrap}{holder}{markup}")
            made += own
            labels += [label] * len(own)
    return made, labels


def _set_apart(chance: random.Random, texts: list[str]) -> str:
    tag, names, kind = chance.choice(AROUND)
    return f"<{tag}{names}>{_aside(chance, texts, kind)}</{tag}>"


class Field:
    """Weights of a chain with two labels: by feature, at the start, and from label to label."""

    def __init__(self) -> None:
        self.weights = np.zeros((DIMS, 2))
        self.start = np.zeros(2)
        self.moves = np.zeros((2, 2))

    def to_bytes(self) -> bytes:
        return np.concatenate([self.weights.ravel(), self.start, self.moves.ravel()]).tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> Field:
        flat = np.frombuffer(data)
        made = cls()
        made.weights = flat[: 2 * DIMS].reshape(DIMS, 2)
        made.start = flat[2 * DIMS : 2 * DIMS + 2]
        made.moves = flat[2 * DIMS + 2 :].reshape(2, 2)
        return made

    def decode(self, rows: list[list[int]]) -> list[int]:
        """The most likely labels of a page (Viterbi)."""
        if not rows:
            return []
        scores = [self.weights[r].sum(axis=0).tolist() for r in rows]
        (m00, m01), (m10, m11) = self.moves.tolist()
        a, b = self.start[0] + scores[0][0], self.start[1] + scores[0][1]
        came = []
        for s0, s1 in scores[1:]:
            to0, to1 = b + m10 > a + m00, b + m11 >= a + m01
            came.append((int(to0), int(to1)))
            a, b = (b + m10 if to0 else a + m00) + s0, (b + m11 if to1 else a + m01) + s1
        label = int(b >= a)
        labels = [label]
        for back in reversed(came):
            label = back[label]
            labels.append(label)
        return labels[::-1]


def train(pages: list[tuple[list[list[int]], list[int]]], steps: int = STEPS) -> Field:
    """Maximum likelihood with a quadratic penalty, by Adam steps over all pages at once."""
    field = Field()
    pages = [p for p in pages if p[0]]
    if not pages:
        return field
    n, longest = len(pages), max(len(rows) for rows, _ in pages)
    mask = np.zeros((n, longest), bool)
    label = np.zeros((n, longest), int)
    block, place = [], []
    for i, (rows, labels) in enumerate(pages):
        mask[i, : len(rows)] = True
        label[i, : len(rows)] = labels
        for j, row in enumerate(rows):
            block += [i * longest + j] * len(row)
            place += row
    at, place = np.array(block), np.array(place)
    truth = np.eye(2)[label] * mask[..., None]
    both = mask[:, 1:] & mask[:, :-1]
    true_moves = np.einsum("nta,ntb,nt->ab", truth[:, :-1], truth[:, 1:], both.astype(float))
    theta = [field.weights, field.start, field.moves]
    mean = [np.zeros_like(t) for t in theta]
    var = [np.zeros_like(t) for t in theta]
    for step in range(1, steps + 1):
        score = np.zeros((n * longest, 2))
        for c in (0, 1):
            score[:, c] = np.bincount(at, field.weights[place, c], n * longest)
        score = score.reshape(n, longest, 2)
        ahead = np.zeros((n, longest, 2))
        behind = np.zeros((n, longest, 2))
        ahead[:, 0] = field.start + score[:, 0]
        for t in range(1, longest):
            step_in = np.logaddexp.reduce(ahead[:, t - 1, :, None] + field.moves, axis=1) + score[:, t]
            ahead[:, t] = np.where(mask[:, t, None], step_in, ahead[:, t - 1])
        total = np.logaddexp.reduce(ahead[:, -1], axis=1)
        for t in range(longest - 2, -1, -1):
            out = np.logaddexp.reduce(
                field.moves + (score[:, t + 1] + behind[:, t + 1])[:, None, :], axis=2
            )
            behind[:, t] = np.where(mask[:, t + 1, None], out, 0.0)
        share = np.exp(ahead + behind - total[:, None, None]) * mask[..., None]
        joint = np.exp(
            ahead[:, :-1, :, None]
            + field.moves
            + (score[:, 1:] + behind[:, 1:])[:, :, None, :]
            - total[:, None, None, None]
        )
        off = (truth - share).reshape(-1, 2)
        slope_w = np.stack([np.bincount(place, off[at, c], DIMS) for c in (0, 1)], axis=1)
        slopes = [
            slope_w - PENALTY * field.weights,
            (truth[:, 0] - share[:, 0]).sum(axis=0) - PENALTY * field.start,
            true_moves - (joint * both[..., None, None]).sum(axis=(0, 1)) - PENALTY * field.moves,
        ]
        for t, m, v, g in zip(theta, mean, var, slopes, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            t += 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return field


def labelled(page: str, key: object, layouts: int) -> list[tuple[list[list[int]], list[int]]]:
    """Training sequences of a page: its own layout, if it names its article, and others."""
    found = blocks(page)
    labels = [own_label(b) for b in found]
    made = [(features(found), labels)] if any(labels) else []
    for i in range(layouts if any(labels) else 0):
        other, others = laid_out(page, random.Random(f"{key} {i}"))
        made.append((features(other), others))
    return made


def fit(
    pages: DataFrame, key: str = "page_id", text: str = "html", most: int = PAGES
) -> Field:
    """A field trained on at most `most` pages, those whose keys have the least hashes.

    Pages whose markup doesn't name an article teach nothing; without any other page the field
    knows nothing and takes every block for text.
    """
    rows = pages.select(pages[key].cast("string").alias("key"), pages[text].alias("html"))
    sample = stored(
        rows.where(F.col("html").isNotNull())
        .orderBy(F.xxhash64(F.lit("pages"), F.coalesce("key", F.lit(""))), "key", "html")
        .limit(most)
    )

    def learn(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = []
        for frame in frames:
            for k, page in zip(frame["key"], frame["html"], strict=True):
                known += labelled(page, k, LAYOUTS)
        yield pd.DataFrame({"field": [train(known).to_bytes()]})

    # A bounded sample, in one task; the weights are a fixed number of bytes.
    return Field.from_bytes(sample.repartition(1).mapInPandas(learn, "field binary").first()[0])


def main_text(page: str, field: Field) -> str:
    """The blocks that the field takes for text, in page order, with an empty line between."""
    found = blocks(page)
    labels = field.decode(features(found))
    return "\n\n".join(b.text for b, label in zip(found, labels, strict=True) if label)


def extract(
    pages: DataFrame, field: Field, key: str = "page_id", url: str = "url", text: str = "html"
) -> DataFrame:
    """Rows (key, url, `text`, `n_chars`): the main text of every page and its code points.

    A null or empty page, or one without text, has the empty text. Repeated pages give repeated
    rows.
    """
    rows = pages.select(pages[key].alias(key), pages[url].alias(url), pages[text].alias("_html"))
    kinds = dict(rows.dtypes)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = [main_text(p, field) if p else "" for p in frame["_html"]]
            yield frame.drop(columns="_html").assign(text=texts)

    made = rows.mapInPandas(run, f"`{key}` {kinds[key]}, `{url}` {kinds[url]}, text string")
    return made.select("*", F.length("text").cast("long").alias("n_chars"))
