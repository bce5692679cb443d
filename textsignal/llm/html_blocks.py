"""Leaf blocks of web pages with the features by which a sequence model tells text from the rest."""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter
from typing import NamedTuple

#: Features are hashed to so many places.
DIMS = 1 << 14

# Fixed values of the HTML standard: elements without content, with content that is no markup, and
# inside a line of text; and which open elements a start tag ends.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
RAW = set("script style title textarea iframe template".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s "
    "samp small span strike strong sub sup time tt u var wbr object canvas noscript".split()
)
#: Elements of formulas and drawings, which are read as part of a line; a slash in the tag ends them.
FOREIGN = set(
    "math maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom "
    "mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder "
    "munderover none semantics annotation annotation-xml svg g defs symbol use text tspan textpath "
    "desc path rect circle ellipse line polyline polygon image lineargradient radialgradient stop "
    "clippath mask pattern marker filter foreignobject switch view animate set".split()
)
INLINE |= FOREIGN
#: Their texts are words of their own.
APART = set("mtd mtr annotation text desc foreignobject".split())
ENDS = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}
SCOPES = set("html body table ul ol dl div article section main aside nav form td th".split())

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']+|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([\w:-]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)")
NAMED = {"class", "id", "role", "itemprop", "aria-label", "data-role", "data-component"}
TOKENS = re.compile(r"[a-z]+")


class Path(NamedTuple):
    """The open elements around a block: the innermost two, and all tags and names. An element's path is
    made from its parent's, which shares its sets if it adds nothing, so deep nesting costs no more."""

    tag: str
    up: str
    tags: frozenset[str]
    names: frozenset[str]

    def inside(self, tag: str, names: tuple[str, ...]) -> Path:
        tags = self.tags if tag in self.tags else self.tags | {tag}
        known = self.names if self.names.issuperset(names) else self.names | set(names)
        return Path(tag, self.tag, tags, known)


NOWHERE = Path("", "", frozenset(), frozenset())


class Block(NamedTuple):
    """Its text, the open elements, and the letters inside links."""

    text: str
    path: Path
    linked: int


def _names(attributes: str) -> tuple[str, ...]:
    if "=" not in attributes:
        return ("hidden",) if "hidden" in attributes.lower() else ()
    found: list[str] = []
    for name, value in ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name in NAMED:
            found += TOKENS.findall(value.lower())
        elif name == "style" and "display:none" in value.replace(" ", "").lower():
            found.append("hidden")
        elif name == "aria-hidden" and "true" in value.lower():
            found.append("hidden")
    return tuple(dict.fromkeys(found))


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page with text, in page order.

    Elements inside a line are no part of the path, and their end tags end no block: of them only
    open links are followed. The time grows with the page, however deep its elements are nested.
    """
    made: list[Block] = []
    stack: list[Path] = []
    n_open: Counter[str] = Counter()
    # For each open link, the number of blocks around it.
    links: list[int] = []
    pieces: list[str] = []
    state = {"linked": 0}

    def close() -> None:
        text = " ".join(html.unescape("".join(pieces)).split())
        if text:
            made.append(Block(text, stack[-1] if stack else NOWHERE, state["linked"]))
        pieces.clear()
        state["linked"] = 0

    def say(text: str) -> None:
        if text:
            pieces.append(text)
            if links and links[-1] > len(stack) - 3:
                state["linked"] += len(text.strip())

    def leave(depth: int) -> None:
        while len(stack) > depth:
            n_open[stack.pop().tag] -= 1
        while links and links[-1] > depth:
            links.pop()

    at, n = 0, len(page)
    while at < n:
        found = TAG.search(page, at)
        if found is None:
            say(page[at:])
            break
        say(page[at : found.start()])
        at = found.end()
        ends, tag, attributes = found.group(1), found.group(2), found.group(3)
        if tag is None:
            ends, tag, attributes = found.group(4), found.group(5), found.group(6)
        if tag is None:
            continue
        tag = tag.lower()
        if ends:
            if tag in APART:
                pieces.append(" ")
            elif tag == "a" and links:
                links.pop()
            elif tag not in INLINE and n_open[tag]:
                close()
                depth = len(stack) - 1
                while stack[depth].tag != tag:
                    depth -= 1
                leave(depth)
            continue
        if tag in RAW:
            if not attributes.rstrip().endswith("/"):
                end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
                at = end.end() if end else n
            continue
        if tag == "br":
            pieces.append(" ")
            continue
        if tag in INLINE:
            if tag in APART:
                pieces.append(" ")
            elif tag == "a":
                links.append(len(stack))
            continue
        close()
        if tag in VOID:
            continue
        # A block ends an open paragraph; items end their like, up to the list that holds them.
        gone = ENDS.get(tag, set()) | {"p"}
        if any(n_open[x] for x in gone):
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].tag in gone:
                    leave(i)
                    break
                if stack[i].tag in SCOPES:
                    break
        stack.append((stack[-1] if stack else NOWHERE).inside(tag, _names(attributes)))
        n_open[tag] += 1
    close()
    return made


def _place(feature: str) -> int:
    return zlib.crc32(feature.encode()) & (DIMS - 1)


_paths: dict[Path, tuple[int, ...]] = {}
_own: dict[str, int] = {}
#: Words and signs of boilerplate (fixed values).
CUES = {
    "copyright": ("©", "copyright", "all rights"),
    "notice": ("cookie", "privacy", "consent", "subscribe", "newsletter", "sign up", "log in"),
    "advert": ("advert", "sponsor", "buy now", "click here"),
    "comment": ("reply", "posted by", "says:"),
    "share": ("share", "tweet", "follow us"),
    "bars": ("|", "·", "»", "›"),
}


def _of_path(path: Path) -> tuple[int, ...]:
    known = _paths.get(path)
    if known is None:
        features = ["bias", f"tag {path.tag}", f"up {path.up}"]
        features += [f"in {tag}" for tag in path.tags] + [f"name {n}" for n in path.names]
        known = tuple(sorted({_place(f) for f in features}))
        if len(_paths) > 50_000:
            _paths.clear()
        _paths[path] = known
    return known


def _own_place(feature: str) -> int:
    """As `_place`, for the few features that don't name elements."""
    if feature not in _own:
        _own[feature] = _place(feature)
    return _own[feature]


def features(found: list[Block]) -> list[list[int]]:
    """The places of the features of each block of a page."""
    made = []
    for i, block in enumerate(found):
        text = block.text
        words = text.count(" ") + 1
        own = [
            f"words {min(words.bit_length(), 7)}",
            f"links {min(4, 5 * block.linked // max(1, len(text)))}",
            f"end {text[-1] in '.!?:…”\"'}",
            f"commas {min(3, text.count(',') + text.count('. '))}",
            f"third {3 * i // len(found)}",
        ]
        lowered = text.lower()
        for name, cues in CUES.items():
            for cue in cues:
                if cue in lowered:
                    own.append(f"cue {name}")
                    break
        made.append([*_of_path(block.path), *map(_own_place, own)])
    return made
