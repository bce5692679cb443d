"""Plain Python forms of what the library computes, to compare with."""

import re
import string


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan_of(df):
    return df._jdf.queryExecution().toString()


def clean(text):
    text = text.lower()
    text = re.sub(r"\[\d{2}:\d{2}:\d{2}\]|\d{2}:\d{2}", "", text, flags=re.ASCII)
    text = re.sub(r"\b\d+\b", "", text, flags=re.ASCII)
    text = "".join(c for c in text if c in string.ascii_letters + string.digits + " \t\n\x0b\f\r")
    text = text.strip(" ")
    return re.sub(r"\b\d+m[ \t\n\x0b\f\r]*\d+s|\b\d+s", "", text, flags=re.ASCII)


def contexts(tokens, subjects, radius, exact=False):
    """By definition: each place that names a subject, with all tokens at most `radius` away."""
    names = "|".join(map(re.escape, subjects))
    named = re.compile(rf"\A(?:{names})\Z" if exact else names).search
    at = {place: token for place, token in enumerate(tokens, 1)}
    return [
        (place, [at[p] for p in sorted(at) if abs(p - place) <= radius])
        for place in sorted(at)
        if named(at[place])
    ]


def segments(documents, n):
    """documents: (show, order, tokens) -> {(show, segment_id): tokens}"""
    streams = {}
    for show, _, tokens in sorted(documents, key=lambda d: (d[0], d[1])):
        streams.setdefault(show, []).extend(t for t in tokens if t and t.strip(" \t\n\x0b\f\r"))
    return {
        (show, start // n): stream[start : start + n]
        for show, stream in streams.items()
        for start in range(0, len(stream), n)
    }


def answer(prompts, budgets):
    """A scorer: no reply at first, then a rating by the length of the prompt."""
    return [f"0.{len(p) % 10} trump" if b > len(p.split()) + 450 else None for p, b in zip(prompts, budgets)]
