"""Cleaning and tokenising of transcript text."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from textsignal import fixed_values as fixed


# The same characters as in `fixed.NOT_WORD_CHARACTERS` and as in "neither a letter nor white
# space of any script", written as intersections: Java matches these about eight times faster
# than a negated list of ranges.
_NOT_WORD = r"[\P{Alnum}&&\S]+"
_NOT_LETTER = r"[\P{Alpha}&&\P{IsWhite_Space}&&[^\x1C-\x1F]]+"


def name_from_path(path: Column) -> Column:
    """Name of the folder that holds a file, readable: `%20` is a space, punctuation goes."""
    element = F.regexp_extract(path, fixed.PATH_NAME, 1)
    spaced = F.replace(element, F.lit(fixed.ESCAPED_SPACE), F.lit(" "))
    return F.regexp_replace(spaced, fixed.NOT_NAME_CHARACTER, "")


def join_lines(lines: Column) -> Column:
    """An array of lines as one text, one space between lines."""
    return F.concat_ws(" ", lines)


def unwrap(text: Column) -> Column:
    """A whole file as one text: the same result as `join_lines` on the lines of the file."""
    unended = F.regexp_replace(text, r"(?:\r\n|\n|\r)\z", "")
    return F.regexp_replace(unended, r"\r\n|\n|\r", " ")


def clean_text(text: Column) -> Column:
    """Lower-cased words and spaces: clock marks, numbers, punctuation and durations go.

    The three patterns for numbers need a digit to match, so texts without one (most speech)
    skip those passes.
    """
    lowered = F.lower(text)
    unclocked = F.regexp_replace(lowered, fixed.CLOCK_MARK, "")
    unnumbered = F.regexp_replace(unclocked, fixed.FREE_NUMBER, "")
    with_digits = F.regexp_replace(
        F.trim(F.regexp_replace(unnumbered, _NOT_WORD, "")),
        fixed.SPOKEN_DURATION,
        "",
    )
    without_digits = F.trim(F.regexp_replace(lowered, _NOT_WORD, ""))
    return F.when(F.rlike(lowered, F.lit("[0-9]")), with_digits).otherwise(without_digits)


def words(text: Column, stop_words: Iterable[str] = (), lowered: bool = False) -> Column:
    """Lower-cased words between white space, in order, without blanks and stop words.

    `lowered` says that the text is in lower case already, as `clean_text` leaves it. The list
    of stop words becomes a hash lookup (`InSet`), not a scan per token. A null text has no
    words: as the array is never null, a join on it adds no null check, which would clean and
    split every text a second time.
    """
    unwanted = ["", *(word.lower() for word in stop_words)]
    lower = text if lowered else F.lower(text)
    kept = F.filter(F.split(lower, fixed.TOKEN_GAP), lambda token: ~token.isin(unwanted))
    return F.coalesce(kept, F.array().cast("array<string>"))


def without_blanks(tokens: Column) -> Column:
    """The array without tokens that are null, empty or only white space.

    `!` is the first character after the space, so nearly all tokens pass on one comparison.
    """
    blank = F.lit(fixed.BLANK_CHARACTERS)

    def filled(token: Column) -> Column:
        return token.isNotNull() & ((token >= "!") | (F.trim(token, blank) != ""))

    return F.filter(tokens, filled)


def letters_only(text: Column) -> Column:
    """Letters in single-spaced words: everything else goes, also digits."""
    kept = F.regexp_replace(text, _NOT_LETTER, "")
    return F.trim(F.regexp_replace(kept, f"[{fixed.ANY_SPACE}]+", " "))
