"""Prompts for labelling a passage, and what can be read from the replies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from textsignal import fixed_values as fixed


def prompt(text: Column, instruction: str) -> Column:
    """The instruction followed by the passage."""
    return F.concat(F.lit(instruction), F.lit(fixed.PROMPT_PASSAGE), text)


def token_budget(prompt_text: Column, reserve: int = fixed.PROMPT_RESERVE) -> Column:
    """Number of words of the prompt, plus room for the reply."""
    parts = F.split(prompt_text, f"[{fixed.ANY_SPACE}]+")
    return F.size(F.filter(parts, lambda word: word != "")) + reserve


def normalise_reply(reply: Column, echo: Column) -> Column:
    """The reply without the echoed prompt, with ` . ` closed up and the ends stripped."""
    unechoed = F.replace(reply, echo, F.lit(""))
    closed = F.replace(unechoed, F.lit(" . "), F.lit(". "))
    ends = rf"\A[{fixed.ANY_SPACE}]+|[{fixed.ANY_SPACE}]+\z"
    return F.regexp_replace(closed, ends, "")


def reply_rating(reply: Column) -> Column:
    """First decimal number of the reply (one digit before the point); null without one."""
    found = F.regexp_extract(reply, fixed.REPLY_RATING, 1)
    return F.nullif(found, F.lit("")).try_cast("double")


def reply_subject(
    reply: Column,
    subjects: Sequence[str],
    neutral_words: Sequence[str] = fixed.REPLY_NEUTRAL_WORDS,
) -> Column:
    """First of the subject or neutral words that occurs in the reply; null without one."""
    pattern = "(" + "|".join([*subjects, *neutral_words]) + ")"
    return F.nullif(F.regexp_extract(reply, pattern, 1), F.lit(""))
