"""A stand-in for a model that labels passages, for queries and tests."""

from __future__ import annotations

from collections.abc import Sequence

from textsignal import fixed_values as fixed
from textsignal.operators.annotate import Scorer


def rule_scorer(subjects: Sequence[str], need_per_word: int = 2) -> Scorer:
    """A scorer for tests, without a model: rates by how often the subjects occur.

    It fails while the budget is under `need_per_word` times the words of the prompt, and
    echoes the prompt as some models do.
    """

    before, after = fixed.REPLY_FRAME

    def score(prompts: Sequence[str], budgets: Sequence[int]) -> list[str | None]:
        found: list[str | None] = []
        for prompt, budget in zip(prompts, budgets):
            words = prompt.split()
            if budget < need_per_word * len(words):
                found.append(None)
                continue
            counts = [words.count(subject) for subject in subjects]
            most = max(counts)
            name = subjects[counts.index(most)] if most else "neutral"
            tenths = 5 + min(most, 4)
            found.append(f"{before}{prompt}{after} 0.{tenths} {name} . Counted {most}")
        return found

    return score
