"""Registered queries over the test tables, each on whole tables and whole texts."""

from textsignal.plans import evaluations, labelling, models, texts  # noqa: F401
from textsignal.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
