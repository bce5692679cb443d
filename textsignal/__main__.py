"""Runs one step of the study: `spark-submit` or `python -m textsignal STEP ...`."""

from __future__ import annotations

import argparse
import importlib
import json

from pyspark.sql import SparkSession

from textsignal import fixed_values as fixed
from textsignal import steps
from textsignal.operators.annotate import Scorer
from textsignal.sources.writers import write_parquet


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="textsignal", description=__doc__)
    step = top.add_subparsers(dest="step", required=True)

    def add(name: str, *paths: str) -> argparse.ArgumentParser:
        sub = step.add_parser(name)
        for path in paths:
            sub.add_argument(path)
        return sub

    add("segments", "transcripts", "cleaned", "segments").add_argument(
        "--subjects", nargs="+", required=True
    )
    contexts = add("contexts", "cleaned", "contexts")
    contexts.add_argument("--subjects", nargs="+", required=True)
    contexts.add_argument("--first", action="store_true", help="first contexts per document")
    add("topics", "segments", "terms", "mixture").add_argument("--k", type=int, default=fixed.TOPICS)
    add("export", "segments", "csv")
    add("prompts", "segments", "prompts").add_argument(
        "--instruction", required=True, help="the text before each passage"
    )
    asked = add("annotate", "prompts", "replies")
    asked.add_argument("--scorer", required=True, help="module:function that answers prompts")
    asked.add_argument("--max-attempts", type=int, default=None)
    add("parse", "replies", "labels").add_argument("--subjects", nargs="+", required=True)
    add("features", "segments", "lexicon", "features")
    add("label", "features", "labels", "labelled").add_argument(
        "--mode", choices=["all", "mean"], default="all"
    )
    for name in ("train", "report"):
        sub = add(name, "labelled", "model")
        sub.add_argument("--task", choices=["regression", "classification"], default="regression")
        sub.add_argument("--neutral", choices=["drop", "one", "zero"], default="drop")
        if name == "train":
            sub.add_argument("--kind", default=None)
            sub.add_argument("--scaled", action="store_true")
            sub.add_argument("--search", action="store_true")
            sub.add_argument(
                "--set", nargs="*", default=[], metavar="NAME=VALUE",
                help="settings of the estimator, for example regParam=0.1 seed=7",
            )
        else:
            sub.add_argument("--subjects", nargs=2, required=True)
            sub.add_argument("--out", help="a folder for all tables, whole")
            sub.add_argument("--rows", type=int, default=50, help="rows to print of each table")
        sub.add_argument("--train-share", type=float, default=0.7)
        sub.add_argument("--seed", type=int, default=42, help="of the split")
    return top


def settings(pairs: list[str]) -> dict[str, object]:
    """`NAME=VALUE` texts as numbers, truth values and texts."""
    found: dict[str, object] = {}
    for pair in pairs:
        name, _, value = pair.partition("=")
        try:
            found[name] = json.loads(value)
        except ValueError:
            found[name] = value
    return found


def scorer_named(name: str) -> Scorer:
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def main(arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    spark = SparkSession.builder.appName(f"textsignal {args.step}").getOrCreate()
    if args.step == "segments":
        steps.store_segments(spark, args.transcripts, args.cleaned, args.segments, args.subjects)
    elif args.step == "contexts":
        steps.store_contexts(
            spark, args.cleaned, args.contexts, args.subjects, first=args.first
        )
    elif args.step == "topics":
        steps.store_topics(spark, args.segments, args.terms, args.mixture, args.k)
    elif args.step == "export":
        steps.store_export(spark, args.segments, args.csv)
    elif args.step == "prompts":
        steps.store_prompts(spark, args.segments, args.prompts, args.instruction)
    elif args.step == "annotate":
        scorer = scorer_named(args.scorer)
        steps.store_replies(spark, args.prompts, args.replies, scorer, args.max_attempts)
    elif args.step == "parse":
        steps.store_parsed_labels(spark, args.replies, args.labels, args.subjects)
    elif args.step == "features":
        steps.store_features(spark, args.segments, args.lexicon, args.features)
    elif args.step == "label":
        steps.store_labelled(spark, args.features, args.labels, args.labelled, args.mode)
    elif args.step == "train":
        plain = {"regression": "linear", "classification": "forest" if args.search else "logistic"}
        steps.store_model(
            spark, args.labelled, args.model, args.task, args.kind or plain[args.task],
            args.neutral, args.scaled, args.search, args.train_share, args.seed,
            **settings(args.set),
        )
    else:
        tables = steps.report(
            spark, args.labelled, args.model, tuple(args.subjects), args.task, args.neutral,
            args.train_share, args.seed,
        )
        for name, table in tables.items():
            if args.out:
                write_parquet(table, f"{args.out}/{name}")
            print(f"{name}: {table.count()} rows, {args.rows} at most are printed")
            table.show(args.rows, truncate=False)


if __name__ == "__main__":
    main()
