"""From raw documents to shards of a training mix, in five stages.

Each stage takes the documents that the one before it kept, and the folder of the tables, and
returns documents with the same columns; the last adds the shard.

1. `language`: documents without letters, or in no language that the labelled ones show, go.
2. `near_duplicates`: of documents that links connect, the one with the least id stays.
3. `decontamination`: documents that overlap with a benchmark item go.
4. `mixing`: each document comes as often as its source's target takes it; the document in which
   a budget ends comes once more, cut.
5. `sharding`: every document gets a slot and a shard.

A table between two stages is written to the folder that the cluster shares.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from textsignal.llm import decontamination, jaccard_join, language, mixing, sharding
from textsignal.llm.store import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def recognise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.recognised(docs, language.fit(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(docs)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def place_in_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.place(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language", recognise),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_passages),
    ("mixing", mix_sources),
    ("sharding", place_in_shards),
]

#: SQL can't express the trained first stage; tests run every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of a folder, after all stages."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
