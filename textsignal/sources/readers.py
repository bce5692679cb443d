"""Transcripts, segments, lexicons and labels from files, each with a declared schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textsignal.functions.text import name_from_path, unwrap


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """All text files under a folder, nested ones too: `[file_name, show, text]`.

    One row per file keeps the order of its lines without a shuffle.
    """
    files = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    return files.select(
        F.input_file_name().alias("file_name"), F.col("value")
    ).select(
        "file_name",
        name_from_path(F.col("file_name")).alias("show"),
        unwrap(F.col("value")).alias("text"),
    )


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table."""
    return spark.read.parquet(path)


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """Words with their scores: `[word, score]`."""
    return spark.read.schema("word string, score int").csv(path, header=True)


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """Labels of segments: `[segment_id, podcast_name_cleaned, label]`, bad numbers as null."""
    raw = spark.read.schema(
        "segment_id string, podcast_name_cleaned string, label string"
    ).csv(path, header=True)
    return raw.select(
        F.col("segment_id").try_cast("int").alias("segment_id"),
        "podcast_name_cleaned",
        F.col("label").try_cast("double").alias("label"),
    )


def read_exported_segments(spark: SparkSession, path: str, arrays: dict[str, str]) -> DataFrame:
    """Segments that `export_csv` wrote: `arrays` names the flattened columns and their gaps.

    All other columns are text. An empty field is an empty array.
    """
    raw = spark.read.csv(path, header=True, inferSchema=False, escape='"')
    empty = F.array().cast("array<string>")

    def parsed(name: str, gap: str) -> Column:
        pieces = F.split(F.col(name), f"\\Q{gap}\\E")
        return F.coalesce(F.filter(pieces, lambda token: token != ""), empty)

    return raw.withColumns({name: parsed(name, gap) for name, gap in arrays.items()})
