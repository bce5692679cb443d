"""Fixed-size segments of the token stream of each show."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textsignal import fixed_values as fixed
from textsignal.functions.text import without_blanks
from textsignal.operators.running import running_total


def document_spans(
    df: DataFrame, show: str, order: Sequence[str], tokens: str
) -> DataFrame:
    """Where each document starts and ends in the token stream of its show.

    `[show, *order, first, last]` with 0-based places, `last` not included; blank tokens do not
    count. Works on one narrow row per document; a show with very many documents is split over
    tasks.
    """
    n_tokens = F.size(without_blanks(F.col(tokens))).cast("long")
    counted = df.select(show, *order, n_tokens.alias("_n_tokens"))
    ended = running_total(counted, order, {"last": "_n_tokens"}, [show], unique=True)
    return ended.select(
        show, *order, (F.col("last") - F.col("_n_tokens")).alias("first"), "last"
    )


def segment_tokens(
    df: DataFrame,
    show: str,
    order: Sequence[str],
    tokens: str,
    n: int = fixed.SEGMENT_TOKENS,
) -> DataFrame:
    """Cuts the token stream of each show into segments of `n` tokens; the last may be short.

    Gives `[show, segment_id, segment]`. The stream is the documents of the show, ordered by
    the `order` columns, which must identify a document inside its show (else the query fails).
    Blank tokens are left out. A document becomes one row per segment it touches, so what moves between tasks
    is runs of tokens and not single tokens.
    """
    documents = df.select(
        F.struct(F.col(show), *order).alias("_key"),
        show,
        without_blanks(F.col(tokens)).alias("_tokens"),
    )
    spans = document_spans(df, show, order, tokens).select(
        F.struct(F.col(show), *order).alias("_key"), "first", "last"
    )
    touched = F.sequence(F.floor(F.col("first") / n), F.floor((F.col("last") - 1) / n))
    pieces = documents.join(spans.where(F.col("last") > F.col("first")), "_key").select(
        show, "_tokens", "first", "last", F.explode_outer(touched).alias("_segment")
    )
    start = F.greatest(F.col("_segment") * n, F.col("first"))
    end = F.least((F.col("_segment") + 1) * n, F.col("last"))
    piece = F.slice(
        "_tokens", (start - F.col("first") + 1).cast("int"), (end - start).cast("int")
    )
    # A group holds at most n tokens.
    return (
        pieces.select(
            show,
            F.col("_segment").cast("int").alias("segment_id"),
            F.struct(start.alias("at"), piece.alias("tokens")).alias("_piece"),
        )
        .groupBy(show, "segment_id")
        .agg(F.array_sort(F.collect_list("_piece")).alias("_pieces"))
        .select(
            show,
            "segment_id",
            F.flatten(F.transform("_pieces", lambda p: p["tokens"])).alias("segment"),
        )
    )
