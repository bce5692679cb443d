"""Segments of stored documents: whole segments leave where their document lies, ends are stitched.

The tokens of a collection are written once, in buckets by document. Counting them afterwards reads
one narrow column, and a join on the document finds its tokens in their bucket. A segment that lies
inside one document is cut there; only the pieces before the first and after the last whole segment
of a document move on, to meet the pieces of its neighbours.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textsignal import fixed_values as fixed
from textsignal.functions.text import without_blanks
from textsignal.operators.rounds import new_path
from textsignal.operators.running import running_total

DOCUMENT = "_document"


def store_tokens(
    df: DataFrame, show: str, order: Sequence[str], tokens: str, buckets: int | None = None
) -> DataFrame:
    """`[show, *order, tokens, n_tokens]` of all rows, computed once, without blank tokens.

    Null tokens become no tokens. The table lies in the folder of `spark.checkpoint.dir`, in as
    many buckets as there are shuffle partitions; `rounds.drop_written` deletes it.
    """
    spark = df.sparkSession
    if buckets is None:
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    filled = F.coalesce(without_blanks(F.col(tokens)), F.array().cast("array<string>"))
    keyed = df.select(
        # One text, as null parts of a key are equal to each other here.
        F.to_json(F.struct(*[F.col(c).cast("string") for c in [show, *order]])).alias(DOCUMENT),
        show,
        *order,
        filled.alias(tokens),
    ).withColumn("n_tokens", F.size(tokens).cast("long"))
    name = f"tokens_{uuid.uuid4().hex}"
    writer = keyed.repartition(buckets, DOCUMENT).write.bucketBy(buckets, DOCUMENT)
    writer.option("path", new_path(spark)).saveAsTable(name)
    found = spark.table(name)
    # The files stay; the frame knows them and their buckets already.
    spark.sql(f"DROP TABLE {name}")
    return found


def stored_spans(stored: DataFrame, show: str, order: Sequence[str]) -> DataFrame:
    """Where each document of `store_tokens` starts and ends in the token stream of its show.

    `[show, *order, first, last]` and the key of the bucket; like `document_spans`, from narrow rows.
    """
    counted = stored.select(DOCUMENT, show, *order, "n_tokens")
    ended = running_total(counted, order, {"last": "n_tokens"}, [show], unique=True)
    return ended.select(
        DOCUMENT, show, *order, (F.col("last") - F.col("n_tokens")).alias("first"), "last"
    )


def _cut(at: Column, end: Column, tokens: str) -> Column:
    return F.slice(tokens, (at - F.col("first") + 1).cast("int"), (end - at).cast("int"))


def stitch_segments(
    stored: DataFrame,
    spans: DataFrame,
    show: str,
    tokens: str,
    n: int = fixed.SEGMENT_TOKENS,
) -> DataFrame:
    """`[show, segment_id, segment]` as `segment_tokens` gives it, from stored tokens and spans.

    A document without tokens touches no segment. The key must identify a document in its show, else
    the query fails. A group of pieces holds fewer than `n` tokens more than a segment.
    """
    first, last = F.col("first"), F.col("last")
    places = spans.where(last > first).select(DOCUMENT, "first", "last").hint("shuffle_hash")
    found = stored.where(F.col("n_tokens") > 0).select(DOCUMENT, show, tokens, "n_tokens")
    placed = found.join(places, DOCUMENT)

    # Segments first_whole .. end_whole - 1 lie in the document from start to end.
    first_whole, end_whole = F.ceil(first / n), F.floor(last / n)
    whole = F.when(end_whole > first_whole, F.sequence(first_whole, end_whole - 1))
    inner = (
        # A shorter document has no whole segment; the scan knows its size.
        placed.where(F.col("n_tokens") >= n)
        .select(show, tokens, "first", F.explode_outer(whole).alias("_segment"))
        .where(F.col("_segment").isNotNull())
    )
    at = F.col("_segment") * n
    inner = inner.select(
        show, F.col("_segment").cast("int").alias("segment_id"), _cut(at, at + n, tokens).alias("segment")
    )

    head_end = F.least(last, first_whole * n)
    tail_at = end_whole * n
    ends = F.array(
        F.when(first % n != 0, F.struct(first.alias("at"), head_end.alias("end"))),
        F.when((last % n != 0) & (tail_at >= first), F.struct(tail_at.alias("at"), last.alias("end"))),
    )
    pieces = placed.select(
        show, tokens, "first", F.explode(F.filter(ends, lambda end: end.isNotNull())).alias("_end")
    )
    at, end = F.col("_end.at"), F.col("_end.end")
    stitched = (
        pieces.select(
            show,
            F.floor(at / n).cast("int").alias("segment_id"),
            F.struct(at.alias("at"), _cut(at, end, tokens).alias("tokens")).alias("_piece"),
        )
        .groupBy(show, "segment_id")
        .agg(F.array_sort(F.collect_list("_piece")).alias("_pieces"))
        .select(
            show, "segment_id", F.flatten(F.transform("_pieces", lambda p: p["tokens"])).alias("segment")
        )
    )
    return inner.unionByName(stitched)
