"""Placement of documents in shards by a permutation-filled lookup table.

Each shard has its own order of preference over the slots of a table whose size is prime: it starts
at an offset and goes on by a step, both hashes of its name. The shards take turns, and each claims
the first slot of its order that is still free, until no slot is. So shards own equal numbers of
slots (one more or less), and adding or removing a shard moves few slots besides its own.

A document's slot is a hash of its id modulo the size; the table is joined by broadcast. Its size
is a parameter, about 100 slots a shard, whatever the number of documents.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHARDS = 64
SLOTS_PER_SHARD = 100


def table_size(shards: int, per_shard: int = SLOTS_PER_SHARD) -> int:
    """The least prime that is at least `shards` x `per_shard`."""
    n = max(2, shards * per_shard)
    while any(n % d == 0 for d in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def _number(name: str) -> int:
    return int(hashlib.md5(name.encode()).hexdigest()[:15], 16)


def lookup_table(names: list[str], size: int) -> list[int]:
    """The owner of each slot, as an index of `names`; `size` is prime and at least their number."""
    if not names or len(names) > size or len(set(names)) < len(names):
        raise ValueError("shards need different names, and at least one slot each")
    place = [_number(f"offset {name}") % size for name in names]
    step = [_number(f"step {name}") % (size - 1) + 1 for name in names]
    owner = [-1] * size
    free = size
    while free:
        for shard in range(len(names)):
            if not free:
                break
            while owner[place[shard]] >= 0:
                place[shard] = (place[shard] + step[shard]) % size
            owner[place[shard]] = shard
            free -= 1
    return owner


def lookup_frame(spark: SparkSession, names: list[str], size: int) -> DataFrame:
    """The table as rows (_slot, _shard)."""
    owners = F.split(F.lit(",".join(map(str, lookup_table(names, size)))), ",")
    return spark.range(size).select(
        F.col("id").alias("_slot"),
        F.get(owners, F.col("id").cast("int")).cast("int").alias("_shard"),
    )


def slot_of(key: Column, size: int) -> Column:
    """The slot of a key: the first 32 bits of its md5, modulo the size. A null key is ''."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 8)
    return F.conv(digits, 16, 10).cast("long") % F.lit(size)


def place(
    docs: DataFrame,
    shards: int | list[str] = SHARDS,
    key: str = "doc_id",
    size: int | None = None,
) -> DataFrame:
    """Adds `slot` (long) and `shard` (int, an index of the shards) to every row.

    Nothing is shuffled. Rows with the same key, repeated rows too, share a shard; a null key is
    placed as ''. Columns of these two names that the rows already have are replaced.
    An empty table gives an empty table.
    """
    names = [f"shard-{i}" for i in range(shards)] if isinstance(shards, int) else shards
    size = size or table_size(len(names))
    others = [docs[c] for c in docs.columns if c.lower() not in ("slot", "shard")]
    slots = docs.select(*others, slot_of(docs[key], size).alias("_slot"))
    table = F.broadcast(lookup_frame(docs.sparkSession, names, size))
    return slots.join(table, "_slot", "left").select(
        *[slots[c] for c in slots.columns if c != "_slot"],
        F.col("_slot").alias("slot"),
        F.col("_shard").alias("shard"),
    )
