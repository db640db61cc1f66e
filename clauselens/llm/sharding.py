"""Sharding with a permutation-filled lookup table.

Every shard prefers the slots of a prime-sized table in an order of its own: an offset and a step,
both taken from a digest of its name, which visits each slot once.  Shards take turns; at its turn a
shard claims its next preferred slot that is still free, until the table is full.  So shards own
nearly equal numbers of slots, and when a shard is added or removed, most slots keep their owner.
A row's slot is the digest of its key modulo the size; the table is broadcast, so placement is one lookup.

Cases: a null key is placed like the empty string; rows of equal keys share a shard; the table of rows may be
empty; new columns sit beside a struct of the row, so none can clash.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLOTS = 65_537  # a prime; over a hundred slots for each shard keep the shares within about one percent
SHARDS = 64


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def fill_table(shards: list[str], slots: int = SLOTS) -> list[int]:
    """Owner of every slot, as a position in ``shards``.  Its size is a parameter, whatever the rows."""
    if not is_prime(slots) or not 0 < len(shards) <= slots or len(set(shards)) < len(shards):
        raise ValueError("a prime number of slots and at most as many different shards are needed")
    place, step = [], []
    for name in shards:
        digest = hashlib.md5(name.encode()).hexdigest()
        place.append(int(digest[:16], 16) % slots)
        step.append(int(digest[16:], 16) % (slots - 1) + 1)
    owner = [-1] * slots
    for turn in range(slots):
        shard = turn % len(shards)
        while owner[place[shard]] >= 0:
            place[shard] = (place[shard] + step[shard]) % slots
        owner[place[shard]] = shard
    return owner


def lookup_table(spark: SparkSession, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """(slot, shard): one row for each slot."""
    owners = ",".join(map(str, fill_table(shards, slots)))
    row = spark.range(1).select(
        F.split(F.lit(owners), ",").alias("owners"), F.array(*map(F.lit, shards)).alias("names"))
    return row.select(F.posexplode("owners").alias("slot", "owner"), "names").select(
        "slot", F.get("names", F.col("owner").cast("int")).alias("shard"))


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """Slot of a key: 60 bits of its digest, modulo the size."""
    bits = F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")
    return (bits % slots).cast("int")


def place(rows: DataFrame, key: str, shards: list[str], slots: int = SLOTS, keep: list[str] | None = None) -> DataFrame:
    """(doc, slot, shard): doc holds the kept columns (default all).

    The broadcast table has ``slots`` small rows, a fixed number, which proves its bound.
    """
    doc = F.struct(*[F.col(f"`{c}`") for c in (rows.columns if keep is None else keep)]).alias("doc")
    table = F.broadcast(lookup_table(rows.sparkSession, shards, slots))
    return rows.select(doc, slot_of(F.col(f"`{key}`"), slots).alias("slot")).join(table, "slot").select("doc", "slot", "shard")
