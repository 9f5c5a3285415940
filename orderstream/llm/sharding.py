"""Shard placement by a permutation-filled lookup table (operator 9).

Every shard walks its own permutation of the slots of a prime-sized table (a
start and a step drawn from its name); the shards take turns claiming their next
free slot until the table is full. A row goes to the shard that owns the slot of
its key's hash. The table has a fixed number of rows (``SLOTS``), so broadcasting
it is bounded whatever the data's size, and a placement costs one hash lookup and
no shuffle. Removing a shard moves its own rows and few others.

Edge cases: a NULL key is placed by the hash of the text. Repeated rows land in
the same shard. A column named like an output column is replaced. An empty table
gives an empty result; an empty or repeating list of shards is an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLOTS = 65537
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))


def _draw(name: str, salt: str, size: int) -> int:
    return int.from_bytes(hashlib.sha256(f"{salt}:{name}".encode()).digest()[:8], "big") % size


def fill(shards: Sequence[str], slots: int = SLOTS) -> list[int]:
    """For each slot the index of its shard in ``shards``."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be a non-empty list of distinct names")
    if slots < len(shards) or any(slots % p == 0 for p in range(2, int(slots**0.5) + 1)):
        raise ValueError("slots must be a prime of at least the number of shards")
    # Turns go in name order, so that the table does not depend on the list's order.
    order = sorted(range(len(shards)), key=lambda i: shards[i])
    at = {i: _draw(shards[i], "start", slots) for i in order}
    step = {i: 1 + _draw(shards[i], "step", slots - 1) for i in order}
    owner = [-1] * slots
    left = slots
    while True:
        for i in order:
            while owner[at[i]] >= 0:  # the next slot of this shard's permutation
                at[i] = (at[i] + step[i]) % slots
            owner[at[i]] = i
            left -= 1
            if not left:
                return owner


def lookup(spark: SparkSession, shards: Sequence[str], slots: int = SLOTS, name: str = "shard") -> DataFrame:
    """The table as rows (slot, shard): exactly ``slots`` of them."""
    return spark.createDataFrame([(s, shards[i]) for s, i in enumerate(fill(shards, slots))], f"_slot long, {name} string")


def slot(key: Column, fallback: Column, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(F.coalesce(key.cast("string"), F.xxhash64(fallback).cast("string"))), F.lit(slots)).cast("long")


def place(
    docs: DataFrame, shards: Sequence[str] = SHARDS, key: str = "doc_id", text: str = "text", slots: int = SLOTS, name: str = "shard"
) -> DataFrame:
    """``docs`` with its shard in column ``name``."""
    rows = docs.drop(name).withColumn("_slot", slot(F.col(key), F.col(text), slots))
    return rows.join(F.broadcast(lookup(docs.sparkSession, shards, slots, name)), "_slot").drop("_slot")


def write_shards(placed: DataFrame, path: str, name: str = "shard") -> None:
    """One folder per shard. The rebalance hint gathers a shard's rows and lets
    adaptive execution split a shard that grows too large for one task."""
    placed.hint("rebalance", name).write.partitionBy(name).parquet(path)
