"""Sharding by a permutation-filled lookup table, in DataFrame functions only.

Each shard prefers the slots of a prime-sized table in its own order, a
permutation from two hashes of its name: ``(offset + j * skip) mod size``. The
shards take turns; at its turn a shard claims the first slot of its order that
is still free, until the table is full. Shards' slot counts differ by one at
most, and a shard added or removed moves few slots besides its own.

The table depends on the shard names and the size only (``size`` rows, a
parameter), so it is broadcast, and a document finds its shard by one hash and
one lookup: no shuffle, and no key can be hot.

Defined results: a null key is placed as the empty string; equal keys, and so
repeated rows, share a shard; an empty table gives an empty result; input
columns named ``slot`` or ``shard`` are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHARDS = tuple(f"shard-{i:02d}" for i in range(16))
SIZE = 2039  # prime; over a hundred slots per shard keep the shares within one percent


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def lookup(shards: Sequence[str] = SHARDS, size: int = SIZE) -> list[int]:
    """Index of the shard that owns each slot."""
    if not 0 < len(set(shards)) == len(shards) <= size:
        raise ValueError("shard names must be distinct, and no more than slots")
    if size < 2 or any(size % d == 0 for d in range(2, int(size**0.5) + 1)):
        raise ValueError("the table size must be a prime")
    offset = [_number(f"offset:{s}") % size for s in shards]
    skip = [_number(f"skip:{s}") % (size - 1) + 1 for s in shards]
    owner, step = [-1] * size, [0] * len(shards)
    for turn in range(size):
        i = turn % len(shards)
        while owner[(offset[i] + step[i] * skip[i]) % size] >= 0:
            step[i] += 1
        owner[(offset[i] + step[i] * skip[i]) % size] = i
    return owner


def lookup_table(spark: SparkSession, shards: Sequence[str] = SHARDS, size: int = SIZE) -> DataFrame:
    """The table as a DataFrame of ``size`` rows: slot, shard."""
    owners = F.split(F.lit(",".join(map(str, lookup(shards, size)))), ",")
    names = F.array(*[F.lit(s) for s in shards])
    owner = F.element_at(owners, (F.col("id") + 1).cast("int")).cast("int")
    return spark.range(size).select(F.col("id").alias("slot"), F.element_at(names, owner + 1).alias("shard"))


def slot_of(key, size: int = SIZE) -> Column:
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(name), 1, 15), 16, 10).cast("long") % size


def assign(docs: DataFrame, key: str = "doc_id", shards: Sequence[str] = SHARDS, size: int = SIZE) -> DataFrame:
    """Every input row with its ``slot`` and ``shard``."""
    kept = [F.col(c) for c in docs.columns if c not in ("slot", "shard")]
    rows = docs.select(*kept, slot_of(key, size).alias("slot"))
    return rows.join(F.broadcast(lookup_table(docs.sparkSession, shards, size)), "slot").select(
        *[c for c in docs.columns if c not in ("slot", "shard")], "slot", "shard"
    )
