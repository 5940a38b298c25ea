"""Sharding by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table of prime
size: a first slot and a stride, both hashed from its name (a prime size makes
every stride visit every slot).  The shards take turns; on its turn each
claims its most preferred free slot, until the table is full.  Slots are then
dealt almost evenly, and adding or removing a shard moves little else.

A row's key is hashed to a slot, and a join with the broadcast table places it
in constant time without moving the row.  The table has ``size`` rows by
construction, 4,099 unless the caller chooses otherwise (256 for each of 16
shards, which keeps their shares within half a percent) and at most
``MOST_SLOTS``, so the broadcast cannot grow with the data.

The key is the row's own id: a hot source is dealt over all shards.  Rows that
share a key share a shard; a key that must not be split belongs in ``key``, a
hot one can be salted by adding a second column.

Defined results: null keys are hashed as the text ``\\N`` and so share a slot;
repeated rows go to one shard; an empty table stays empty; extra columns pass
through, whatever their names, but for those of the two new columns, which are
refused until these get other names.  Shard names must be distinct and at least one.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free_name

SLOTS = 4099
MOST_SLOTS = 1 << 20
DIGITS = 13  # 52 bits of an MD5 digest


def _hashed(text: str) -> int:
    return int(hashlib.md5(text.encode("utf-8")).hexdigest()[:DIGITS], 16)


def lookup_table(shards: list[str], size: int = SLOTS) -> list[str]:
    """The shard of every slot."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shard names must be distinct and at least one")
    if size > MOST_SLOTS or size < len(shards) or any(size % p == 0 for p in range(2, int(size ** 0.5) + 1)):
        raise ValueError(f"the table size must be a prime from {len(shards)} to {MOST_SLOTS}")
    owner: list[str | None] = [None] * size
    stride = {s: _hashed(f"{s}/stride") % (size - 1) + 1 for s in shards}
    wish = {s: _hashed(f"{s}/first") % size for s in shards}
    for turn in range(size):
        shard = shards[turn % len(shards)]
        while owner[wish[shard]] is not None:
            wish[shard] = (wish[shard] + stride[shard]) % size
        owner[wish[shard]] = shard
    return owner


def slot_table(spark: SparkSession, shards: list[str], size: int = SLOTS) -> DataFrame:
    return spark.createDataFrame(list(enumerate(lookup_table(shards, size))), "slot long, shard string")


def place(df: DataFrame, shards: list[str], key: str | list[str] = "doc_id", size: int = SLOTS,
          slot: str = "slot", shard: str = "shard") -> DataFrame:
    """``df`` with each row's slot and shard."""
    if clash := {slot.lower(), shard.lower()} & {c.lower() for c in df.columns}:
        raise ValueError(f"the input already has {sorted(clash)}: pass other names")
    keys = [key] if isinstance(key, str) else key
    text = F.concat_ws("\x1f", *[F.coalesce(F.col(k).cast("string"), F.lit("\\N")) for k in keys])
    hashed = F.conv(F.substring(F.md5(text), 1, DIGITS), 16, 10).cast("long")
    of = free_name([*df.columns, slot, shard], "__slot")
    table = F.broadcast(slot_table(df.sparkSession, shards, size)).select(
        F.col("slot").alias(of), F.col("shard").alias(shard))
    keyed = df.withColumn(slot, hashed % F.lit(size))
    return keyed.join(table, F.col(slot) == F.col(of)).drop(of)
