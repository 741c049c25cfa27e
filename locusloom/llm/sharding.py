"""Placement of keys on shards by a permutation-filled look-up table.

Each shard orders all slots of a prime-sized table by its own offset and stride. Shards take
turns; in its turn a shard claims the first slot of its order that is still free, until none
is. So every shard holds the same number of slots but for one, and a shard that comes or goes
moves little else. A key's slot is its hash modulo the table size, and the broadcast table
gives the shard, in constant time per row whatever the number of shards.

The table depends on the shards' names and its size alone, never on the data: it is filled on
the driver and broadcast, with ``size`` rows of two numbers. Placement uses DataFrame functions
only. Keys are hashed one by one, so a source with a third of all rows spreads like any other.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def name_hash(text: str) -> int:
    """First 60 bits of the MD5, as :func:`key_hash` takes them in Spark."""
    return int(hashlib.md5(text.encode("utf-8")).hexdigest()[:15], 16)


def fill_table(shards: list[str], size: int) -> list[int]:
    """Index of the shard of each slot."""
    if not shards or len(set(shards)) < len(shards) or size < len(shards) or not is_prime(size):
        raise ValueError("distinct shards and a prime table size of at least their number are needed")
    place = [name_hash(f"offset {s}") % size for s in shards]
    stride = [name_hash(f"stride {s}") % (size - 1) + 1 for s in shards]
    table, free = [-1] * size, size
    while free:
        for i in range(len(shards)):
            if not free:
                break
            while table[place[i]] >= 0:
                place[i] = (place[i] + stride[i]) % size
            table[place[i]] = i
            free -= 1
    return table


def key_hash(*keys: Column) -> Column:
    """60 bits of the MD5 of the keys as text, joined by a unit separator; a null key is told from an empty one."""
    text = F.concat_ws("\x1f", *(F.coalesce(F.concat(F.lit("="), k.cast("string")), F.lit("null")) for k in keys))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def table_frame(spark: SparkSession, shards: list[str], size: int) -> DataFrame:
    """``(slot, shard)`` rows of the table, from one literal."""
    numbers = ",".join(map(str, fill_table(shards, size)))
    names = F.array(*(F.lit(s) for s in shards))
    rows = spark.range(1).select(F.posexplode(F.split(F.lit(numbers), ",")).alias("slot", "number"))
    return rows.select(F.col("slot").cast("long").alias("slot"), F.get(names, F.col("number").cast("int")).alias("shard"))


def place(df: DataFrame, keys: list[str], shards: list[str], size: int) -> DataFrame:
    """``df`` with ``slot`` and ``shard``, which replace columns of these names.

    Every row is placed: null keys have a place of their own, equal keys the same place. An
    empty table stays empty, texts and other columns are passed on unread.
    """
    slots = df.drop("slot", "shard").withColumn("slot", F.pmod(key_hash(*(df[k] for k in keys)), F.lit(size)))
    table = table_frame(df.sparkSession, shards, size)
    return slots.join(F.broadcast(table), "slot").select(*[c for c in df.columns if c not in ("slot", "shard")], "slot", "shard")
