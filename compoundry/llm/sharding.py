"""Sharding by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table of prime size; in turns, each claims the next
slot on its list that is still free, until all are taken. A key is hashed to a slot, and a broadcast of the table,
whose size is fixed, gives its shard. Shares differ by little, and when a shard comes or goes few keys move.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Slots of the table: a prime, some hundred times the number of shards.
SLOTS = 16_381


def preference(shard: str, slots: int) -> tuple[int, int]:
    """First slot and step of a shard's order; every step below a prime visits all slots."""
    h = hashlib.md5(shard.encode()).digest()
    return int.from_bytes(h[:8], "big") % slots, int.from_bytes(h[8:], "big") % (slots - 1) + 1


def fill(shards: Sequence[str], slots: int = SLOTS) -> list[str]:
    """The shard of each slot. Shards take turns in the order of their names; repeated names count once."""
    if slots < 2 or any(slots % k == 0 for k in range(2, int(slots**0.5) + 1)):
        raise ValueError("the number of slots must be prime")
    names = sorted(set(shards))
    if not names:
        raise ValueError("there is no shard")
    table: list[str | None] = [None] * slots
    at, step = map(list, zip(*(preference(s, slots) for s in names), strict=True))
    free = slots
    while True:
        for k, name in enumerate(names):
            while table[at[k]] is not None:
                at[k] = (at[k] + step[k]) % slots
            table[at[k]] = name
            free -= 1
            if not free:
                return table


def slot(key: Column, slots: int = SLOTS) -> Column:
    """The slot of a key: the first 32 bits of its MD5, modulo the number of slots; null counts as the empty text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % slots).cast("int")


def place(rows: DataFrame, key: str, shards: Sequence[str], into: str = "shard", slots: int = SLOTS) -> DataFrame:
    """All columns of ``rows``, ``slot``, and the shard in column ``into``; columns of these names are replaced.

    Equal keys always share a shard. Nothing is shuffled: the table has ``slots`` rows and is broadcast. An empty
    table gives no rows.
    """
    names = fill(shards, slots)
    spark = rows.sparkSession
    table = spark.createDataFrame(list(enumerate(names)), "_slot int, _shard string")
    keyed = rows.drop(into, "slot").withColumn("slot", slot(rows[key], slots))
    return keyed.join(F.broadcast(table), F.col("slot") == F.col("_slot")).withColumnRenamed("_shard", into).drop("_slot")


def write(rows: DataFrame, key: str, shards: Sequence[str], path: str, files: int = 1, slots: int = SLOTS) -> None:
    """Write one folder for each shard, each of about ``files`` files; a large shard is written by as many tasks."""
    placed = place(rows, key, shards, "shard", slots)
    dealt = placed.withColumn("_file", F.pmod(F.xxhash64(*[c for c in rows.columns]), F.lit(files)))
    dealt.repartition("shard", "_file").drop("_file", "slot").write.partitionBy("shard").parquet(path)
