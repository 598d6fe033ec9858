"""Sharding by a permutation-filled lookup table.

Each shard has its own order of preference over the slots of a table of prime
size, from two hashes of its name. The shards take turns: each claims the first
slot of its order that is still free, until the table is full. All shards end up
with the same number of slots, give or take one, and when shards come or go most
slots keep theirs. A row's slot is the hash of its key modulo the table size, so
placing it takes one look into the broadcast table, whose size is fixed.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SHARDS = tuple(f"shard-{i:03d}" for i in range(64))
#: A prime, well above a hundred times the number of shards.
TABLE_SIZE = 65_537


def _preference(name: str, size: int) -> tuple[int, int]:
    digest = hashlib.md5(name.encode()).digest()
    first, step = (int.from_bytes(digest[i : i + 8], "big") for i in (0, 8))
    return first % size, step % (size - 1) + 1


def lookup_table(shards: tuple[str, ...] = SHARDS, size: int = TABLE_SIZE) -> np.ndarray:
    """The shard (by number) of each slot; ``size`` is a prime no less than the shards."""
    if not shards or len(set(shards)) != len(shards) or len(shards) > size:
        raise ValueError("shards are named once each, and no more than the slots")
    if size < 2 or any(size % d == 0 for d in range(2, int(size**0.5) + 1)):
        raise ValueError(f"the table size {size} is not a prime")
    table = np.full(size, -1, dtype=np.int64)
    places = [_preference(name, size) for name in shards]
    now, steps = [p for p, _ in places], [s for _, s in places]
    left = size
    while left:
        for shard in range(min(len(shards), left)):
            slot = now[shard]
            while table[slot] >= 0:
                slot = (slot + steps[shard]) % size
            table[slot] = shard
            now[shard] = slot
        left -= min(len(shards), left)
    return table


def _slots(spark: SparkSession, shards: tuple[str, ...], size: int) -> DataFrame:
    table = lookup_table(shards, size)
    names = np.array(shards, dtype=object)[table]
    return spark.createDataFrame(pd.DataFrame({"slot": np.arange(size), "shard": names}))


def _slot(key: str, text: str, size: int):
    # Rows without a key are spread by their content.
    lot = F.when(F.col(key).isNull(), F.xxhash64(text, F.lit("no key")))
    return F.pmod(lot.otherwise(F.xxhash64(key)), F.lit(size))


def place(
    docs: DataFrame,
    shards: tuple[str, ...] = SHARDS,
    size: int = TABLE_SIZE,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row for each row of ``docs``: the key, slot, shard. Nothing is shuffled.

    Rows of equal keys share a shard. A null key is placed by the hash of its text,
    null texts together. Other columns are not looked at; no rows give no rows.
    """
    slots = F.broadcast(_slots(docs.sparkSession, shards, size))
    return docs.select(F.col(key).alias(key), _slot(key, text, size).alias("slot")).join(
        slots, "slot"
    ).select(key, "slot", "shard")


def write_shards(docs: DataFrame, path: str, shards: tuple[str, ...] = SHARDS, **options) -> None:
    """All columns of ``docs`` as Parquet, in a folder ``_shard=<name>`` for each shard."""
    size = options.pop("size", TABLE_SIZE)
    key, text = options.pop("key", "doc_id"), options.pop("text", "text")
    slots = _slots(docs.sparkSession, shards, size).toDF("_slot", "_shard")
    placed = docs.withColumn("_slot", _slot(key, text, size)).join(F.broadcast(slots), "_slot")
    placed.drop("_slot").write.partitionBy("_shard").parquet(path)
