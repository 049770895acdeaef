"""Sharding by a lookup table that shards fill in turns, each in the order of its own permutation of the slots.

The table has a prime number of slots. Shard s prefers slots offset + k * skip
(mod size), k = 0, 1, ...; in every round each shard claims its next free slot,
so shards get equal parts to within one slot, and few slots change hands when a
shard is added or removed. A document's slot is the hash of its key modulo the
size; the table (`slots` rows, however large the corpus) is broadcast.

A null key hashes like any other value, equal keys share a shard, an empty
table gives no rows. Other columns pass through; the added ones are `slot` and
`shard`, which replace columns of those names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A prime that is at least 100 times as large as the usual number of shards.
SLOTS = 65_537


def fill(names: list[str], slots: int = SLOTS) -> np.ndarray:
    """By slot, the index of the shard that claimed it."""
    if not 0 < len(names) <= slots or len(set(names)) < len(names):
        raise ValueError("between one shard and one per slot, with different names")
    if slots < 2 or any(slots % k == 0 for k in range(2, int(slots**0.5) + 1)):
        raise ValueError("the number of slots must be prime")
    at = np.array([xxhash.xxh64_intdigest(name, seed=1) % slots for name in names])
    skip = np.array([xxhash.xxh64_intdigest(name, seed=2) % (slots - 1) + 1 for name in names])
    owner = [-1] * slots
    left = slots
    while left:
        for shard in range(min(len(names), left)):
            while owner[at[shard]] >= 0:
                at[shard] = (at[shard] + skip[shard]) % slots
            owner[at[shard]] = shard
        left -= min(len(names), left)
    return np.array(owner)


def lookup_table(spark: SparkSession, names: list[str], slots: int = SLOTS) -> DataFrame:
    """slot, shard (name)."""
    owner = fill(names, slots)
    return spark.createDataFrame(pa.table({"slot": pa.array(range(slots), pa.int32()), "shard": pa.array([names[k] for k in owner])}))


def place(docs: DataFrame, names: list[str], key: str = "doc_id", slots: int = SLOTS) -> DataFrame:
    """The rows with their `slot` and `shard`; one hash and one look-up per row, no shuffle."""
    rows = docs.drop("slot", "shard").withColumn("slot", F.pmod(F.xxhash64(F.col(key)), F.lit(slots)).cast("int"))
    return rows.join(F.broadcast(lookup_table(docs.sparkSession, names, slots)), "slot")


def write_shards(docs: DataFrame, path: str, names: list[str], key: str = "doc_id", slots: int = SLOTS) -> None:
    """A folder per shard. Rows of a shard are written by the tasks that hold them, so no task holds a whole shard."""
    place(docs, names, key, slots).drop("slot").write.partitionBy("shard").parquet(path)
