"""Placement of documents in shards by a permutation-filled lookup table, by DataFrame functions alone.

Each shard has its own order of the slots of a table with a prime number of slots: a first slot and
a step, both from its name. Shards take turns, each claiming the first slot of its order that is
free, until the table is full. A document goes to the shard in the slot that its key hashes to. A
shard that is added or lost changes few other slots. The table depends on the parameters alone and
has ``slots`` rows, which bounds what is broadcast.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayline.llm.text import unit_hash

SHARDS = 32
SLOTS = 4099  # a prime, over 100 slots a shard
MOST_SLOTS = 1_000_003


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16)


def lookup_table(names: list[str], slots: int = SLOTS) -> list[int]:
    """The shard in each slot. ``slots`` must be a prime not below the number of shards."""
    if slots < max(2, len(names)) or slots > MOST_SLOTS or any(slots % k == 0 for k in range(2, int(slots ** 0.5) + 1)):
        raise ValueError("slots must be a prime, at least the number of shards and at most a million")
    if not names or len(set(names)) < len(names):
        raise ValueError("shards need distinct names")
    at = [_number(f"first:{n}") % slots for n in names]
    step = [_number(f"step:{n}") % (slots - 1) + 1 for n in names]
    table, free = [-1] * slots, slots
    while free:
        for shard in range(len(names)):
            while table[at[shard]] >= 0:
                at[shard] = (at[shard] + step[shard]) % slots
            table[at[shard]] = shard
            free -= 1
            if not free:
                break
    return table


def shard_names(n: int) -> list[str]:
    return [f"shard-{i}" for i in range(n)]


def slot_of(*key: Column, slots: int = SLOTS) -> Column:
    return unit_hash("slot", *key) % slots


def place(docs: DataFrame, shards: int | list[str] = SHARDS, slots: int = SLOTS,
          key: str = "doc_id") -> DataFrame:
    """``docs`` with slot and shard (long), which replace columns of those names.

    Nothing is shuffled. Null keys share one slot; rows with equal keys share theirs; texts are not
    looked at; an empty table stays empty. All other columns pass through.
    """
    names = shard_names(shards) if isinstance(shards, int) else list(shards)
    table = _slots(docs.sparkSession, lookup_table(names, slots))
    kept = [c for c in docs.columns if c.lower() not in ("slot", "shard")]
    slotted = docs.select(*[F.col(f"`{c}`") for c in kept], slot_of(F.col(key), slots=slots).alias("slot"))
    return slotted.join(F.broadcast(table), "slot").select(*[f"`{c}`" for c in kept], "slot", "shard")


def _slots(spark: SparkSession, table: list[int]) -> DataFrame:
    """(slot, shard) with a row per slot."""
    shards = F.split(F.lit(",".join(map(str, table))), ",")
    return spark.range(1).select(F.posexplode(shards).alias("slot", "shard")) \
        .select(F.col("slot").cast("long"), F.col("shard").cast("long"))


def write_shards(placed: DataFrame, path: str) -> None:
    """A folder per shard. Large shards are split over several tasks and files when writing."""
    placed.hint("rebalance", "shard").write.mode("overwrite").partitionBy("shard").parquet(path)
