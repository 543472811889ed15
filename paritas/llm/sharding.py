"""Shard placement by a permutation-filled lookup table.

Each shard prefers the slots of a prime-sized table in an order of its own
(a start and a stride from a hash of its name). The shards take turns, each
claiming its most preferred free slot, until the table is full; so shards get
equally many slots, give or take one, and adding or losing one moves few
slots. A row's key hashes to a slot, and the broadcast table, whose size is
fixed by the settings, gives the shard: one lookup, no shuffle.

Edge cases: a row whose key is null takes the slot of the empty string;
repeated rows go to the same shard. An empty table stays empty. Extra columns
stay as they are (``slot`` and ``shard`` are replaced if there).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A prime some hundred times the number of shards keeps shares within one per cent.
SLOTS = 65537
SHARDS = 128


def _hash(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.md5(f"{salt}:{name}".encode()).digest()[:8], "big")


def lookup_table(shards: list[str], slots: int = SLOTS) -> list[int]:
    """For each slot the index of the shard that holds it."""
    if not 1 <= len(shards) <= slots or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("slots must be a prime and at least the number of shards")
    at = [_hash(s, "start") % slots for s in shards]
    stride = [_hash(s, "stride") % (slots - 1) + 1 for s in shards] if slots > 2 else [1] * len(shards)
    owner = [-1] * slots
    left = slots
    while True:
        for i in range(len(shards)):
            while owner[at[i]] >= 0:
                at[i] = (at[i] + stride[i]) % slots
            owner[at[i]] = i
            left -= 1
            if not left:
                return owner


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """The first 15 hexadecimal digits of the key's MD5, modulo the table's size."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15)
    return F.conv(digits, 16, 10).cast("long") % slots


def place(rows: DataFrame, key: str = "doc_id", shards: list[str] | None = None,
          slots: int = SLOTS) -> DataFrame:
    """``rows`` with ``slot`` (long) and ``shard`` (int)."""
    names = shards if shards is not None else [f"shard-{i:05d}" for i in range(SHARDS)]
    held = rows.sparkSession.createDataFrame(
        list(enumerate(lookup_table(names, slots))), "slot long, shard int")
    with_slot = rows.drop("shard").withColumn("slot", slot_of(F.col(key), slots))
    return with_slot.join(F.broadcast(held), "slot").select(
        *[c for c in with_slot.columns], "shard")


def write_shards(placed: DataFrame, folder: str, files: int = 4) -> None:
    """One folder for each shard, each of about ``files`` files; a shard's rows
    are spread over that many tasks."""
    spread = F.pmod(F.xxhash64(*[c for c in placed.columns if c not in ("slot", "shard")][:1]),
                    F.lit(files))
    placed.repartition("shard", spread).write.partitionBy("shard").parquet(folder)
