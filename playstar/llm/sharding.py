"""Placement of keys on shards by a permutation-filled lookup table."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playstar.llm.common import free_name

#: A prime; more than a hundred slots for each of 64 shards, so shares differ by less than 1 %.
TABLE_SIZE = 8191
#: Largest table: a few MB, so the broadcast of it is bounded whatever the data.
MOST_SLOTS = 1_000_003


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def lookup_table(shards: list[str], size: int = TABLE_SIZE) -> list[int]:
    """The shard's number for each slot.

    Each shard prefers the slots in an order of its own, a walk of fixed stride through the table, whose
    prime size makes it a permutation. Shards take turns claiming the next slot of their order that is free, so
    their shares differ by one slot at most, and few slots move when a shard comes or goes.
    """
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards need distinct names")
    if not len(shards) <= size <= MOST_SLOTS or size < 2 or any(size % n == 0 for n in range(2, int(size**0.5) + 1)):
        raise ValueError(f"the table size must be a prime from the number of shards to {MOST_SLOTS}")
    place = [_number(f"offset {name}") % size for name in shards]
    stride = [_number(f"stride {name}") % (size - 1) + 1 for name in shards]
    table, free, turn = [-1] * size, size, 0
    while free:
        shard = turn % len(shards)
        while table[place[shard]] >= 0:
            place[shard] = (place[shard] + stride[shard]) % size
        table[place[shard]] = shard
        free -= 1
        turn += 1
    return table


def slot_of(keys: list[Column], size: int) -> Column:
    """Slot of a key: 60 bits of the MD5 of its parts. A null part counts as a value of its own, unlike any text."""
    parts = [F.coalesce(F.concat(F.length(key.cast("string")).cast("string"), F.lit(":"), key.cast("string")), F.lit("null")) for key in keys]
    digits = F.substring(F.md5(F.concat_ws(",", *parts).cast("binary")), 1, 15)
    return F.pmod(F.conv(digits, 16, 10).cast("long"), F.lit(size)).cast("int")


def assign(rows: DataFrame, keys: list[str], shards: list[str], size: int = TABLE_SIZE, slot: str = "slot", shard: str = "shard") -> DataFrame:
    """``rows`` with the columns ``slot`` and ``shard`` (its name) added, or replaced where they exist.

    The table has at most MOST_SLOTS rows and is broadcast, so each row costs one hash and one lookup; rows are neither
    shuffled nor grouped, and a crowded key costs nothing. Equal keys have equal shards: choose
    a key without crowded values (an id, not a source) for even shards.

    Null keys, empty texts, repeated rows: placed by their value like any other, null as a value of its own.
    Empty tables stay empty.
    """
    names = [c for c in rows.columns if c not in (slot, shard)]
    key, value = (free_name(f"_{c}", rows.columns) for c in ("slot", "shard"))
    table = [(i, shards[k]) for i, k in enumerate(lookup_table(shards, size))]
    places = rows.sparkSession.createDataFrame(table, f"{key} int, {value} string")
    place = slot_of([F.col(f"`{k}`") for k in keys], size)
    placed = rows.select(*(F.col(f"`{c}`") for c in names), place.alias(slot))
    return placed.join(F.broadcast(places), F.col(f"`{slot}`") == F.col(key), "left").select(
        *(F.col(f"`{c}`") for c in names), slot, F.col(value).alias(shard)
    )


def write_shards(rows: DataFrame, keys: list[str], shards: list[str], path: str, files: int = 4, size: int = TABLE_SIZE) -> None:
    """Write each shard to a folder of its own, in about ``files`` files, whatever the size of a shard."""
    part = free_name("_part", rows.columns)
    spread = F.pmod(F.xxhash64(*keys, F.monotonically_increasing_id()), F.lit(files))
    placed = assign(rows, keys, shards, size).drop("slot").withColumn(part, spread)
    placed.repartition("shard", part).drop(part).write.partitionBy("shard").parquet(path)
