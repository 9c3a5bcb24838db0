"""Sharding: a permutation-filled lookup table (DataFrame functions on the data path).

Every shard has its own permutation of the slots of a table whose size is prime (offset and
step from a hash of its name). Shards take turns; in its turn a shard claims the first slot
of its permutation that is still free, so all shards own the same number of slots but for
one, and removing a shard leaves nearly all other slots where they were. A row's key hashes
to a slot; the table, of fixed size, is joined by broadcast: one look-up per row.

The hash is the first 60 bits of MD5, so that any SQL engine can repeat it.

Defined results: a null key hashes as the empty text; repeated rows go to the same shard;
an empty table gives an empty result; columns besides the key take no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOTS = 4099
SHARDS = tuple(f"shard-{i:02d}" for i in range(31))


def _hash(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def _prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def fill(shards: Sequence[str], slots: int = SLOTS, turns: dict[str, int] | None = None) -> list[int]:
    """The lookup table: the shard number of every slot. ``turns`` gives a shard several
    claims per round (its weight); default one."""
    if not _prime(slots):
        raise ValueError("the number of slots must be prime, so that every step visits all")
    if not shards or len(shards) > slots or len(set(shards)) != len(shards):
        raise ValueError("shards must be distinct, at least one and at most one per slot")
    offset = [_hash("offset:" + s) % slots for s in shards]
    step = [_hash("step:" + s) % (slots - 1) + 1 for s in shards]
    seen = [0] * len(shards)
    table, free = [-1] * slots, slots
    while free:
        for i, name in enumerate(shards):
            for _ in range((turns or {}).get(name, 1)):
                if not free:
                    break
                while table[at := (offset[i] + seen[i] * step[i]) % slots] >= 0:
                    seen[i] += 1
                table[at] = i
                free -= 1
    return table


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15)
    return F.pmod(F.conv(digits, 16, 10).cast("bigint"), F.lit(slots)).cast("int")


def lookup(df_session, shards: Sequence[str] = SHARDS, slots: int = SLOTS,
           turns: dict[str, int] | None = None) -> DataFrame:
    """The table as a DataFrame (slot, shard): ``slots`` rows, whatever the data."""
    names = ",".join(str(x) for x in fill(shards, slots, turns))
    row = df_session.range(1).select(F.posexplode(F.split(F.lit(names), ",")))
    return row.select(F.col("pos").alias("slot"), F.col("col").cast("int").alias("shard"))


def place(df: DataFrame, key_col: str = "doc_id", shards: Sequence[str] = SHARDS,
          slots: int = SLOTS, turns: dict[str, int] | None = None) -> DataFrame:
    """key, slot and shard of every row. The broadcast side has ``slots`` rows."""
    keys = df.select(F.col(f"`{key_col}`").alias(key_col),
                     slot_of(F.col(f"`{key_col}`"), slots).alias("slot"))
    return keys.join(F.broadcast(lookup(df.sparkSession, shards, slots, turns)), "slot") \
        .select(key_col, "slot", "shard")


def moved(df: DataFrame, before: Sequence[str], after: Sequence[str], key_col: str = "doc_id",
          slots: int = SLOTS) -> DataFrame:
    """Rows by shard name before and after a change of shards: one partial aggregate."""
    slot = df.groupBy(slot_of(F.col(f"`{key_col}`"), slots).alias("slot")).count()
    old, new = (lookup(df.sparkSession, s, slots).select("slot", F.get(
        F.array(*[F.lit(n) for n in s]), F.col("shard")).alias(c))
        for s, c in ((before, "old"), (after, "new")))
    return slot.join(F.broadcast(old), "slot").join(F.broadcast(new), "slot") \
        .groupBy("old", "new").agg(F.sum("count").alias("rows"))
