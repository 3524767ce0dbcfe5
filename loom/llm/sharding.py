"""Sharding by a permutation-filled lookup table."""

from __future__ import annotations

from hashlib import blake2b

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARDS, SLOTS = 64, 65_537


def lookup_table(shards: list[str], slots: int = SLOTS) -> list[int]:
    """The shard number of each slot: shards take turns, each claiming the next free slot in its own order of preference.

    The order of shard s is offset + j * skip modulo slots; slots is prime, so every order is a permutation. Shards differ
    by one slot at most, and when one is added or removed few other slots change hands.
    """
    if not shards or slots < len(shards) or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)) or slots < 2:
        raise ValueError("slots must be a prime, at least as large as the number of shards, of which there is one or more")
    number = lambda name, salt: int.from_bytes(blake2b(name.encode(), digest_size=8, salt=salt).digest())
    at = [number(s, b"offset") % slots for s in shards]
    skip = [number(s, b"skip") % (slots - 1) + 1 for s in shards]
    table, left = [-1] * slots, slots
    while left:
        for i in range(len(shards)):
            while table[at[i]] >= 0:
                at[i] = (at[i] + skip[i]) % slots
            table[at[i]] = i
            left -= 1
            if not left:
                break
    return table


def place(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """docs with slot (a hash of the id) and shard (of the table); columns of these names are replaced.

    The table has `slots` rows whatever the data, so it is broadcast. Rows with equal ids meet in one shard. A null id is
    placed by its text, so that such rows spread; null text counts as empty. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    table = spark.createDataFrame(list(enumerate(lookup_table([f"shard-{i}" for i in range(shards)], slots))), "slot int, shard int")
    kept = docs.select(*[c for c in docs.columns if c.lower() not in ("slot", "shard")])
    key = F.coalesce(F.concat(F.lit("id:"), F.col(id_col).cast("string")),
        F.when(F.col(id_col).isNull(), F.concat(F.lit("text:"), F.coalesce(F.col(text_col), F.lit("")))))
    return kept.withColumn("slot", F.pmod(F.xxhash64(key), F.lit(slots)).cast("int")).join(F.broadcast(table), "slot").select(*kept.columns, "slot", "shard")
