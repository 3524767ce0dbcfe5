"""Distinct sets as bitmaps over dense ids: they merge, meet and are counted without another distinct."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loom.operators.ranks import ranked
from loom.plans.shared import written


def dense_ids(df: DataFrame, member: str) -> DataFrame:
    """(member, dense): the different members numbered from 1, without a task that holds them all. Nulls get no number."""
    return written(ranked(df.select(member).where(F.col(member).isNotNull()).distinct(), F.col(member), name="dense").select(member, "dense"))


def bitmaps(df: DataFrame, keys: list[str], member: str, ids: DataFrame) -> DataFrame:
    """(keys, bucket, bits): each key's different members, 32,768 ids a bucket; members without a number are left out.

    Tasks set bits before the shuffle, so a key that holds a third of all rows shuffles one bitmap of 4 KB a task and bucket.
    """
    numbered = df.join(ids, member)
    return numbered.groupBy(*keys, F.bitmap_bucket_number("dense").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("dense")).alias("bits"))


def merged(sets: DataFrame, keys: list[str]) -> DataFrame:
    """The unions of the sets alike in these fewer keys."""
    return sets.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def counted(sets: DataFrame, keys: list[str], name: str = "n") -> DataFrame:
    """(keys, name): the sizes of the sets; an empty set has no row."""
    return sets.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(name))


def in_common(pairs: DataFrame, sets: DataFrame, key: str, one: str, two: str, name: str = "n") -> DataFrame:
    """(one, two, name): for each of the different pairs the members that both sets hold, 0 included; pairs with a null have 0.

    A pair meets the buckets of its two sets and no members: 4 KB for up to 32,768 of them.
    """
    named = lambda c: sets.select(F.col(key).alias(c), "bucket", "bits")
    p = pairs.select(one, two).distinct()
    a, b = p.join(named(one), one), p.join(named(two), two)
    rows = a.unionByName(b).groupBy(one, two, "bucket").agg(F.bitmap_and_agg("bits").alias("bits"), F.count("*").alias("sides"))
    sizes = counted(rows.where("sides = 2"), [one, two], "__n")
    return p.join(sizes, [one, two], "left").select(one, two, F.coalesce("__n", F.lit(0)).alias(name))
