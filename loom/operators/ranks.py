"""Places in a global order, and within groups, without a task that holds the whole or a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loom.plans.shared import written


def ranked(df: DataFrame, *order: Column, name: str = "place") -> DataFrame:
    """df with its rows' places from 1 by the order, which should be total: rows that are equal in it get places as they come.

    Rows are dealt out by ranges of the order and sorted there; a row's place is its number in its range and the rows of the ranges
    before, whose counts are one row a range. Only they meet in one task. An empty table stays empty.
    """
    n = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    at = F.monotonically_increasing_id()
    dealt = written(df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("__at", at))
    part = F.shiftright("__at", 33).alias("__part")
    before = F.coalesce(F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = dealt.groupBy(part).agg(F.count("*").alias("n")).select("__part", before.alias("__before"))
    out = dealt.withColumn("__part", part).join(F.broadcast(counts), "__part")  # one row for each of n ranges
    return out.withColumn(name, F.col("__before") + F.col("__at").bitwiseAND((1 << 33) - 1) + 1).drop("__part", "__before", "__at")


def ranked_within(df: DataFrame, group: str, *order: Column, name: str = "place") -> DataFrame:
    """df with its rows' places from 1 within each group, by the order; a hot group is dealt out like any other. No null groups."""
    whole = written(ranked(df, F.col(group), *order, name="__global"))
    first = whole.groupBy(group).agg(F.min("__global").alias("__first"))
    return whole.join(first, group).withColumn(name, F.col("__global") - F.col("__first") + 1).drop("__global", "__first")
