"""Exact order statistics of groups from counts, without a list of a group's values and without a task that sorts a group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loom.plans.shared import written

#: Cells that an interval is cut into in one pass, and the different values up to which an interval is put in order whole.
CELLS, SORTED = 1024, 65_536


def order_statistics(df: DataFrame, group: str, value: str, ranks: DataFrame, cells: int = CELLS, most: int = SORTED) -> DataFrame:
    """(group, rank, value): the rank-th smallest value of each group, counted from 1, for ranks (group, rank).

    Values are counted in the tasks first, so repeats cost nothing later. A pass counts the values of each interval that still
    holds a wanted rank by cells of equal width, and keeps the cells in which the ranks fall; intervals are as wide as the values
    in them, so each pass tells the smallest from the largest. Intervals of `most` different values and fewer are put in order.
    A window holds at most that many rows, or `cells`. The driver learns one number a pass. Evenly spread values take a pass or two; values of many
    magnitudes may take one for each power of `cells` between them.

    Nulls, NaN and infinite values don't count; a null group is a group; ranks below 1, beyond their group's values or without a group give no row;
    repeated ranks count once. Values become doubles.
    """
    if cells < 2 or most < 1:
        raise ValueError("an interval needs two cells and room for one value")
    v = F.col(value).cast("double")
    real = v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
    counts = written(df.where(real).select(F.col(group).alias("g"), (v + 0.0).alias("v")).groupBy("g", "v").agg(F.count("*").alias("n")))
    of = counts.groupBy("g").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.sum("n").alias("n"), F.count("*").alias("different"))
    asked = ranks.select(F.col(group).alias("g"), F.col("rank").cast("long").alias("rank")).distinct()
    wanted = written(asked.join(of, asked.g.eqNullSafe(of.g)).where("rank BETWEEN 1 AND n").select(asked.g, "rank", "lo", "hi", "different",
        F.col("rank").alias("left")))
    while (wanted.agg(F.max("different")).first()[0] or 0) > most:
        wanted = written(_narrowed(counts, wanted, cells, most))
    inside = _inside(counts, wanted)
    upto = F.sum("n").over(Window.partitionBy("g", "lo").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    runs = inside.select("g", "lo", "v", "n", upto.alias("upto")).alias("r")
    w = wanted.alias("w")
    met = w.join(runs, F.col("w.g").eqNullSafe(F.col("r.g")) & (F.col("w.lo") == F.col("r.lo")))
    met = met.where((F.col("left") <= F.col("upto")) & (F.col("left") > F.col("upto") - F.col("n")))
    return met.select(F.col("w.g").alias(group), "rank", F.col("v").alias(value))


def _inside(counts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The counted values in the wanted intervals, with these; intervals of a group don't overlap."""
    w = wanted.select("g", "lo", "hi", "different").distinct().alias("w")
    c = counts.alias("c")
    met = c.join(w, F.col("c.g").eqNullSafe(F.col("w.g")) & F.col("c.v").between(F.col("w.lo"), F.col("w.hi")))
    return met.select("c.g", "lo", "hi", "different", "v", "n")


def _narrowed(counts: DataFrame, wanted: DataFrame, cells: int, most: int) -> DataFrame:
    """wanted with the intervals of more than most values cut down to the cells in which their ranks fall."""
    wide, done = wanted.where(F.col("different") > most), wanted.where(F.col("different") <= most)
    # Halves before differences: the width of an interval may be beyond the largest double.
    place = (F.col("v") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2)
    cell = F.when(F.col("v") == F.col("hi"), cells - 1).otherwise(F.least(F.floor(place * (cells - 1)), F.lit(cells - 2)).cast("int"))
    per = _inside(counts, wide).groupBy("g", "lo", cell.alias("cell")).agg(F.sum("n").alias("n"), F.min("v").alias("first"), F.max("v").alias("last"),
        F.count("*").alias("few"))
    upto = F.sum("n").over(Window.partitionBy("g", "lo").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0))
    per, w = per.withColumn("before", upto - F.col("n")).alias("p"), wide.alias("w")
    met = w.join(per, F.col("w.g").eqNullSafe(F.col("p.g")) & (F.col("w.lo") == F.col("p.lo")))
    met = met.where((F.col("left") > F.col("before")) & (F.col("left") <= F.col("before") + F.col("n")))
    return met.select("w.g", "rank", F.col("first").alias("lo"), F.col("last").alias("hi"), F.col("few").alias("different"),
        (F.col("left") - F.col("before")).alias("left")).unionByName(done)
