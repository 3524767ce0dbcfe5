"""Connected components of an edge table by randomised contraction; nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loom.llm.common import materialize


def components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(node, label) for every node of edges (x, y: long); nodes share a label when a path joins them.

    Each round maps a node to the neighbour (or itself) with the smallest hash of that round and replaces both ends of every
    edge, so that the nodes shrink by a constant factor whatever the shape: no round depends on a path's length. Minima are
    partial sums; the relabelling joins have an exchange on both sides, so a hub's edges can be split. The maps are composed
    at the end. Self loops and repeated edges are harmless; an empty table gives an empty one.
    """
    both = lambda e: e.select("x", "y").union(e.select(F.col("y").alias("x"), F.col("x").alias("y")))
    nodes = both(edges).select(F.col("x").alias("node")).distinct()
    current, maps = materialize(both(edges.where("x <> y")).distinct()), []
    while not current.isEmpty():
        if len(maps) == max_rounds:
            raise RuntimeError("components did not converge")
        ranked = lambda c, salt=len(maps): F.struct(F.xxhash64(c, F.lit(salt)).alias("h"), F.col(c).alias("to"))
        best = materialize(current.groupBy("x").agg(F.min(ranked("y")).alias("m")).select("x", F.least("m", ranked("x"))["to"].alias("to")))
        maps.append(best)
        left = current.join(best, "x").select(F.col("to").alias("x"), "y")
        current = materialize(left.join(best.select(F.col("x").alias("y"), F.col("to").alias("z")), "y").select("x",
            F.col("z").alias("y")).where("x <> y").distinct())
    out = nodes.withColumn("label", F.col("node"))
    for best in maps:
        out = out.join(best.select(F.col("x").alias("label"), "to"), "label", "left").select("node", F.coalesce("to", "label").alias("label"))
    return out
