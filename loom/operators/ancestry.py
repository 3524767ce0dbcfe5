"""Hierarchies of any depth by pointer jumping: roots, depths, cycles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loom.plans.shared import written


def ancestry(nodes: DataFrame, id_col: str = "id", parent_col: str = "parent") -> DataFrame:
    """(id, root, depth, state) of every node of nodes (id, parent), each of which has one parent or none.

    state is 'root' for a node without a parent, 'orphan' for one whose parent is no node (both are their own roots, at depth
    0), 'below' for one that reaches a root, 'cycle' for one on a cycle, 'above cycle' for one that leads into a cycle; the last
    two have neither root nor depth. A node that is its own parent is a cycle. Null ids don't count; of rows of one id the
    smallest parent counts, null last. An empty table gives an empty one.

    Each pass doubles the steps that a pointer spans, so a chain of n nodes takes log2(n) passes, each one join by id of the
    nodes that are still on their way. They all lead into cycles when a pass brings none to its root; pointers of at least
    as many steps as there are such nodes then end on cycles, and on every node of them.
    """
    n = nodes.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.min(parent_col).alias("parent"))
    known = n.select(F.col("id").alias("parent"), F.lit(True).alias("known"))
    state = F.when(F.col("parent").isNull(), "root").when(F.col("known").isNull(), "orphan").otherwise("below")
    all_nodes = written(n.join(known, "parent", "left").select("id", F.when(F.col("known"), F.col("parent")).alias("up"), state.alias("state")))
    ends = all_nodes.where("up IS NULL").select("id", F.col("id").alias("root"), F.lit(0).cast("long").alias("depth"), "state")
    reached = written(ends)
    going = written(all_nodes.where("up IS NOT NULL").select("id", "up"))
    done, left, span = [reached], going.count(), 1
    while left:
        # What a pointer meets: an end span steps away or fewer, or a node whose own pointer goes on.
        met = reached.select(F.col("id").alias("up"), "root", "depth")
        found = written(going.join(met, "up").select("id", "root", (F.col("depth") + span).alias("depth"), F.lit("below").alias("state")))
        rest = going.join(found.select("id"), "id", "left_anti")
        on = going.select(F.col("id").alias("up"), F.col("up").alias("next"))
        after = written(rest.join(on, "up").select("id", F.col("next").alias("up")))
        now = after.count()
        if now == left and span >= left:
            break
        done.append(found)
        reached = written(reached.unionByName(found)) if now else reached
        going, left, span = after, now, 2 * span
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    turning = going.select(F.col("up").alias("id")).distinct().withColumn("turns", F.lit(True))
    lost = going.select("id").join(turning, "id", "left").select("id", F.lit(None).cast(all_nodes.schema["id"].dataType).alias("root"),
        F.lit(None).cast("long").alias("depth"), F.when(F.col("turns"), "cycle").otherwise("above cycle").alias("state"))
    return out.unionByName(lost)
