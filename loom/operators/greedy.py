"""Greedy representatives: visit items in order, keep one that no kept item resembles; in parallel rounds, same result."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loom.operators import cells
from loom.operators.ranks import ranked
from loom.plans.shared import written

#: Items of a walk's first wave, and how many times as many each next one has.
WAVE, WIDER = 8192, 3
#: Undecided edges that one task finishes; more go through further rounds.
SMALL = 200_000


def select_representatives(nodes: DataFrame, edges: DataFrame, seeds: DataFrame | None = None) -> DataFrame:
    """The nodes (id, priority) that the sequential greedy walk by ascending (priority, id) keeps.

    edges (id1, id2) join items that resemble each other, in either direction. seeds (id) are kept whatever they resemble,
    and are not returned. Each round keeps the items without an undecided better neighbour and drops the neighbours of
    those, so the result is the lexicographically first maximal independent set; rounds are few on similarity graphs.
    When SMALL edges or fewer are left, one task decides the rest. A round writes its remaining edges, once, to the shared folder, so lineage stays short and lost executors do not lose it.
    """
    order = nodes.select("id", "priority")
    ranked = edges.join(order.select(F.col("id").alias("id1"), F.col("priority").alias("p1")),
        "id1").join(order.select(F.col("id").alias("id2"), F.col("priority").alias("p2")), "id2")
    first = F.struct("p1", "id1") < F.struct("p2", "id2")
    graph = ranked.where("id1 <> id2").select(F.when(first, F.col("id1")).otherwise(F.col("id2")).alias("lo"),
        F.when(first, F.col("id2")).otherwise(F.col("id1")).alias("hi")).distinct()
    dropped = []
    if seeds is not None:
        kept = seeds.select("id").distinct()
        near = edges.join(kept.withColumnRenamed("id", "id1"), "id1",
            "left_semi").select(F.col("id2").alias("id")).union(edges.join(kept.withColumnRenamed("id", "id2"), "id2",
            "left_semi").select(F.col("id1").alias("id")))
        gone = written(near.union(kept).distinct())
        dropped.append(gone)
        graph = _without(graph, gone, "lo", "hi")
    while True:
        graph = written(graph)
        if graph.count() <= SMALL:
            dropped.append(written(graph.coalesce(1).mapInPandas(_finish, graph.select(F.col("hi").alias("id")).schema)))
            break
        blocked = graph.select(F.col("hi").alias("lo"), F.lit(True).alias("blocked")).distinct()
        marked = written(graph.join(blocked, "lo", "left").select("lo", "hi", F.col("blocked").isNull().alias("free")))
        gone = marked.where("free").select(F.col("hi").alias("id")).distinct()
        dropped.append(gone)
        graph = _without(marked.where("NOT free").select("lo", "hi"), gone, "lo", "hi")
    out = nodes
    for gone in dropped:
        out = out.join(gone, "id", "left_anti")
    return out


def _finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The dropped nodes of a small graph (lo, hi): nodes are decided once all before them are, each edge is read once."""
    parts = list(batches)
    if not parts:
        return
    edges = pd.concat(parts)
    after, waits = defaultdict(list), defaultdict(int)
    for lo, hi in zip(edges["lo"], edges["hi"], strict=True):
        after[lo].append(hi)
        waits[hi] += 1
    ready, gone = [x for x in after if x not in waits], set()
    while ready:
        node = ready.pop()
        for hi in after[node]:
            if node not in gone:
                gone.add(hi)
            waits[hi] -= 1
            if not waits[hi]:
                ready.append(hi)
    yield pd.DataFrame({"id": edges["hi"].drop_duplicates().loc[lambda x: x.isin(gone)]})


def _without(graph: DataFrame, ids: DataFrame, *columns: str) -> DataFrame:
    for c in columns:
        graph = graph.join(ids.withColumnRenamed("id", c), c, "left_anti")
    return graph


def nested_levels(nodes: DataFrame, sims: DataFrame, levels: list[int]) -> DataFrame:
    """(level, id, priority): representatives at each similarity level, ascending; a level keeps all of the coarser ones.

    sims: (id1, id2, sim) of pairs that reach the least level.
    """
    found: DataFrame | None = None
    out: DataFrame | None = None
    for level in sorted(levels):
        new = select_representatives(nodes, sims.where(F.col("sim") >= level).select("id1", "id2"), found)
        own = written(new if found is None else new.unionByName(nodes.join(found, "id", "left_semi")))
        found = own.select("id")
        part = own.select(F.lit(level).alias("level"), "id", "priority")
        out = part if out is None else out.unionByName(part)
    return out


@dataclass(frozen=True)
class Ordered:
    """Sequences in the order of a walk: order (id, place, bucket), places from 1 without gaps, and packed by bucket."""

    nodes: DataFrame
    order: DataFrame
    seqs: cells.Packed


def ordered(nodes: DataFrame, seqs: DataFrame, k: int) -> Ordered:
    """nodes (id, priority), of rows of one id the first; seqs (id, seq)."""
    nodes = nodes.groupBy("id").agg(F.min("priority").alias("priority"))
    order = ranked(nodes, F.col("priority"), F.col("id")).select("id", "place", F.floor((F.col("place") - 1) / cells.BUCKET).cast("int").alias("bucket"))
    order = written(order)
    return Ordered(nodes, order, cells.packed(seqs.join(order, "id"), k))


def walked(o: Ordered, least: int = 1, most: float = 1.0, seeds: DataFrame | None = None) -> DataFrame:
    """(id, place, bucket): what select_representatives() keeps where sequences resemble each other that share `least` k-mers up to the distance `most`.

    The order is walked in waves. What resembles a kept sequence of an earlier wave is dropped without a list of the pairs; only
    pairs within a wave become edges, when most that resembles much is gone. So no table of all similar pairs is made.
    """
    left, total = o.order, o.order.count()
    if seeds is not None:
        old = left.join(seeds.select("id").distinct(), "id", "left_semi")
        left = left.join(seeds.select("id").distinct(), "id", "left_anti")
        left = written(left.join(cells.resembling(o.seqs.only(left), o.seqs.only(old), least, most).distinct(), "id", "left_anti"))
    kept: DataFrame | None = None
    low, size = 0, WAVE
    while low < total:
        wave, buckets = left.where(F.col("place").between(low + 1, low + size)), -(-size // cells.BUCKET)
        if kept is not None:
            near = cells.resembling(o.seqs.only(wave, buckets), o.seqs.only(kept, -(-low // cells.BUCKET)), least, most)
            wave = written(wave.join(near.distinct(), "id", "left_anti"))
        edges = written(cells.pair_distances(o.seqs.only(wave, buckets), least, most).select("id1", "id2"))
        found = select_representatives(wave.withColumnRenamed("place", "priority"), edges).withColumnRenamed("priority", "place")
        found = written(found.select("id", "place", "bucket"))
        kept = found if kept is None else kept.unionByName(found)
        low, size = low + size, size * WIDER
    return left.limit(0) if kept is None else kept


def nested(o: Ordered, levels: list[int]) -> DataFrame:
    """As nested_levels()."""
    found: DataFrame | None = None
    out: DataFrame | None = None
    for level in sorted(levels):
        new = walked(o, level, seeds=found).select("id")
        found = new if found is None else found.unionByName(new)
        part = o.nodes.join(found, "id", "left_semi").select(F.lit(level).alias("level"), "id", "priority")
        out = part if out is None else out.unionByName(part)
    return out
