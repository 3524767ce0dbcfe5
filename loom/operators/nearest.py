"""Nearest representatives: one best, all levels at once, the top with ties, the nearest of a group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loom.functions.kmers import signal
from loom.operators import cells
from loom.operators.greedy import select_representatives
from loom.operators.similarity import cross_sims, pair_sims, sizes, with_distance
from loom.plans.shared import written


def best(sims: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The row of the largest sim for each id (and further keys); of equal ones that with the smallest ref_id."""
    keys = ["id", *(by or [])]
    others = [c for c in sims.columns if c not in keys]
    top = sims.groupBy(*keys).agg(F.min_by(F.struct(*others), F.struct(-F.col("sim"), F.col("ref_id"))).alias("best"))
    return top.select(*keys, *[F.col("best")[c].alias(c) for c in others])


def nearest(queries: DataFrame, references: DataFrame, level: int = 1) -> DataFrame:
    """(id, ref_id, sim, distance, outlier) for every id of queries (an index): outlier when sim does not reach level.

    A query that shares nothing with any reference has null ref_id, sim 0 and distance 1.
    """
    queries, references = written(queries), written(references)
    own, theirs = sizes(queries), sizes(references)
    top = with_distance(best(cross_sims(queries, references)), "id", own, "ref_id", theirs)
    out = own.select("id").join(top, "id", "left")
    return out.select("id", "ref_id", F.coalesce("sim", F.lit(0)).alias("sim"), F.coalesce("distance", F.lit(1.0)).alias("distance"),
        (F.coalesce("sim", F.lit(0)) < level).alias("outlier"))


def nearest_of(queries: cells.Packed, references: cells.Packed, level: int = 1) -> DataFrame:
    """As nearest(), of packed sequences: no row a common k-mer is shuffled."""
    out = queries.sequences().join(cells.best(queries, references), "id", "left")
    return out.select("id", "ref_id", F.coalesce("sim", F.lit(0)).alias("sim"), F.coalesce("distance", F.lit(1.0)).alias("distance"),
        (F.coalesce("sim", F.lit(0)) < level).alias("outlier"))


def updated_assignments(queries: DataFrame, references: DataFrame, level: int) -> DataFrame:
    """As nearest(), for a set that grows: a query that nothing represents becomes a representative, before all later ids.

    Such a query has its own id, sim 9999 and distance 0. Others have the nearest of the references and of the queries
    with smaller ids that were added.
    """
    index = written(queries.unionByName(references))
    nodes = index.select("id").distinct().select("id", F.col("id").alias("priority"))
    sims = written(pair_sims(index, level))
    added = written(select_representatives(nodes, sims.select("id1", "id2"), references.select("id").distinct()).select("id"))
    known = references.select("id", "kmer", F.lit(False).alias("new")).unionByName(queries.join(added, "id", "left_semi").select("id", "kmer",
        F.lit(True).alias("new")))
    counted = queries.join(known.select(F.col("id").alias("ref_id"), "kmer", "new"), "kmer").where("NOT new OR ref_id < id").groupBy("id",
        "ref_id").agg(F.count("*").alias("sim"))
    n = sizes(index)
    top = with_distance(best(counted), "id", n, "ref_id", n).where(F.col("sim") >= level)
    own = added.select("id", F.col("id").alias("ref_id"), F.lit(9999).cast("long").alias("sim"), F.lit(0.0).alias("distance"), F.lit(True).alias("outlier"))
    return own.unionByName(top.join(added, "id", "left_anti").select("id", "ref_id", "sim", "distance", F.lit(False).alias("outlier")))


def cross_proximity(queries: tuple[DataFrame, DataFrame], references: tuple[DataFrame, DataFrame]) -> DataFrame:
    """Queries that two k-mer indexes place with different references: each one's similarity by the other index too.

    (id, seed_rep, seed_sim, seed_rep_rna_sim, rna_rep, rna_sim, rna_rep_seed_sim, ref_seed_sim, ref_rna_sim): the last two
    are of the references with each other. Of each tuple the first index is the seed's.
    """
    sims = [written(cross_sims(q, r)) for q, r in zip(queries, references, strict=True)]
    tops = [best(s).select("id", F.col("ref_id").alias(f"{n}_rep"), F.col("sim").alias(f"{n}_sim")) for n, s in zip(("seed", "rna"), sims, strict=True)]
    out = written(tops[0].join(tops[1], "id").where("seed_rep <> rna_rep"))
    for rep, other, name in (("seed_rep", sims[1], "seed_rep_rna_sim"), ("rna_rep", sims[0], "rna_rep_seed_sim")):
        out = out.join(other.select("id", F.col("ref_id").alias(rep), F.col("sim").alias(name)), ["id", rep], "left")
    for r, name in zip(references, ("ref_seed_sim", "ref_rna_sim"), strict=True):
        pair = out.select("seed_rep", "rna_rep").distinct()
        shared = pair.join(r.select(F.col("id").alias("seed_rep"), "kmer"), "seed_rep").join(r.select(F.col("id").alias("rna_rep"), "kmer"),
            ["rna_rep", "kmer"])
        out = out.join(shared.groupBy("seed_rep", "rna_rep").agg(F.count("*").alias(name)), ["seed_rep", "rna_rep"], "left")
    none = [F.coalesce(c, F.lit(0)).alias(c) for c in ("seed_rep_rna_sim", "rna_rep_seed_sim", "ref_seed_sim", "ref_rna_sim")]
    return out.select("id", "seed_rep", "seed_sim", "rna_rep", "rna_sim", *none)


def assign_levels(queries: DataFrame, rep_index: DataFrame) -> DataFrame:
    """(id, level, ref_id, sim, represented): the nearest representative at each level of rep_index (level, id, kmer).

    The similarities are counted once for all levels: representatives are joined by k-mer, levels only by id.
    """
    members = rep_index.select("level", F.col("id").alias("ref_id")).distinct()
    sims = cross_sims(queries, rep_index.select("id", "kmer").distinct()).join(members, "ref_id")
    return best(sims.select("id", "level", "ref_id", "sim"), ["level"]).withColumn("represented", F.col("sim") >= F.col("level"))


def top_with_ties(queries: DataFrame, references: DataFrame, n: int = 5, least: int = 1) -> DataFrame:
    """(id, place, ref_id, sim, distance, closest, signal): the n most similar references, ties at the cut kept.

    A query with none has one row of nulls; the first row of a query has closest 'Y'.
    """
    queries, references = written(queries), written(references)
    own, theirs = sizes(queries), sizes(references)
    sims = with_distance(cross_sims(queries, references, least), "id", own, "ref_id", theirs)
    w = Window.partitionBy("id").orderBy(F.desc("sim"))
    kept = sims.withColumn("rank", F.rank().over(w)).where(F.col("rank") <= n)
    kept = kept.withColumn("place", F.row_number().over(Window.partitionBy("id").orderBy(F.desc("sim"), "ref_id")))
    out = own.select("id", F.col("n").alias("size")).join(kept, "id", "left")
    return out.select("id", "size", "place", "ref_id", "sim", "distance", F.when(F.col("place") == 1, "Y").otherwise("").alias("closest"),
        signal(F.col("size"), F.col("distance")).alias("signal"))


def group_distance(queries: DataFrame, groups: DataFrame, members: DataFrame, most: float = 0.995) -> DataFrame:
    """(id, grp, distance): the least distance to a member of the query's own group, itself left out, up to `most`.

    queries: (id, kmer); groups: (id, grp) of queries; members: (id, grp, kmer).
    """
    queries, members = written(queries), written(members)
    n = sizes(members.select("id", "kmer").distinct())
    sims = queries.join(groups, "id").join(members.select(F.col("id").alias("ref_id"), "grp", "kmer"),
        ["grp", "kmer"]).where("id <> ref_id").groupBy("id", "grp", "ref_id").agg(F.count("*").alias("sim"))
    out = with_distance(sims, "id", sizes(queries), "ref_id", n).groupBy("id", "grp").agg(F.min("distance").alias("distance"))
    return out.where(F.col("distance") <= most)
