"""Taxonomic reports and the checks of nested representative sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loom.functions.sequences import last_mismatch

#: The domain taxon that is told apart, and the default genetic code.
ARCHAEA, DEFAULT_CODE = "2157", 11
STOP_RANKS = {"SPECIES": ["species"], "GENUS": ["species", "genus"], "FAMILY": ["species", "genus", "family"]}


def parse_lineage(genomes: DataFrame, taxa: DataFrame) -> DataFrame:
    """genomes (id, lineage 'a::b::c') with genus, species, domain and genetic_code; rows without a species are left out.

    taxa: (tax_id, rank, genetic_code). The last genus and the last species of the lineage win.
    """
    steps = genomes.select("id", F.posexplode(F.split("lineage", "::")).alias("pos", "tax_id")).join(taxa, "tax_id", "left")
    found = steps.groupBy("id").agg(
        F.max_by("tax_id", F.when(F.col("rank") == "genus", F.col("pos"))).alias("genus"),
        F.max_by("tax_id", F.when(F.col("rank") == "species", F.col("pos"))).alias("species"),
        F.max_by("genetic_code", F.when(F.col("rank") == "species", F.col("pos"))).alias("code"),
        F.when(F.max((F.col("tax_id") == ARCHAEA).cast("int")) == 1, "Archaea").otherwise("Bacteria").alias("domain"),
    )
    found = found.select("id", F.coalesce("genus", F.lit("")).alias("genus"), "species", "domain",
        F.coalesce("code", F.lit(DEFAULT_CODE)).alias("genetic_code"))
    return genomes.join(found.where("species IS NOT NULL"), "id")


def without_species(genomes: DataFrame, parsed: DataFrame) -> DataFrame:
    """What parse_lineage left out."""
    return genomes.join(parsed.select("id"), "id", "left_anti")


def taxon_report(good: DataFrame, rep_col: str, genus_col: str = "genus", species_col: str = "species") -> DataFrame:
    """(tax_id, rank, repgen_id, count, weight): how often each genus and species falls to each representative."""
    taxa = good.select(F.col(rep_col).alias("repgen_id"),
        F.explode(F.array(F.struct(F.lit("genus").alias("rank"), F.col(genus_col).cast("string").alias("tax_id")),
        F.struct(F.lit("species").alias("rank"), F.col(species_col).cast("string").alias("tax_id")))).alias("t")).select("repgen_id", "t.*")
    counts = taxa.where("tax_id IS NOT NULL AND tax_id NOT IN ('', '0')").groupBy("tax_id", "rank", "repgen_id").agg(F.count("*").alias("count"))
    total = counts.groupBy("tax_id", "rank").agg(F.sum("count").alias("total"))
    return counts.join(total, ["tax_id", "rank"]).select("tax_id", "rank", "repgen_id", "count", (F.col("count") / F.col("total")).alias("weight"))


def lineage_text(taxonomy: Column, domain: Column, least_rank: str = "SPECIES") -> Column:
    """Names from the first rank of the stop set on, joined by ', '; the domain where there is none.

    taxonomy: array of (rank, name), finest first.
    """
    stops = F.array(*[F.lit(r) for r in STOP_RANKS[least_rank]])
    at = F.array_position(F.transform(taxonomy, lambda t: F.array_contains(stops, t["rank"])), F.lit(True)).cast("int")
    names = F.transform(F.slice(taxonomy, at, F.size(taxonomy)), lambda t: t["name"])
    return F.when(at > 0, F.array_join(names, ", ")).otherwise(domain)


def hierarchy_errors(good: DataFrame, levels: list[int]) -> DataFrame:
    """(id, level, expected, actual): where a genome's representatives differ from those of its finest one, at the finest level.

    good: (id, rep<level> ...). expected are the finest representative's own representatives. Where that one is no row of
    good nothing can be expected: its genomes are errors of the finest level, with expected null.
    """
    cols = [f"rep{n}" for n in sorted(levels)]
    own = F.array(*[F.col(c) for c in cols])
    reps = good.select(F.col("id").alias(cols[-1]), own.alias("expected"))
    both = good.select("id", cols[-1], own.alias("actual")).join(reps, cols[-1], "left")
    found = F.when(F.col("expected").isNull(), F.lit(len(cols) - 1)).otherwise(last_mismatch(F.col("expected"), F.col("actual")))
    bad = both.withColumn("at", found).where("at IS NOT NULL")
    return bad.select("id", F.get(F.array(*[F.lit(n) for n in sorted(levels)]), F.col("at")).alias("level"),
        F.get("expected", F.col("at")).alias("expected"), F.get("actual", F.col("at")).alias("actual"))


def parents(good: DataFrame, levels: list[int]) -> DataFrame:
    """(level, id, parent): representatives of each level but the coarsest with those of the next coarser one they meet."""
    n = sorted(levels)
    steps = F.array(*[F.struct(F.lit(b).alias("level"), F.col(f"rep{b}").alias("id"), F.col(f"rep{a}").alias("parent")) for a, b in zip(n, n[1:])])
    return good.select(F.explode(steps).alias("e")).select("e.*").where("id IS NOT NULL AND parent IS NOT NULL").distinct()


def multiple_parents(edges: DataFrame) -> DataFrame:
    """The rows of parents() of representatives that have more than one."""
    many = edges.groupBy("level", "id").agg(F.count("*").alias("n")).where("n > 1")
    return edges.join(many.select("level", "id"), ["level", "id"], "left_semi")


def blanked(edges: DataFrame) -> DataFrame:
    """multiple_parents() as printed: (level, id, place, child, set_name, parent), child and set_name blank after the first parent."""
    place = F.row_number().over(Window.partitionBy("level", "id").orderBy("parent"))
    rows = multiple_parents(edges).withColumn("place", place)
    shown = lambda c: F.when(F.col("place") == 1, c).otherwise("")
    return rows.select("level", "id", "place", shown(F.col("id").cast("string")).alias("child"),
        shown(F.concat(F.lit("rep"), F.col("level").cast("string"))).alias("set_name"), "parent")


def tree(edges: DataFrame, levels: list[int]) -> DataFrame:
    """(depth, id, path): every representative below every chain of parents, as many joins as there are levels."""
    n = sorted(levels)
    roots = edges.where(F.col("level") == n[1]).select(F.col("parent").alias("id")).distinct() if len(n) > 1 else edges.select("id")
    level = roots.select(F.lit(0).alias("depth"), "id", F.array("id").alias("path"))
    out = level
    for depth, k in enumerate(n[1:], 1):
        down = edges.where(F.col("level") == k).select(F.col("id").alias("child"), "parent")
        level = level.join(down, level.id == down.parent).select(F.lit(depth).alias("depth"), F.col("child").alias("id"),
            F.concat("path", F.array("child")).alias("path"))
        out = out.unionByName(level)
    return out


def tree_lines(nodes: DataFrame, indent: str = "    ") -> DataFrame:
    """(path, line): the tree as indented text; ordered by path, every node follows its parent."""
    return nodes.select("path", F.concat(F.repeat(F.lit(indent), F.col("depth")), F.col("id").cast("string")).alias("line"))


def missing_in_finer(sets: DataFrame) -> DataFrame:
    """(level, id, missing_in): representatives that the next finer set lacks. sets: (level, id)."""
    levels = sorted(r.level for r in sets.select("level").distinct().collect())
    step = F.create_map(*[F.lit(x) for a, b in zip(levels, levels[1:]) for x in (a, b)]) if len(levels) > 1 else F.create_map(F.lit(-1), F.lit(-1))
    next_level = sets.withColumn("missing_in", F.get(F.array(step[F.col("level")]), F.lit(0))).where("missing_in IS NOT NULL")
    return next_level.join(sets.select(F.col("level").alias("missing_in"), "id"), ["missing_in", "id"], "left_anti").select("level", "id", "missing_in")


def representation_errors(good: DataFrame, sets: DataFrame, levels: list[int]) -> DataFrame:
    """(id, level, bad_rep, error): assigned ids that are no representative, and representatives not their own."""
    long = good.select("id", F.explode(F.array(*[F.struct(F.lit(n).alias("level"),
        F.col(f"rep{n}").alias("rep")) for n in sorted(levels)])).alias("r")).select("id", "r.*").where("rep IS NOT NULL")
    strange = long.join(sets.select("level", F.col("id").alias("rep")), ["level", "rep"], "left_anti").select("id", "level",
        F.col("rep").alias("bad_rep"), F.lit("Not a Representative").alias("error"))
    other = long.join(sets.select("level", "id"), ["level", "id"], "left_semi").where("rep <> id").select("id", "level",
        F.col("rep").alias("bad_rep"), F.lit("Not Self-Representing").alias("error"))
    return strange.unionByName(other)
