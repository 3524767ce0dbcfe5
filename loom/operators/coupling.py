"""Functional coupling: which feature classes repeatedly stand close together along an ordered axis.

features: genome, fid, contig, strand, left, right, and what a classifier needs. classes: (genome, fid, class).
pairs of neighbours: genome, fid1, fid2 in location order.
"""

from __future__ import annotations

from collections.abc import Callable
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loom.functions.sequences import canonical_pair, hypothetical, roles_of_function
from loom.operators import bitmaps
from loom.operators.ranks import ranked

# --- classifiers: features -> (genome, fid, class) ---------------------------------------------------------------------


def by_role(features: DataFrame, function: str = "function") -> DataFrame:
    """Every role of the function that is not hypothetical."""
    return features.select("genome", "fid", F.explode(F.array_distinct(F.filter(roles_of_function(F.col(function)),
        lambda r: ~hypothetical(r)))).alias("class"))


def by_family(features: DataFrame, family: str = "pgfam") -> DataFrame:
    """The family of the feature, if it has one; also for local families, given their column."""
    return features.where(F.coalesce(F.col(family), F.lit("")) != "").select("genome", "fid", F.col(family).alias("class"))


def by_random_family(features: DataFrame, family: str = "pgfam", seed: int = 0) -> DataFrame:
    """A control: the families of a genome dealt anew among its features that have one, by the order of MD5("genome:fid:seed")."""
    own = features.where(F.coalesce(F.col(family), F.lit("")) != "").select("genome", "fid", F.col(family).alias("class"))
    w = Window.partitionBy("genome")
    a = own.select("genome", "fid", F.row_number().over(w.orderBy("fid")).alias("n"))
    b = own.select("genome", "class", F.row_number().over(w.orderBy(F.md5(F.concat_ws(":", "genome", "fid", F.lit(seed))), "fid")).alias("n"))
    return a.join(b, ["genome", "n"]).select("genome", "fid", "class")


def by_sequence(features: DataFrame, families: DataFrame, checksum: str = "md5") -> DataFrame:
    """The family that families (fam_id, product, md5) gives for the protein's checksum."""
    return features.join(families.select(F.col("md5").alias(checksum), F.col("fam_id").alias("class")), checksum).select("genome", "fid", "class").distinct()


CLASSIFIERS: dict[str, Callable[..., DataFrame]] = {"ROLES": by_role, "PGFAMS": by_family, "RANDOM": by_random_family, "LOCAL_TEST": by_family,
    "FILE_FAMILY": by_sequence}

# --- neighbours --------------------------------------------------------------------------------------------------------



def adjacent(features: DataFrame, distance: int = 5000) -> DataFrame:
    """Each feature with the next one in location order, when the gap is within distance. Features without a class count."""
    w = Window.partitionBy("genome", "contig", "strand").orderBy("left", "fid")
    out = features.select("genome", F.col("fid").alias("fid1"), F.lead("fid").over(w).alias("fid2"), (F.lead("left").over(w) - F.col("right")).alias("gap"))
    return out.where("fid2 IS NOT NULL").where(F.col("gap") <= distance).select("genome", "fid1", "fid2", "gap")


def close(features: DataFrame, distance: int = 5000) -> DataFrame:
    """Each feature with those that follow on its contig and strand, up to the first gap beyond distance.

    Features meet by an equi-join on bins of the axis as wide as distance, never all with all: a feature stands in every bin
    it or its reach touches, and meets those that begin there. The gap to what follows grows along the contig, so all within
    distance come before the first that is not.
    """
    width = max(1, distance)
    bin_of = lambda c: F.floor(F.col(c) / width)
    a = features.select("genome", "contig", "strand", F.col("fid").alias("fid1"), F.col("left").alias("l1"), F.col("right").alias("r1"),
        F.explode(F.sequence(bin_of("left"), F.floor((F.col("right") + distance) / width))).alias("bin"))
    b = features.select("genome", "contig", "strand", F.col("fid").alias("fid2"), F.col("left").alias("l2"), F.col("right").alias("r2"),
        bin_of("left").alias("bin"))
    after = (F.col("l2") > F.col("l1")) | ((F.col("l2") == F.col("l1")) & (F.col("fid2") > F.col("fid1")))
    pairs = a.join(b, ["genome", "contig", "strand", "bin"]).where(after).withColumn("gap", F.greatest(F.col("l2") - F.col("r1"), F.col("l1") - F.col("r2")))
    return pairs.where(F.col("gap") <= distance).select("genome", "fid1", "fid2", "gap")


FINDERS = {"ADJACENT": adjacent, "CLOSE": close}

# --- class filters: (genome, fid, class) -> fewer; the features stay ---------------------------------------------------


def all_classes(classes: DataFrame) -> DataFrame:
    return classes


def without_listed(classes: DataFrame, blacklist: DataFrame) -> DataFrame:
    return classes.join(blacklist.select("class").distinct(), "class", "left_anti").select("genome", "fid", "class")


def limited(classes: DataFrame, limit: int = 2) -> DataFrame:
    """Without the classes that stand more than limit times in the genome."""
    many = classes.groupBy("genome", "class").agg(F.count("*").alias("n")).where(F.col("n") > limit)
    return classes.join(many.select("genome", "class"), ["genome", "class"], "left_anti").select("genome", "fid", "class")


CLASS_FILTERS = {"NONE": all_classes, "BLACKLIST": without_listed, "LIMITED": limited}

# --- pairs -------------------------------------------------------------------------------------------------------------


def class_pairs(neighbors: DataFrame, classes: DataFrame, weights: DataFrame) -> DataFrame:
    """(class1, class2, genome, fid1, fid2, weight): neighbours as pairs of two different classes.

    weights: (genome, class, n), counted before any class filter; a pair weighs 1 / (n1 * n2).
    """
    one = classes.select("genome", F.col("fid").alias("fid1"), F.col("class").alias("a"))
    two = classes.select("genome", F.col("fid").alias("fid2"), F.col("class").alias("b"))
    low, high = canonical_pair(F.col("a"), F.col("b"))
    out = neighbors.join(one, ["genome", "fid1"]).join(two, ["genome", "fid2"]).where("a <> b").withColumns({"class1": low, "class2": high})
    out = out.join(weights.select("genome", F.col("class").alias("class1"), F.col("n").alias("n1")),
        ["genome", "class1"]).join(weights.select("genome", F.col("class").alias("class2"), F.col("n").alias("n2")), ["genome", "class2"])
    return out.select("class1", "class2", "genome", "fid1", "fid2", (1.0 / (F.col("n1") * F.col("n2"))).alias("weight"))


def class_counts(classes: DataFrame) -> DataFrame:
    """(genome, class, n)."""
    return classes.groupBy("genome", "class").agg(F.count("*").alias("n"))


def pair_genomes(pairs: DataFrame, subsystems: DataFrame | None = None) -> DataFrame:
    """(class1, class2, genome, weight, sub_match, sub_fail): a genome counts its weight once, matches per occurrence.

    subsystems: (genome, fid, subsystems array). An occurrence matches when its features share one, fails when only one of
    them has any or they share none; two without any do neither.
    """
    if subsystems is None:
        pairs = pairs.withColumns({"hit": F.lit(0), "miss": F.lit(0)})
    else:
        none = F.array().cast("array<string>")
        for i in ("1", "2"):
            pairs = pairs.join(subsystems.select("genome", F.col("fid").alias(f"fid{i}"), F.col("subsystems").alias(f"s{i}")), ["genome", f"fid{i}"],
                "left").withColumn(f"s{i}", F.coalesce(f"s{i}", none))
        hit = F.arrays_overlap("s1", "s2")
        pairs = pairs.withColumns({"hit": hit.cast("int"), "miss": (~hit & (F.size("s1") + F.size("s2") > 0)).cast("int")})
    return pairs.groupBy("class1", "class2", "genome").agg(F.min("weight").alias("weight"), F.sum("hit").alias("sub_match"), F.sum("miss").alias("sub_fail"))


def pair_totals(per_genome: DataFrame) -> DataFrame:
    """(class1, class2, size, weight, sub_match, sub_fail)."""
    return per_genome.groupBy("class1", "class2").agg(F.count("*").alias("size"), F.sum("weight").alias("weight"),
        F.sum("sub_match").alias("sub_match"), F.sum("sub_fail").alias("sub_fail"))


def in_size_order(totals: DataFrame) -> DataFrame:
    """totals with place: the largest couplings first, equal ones by their classes."""
    return ranked(totals, F.desc("size"), F.col("class1"), F.col("class2"))


def by_size(totals: DataFrame, limit: float = 15.0) -> DataFrame:
    if limit <= 1:
        raise ValueError("a size limit must exceed 1")
    return totals.where(F.col("size") >= ceil(limit))


def by_weight(totals: DataFrame, limit: float = 15.0) -> DataFrame:
    return totals.where(F.col("weight") >= limit)


def whitelisted(totals: DataFrame, whitelist: DataFrame) -> DataFrame:
    """Pairs of which either class is listed."""
    one = whitelist.select(F.col("class").alias("class1")).distinct().withColumn("in1", F.lit(True))
    two = whitelist.select(F.col("class").alias("class2")).distinct().withColumn("in2", F.lit(True))
    return totals.join(one, "class1", "left").join(two, "class2", "left").where("in1 OR in2").select(*totals.columns)


PAIR_FILTERS = {"SIZE": by_size, "WEIGHT": by_weight, "WHITELIST": whitelisted}

# --- reports -----------------------------------------------------------------------------------------------------------


def groups_report(per_genome: DataFrame, totals: DataFrame) -> DataFrame:
    """(class1, class2, genomes): the genomes of each pair that passed, sorted, joined by commas."""
    kept = per_genome.join(totals.select("class1", "class2"), ["class1", "class2"], "left_semi")
    return kept.groupBy("class1", "class2").agg(F.array_join(F.sort_array(F.collect_set("genome")), ",").alias("genomes"))


def scores_report(per_genome: DataFrame, totals: DataFrame, classes: DataFrame, genome_sims: DataFrame) -> DataFrame:
    """totals with sim_distance, real_distance, percent1 and percent2.

    genome_sims: (g1, g2, sim, distance) of genomes g1 < g2 that share a k-mer; the others have sim 0 and distance 1.
    sim_distance sums 1 / (sim + 1) over the pairs of a pair's genomes, real_distance their distances. All pairs of a group
    would be quadratic, so the sums start from the number of pairs, for which each adds 1 and 1, and only pairs that share a
    k-mer correct them.
    """
    member = per_genome.join(totals.select("class1", "class2"), ["class1", "class2"], "left_semi").select("class1", "class2", "genome")
    a, b = member.withColumnRenamed("genome", "g1"), member.withColumnRenamed("genome", "g2")
    near = a.join(genome_sims, "g1").join(b, ["class1", "class2", "g2"])
    less = near.groupBy("class1", "class2").agg(F.sum(1.0 - 1.0 / (F.col("sim") + 1)).alias("less_sim"), F.sum(1.0 - F.col("distance")).alias("less_real"))
    has = bitmaps.counted(bitmaps.bitmaps(classes, ["class"], "genome", bitmaps.dense_ids(classes, "genome")), ["class"], "genomes")
    all_pairs = F.col("size") * (F.col("size") - 1) / 2
    out = totals.join(less, ["class1", "class2"], "left")
    for i in ("1", "2"):
        out = out.join(has.select(F.col("class").alias(f"class{i}"), F.col("genomes").alias(f"has{i}")), f"class{i}")
    return out.select(*totals.columns, (all_pairs - F.coalesce("less_sim", F.lit(0.0))).alias("sim_distance"),
        (all_pairs - F.coalesce("less_real", F.lit(0.0))).alias("real_distance"), (100.0 * F.col("size") / F.col("has1")).alias("percent1"),
        (100.0 * F.col("size") / F.col("has2")).alias("percent2"))


def verify_report(known: DataFrame, classes: DataFrame, totals: DataFrame) -> DataFrame:
    """(class1, class2, size, occurrences, percent) of known pairs: genomes where they are coupled, and where both stand."""
    low, high = canonical_pair(F.col("class1"), F.col("class2"))
    pairs = known.select(low.alias("class1"), high.alias("class2")).distinct()
    has = classes.select("genome", "class").distinct()
    both = pairs.join(has.select("genome", F.col("class").alias("class1")), "class1").join(has.select("genome", F.col("class").alias("class2")),
        ["genome", "class2"])
    occurs = both.groupBy("class1", "class2").agg(F.count("*").alias("occurrences"))
    out = pairs.join(occurs, ["class1", "class2"], "left").join(totals.select("class1", "class2", "size"), ["class1", "class2"], "left")
    size, n = F.coalesce("size", F.lit(0)), F.coalesce("occurrences", F.lit(0))
    return out.select("class1", "class2", size.alias("size"), n.alias("occurrences"), F.when(n > 0, size * 100.0 / n).otherwise(0.0).alias("percent"))


def link_back(pairs: DataFrame, couplings: DataFrame) -> DataFrame:
    """(genome, fid, target, size, strength): for each neighbour pair its strongest coupling, seen from both features.

    pairs: of class_pairs; couplings: (class1, class2, size, strength).
    """
    strongest = pairs.join(couplings, ["class1", "class2"]).groupBy("genome", "fid1", "fid2").agg(F.max(F.struct("size", "strength")).alias("c"))
    one = strongest.select("genome", F.col("fid1").alias("fid"), F.col("fid2").alias("target"), "c.size", "c.strength")
    return one.union(strongest.select("genome", F.col("fid2").alias("fid"), F.col("fid1").alias("target"), "c.size", "c.strength"))


def coupled_features(pairs: DataFrame, couplings: DataFrame) -> DataFrame:
    """(class1, class2, n, features): the feature pairs of each coupling that has any, sorted and joined by commas."""
    text = F.concat(F.least("fid1", "fid2"), F.lit(":"), F.greatest("fid1", "fid2"))
    found = pairs.join(couplings.select("class1", "class2"), ["class1", "class2"], "left_semi").select("class1", "class2", text.alias("f")).distinct()
    return found.groupBy("class1", "class2").agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_list("f")), ",").alias("features"))


def run_statistics(totals: DataFrame) -> DataFrame:
    """(pairs, mean_size, max_size) of the pairs a run gives out."""
    return totals.agg(F.count("*").alias("pairs"), F.avg("size").alias("mean_size"), F.max("size").alias("max_size"))


def couplings_of_genomes(pairs: DataFrame, couplings: DataFrame, features: DataFrame) -> DataFrame:
    """(genome, couplings): how many neighbour pairs of a genome are coupled; genomes without any are left out."""
    linked = link_back(pairs, couplings).where(F.col("fid") < F.col("target")).groupBy("genome").agg(F.count("*").alias("couplings"))
    return features.select("genome").distinct().join(linked, "genome")


def report_lines(report: DataFrame, kind: str = "ROLES") -> DataFrame:
    """(line): a report as tab-separated text; families have their products beside them."""
    classes = ("class1", "class2") if kind == "ROLES" else ("class1", "family_product1", "class2", "family_product2")
    return report.select(F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (*classes, "size", "weight")]).alias("line"))


def read_report(lines: DataFrame, kind: str = "ROLES") -> DataFrame:
    """(class1, class2, size, strength) of a report's lines, the pair in canonical order; lines with too few fields don't count."""
    part, (one, two, size) = F.split("line", "\t"), (0, 1, 2) if kind == "ROLES" else (0, 2, 4)
    rows = lines.select(part.alias("p")).where(F.size("p") > size + 1)
    low, high = canonical_pair(F.get("p", F.lit(one)), F.get("p", F.lit(two)))
    return rows.select(low.alias("class1"), high.alias("class2"), F.get("p", F.lit(size)).try_cast("long").alias("size"),
        F.get("p", F.lit(size + 1)).try_cast("double").alias("strength")).where("size IS NOT NULL")


def named(report: DataFrame, names: DataFrame) -> DataFrame:
    """report with family_product1 and family_product2 from names (class, name); '' where there is none."""
    out = report
    for i in ("1", "2"):
        out = out.join(names.select(F.col("class").alias(f"class{i}"), F.col("name").alias(f"family_product{i}")), f"class{i}",
            "left").withColumn(f"family_product{i}", F.coalesce(f"family_product{i}", F.lit("")))
    return out


