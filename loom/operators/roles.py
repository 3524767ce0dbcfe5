"""Role coverage: universal roles, missing and over-present ones, the longest sequence of a role."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loom.functions.sequences import percent_threshold, role_type, without_comment
from loom.functions.stats import sample_deviation
from loom.operators.ranks import ranked_within

REPORTS = {"FULL": ("MISSING", "GOOD", "OVER_PRESENT"), "MISSING": ("MISSING",), "OVER_PRESENT": ("OVER_PRESENT",), "BAD": ("MISSING", "OVER_PRESENT")}
DOMAINS = ("Bacteria", "Archaea")


def universal_roles(features: DataFrame, percent: float = 80.0) -> DataFrame:
    """(role, count, percent, mean_len, sdev_len, families): roles that stand just once in enough genomes.

    features: (genome, role, length, family). count: genomes with the role once; lengths are of those; families of all.
    """
    genomes = features.agg(F.count_distinct("genome").alias("genomes"))
    per_genome = features.groupBy("genome", "role").agg(F.count("*").alias("n"), F.min("length").alias("length"))
    single = per_genome.where("n = 1").groupBy("role").agg(F.count("*").alias("count"), F.avg("length").alias("mean_len"),
        sample_deviation(F.col("length")).alias("sdev_len"))
    families = features.where("family IS NOT NULL").groupBy("role").agg(F.array_join(F.sort_array(F.collect_set("family")), ",").alias("families"))
    kept = single.crossJoin(F.broadcast(genomes)).where(F.col("count") >= percent_threshold(percent, F.col("genomes")))  # one row
    out = kept.join(families, "role", "left")
    return out.select("role", "count", (F.col("count") * 100.0 / F.col("genomes")).alias("percent"), "mean_len", "sdev_len",
        F.coalesce("families", F.lit("")).alias("families"))


def in_domains(features: DataFrame, genomes: DataFrame, domains: tuple[str, ...] = DOMAINS) -> DataFrame:
    """The features of genomes (genome, domain) of the given domains."""
    return features.join(genomes.where(F.col("domain").isin(*domains)).select("genome").distinct(), "genome", "left_semi")


def with_seed(features: DataFrame, seed: str) -> DataFrame:
    """The features of genomes that have a feature of the seed role; the others are skipped."""
    return features.join(features.where(F.col("role") == seed).select("genome").distinct(), "genome", "left_semi")


def in_lineage_order(counts: DataFrame, genomes: DataFrame) -> DataFrame:
    """counts with taxonomy and its place within the role: by lineage, step by step, a shorter one first, then by genome.

    genomes: (genome, lineage array).
    """
    out = counts.join(genomes.select("genome", "lineage", F.array_join("lineage", ", ").alias("taxonomy")), "genome")
    return ranked_within(out, "role", F.col("lineage"), F.col("genome")).drop("lineage")


def role_ids(names: DataFrame) -> DataFrame:
    """(role, role_id): names that differ only in case, comments, blanks and punctuation share an id, whatever else there is."""
    plain = F.trim(F.regexp_replace(F.lower(without_comment(F.col("role"))), r"[^a-z0-9]+", " "))
    return names.select("role").where("role IS NOT NULL").distinct().withColumn("role_id", F.substring(F.md5(plain), 1, 12))


def role_counts(roles: DataFrame, genomes: DataFrame, features: DataFrame, report: str = "FULL") -> DataFrame:
    """(role, genome, count, type): for the report's types, 0 included.

    roles (role) is the list that someone asks for and genomes (genome) the table at hand; the grid of both is the result
    itself. It is made by an explode of the list, which is one row of the right side.
    """
    asked = roles.select("role").distinct().agg(F.sort_array(F.collect_list("role")).alias("roles"))
    grid = genomes.select("genome").crossJoin(F.broadcast(asked)).select("genome", F.explode("roles").alias("role"))  # one row
    counts = features.groupBy("genome", "role").agg(F.count("*").alias("n"))
    n = F.coalesce("n", F.lit(0))
    return grid.join(counts, ["genome", "role"], "left").select("role", "genome", n.alias("count"),
        role_type(n).alias("type")).where(F.col("type").isin(*REPORTS[report]))


def distinct_roles_summary(counts: DataFrame) -> DataFrame:
    """(min, max, mean, median) of the number of roles that genomes have."""
    per = counts.groupBy("genome").agg(F.count_if(F.col("count") > 0).alias("n"))
    return per.agg(F.min("n").alias("min"), F.max("n").alias("max"), F.avg("n").alias("mean"), F.percentile("n", F.lit(0.5)).alias("median"))


def longest_per_group(df: DataFrame, group: str, seq: str, position: str) -> DataFrame:
    """The row of the longest sequence of each group, the first by position among equals; partial maxima before the shuffle."""
    others = [c for c in df.columns if c != group]
    top = df.where(F.col(seq).isNotNull()).groupBy(group).agg(F.min_by(F.struct(*others), F.struct(-F.length(seq), F.col(position))).alias("r"))
    return top.select(group, *[F.col("r")[c].alias(c) for c in others])
