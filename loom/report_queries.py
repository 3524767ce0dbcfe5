"""Further registered queries: outliers, updates, filters, re-read reports and printed forms, over the driver's tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loom import queries as q
from loom.functions import kmers, sequences, stats
from loom.operators import coupling, nearest, ratings, roles, sets, taxonomy
from loom.plans import build as plans
from loom.sources import tables

LEAST = 10


def seq_test_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    own, theirs = (tuple(q.index(spark, sf_dir, k, role) for k in (8, 12)) for role in ("user", "assistant"))
    return nearest.cross_proximity(own, theirs)


def updated_assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.updated_assignments(q.index(spark, sf_dir, role="user"), q.index(spark, sf_dir, role="assistant"), LEAST)


def unrepresented(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user turns that no assistant turn represents, with the best similarity there is."""
    return nearest.nearest(q.index(spark, sf_dir, role="user"), q.index(spark, sf_dir, role="assistant"), LEAST).where("outlier").select("id", "sim")


def both_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations that have a user and an assistant turn: the longest of each."""
    seqs, out = q.sequences(spark, sf_dir), None
    for name, role in (("seed", "user"), ("ssu", "assistant")):
        top = roles.longest_per_group(seqs.where(F.col("role") == role).select("conv_id", "turn", "seq"), "conv_id", "seq", "turn")
        top = top.select("conv_id", F.col("turn").alias(f"{name}_turn"), F.length("seq").cast("long").alias(f"{name}_letters"))
        out = top if out is None else out.join(top, "conv_id")
    return out


def _purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, part = q.table(spark, sf_dir, "lineitem"), q.table(spark, sf_dir, "part")
    return lines.join(part, lines.l_partkey == part.p_partkey).select(F.col("l_orderkey").alias("genome"), F.col("p_type").alias("role"),
        F.col("l_quantity").alias("length"), F.col("p_brand").alias("family"))


def domain_universal_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Universal roles of the orders that are in one of two domains."""
    status = F.when(F.col("o_orderstatus") == "F", "Bacteria").when(F.col("o_orderstatus") == "O", "Archaea").otherwise("Virus")
    genomes = q.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("genome"), status.alias("domain"))
    out = roles.universal_roles(roles.in_domains(_purchases(spark, sf_dir), genomes), 10.0)
    return out.select("role", "count", F.round("percent", 6).alias("percent"))


def seeded_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of each type of the users that have an error: the others are skipped."""
    events = q.table(spark, sf_dir, "events").select(F.col("user_id").alias("genome"), F.col("event_type").alias("role"), "value")
    kept = roles.with_seed(events, "error")
    return kept.groupBy("role").agg(F.count("*").alias("n"), F.count_distinct("genome").alias("genomes"))


def ssu_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = q.table(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("product"), F.col("p_size").alias("length"))
    return ratings.ssu_features(part, "(?i)medium|promo", 20).select("p_partkey", "length")


def checksum_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each benchmark text by its checksum among the documents; the sequence is null where none has it."""
    items = q.table(spark, sf_dir, "benchmark").select("item_id", F.md5("text").alias("md5"))
    lines = q.table(spark, sf_dir, "documents").select(F.md5("text").alias("md5"), F.col("text").alias("seq"))
    known = lines.unionByName(q.table(spark, sf_dir, "benchmark").where("item_id % 2 = 0").select(F.md5("text").alias("md5"), F.col("text").alias("seq")))
    return ratings.sequence_of_checksum(items, known).select("item_id", "md5", F.length("seq").cast("long").alias("letters"))


def missing_roles_taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing and over-present roles with their genomes' taxonomy, in its order."""
    lineage = F.array("n_regionkey", "c_nationkey")
    genomes = q._customers(spark, sf_dir).select(F.col("c_custkey").alias("genome"), lineage.alias("lineage"))
    out = roles.in_lineage_order(q.missing_roles(spark, sf_dir), genomes)
    return out.select("role", "place", "genome", "count", "type", "taxonomy").orderBy("role", "place")


def coupling_genome_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = coupling.by_size(q.event_totals(spark, sf_dir, "ADJACENT"), 20.0).select("class1", "class2", "size", F.col("weight").alias("strength"))
    return coupling.couplings_of_genomes(q.event_pairs(spark, sf_dir, "ADJACENT"), totals, q.features(spark, sf_dir))


def coupling_run_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = coupling.run_statistics(coupling.by_size(q.event_totals(spark, sf_dir, "ADJACENT"), 20.0))
    return out.select("pairs", F.round("mean_size", 6).alias("mean_size"), "max_size")


def coupling_reread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A coupling report as text, read again; half of it the other way round."""
    totals = q.event_totals(spark, sf_dir, "ADJACENT")
    turned = totals.select(F.when(F.col("size") % 2 == 0, F.col("class1")).otherwise(F.col("class2")).alias("class1"),
        F.when(F.col("size") % 2 == 0, F.col("class2")).otherwise(F.col("class1")).alias("class2"), "size", "weight")
    return coupling.read_report(coupling.report_lines(turned)).select("class1", "class2", "size", F.round("strength", 6).alias("strength"))


def coupling_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coupled classes with their names, and '' for those without one."""
    totals = q.event_totals(spark, sf_dir, "ADJACENT")
    names = q.event_classes(spark, sf_dir).select("class").distinct().where("class LIKE 'f%'").select("class",
        F.concat(F.lit("family "), F.substring("class", 2, 9)).alias("name"))
    return coupling.named(totals, names).select("class1", "family_product1", "class2", "family_product2", "size")


def coupling_by_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features whose family is that of their protein's checksum, counted by family."""
    feats = q.features(spark, sf_dir).withColumn("md5", F.md5(F.concat(F.lit("p"), (F.col("fid") % 50).cast("string"))))
    families = spark.range(40).select(F.concat(F.lit("X"), (F.col("id") % 7).cast("string")).alias("fam_id"), F.lit("").alias("product"),
        F.md5(F.concat(F.lit("p"), F.col("id").cast("string"))).alias("md5"))
    return coupling.by_sequence(feats, families).groupBy("class").agg(F.count("*").alias("n"), F.count_distinct("genome").alias("genomes"))


def role_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = q.table(spark, sf_dir, "part")
    names = part.select(F.col("p_type").alias("role")).union(part.select(F.concat(F.lower("p_type"), F.lit("  # note"))))
    return roles.role_ids(names)


def multi_parent_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxonomy.blanked(taxonomy.parents(q._good(spark, sf_dir), [10, 50, 100])).orderBy("level", "id", "place")


def without_species(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers whose lineage names no species."""
    return taxonomy.without_species(q.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")), q.lineage_parse(spark, sf_dir))


def fully_placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sets.fully_placed(q.built(spark, sf_dir).placements, len(q.LEVELS))


def genome_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of each table that each genome mode gives out."""
    b = q.built(spark, sf_dir)
    rows = [df.agg(F.count("*").alias("n")).select(F.lit(mode).alias("mode"), F.lit(name).alias("name"), "n") for mode in plans.MODES for name,
        df in plans.outputs(b, mode).items()]
    return reduce(DataFrame.unionByName, rows)


def feature_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The column expressions on feature ids, comments, sequences and places, over all events."""
    e = q.table(spark, sf_dir, "events")
    n = F.col("event_id")
    fid = F.when(n % 5 == 0, F.concat(F.lit("peg."), n.cast("string"))).otherwise(F.concat(F.lit("fig|"), F.col("user_id").cast("string"), F.lit("."),
        (n % 30).cast("string"), F.lit(".peg."), n.cast("string")))
    comment = F.when(n % 3 == 0, F.concat("event_type", F.lit("\t"), n.cast("string"), F.lit("\tend"))).otherwise(F.col("event_type"))
    dna = F.when(n % 7 > 0, F.concat(F.lit("acgt"), F.repeat(F.lit("n"), (n % 8).cast("int")), F.lit("acgt")))
    protein = F.when(n % 11 > 0, F.when(n % 4 == 0, F.concat(F.lit("MAXX"), F.col("event_type"))).otherwise(F.concat(F.lit("MA"), F.upper("event_type"))))
    left = n % 100
    sim = F.when(n % 13 == 0, F.lit(sequences.INFINITE)).otherwise(n % 50)
    return e.select(
        "event_id", sequences.genome_of_feature(fid).alias("genome"), sequences.after_first_tab(comment).alias("after_tab"),
            sequences.incomplete_reason(dna, protein).alias("reason"), sequences.valid_dna(dna).alias("valid"),
        sequences.gap(n % 2 == 0, left, left + 20, F.lit(50), F.lit(70)).alias("gap"), sequences.shown_similarity(sim).alias("shown"),
            F.round(kmers.inverse_similarity(n % 50), 9).alias("inverse"),
        kmers.similarity(kmers.kmer_array(protein, 2), kmers.kmer_array(F.lit("MAXXCLICK"), 2)).alias("shared"),
            sequences.triplet_index(protein, F.lit(1)).alias("triplet"),
    )


def natural_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Genome ids within their first part, in the order of their numbers."""
    ids = q.table(spark, sf_dir, "events").select(F.concat((F.col("user_id") % 20).cast("string"), F.lit("."),
        F.col("user_id").cast("string")).alias("id")).distinct()
    key = sequences.natural_id_key(F.col("id"))
    return ids.withColumn("place", F.row_number().over(Window.partitionBy(key[0]).orderBy(key))).select("id", "place")


def local_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Families of one's own, by their column, with how many features of how many users have them."""
    feats = q.features(spark, sf_dir).withColumn("plfam",
        F.when(F.col("fid") % 6 > 0, F.concat(F.lit("L"), (F.col("genome") % 4).cast("string"), F.lit("_"), (F.col("fid") % 9).cast("string"))))
    return coupling.CLASSIFIERS["LOCAL_TEST"](feats, "plfam").groupBy("class").agg(F.count("*").alias("n"), F.count_distinct("genome").alias("genomes"))


def random_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The control keeps each user's number of features of each family."""
    return coupling.class_counts(coupling.by_random_family(q.features(spark, sf_dir)))


def resume_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders behind the one that was done last."""
    return sets.after(q.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", "o_custkey", 7)


def seed_proteins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest text of the users' features that have a role; an array of features a user stands for a genome document."""
    e = q.table(spark, sf_dir, "events")
    feature = F.struct(F.lpad(F.col("event_id").cast("string"), 9, "0").alias("fid"), F.concat("event_type", F.lit(" / other")).alias("function"),
        "props", F.concat("props", F.lit("x")).alias("protein"), F.lit("").alias("dna"))
    genomes = e.groupBy(F.col("user_id").alias("id")).agg(F.collect_list(feature).alias("features"))
    out = tables.seed_proteins(tables.features_of(genomes), ["click", "error"])
    return out.select("genome", "fid", F.length("protein").cast("long").alias("letters"))


def flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers by a cell that says whether they are good."""
    k = F.col("c_custkey")
    cell = F.when(k % 4 == 0, " Y ").when(k % 4 == 1, "1").when(k % 4 == 2, "").otherwise(F.lit(None))
    return q.table(spark, sf_dir, "customer").select(k.alias("id"), tables.flag(cell).alias("good"))


def level_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The representatives with their genomes, as they are written to a folder a level."""
    return plans.representative_genomes(q.built(spark, sf_dir)).select("level", "id", "domain", "rating")


def rank_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kendall's tau of size and price over all parts at once."""
    part = q.table(spark, sf_dir, "part").select(F.col("p_size").cast("double").alias("x"), F.col("p_retailprice").alias("y"))
    return stats.kendall_tau_of_all(part, "x", "y").select("n", F.round("tau", 6).alias("tau"))


QUERIES = (
    rank_correlation, feature_texts, natural_order, local_families, random_families, resume_after, seed_proteins, flagged, level_folders,
    seq_test_outliers, updated_assignments, unrepresented, both_sequences, domain_universal_roles, seeded_roles, ssu_features, checksum_sequences,
    missing_roles_taxonomy, coupling_genome_counts, coupling_run_stats, coupling_reread, coupling_named, coupling_by_checksum, role_ids,
    multi_parent_report, without_species, fully_placed, genome_modes,
)
