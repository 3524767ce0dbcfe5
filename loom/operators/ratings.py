"""Ratings of genomes by their SSU rRNA sequences, and the second chance within a genus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loom.functions.kmers import kmer_array
from loom.functions.sequences import valid_dna


#: Ratings from best to worst, lengths and distances of the verdicts.
RATINGS = ("NCBI_REF", "NCBI_REP", "NORMAL", "SHORT_SSU", "SINGLE_SSU", "BAD_SSU")
USEFUL_LENGTH, FULL_LENGTH = 700, 1400
SAME_GENOME, SAME_GENUS = 0.5, 0.75


def rating_order(rating: str = "rating") -> Column:
    return F.array_position(F.array(*[F.lit(r) for r in RATINGS]), F.col(rating)).cast("int") - 1


def with_default_rating(genomes: DataFrame, ratings: DataFrame) -> DataFrame:
    """genomes (id, ...) with rating from ratings (id, rating), NORMAL where it has none."""
    return genomes.join(ratings.select("id", "rating"), "id", "left").withColumn("rating", F.coalesce("rating", F.lit("NORMAL")))


def ssu_verdicts(genomes: DataFrame, rnas: DataFrame, k: int = 15, useful: int = USEFUL_LENGTH, full: int = FULL_LENGTH, valid=valid_dna) -> DataFrame:
    """(id, rating, ssu) by the genome's SSU sequences. genomes: (id, rating); rnas: (id, pos, seq).

    No useful sequence: BAD. One: SINGLE below the reference ratings; those stay, SHORT without a full one. More: BAD
    when two lie further apart than SAME_GENOME, else SHORT without a full one. ssu: the longest valid sequence, first of
    equals. Only pairs within a genome are compared, by an equi-join on (genome, k-mer).
    """
    good = rnas.where(valid(F.col("seq"))).withColumn("len", F.length("seq"))
    counts = good.groupBy("id").agg(F.count_if(F.col("len") >= useful).alias("useful"), F.max("len").alias("longest"),
        F.min_by("seq", F.struct(-F.col("len"), "pos")).alias("ssu"))
    use = good.where(F.col("len") >= useful).select("id", "pos", "seq").distinct()
    index = use.select(F.struct("id", "pos").alias("id"), F.explode(kmer_array(F.col("seq"), k)).alias("kmer"))
    own = index.select(F.col("id")["id"].alias("g"), F.col("id")["pos"].alias("p"), "kmer")
    sims = own.withColumnRenamed("p", "p1").join(own.withColumnRenamed("p", "p2"), ["g", "kmer"]).where("p1 < p2").groupBy("g", "p1",
        "p2").agg(F.count("*").alias("sim"))
    n = own.groupBy("g", "p").agg(F.count("*").alias("n"))
    near = sims.join(n.select("g", F.col("p").alias("p1"), F.col("n").alias("n1")),
        ["g", "p1"]).join(n.select("g", F.col("p").alias("p2"), F.col("n").alias("n2")), ["g", "p2"])
    close = near.where(1.0 - F.col("sim") / (F.col("n1") + F.col("n2") - F.col("sim")) <= SAME_GENOME).groupBy(F.col("g").alias("id")).agg(F.count("*").alias("close"))
    out = genomes.join(counts, "id", "left").join(close, "id", "left")
    pairs = F.col("useful") * (F.col("useful") - 1) / 2
    short = F.when(F.col("longest") < full, "SHORT_SSU").otherwise(F.col("rating"))
    verdict = (
        F.when(F.coalesce("useful", F.lit(0)) == 0, "BAD_SSU")
        .when((F.col("useful") == 1) & (rating_order() >= RATINGS.index("NORMAL")), "SINGLE_SSU")
        .when((F.col("useful") > 1) & (F.coalesce("close", F.lit(0)) < pairs), "BAD_SSU")
        .otherwise(short)
    )
    return out.select("id", verdict.alias("rating"), "ssu")


def genus_retry(genomes: DataFrame, k: int = 15, full: int = FULL_LENGTH) -> DataFrame:
    """genomes (id, genus, rating, ssu, priority) with SINGLE_SSU ones judged by the first good genome of their genus.

    Further than SAME_GENUS from it: BAD; else SHORT where the reference is not of full length, NORMAL otherwise. Without a
    reference they stay SINGLE; without a genus they are left out.
    """
    w = Window.partitionBy("genus").orderBy("priority", "id")
    reference = genomes.where((rating_order() <= RATINGS.index("NORMAL")) & F.col("genus").isNotNull()).withColumn("n",
        F.row_number().over(w)).where("n = 1").select("genus", F.col("id").alias("ref"), F.col("ssu").alias("ref_ssu"))
    single = genomes.where("rating = 'SINGLE_SSU' AND genus IS NOT NULL").join(reference, "genus", "left")
    sim = F.size(F.array_intersect(kmer_array(F.col("ssu"), k), kmer_array(F.col("ref_ssu"), k)))
    union = F.size(F.array_union(kmer_array(F.col("ssu"), k), kmer_array(F.col("ref_ssu"), k)))
    distance = F.when(union > 0, 1.0 - sim / union).otherwise(1.0)
    verdict = F.when(F.col("ref").isNull(), "SINGLE_SSU").when(distance >= SAME_GENUS, "BAD_SSU").when(F.length("ref_ssu") < full,
        "SHORT_SSU").otherwise("NORMAL")
    judged = single.withColumn("rating", verdict).select(*genomes.columns)
    return genomes.where("rating <> 'SINGLE_SSU'").unionByName(judged)


def prune(genomes: DataFrame, least: str = "SINGLE_SSU") -> DataFrame:
    """Without the genomes rated worse than least."""
    return genomes.where(rating_order() <= RATINGS.index(least))


def rating_counts(genomes: DataFrame) -> DataFrame:
    return genomes.groupBy("rating").agg(F.count("*").alias("count"))


def ssu_features(features: DataFrame, pattern: str, least: int) -> DataFrame:
    """Features (product, length, ...) whose product the pattern finds and that are at least so long."""
    return features.where(F.col("product").rlike(pattern) & (F.col("length") >= least))


def sequence_of_checksum(rows: DataFrame, sequences: DataFrame, checksum: str = "md5", seq: str = "seq") -> DataFrame:
    """rows with the sequence of their checksum, null where none has it; of several the least one."""
    known = sequences.groupBy(checksum).agg(F.min(seq).alias(seq))
    return rows.join(known, checksum, "left")


def max_pair_distance(seqs: DataFrame, group: str, k: int = 15) -> DataFrame:
    """(group, count, max_dist) of groups of two sequences and more. seqs: (group, id, seq).

    A pair without a common k-mer is at distance 1, so a group with fewer similar pairs than pairs has that.
    """
    n = seqs.groupBy(F.col(group).alias("grp")).agg(F.count("*").alias("count")).where("count > 1")
    own = seqs.select(F.col(group).alias("grp"), "id", F.explode(kmer_array(F.col("seq"), k)).alias("kmer"))
    sims = own.withColumnRenamed("id", "id1").join(own.withColumnRenamed("id", "id2"), ["grp", "kmer"]).where("id1 < id2").groupBy("grp", "id1",
        "id2").agg(F.count("*").alias("sim"))
    size = own.groupBy("grp", "id").agg(F.count("*").alias("n"))
    near = sims.join(size.select("grp", F.col("id").alias("id1"), F.col("n").alias("n1")),
        ["grp", "id1"]).join(size.select("grp", F.col("id").alias("id2"), F.col("n").alias("n2")), ["grp", "id2"])
    near = near.groupBy("grp").agg(F.count("*").alias("near"), F.max(1.0 - F.col("sim") / (F.col("n1") + F.col("n2") - F.col("sim"))).alias("far"))
    all_pairs = F.col("count") * (F.col("count") - 1) / 2
    return n.join(near, "grp", "left").select(F.col("grp").alias(group), "count",
        F.when(F.coalesce("near", F.lit(0)) < all_pairs, 1.0).otherwise(F.col("far")).alias("max_dist"))


