"""The registered queries over the driver's tables.

Turns of conversations stand for sequences (a conversation for a genome), events for features along an axis (a user for a
genome), orders, customers and nations for the tables of roles, ratings and lineages. Every query reads its whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loom.functions import stats
from loom.functions.kmers import kmer_index
from loom.functions.sequences import ambiguity_count, genome_checksum
from loom.operators import cells, coupling, greedy, nearest, ratings, roles, selection, sets, similarity, taxonomy
from loom.plans import build as plans
from loom.plans.shared import spread, written

K, LEVELS = 8, (10, 20, 40)
REACH = 40_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, conv_id, turn, role, seq)."""
    t = spread(table(spark, sf_dir, "conversations"))
    return t.select((F.col("conv_id") * 100 + F.col("turn")).alias("id"), "conv_id", "turn", "role", F.col("text").alias("seq"))


def index(spark: SparkSession, sf_dir: str, k: int = K, role: str | None = None) -> DataFrame:
    seqs = sequences(spark, sf_dir)
    return kmer_index(seqs.where(F.col("role") == role) if role else seqs, "id", "seq", k)


def genomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences as rated genomes: role as domain, length as score."""
    seqs = sequences(spark, sf_dir)
    rating = F.when(F.col("role") == "system", "NCBI_REF").when(F.col("role") == "assistant", "NCBI_REP").otherwise("NORMAL")
    return plans.prioritised(seqs.select("id", rating.alias("rating"), F.length("seq").cast("double").alias("score"), F.col("role").alias("domain"), "seq"))


def built(spark: SparkSession, sf_dir: str) -> plans.Build:
    return plans.build(genomes(spark, sf_dir), "seq", K, LEVELS)


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as features of a user: a minute long, on one of two strands, with families and subsystems."""
    e = spread(table(spark, sf_dir, "events"))
    left = F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ '2024-01-01 00:00:00', ts)").cast("long")
    sub = F.when(F.col("event_id") % 3 == 0, F.array(F.concat(F.lit("s"), (F.col("event_id") % 5).cast("string")),
        F.lit("s9"))).when(F.col("event_id") % 3 == 1, F.array(F.concat(F.lit("s"),
        (F.col("event_id") % 5).cast("string")))).otherwise(F.array().cast("array<string>"))
    family = F.when(F.col("value") < 10, F.lit(None)).otherwise(F.concat(F.lit("f"), F.floor(F.col("value") / 20).cast("string")))
    return e.select(F.col("user_id").alias("genome"), F.col("event_id").alias("fid"), F.lit("c").alias("contig"),
        (F.col("event_id") % 2).alias("strand"), left.alias("left"), (left + 60).alias("right"),
        F.concat("event_type", F.lit(" / hypothetical protein # note")).alias("function"), family.alias("pgfam"), sub.alias("subsystems"))


def event_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event's role and, where it has one, its family."""
    f = features(spark, sf_dir)
    return coupling.by_role(f).unionByName(coupling.by_family(f)).distinct()


def event_pairs(spark: SparkSession, sf_dir: str, finder: str = "CLOSE", keep: Callable[[DataFrame], DataFrame] = coupling.all_classes) -> DataFrame:
    classes = event_classes(spark, sf_dir)
    return coupling.class_pairs(coupling.FINDERS[finder](features(spark, sf_dir), REACH), keep(classes), coupling.class_counts(classes))


def event_totals(spark: SparkSession, sf_dir: str, finder: str = "CLOSE", keep: Callable[[DataFrame], DataFrame] = coupling.all_classes) -> DataFrame:
    pairs = event_pairs(spark, sf_dir, finder, keep)
    out = coupling.pair_totals(coupling.pair_genomes(pairs, features(spark, sf_dir).select("genome", "fid", "subsystems")))
    return out.withColumn("weight", F.round("weight", 6))


def _packed(spark: SparkSession, sf_dir: str, k: int = K, role: str | None = None) -> cells.Packed:
    seqs = sequences(spark, sf_dir)
    return cells.packed(seqs.where(F.col("role") == role) if role else seqs, k)


# --- similarity --------------------------------------------------------------------------------------------------------


def kmer_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = similarity.sizes(index(spark, sf_dir))
    seqs = sequences(spark, sf_dir)
    return seqs.join(n, "id", "left").select("id", F.coalesce("n", F.lit(0)).alias("kmers"), ambiguity_count(F.col("seq"), "x").alias("ambiguous"),
        F.length("seq").cast("long").alias("letters"))


def pair_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.pair_distances(_packed(spark, sf_dir))


def distance_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summary of all pairs; those that share nothing enter as sim 0 and distance 1, by their number."""
    seqs = _packed(spark, sf_dir)
    near = cells.pair_sums(seqs).agg(*[F.sum(c).alias(c) for c in ("near", "s", "ss", "d", "dd")])
    n = seqs.sequences().agg(F.count("*").alias("n")).select((F.col("n") * (F.col("n") - 1) / 2).alias("pairs"))
    both = near.crossJoin(F.broadcast(n))  # one row each
    mean_s, mean_d = F.col("s") / F.col("pairs"), F.col("d") / F.col("pairs")
    return both.select(F.col("pairs").cast("long").alias("pairs"), (F.col("pairs") - F.col("near")).cast("long").alias("zero_pairs"),
        F.round(mean_s, 6).alias("mean_sim"), F.round(F.sqrt(F.col("ss") / F.col("pairs") - mean_s * mean_s), 6).alias("sd_sim"),
        F.round(1 - mean_d, 6).alias("mean_distance"), F.round(F.sqrt(F.col("dd") / F.col("pairs") - mean_d * mean_d), 6).alias("sd_distance"))


def nearest_representative(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest_of(_packed(spark, sf_dir, K, "user"), _packed(spark, sf_dir, K, "assistant"), 10)


def ssu_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest by distance; what shares nothing has no row."""
    return cells.best(_packed(spark, sf_dir, 12, "user"), _packed(spark, sf_dir, 12, "assistant"), by_distance=True)


def representative_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = nearest_representative(spark, sf_dir).where("ref_id IS NOT NULL")
    return near.groupBy(F.col("ref_id").alias("rep_id")).agg(F.count_if(~F.col("outlier")).alias("represented"), F.count_if("outlier").alias("outliers"))


def neighbors_topn_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.top_with_ties(index(spark, sf_dir, role="user"), index(spark, sf_dir, role="assistant"), 3, 2)


def group_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.least_distance(cells.packed(sequences(spark, sf_dir), K, "role")).where("distance <= 0.995")


def seq_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best representative by each of two k-mer sizes, and whether they agree."""
    best = [nearest.nearest_of(_packed(spark, sf_dir, k, "user"), _packed(spark, sf_dir, k, "assistant")).select("id", F.col("ref_id").alias(f"{n}_rep"),
        F.col("sim").alias(f"{n}_sim")) for n, k in (("seed", 8), ("rna", 12))]
    return best[0].join(best[1], "id").withColumn("same", F.col("seed_rep").eqNullSafe(F.col("rna_rep")))


# --- greedy and build --------------------------------------------------------------------------------------------------


def greedy_representatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    seqs = sequences(spark, sf_dir)
    return greedy.walked(greedy.ordered(seqs.select("id", F.col("id").alias("priority")), seqs, K), 10).select("id")


def deferred_priority_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences with four ambiguous letters and more come last."""
    seqs = sequences(spark, sf_dir)
    nodes = seqs.select("id", F.struct((ambiguity_count(F.col("seq"), "x") >= 4).alias("late"), "id").alias("priority"))
    return greedy.walked(greedy.ordered(nodes, seqs, K), 10).select("id")


def greedy_by_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By the sum of distances to all others, then their deviation, then id; those farther than 0.995 from all are dropped.

    What shares no k-mer is at distance 1, so the sums start from the number of sequences and near pairs correct them.
    """
    seqs = sequences(spark, sf_dir)
    n = seqs.count() - 1
    sums = written(cells.end_sums(_packed(spark, sf_dir)).where("least <= 0.995"))
    deviation = stats.deviation_of_sums(F.lit(n), F.col("u"), F.col("uu"))
    nodes = sums.select("id", F.struct(F.round(n - F.col("u"), 9).alias("total"), F.round(deviation, 9).alias("deviation"), "id").alias("priority"))
    return greedy.walked(greedy.ordered(nodes, seqs, K), most=0.995).select("id")


def updated_representatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The representatives that others add to the system turns, which are kept."""
    seqs = sequences(spark, sf_dir)
    nodes = seqs.select("id", F.col("id").alias("priority"))
    return greedy.walked(greedy.ordered(nodes, seqs, K), 10, seeds=seqs.where("role = 'system'").select("id")).select("id")


def nested_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    seqs = sequences(spark, sf_dir)
    return greedy.nested(greedy.ordered(seqs.select("id", F.col("id").alias("priority")), seqs, K), list(LEVELS)).select("level", "id")


def level_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.level_lists(built(spark, sf_dir))


def rep_group_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.group_stats(built(spark, sf_dir))


def first_two_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.reference_genomes(built(spark, sf_dir))


def good_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.good_table(built(spark, sf_dir)).select("id", "domain", "score", "rating", *[f"rep{n}" for n in LEVELS])


def finder_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.finder_table(built(spark, sf_dir))


def rep_classify_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns against nested sets of assistant turns: a column for each level, null where none represents."""
    turns = sequences(spark, sf_dir).where(f"role = 'assistant' AND length(seq) >= {K}")
    theirs = greedy.ordered(turns.select("id", F.col("id").alias("priority")), turns, K)
    reps = greedy.nested(theirs, list(LEVELS)).groupBy("id").agg(F.min("level").alias("mark")).join(theirs.order, "id").select("id", "mark", "bucket")
    mine = _packed(spark, sf_dir, K, "user")
    placed = cells.best_by_level(mine, theirs.seqs.only(reps), LEVELS).where("represented")
    wide = placed.groupBy("id").pivot("level", list(LEVELS)).agg(F.first("ref_id"))
    return mine.sequences().join(wide, "id", "left").withColumnsRenamed({str(n): f"rep{n}" for n in LEVELS})


# --- coupling ----------------------------------------------------------------------------------------------------------


def coupling_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_totals(spark, sf_dir, "CLOSE")


def coupling_adjacent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_totals(spark, sf_dir, "ADJACENT")


def coupling_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_totals(spark, sf_dir, keep=lambda c: coupling.limited(c, 12))


def coupling_blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    black = spark.createDataFrame([("view",), ("f1",)], "class string")
    return event_totals(spark, sf_dir, keep=lambda c: coupling.without_listed(c, black))


def coupling_pair_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which filters each pair passes."""
    totals = event_totals(spark, sf_dir)
    white = spark.createDataFrame([("error",), ("f0",)], "class string")
    passed = [f.select("class1", "class2", F.lit(n).alias("filter"), "size") for n,
        f in (("SIZE", coupling.by_size(totals, 140.0)), ("WEIGHT", coupling.by_weight(totals, 1.0)),
        ("WHITELIST", coupling.whitelisted(totals, white)))]
    return passed[0].union(passed[1]).union(passed[2])


def coupling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = event_pairs(spark, sf_dir, "ADJACENT")
    per = coupling.pair_genomes(pairs.withColumn("genome", F.lpad(F.col("genome").cast("string"), 6, "0")))
    return coupling.groups_report(per, coupling.by_size(coupling.pair_totals(per), 20.0))


def coupling_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of a conversation as neighbours of a genome; classes are roles and lengths."""
    seqs = sequences(spark, sf_dir)
    classes = seqs.select(F.col("conv_id").alias("genome"), F.col("turn").alias("fid"),
        F.explode(F.array("role", F.concat(F.lit("len"), F.floor(F.length("seq") / 400).cast("string")))).alias("class"))
    feats = seqs.select(F.col("conv_id").alias("genome"), F.col("turn").alias("fid"), F.lit("c").alias("contig"), F.lit(0).alias("strand"),
        F.col("turn").alias("left"), F.col("turn").alias("right"))
    per = coupling.pair_genomes(coupling.class_pairs(coupling.adjacent(feats, 1), classes, coupling.class_counts(classes)))
    seeds = kmer_index(roles.longest_per_group(seqs.select("conv_id", "turn", "seq"), "conv_id", "seq", "turn"), "conv_id", "seq", K)
    sims = similarity.pair_distances(seeds).select(F.col("id1").alias("g1"), F.col("id2").alias("g2"), "sim", "distance")
    totals = coupling.pair_totals(per)
    out = coupling.scores_report(per, totals, classes, sims)
    return out.select("class1", "class2", "size", *[F.round(c, 6).alias(c) for c in ("weight", "sim_distance", "real_distance", "percent1", "percent2")])


def coupling_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = spark.createDataFrame([("view", "click"), ("f0", "error"), ("nothing", "view")], "class1 string, class2 string")
    out = coupling.verify_report(known, event_classes(spark, sf_dir), event_totals(spark, sf_dir, "ADJACENT"))
    return out.withColumn("percent", F.round("percent", 6))


def coupling_linkback(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = event_pairs(spark, sf_dir, "ADJACENT")
    totals = coupling.by_size(event_totals(spark, sf_dir, "ADJACENT"), 20.0)
    return coupling.link_back(pairs, totals.select("class1", "class2", "size", F.col("weight").alias("strength")))


def coupling_feature_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = event_pairs(spark, sf_dir, "ADJACENT").withColumns({"fid1": F.col("fid1").cast("string"), "fid2": F.col("fid2").cast("string")})
    out = coupling.coupled_features(pairs, event_totals(spark, sf_dir, "ADJACENT").where("size >= 20"))
    return out.select("class1", "class2", "n", F.md5("features").alias("features_md5"))


# --- roles, taxonomy, ratings ------------------------------------------------------------------------------------------


def universal_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    feats = lines.join(part, lines.l_partkey == part.p_partkey).select(F.col("l_orderkey").alias("genome"), F.col("p_type").alias("role"),
        F.col("l_quantity").alias("length"), F.col("p_brand").alias("family"))
    out = roles.universal_roles(feats, 15.0)
    return out.select("role", "count", "families", *[F.round(c, 6).alias(c) for c in ("percent", "mean_len", "sdev_len")]).orderBy(F.desc("count"), "role")


def missing_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    feats = orders.select(F.col("o_custkey").alias("genome"), F.col("o_orderpriority").alias("role"))
    return roles.role_counts(feats.select("role"), table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("genome")), feats, "BAD")


def role_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    feats = orders.select(F.col("o_custkey").alias("genome"), F.col("o_orderpriority").alias("role"))
    counts = roles.role_counts(feats.select("role"), table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("genome")), feats)
    out = roles.distinct_roles_summary(counts)
    return out.select("min", "max", F.round("mean", 6).alias("mean"), F.col("median").cast("double").alias("median"))


def longest_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = roles.longest_per_group(sequences(spark, sf_dir).select("conv_id", "turn", "seq"), "conv_id", "seq", "turn")
    return out.select("conv_id", "turn", F.length("seq").cast("long").alias("letters"), F.md5("seq").alias("md5"))


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, n, r = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    return c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)


def tax_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxonomy.taxon_report(_customers(spark, sf_dir), "n_regionkey", "c_nationkey", "c_mktsegment").orderBy(F.desc("count"), "tax_id", "repgen_id")


def lineage_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    rank = F.when(F.col("c_custkey") % 3 == 0, "species").when(F.col("c_custkey") % 3 == 1, "genus").otherwise("strain")
    chain = F.array(F.struct(rank.alias("rank"), F.col("c_name").alias("name")),
        F.struct(F.when(F.col("c_custkey") % 2 == 0, "genus").otherwise("clade").alias("rank"), F.col("n_name").alias("name")),
        F.struct(F.lit("phylum").alias("rank"), F.col("r_name").alias("name")))
    return _customers(spark, sf_dir).select("c_custkey", taxonomy.lineage_text(chain, F.lit("Bacteria"), "GENUS").alias("taxonomy"))


def lineage_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _customers(spark, sf_dir)
    rows = c.select(F.col("c_custkey").alias("id"),
        F.concat(F.when(F.col("n_regionkey") == 2, "2157::").otherwise(""), F.lit("r"), F.col("n_regionkey").cast("string"), F.lit("::n"),
        F.col("c_nationkey").cast("string"), F.when(F.col("c_custkey") % 4 > 0,
        F.concat(F.lit("::"), F.lower("c_mktsegment"))).otherwise("")).alias("lineage"))
    n = table(spark, sf_dir, "nation")
    taxa = n.select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("tax_id"), F.lit("genus").alias("rank"),
        F.lit(None).cast("int").alias("genetic_code"))
    segments = c.select(F.lower("c_mktsegment").alias("tax_id"), F.lit("species").alias("rank"),
        F.when(F.col("c_mktsegment") == "BUILDING", 4).cast("int").alias("genetic_code")).distinct()
    return taxonomy.parse_lineage(rows, taxa.unionByName(segments)).select("id", "genus", "species", "domain", "genetic_code")


def _good(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with representatives at three levels, nested but for some."""
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(k.alias("id"), (k % 5).alias("rep10"), F.when(k % 11 == 0, k % 7).otherwise(k % 25).alias("rep50"),
        (k % 100).alias("rep100"))


def _good_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    return k.where("id < 5").select(F.lit(10).alias("level"),
        "id").union(k.where("id < 25 AND id <> 3").select(F.lit(50), "id")).union(k.where("id < 100 AND id % 10 <> 7").select(F.lit(100), "id"))


def hierarchy_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxonomy.hierarchy_errors(_good(spark, sf_dir), [10, 50, 100])


def multi_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxonomy.multiple_parents(taxonomy.parents(_good(spark, sf_dir), [10, 50, 100]))


def hierarchy_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = taxonomy.tree_lines(taxonomy.tree(taxonomy.parents(_good(spark, sf_dir), [10, 50, 100]), [10, 50, 100]))
    return lines.select(F.array_join(F.transform("path", lambda x: x.cast("string")), ">").alias("path"), "line")


def subset_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxonomy.missing_in_finer(_good_sets(spark, sf_dir))


def representation_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxonomy.representation_errors(_good(spark, sf_dir), _good_sets(spark, sf_dir), [10, 50, 100])


def rating_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.when(F.col("quality") == 1, "NCBI_REP").otherwise("BAD_SSU").alias("rating"))
    docs = ratings.with_default_rating(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id")), labels)
    return ratings.rating_counts(ratings.prune(docs))


def _verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    seqs = sequences(spark, sf_dir)
    own = seqs.groupBy(F.col("conv_id").alias("id")).agg(F.when(F.col("conv_id") % 4 == 0, "NCBI_REF").otherwise("NORMAL").alias("rating"))
    return ratings.ssu_verdicts(own, seqs.select(F.col("conv_id").alias("id"), F.col("turn").alias("pos"), "seq"), K, 400, 800, lambda s: s.isNotNull())


def ssu_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _verdicts(spark, sf_dir).select("id", "rating", F.md5("ssu").alias("ssu_md5"))


def genus_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = written(_verdicts(spark, sf_dir)).withColumns({"genus": F.when(F.col("id") % 7 > 0, F.col("id") % 7), "priority": F.col("id")})
    return ratings.genus_retry(rows, 4, 800).select("id", "genus", "rating")


def max_pair_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ratings.max_pair_distance(sequences(spark, sf_dir).select("conv_id", "id", "seq"), "conv_id", 4)


# --- comparisons -------------------------------------------------------------------------------------------------------


def _compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id1, id2, seed_dist, rna_dist) of all turns that share four letters; all other pairs are at (1, 1)."""
    rna = similarity.pair_distances(index(spark, sf_dir, 4)).select("id1", "id2", F.col("distance").alias("rna_dist"))
    seed = similarity.pair_distances(index(spark, sf_dir, K)).select("id1", "id2", F.col("distance").alias("seed_dist"))
    return rna.join(seed, ["id1", "id2"], "left").select("id1", "id2", F.coalesce("seed_dist", F.lit(1.0)).alias("seed_dist"), "rna_dist")


def seq_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs that are not at (1, 1)."""
    return _compared(spark, sf_dir)


def _sums(rows: DataFrame, by: list[str]) -> DataFrame:
    """Sums over 1 - distance, in which pairs at distance 1 are 0."""
    u, v = 1 - F.col("seed_dist"), 1 - F.col("rna_dist")
    d = F.abs(F.col("seed_dist") - F.col("rna_dist"))
    return rows.groupBy(*by).agg(F.count("*").alias("near"), F.sum(u).alias("u"), F.sum(v).alias("v"), F.sum(u * u).alias("uu"),
        F.sum(v * v).alias("vv"), F.sum(u * v).alias("uv"), F.sum(d).alias("d"), F.sum(d * d).alias("dd"))


def _pearson(n: Column) -> Column:
    return F.round(stats.pearson_of_sums(n, *[F.col(c) for c in ("u", "v", "uu", "vv", "uv")]), 6)


def seq_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over all pairs; those at (1, 1) enter by their number."""
    n = sequences(spark, sf_dir).count()
    return _sums(_compared(spark, sf_dir), []).select(F.lit(n * (n - 1) // 2).cast("long").alias("pairs"),
        _pearson(F.lit(float(n * (n - 1) // 2))).alias("pearson"))


def _each(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = written(_compared(spark, sf_dir))
    return pairs.select(F.col("id1").alias("id"), "seed_dist", "rna_dist").union(pairs.select("id2", "seed_dist", "rna_dist"))


def error_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each turn's errors against all others, the largest mean first, then the largest deviation."""
    seqs = sequences(spark, sf_dir)
    n = seqs.count() - 1
    sums = cells.error_sums(cells.packed(seqs, 4), K)
    out = seqs.select("id").join(sums, "id", "left").fillna(0.0, ["d", "dd"])
    out = out.select("id", F.round(F.col("d") / n, 6).alias("mean_error"),
        F.round(stats.deviation_of_sums(F.lit(n), F.col("d"), F.col("dd")), 6).alias("sd_error"))
    return out.orderBy(F.desc("mean_error"), F.desc("sd_error"), "id")


def kendall_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each turn's rank and linear correlation of the two distances to all others, the smallest linear one first, then the smallest tau."""
    n, rows = sequences(spark, sf_dir).count() - 1, _each(spark, sf_dir)
    sums = written(_sums(rows, ["id"]))
    tau = stats.kendall_tau(rows.join(sums.select("id", (n - F.col("near")).alias("far")), "id"), "id", "seed_dist", "rna_dist", "far")
    out = sequences(spark, sf_dir).select("id").join(tau.select("id", "tau"), "id", "left").join(sums, "id", "left")
    out = out.select("id", F.lit(n).cast("long").alias("n"), F.round("tau", 6).alias("tau"), _pearson(F.lit(float(n))).alias("pearson"))
    return out.orderBy("pearson", "tau", "id")


def neighbor_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order statistics of each other turn's distances to all assistant turns, by two measures; what shares nothing is at 1."""
    out = None
    refs = sequences(spark, sf_dir).where("role = 'assistant'").count()
    others = sequences(spark, sf_dir).where("role <> 'assistant'").select("id")
    quartiles = [stats.percentile_ranks(refs, i / 4) for i in (1, 2, 3)]
    places = {1, min(101, refs), refs, *(i for q in quartiles for i in q[:2])}
    for measure, k in (("seed", K), ("rna", 4)):
        r = written(index(spark, sf_dir, k, "assistant"))
        q = written(index(spark, sf_dir, k).join(others, "id", "left_semi"))
        d = written(similarity.with_distance(similarity.cross_sims(q, r), "id", similarity.sizes(q), "ref_id", similarity.sizes(r)))
        u = 1 - F.col("distance")
        sums = d.groupBy("id").agg(F.sum(u).alias("u"), F.sum(u * u).alias("uu"))
        ranks = others.select("id", F.explode(F.array(*[F.lit(i) for i in sorted(places)])).alias("rank"))
        found = selection.order_statistics(d, "id", "distance", ranks).groupBy("id")
        found = found.agg(*[F.max(F.when(F.col("rank") == i, F.col("distance"))).alias(f"v{i}") for i in sorted(places)])
        got = others.join(sums, "id", "left").join(found, "id", "left")
        u, uu = F.coalesce("u", F.lit(0.0)), F.coalesce("uu", F.lit(0.0))
        at = lambda i: F.coalesce(f"v{i}", F.lit(1.0))
        cols = {"min": at(1), "v100": at(min(101, refs)), "max": at(refs), "mean": 1 - u / refs, "sdev": stats.deviation_of_sums(F.lit(refs), u, uu)}
        for i, (low, high, part) in enumerate(quartiles, 1):
            cols[f"q{i}"] = at(low) + part * (at(high) - at(low))
        part = got.select("id", F.lit(measure).alias("measure"), *[F.round(c, 6).alias(name) for name, c in cols.items()])
        out = part if out is None else out.unionByName(part)
    return out


# --- sets --------------------------------------------------------------------------------------------------------------


def discriminating_kmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, s = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    return sets.discriminating_kmers(kmer_index(c, "c_custkey", "c_name", 4), kmer_index(s, "s_suppkey", "s_name", 4))


def prioritize(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return sets.prioritize(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), first, "o_custkey", "o_orderkey")


def top_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sets.top_groups(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), "o_custkey", "o_totalprice", "o_orderkey", 12, 5)


def distance_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    seqs = sequences(spark, sf_dir)
    return sets.distance_buckets(index(spark, sf_dir, 4), seqs.select("id", F.col("id").alias("position")), 0, 50, 4)


def catalog_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    bench = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc_id"))
    return sets.sync_plan(bench, table(spark, sf_dir, "labels"), "doc_id")


def incremental_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sets.pending(table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars"), table(spark, sf_dir, "labels"), "doc_id")


def md5_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One checksum for a site: of the sorted checksums of its pages."""
    pages = table(spark, sf_dir, "pages").select(F.regexp_extract("url", "^[a-z]+://([^/?#]+)", 1).alias("site"), F.md5("html").alias("md5"))
    return pages.groupBy("site").agg(F.count("*").alias("pages"), genome_checksum(F.collect_list("md5")).alias("checksum"))


QUERIES = (
    nested_levels, kmer_profile, pair_similarity, distance_matrix, nearest_representative, ssu_nearest, representative_stats, neighbors_topn_ties,
    group_distance, seq_test, greedy_representatives, deferred_priority_build, greedy_by_distance, updated_representatives, level_lists,
    rep_group_stats, first_two_per_group, good_table, finder_table, rep_classify_levels, coupling_close, coupling_adjacent, coupling_limited,
    coupling_blacklist, coupling_pair_filters, coupling_groups, coupling_scores, coupling_verify, coupling_linkback, coupling_feature_lists,
    universal_roles, missing_roles, role_summary, longest_per_group, tax_report, lineage_string, lineage_parse, hierarchy_errors, multi_parent,
    hierarchy_tree, subset_errors, representation_errors, rating_default, ssu_verdict, genus_retry, max_pair_distance, seq_compare,
    seq_correlation, error_summary, kendall_summary, neighbor_stats, discriminating_kmers, prioritize, top_groups, distance_buckets,
    catalog_sync, incremental_table, md5_checksum,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from loom import listing_queries, mechanism_queries, report_queries, stored_queries

    return {f.__name__: f for f in (*QUERIES, *report_queries.QUERIES, *stored_queries.QUERIES, *listing_queries.QUERIES,
        *mechanism_queries.QUERIES)}
