"""Column expressions against plain Python."""

import itertools
import random

from pyspark.sql import functions as F

from loom.functions import kmers, sequences, stats


def test_kmers(spark):
    texts = [None, "", "abc", "abcabcabc", "naïve café " * 3, "x" * 6000, "ab" * 3000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, t string")
    got = {r.id: set(r.k) for r in df.select("id", kmers.kmer_array(F.col("t"), 4).alias("k")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == {(t or "")[j : j + 4] for j in range(len(t or "") - 3)}
    words = {r.id: set(r.k) for r in df.select("id", kmers.word_kmer_array(F.col("t"), 2).alias("k")).collect()}
    assert words[4] == {"naïve café", "café naïve"} and words[0] == set()
    assert df.select(kmers.jaccard_distance(F.lit(0), F.lit(0), F.lit(0)).alias("d")).first().d == 1.0


def test_sequences(spark):
    row = spark.range(1).select(
        sequences.genome_of_feature(F.lit("fig|511145.12.peg.7")).alias("g"), sequences.genome_of_feature(F.lit("x")).alias("no"),
        sequences.ambiguity_count(F.lit("AXXB")).alias("x"), sequences.roles_of_function(F.lit("A b / C @ D; E # note")).alias("roles"),
        sequences.after_first_tab(F.lit("a\tb c\td")).alias("tab"), sequences.bucket_of(F.lit(0.021), 50).alias("b"), sequences.bucket_of(F.lit(1.0), 50).alias("far"),
        sequences.triplet_index(F.lit("ACDX"), F.lit(1)).alias("t"), sequences.triplet_index(F.lit("ACDX"), F.lit(2)).alias("bad"),
        sequences.last_mismatch(F.array(*map(F.lit, "abc")), F.array(*map(F.lit, "xbz"))).alias("m"), sequences.role_type(F.lit(2)).alias("over"),
        sequences.percent_threshold(80.0, F.lit(7)).alias("p"), sequences.shown_similarity(F.lit(sequences.INFINITE)).alias("max"),
        sequences.gap(F.lit(True), F.lit(1), F.lit(10), F.lit(5), F.lit(20)).alias("gap"), sequences.gap(F.lit(False), F.lit(1), F.lit(10), F.lit(5), F.lit(20)).alias("other"),
        sequences.incomplete_reason(F.lit("acgt"), F.lit("MXXK")).alias("why"), (sequences.natural_id_key(F.lit("2.10")) > sequences.natural_id_key(F.lit("2.9"))).alias("natural"),
    ).first()
    assert (row.g, row.no, row.x, row.roles, row.tab) == ("511145.12", None, 2, ["A b", "C", "D", "E"], "b c\td")
    assert (row.b, row.far, row.t, row.bad, row.m, row.over) == (1, None, 0 * 400 + 1 * 20 + 2, -1, 2, "OVER_PRESENT")
    assert (row.p, row.max, row.gap, row.other) == (int((80 * 7 + 99) // 100), "MAX", -5, sequences.FAR)
    assert row.why == "ambiguous protein" and row.natural


def test_stats(spark):
    values = [1.0, 2.0, 3.0, 4.0]
    row = spark.range(1).select(*[stats.percentile(F.array(*map(F.lit, values)), p).alias(n) for n, p in (("a", 0.25), ("b", 0.5), ("c", 0.99))], stats.order_statistic(F.array(*map(F.lit, values)), 100).alias("v")).first()
    assert (row.a, row.b, row.c, row.v) == (1.25, 2.5, 4.0, 4.0)
    rng = random.Random(1)
    rows = [(g, rng.randrange(6), rng.randrange(6)) for g in range(5) for _ in range(12)] + [(9, 1, 1), (8, 1, 1), (8, 1, 2)]
    got = {r.g: r.tau for r in stats.kendall_tau(spark.createDataFrame(rows, "g long, x long, y long"), "g", "x", "y").collect()}
    sign = lambda x: (x > 0) - (x < 0)
    for g in set(r[0] for r in rows):
        pts = [r[1:] for r in rows if r[0] == g]
        s = nx = ny = 0
        for (a, b), (c, d) in itertools.combinations(pts, 2):
            s, nx, ny = s + sign(a - c) * sign(b - d), nx + abs(sign(a - c)), ny + abs(sign(b - d))
        assert got[g] is None if nx * ny == 0 else abs(got[g] - s / (nx * ny) ** 0.5) < 1e-12
