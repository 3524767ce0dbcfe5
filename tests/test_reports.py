"""Rank correlation, linear k-mers, small remainders of the greedy walk, filters and re-read reports on small tables."""

import random
import time

import pytest
from pyspark.sql import functions as F

from loom.functions import kmers, stats
from loom.operators import coupling, greedy, ratings, roles, taxonomy
from loom.plans import build


def brute_tau(points):
    sign = lambda d: (d > 0) - (d < 0)
    s = nx = ny = 0
    for i, (a, b) in enumerate(points):
        for c, d in points[:i]:
            s += sign(a - c) * sign(b - d)
            nx += abs(sign(a - c))
            ny += abs(sign(b - d))
    return s / (nx * ny) ** 0.5 if nx and ny else None


def test_kendall_against_all_pairs(spark):
    rng = random.Random(3)
    rows, far = [], {"a": 0, "b": 7, "c": 3, "d": 0, "e": 2}
    for g in far:
        for _ in range({"a": 60, "b": 40, "c": 1, "d": 5, "e": 25}[g]):
            rows.append((g, rng.randrange(5) / 5 if g == "a" else 0.5 if g == "d" else rng.choice([1.0, rng.random()]), rng.randrange(4) / 4, far[g]))
    df = spark.createDataFrame([*rows, ("a", None, 0.5, 0)], "g string, x double, y double, more long")
    got = {r.g: r for r in stats.kendall_tau(df, "g", "x", "y", "more").collect()}
    for g, n in far.items():
        points = [(x, y) for h, x, y, _ in rows if h == g] + [(1.0, 1.0)] * n
        want = brute_tau(points)
        assert got[g].n == len(points)
        assert (got[g].tau is None and want is None) or abs(got[g].tau - want) < 1e-9


@pytest.mark.parametrize("parts", [2, 7, 64])
def test_kendall_of_all_against_all_pairs(spark, parts):
    rng = random.Random(parts)
    for kind in range(3):
        points = [(rng.choice([0.25, 0.5, 1.0, rng.random()]), rng.choice([0.5, rng.random()]) if kind else rng.randrange(3) / 3) for _ in range(150)]
        points += [(a, a if kind == 2 else 1 - a) for a in (rng.random() for _ in range(40))]
        df = spark.createDataFrame([*points, (None, 0.1)], "x double, y double")
        for far in (0, 11):
            got = stats.kendall_tau_of_all(df, "x", "y", far, parts).first()
            assert got.n == len(points) + far and abs(got.tau - brute_tau([(round(a, 12), round(b, 12)) for a, b in points] + [(1.0, 1.0)] * far)) < 1e-9
    assert stats.kendall_tau_of_all(df.limit(0), "x", "y").first().tau is None


def test_pearson_of_sums_counts_far_points(spark):
    near = [(0.2, 0.5), (0.9, 0.8), (0.4, 0.1)]
    df = spark.createDataFrame(near, "x double, y double")
    u, v = 1 - F.col("x"), 1 - F.col("y")
    sums = df.agg(F.sum(u).alias("u"), F.sum(v).alias("v"), F.sum(u * u).alias("uu"), F.sum(v * v).alias("vv"), F.sum(u * v).alias("uv"))
    got = sums.select(stats.pearson_of_sums(F.lit(10.0), *[F.col(c) for c in ("u", "v", "uu", "vv", "uv")]).alias("r")).first().r
    every = spark.createDataFrame(near + [(1.0, 1.0)] * 7, "x double, y double")
    assert abs(got - every.select(F.corr("x", "y")).first()[0]) < 1e-9


def test_long_strings_are_read_in_linear_time(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice("acgté\n") for _ in range(n)) for n in (3, 8, 4103, 4104, 64_000)]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    df.select(kmers.kmer_array(F.col("s"), 8)).collect()
    began = time.time()
    got = [set(r[0]) for r in df.select(kmers.kmer_array(F.col("s"), 8)).collect()]
    assert time.time() - began < 10
    assert got == [{t[i : i + 8] for i in range(len(t) - 7)} for t in texts]


@pytest.mark.parametrize("small", [0, 40, 10**6])
def test_small_remainders_are_finished_alike(spark, monkeypatch, small):
    rng = random.Random(5)
    edges = {tuple(sorted(rng.sample(range(60), 2))) for _ in range(150)} | {(i, i + 1) for i in range(60, 90)}
    priority = {i: rng.random() for i in range(95)}
    kept = []
    for i in sorted(priority, key=priority.get):
        if not any((min(i, j), max(i, j)) in edges for j in kept):
            kept.append(i)
    monkeypatch.setattr(greedy, "SMALL", small)
    nodes = spark.createDataFrame(list(priority.items()), "id long, priority double")
    got = greedy.select_representatives(nodes, spark.createDataFrame(list(edges), "id1 long, id2 long"))
    assert sorted(r.id for r in got.collect()) == sorted(kept)


def test_filters_and_forms(spark):
    feats = spark.createDataFrame([("g1", "seed"), ("g1", "x"), ("g2", "x"), ("g3", "seed")], "genome string, role string")
    assert {r.genome for r in roles.with_seed(feats, "seed").collect()} == {"g1", "g3"}
    genomes = spark.createDataFrame([("g1", "Bacteria"), ("g2", "Virus"), ("g3", None)], "genome string, domain string")
    assert {r.genome for r in roles.in_domains(feats, genomes).collect()} == {"g1"}
    names = spark.createDataFrame([("Seed protein",), ("seed  Protein # note",), ("Other",), (None,)], "role string")
    ids = {r.role: r.role_id for r in roles.role_ids(names).collect()}
    assert len(ids) == 3 and ids["Seed protein"] == ids["seed  Protein # note"] != ids["Other"]
    counts = spark.createDataFrame([("r", "b", 0), ("r", "a", 0), ("r", "c", 2)], "role string, genome string, count int")
    lineages = spark.createDataFrame([("a", ["1", "2"]), ("b", ["1"]), ("c", ["0", "9"])], "genome string, lineage array<string>")
    assert [r.genome for r in roles.in_lineage_order(counts, lineages).orderBy("place").collect()] == ["c", "b", "a"]
    edges = spark.createDataFrame([(50, 1, 7), (50, 1, 8), (50, 2, 7)], "level int, id int, parent int")
    assert [(r.child, r.set_name, r.parent) for r in taxonomy.blanked(edges).orderBy("place").collect()] == [("1", "rep50", 7), ("", "", 8)]
    lines = spark.createDataFrame([("b\ta\t3\t0.5",), ("short\tline",), ("a\tb\tno\t1",)], "line string")
    assert [tuple(r) for r in coupling.read_report(lines).collect()] == [("a", "b", 3, 0.5)]
    named = spark.createDataFrame([("x", "X name", "w", "", 4, 0.25)], "class1 string, family_product1 string, class2 string, family_product2 string, size long, weight double")
    assert [tuple(r) for r in coupling.read_report(coupling.report_lines(named, "FAMILIES"), "FAMILIES").collect()] == [("w", "x", 4, 0.25)]
    rna = spark.createDataFrame([("SSU ribosomal RNA", 900), ("SSU ribosomal RNA", 100), ("other", 2000)], "product string, length int")
    assert [r.length for r in ratings.ssu_features(rna, "(?i)ssu", 500).collect()] == [900]
    known = spark.createDataFrame([("m1", "acg"), ("m1", "aaa")], "md5 string, seq string")
    wanted = spark.createDataFrame([("m1",), ("m2",)], "md5 string")
    assert {r.md5: r.seq for r in ratings.sequence_of_checksum(wanted, known).collect()} == {"m1": "aaa", "m2": None}
    assert set(build.MODES) == {"YES", "NO", "ONLY"}
