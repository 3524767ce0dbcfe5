"""Operators against plain Python on small tables."""

import random

import pytest
from pyspark.sql import functions as F

from loom.operators import coupling, greedy, ratings, roles, sets, taxonomy
from loom.plans import build


@pytest.mark.parametrize("seed", range(3))
def test_greedy_is_the_sequential_walk(spark, seed):
    rng = random.Random(seed)
    n = 60
    order = list(range(n))
    rng.shuffle(order)
    edges = {tuple(sorted(rng.sample(range(n), 2))) for _ in range(80)} if seed else {(i, i + 1) for i in range(n - 1)}
    seeds = set(rng.sample(range(n), 4)) if seed == 2 else set()
    kept = set(seeds)
    for i in sorted(range(n), key=lambda i: order[i]):
        if i not in kept and not any(tuple(sorted((i, k))) in edges for k in kept):
            kept.add(i)
    nodes = spark.createDataFrame([(i, order[i] if seed else i // 2) for i in range(n)], "id long, priority long")
    if not seed:
        kept = set(range(0, n, 2))
    df = spark.createDataFrame(list(edges) + [(3, 3)], "id1 long, id2 long")
    got = greedy.select_representatives(nodes, df, spark.createDataFrame([(s,) for s in seeds], "id long") if seeds else None)
    assert {r.id for r in got.collect()} == kept - seeds


def test_close_stops_at_the_first_gap(spark):
    rng = random.Random(5)
    rows = [(g, f, "c", "+" if f % 3 else "-", left, left + rng.randrange(5, 400)) for g in range(3) for f in range(40) for left in [rng.randrange(3000)]]
    df = spark.createDataFrame(rows, "genome long, fid long, contig string, strand string, left long, right long")
    got = {(r.genome, r.fid1, r.fid2) for r in coupling.close(df, 100).collect()}
    want = set()
    for a in rows:
        later = sorted((b for b in rows if b[0] == a[0] and b[3] == a[3] and (b[4], b[1]) > (a[4], a[1])), key=lambda b: (b[4], b[1]))
        for b in later:
            if max(b[4] - a[5], a[4] - b[5]) > 100:
                break
            want.add((a[0], a[1], b[1]))
    assert got == want and want
    next_to = {(r.genome, r.fid1): r.fid2 for r in coupling.adjacent(df, 10**6).collect()}
    assert len(next_to) == len(rows) - 6


def test_pair_weights_count_once_a_genome(spark):
    occ = spark.createDataFrame([("a", "b", 1, 1, 2, 0.5), ("a", "b", 1, 3, 4, 0.5), ("a", "b", 2, 1, 2, 0.25)], "class1 string, class2 string, genome long, fid1 long, fid2 long, weight double")
    subs = spark.createDataFrame([(1, 1, ["x"]), (1, 2, ["x", "y"]), (1, 3, ["z"]), (2, 1, None), (2, 2, [])], "genome long, fid long, subsystems array<string>")
    row = coupling.pair_totals(coupling.pair_genomes(occ, subs)).first()
    assert (row.size, row.weight, row.sub_match, row.sub_fail) == (2, 0.75, 1, 1)
    known = spark.createDataFrame([("b", 3, 0.5)], "class string, size long, strength double").select(F.lit("a").alias("class1"), F.col("class").alias("class2"), "size", "strength")
    assert coupling.link_back(occ, known).count() == 6
    with pytest.raises(ValueError):
        coupling.by_size(known, 1.0)
    rand = coupling.by_random_family(spark.createDataFrame([(1, i, f"f{i % 3}" if i % 4 else "") for i in range(12)], "genome long, fid long, pgfam string"))
    assert sorted(r["class"] for r in rand.collect()) == sorted(f"f{i % 3}" for i in range(12) if i % 4)


def test_ratings(spark):
    s = "acgtacgattacgcatgcat" * 40
    t = "ttgacaggcatgcaaggtcc" * 40
    rnas = [(1, 0, s), (1, 1, s[:750]), (2, 0, s), (3, 0, s[:800]), (3, 1, t), (4, 0, "acgt"), (6, 0, (s + t) * 2), (6, 1, (s + t)[:1500]), (7, 0, "n" * 900), (8, 0, s[:720]), (8, 1, s[:710])]
    genomes = spark.createDataFrame([(i, "NCBI_REF" if i == 5 else "NORMAL") for i in range(1, 9)], "id long, rating string")
    got = {r.id: r.rating for r in ratings.ssu_verdicts(genomes, spark.createDataFrame(rnas, "id long, pos long, seq string")).collect()}
    assert got == {1: "SHORT_SSU", 2: "SINGLE_SSU", 3: "BAD_SSU", 4: "BAD_SSU", 5: "BAD_SSU", 6: "NORMAL", 7: "BAD_SSU", 8: "SHORT_SSU"}
    rows = [(1, 10, "NORMAL", s * 2, 1), (2, 10, "SINGLE_SSU", s, 2), (3, 10, "SINGLE_SSU", t, 3), (4, None, "SINGLE_SSU", s, 4), (5, 11, "SINGLE_SSU", s, 5), (6, 12, "NCBI_REP", t, 6), (7, 12, "SINGLE_SSU", t, 7)]
    retry = {r.id: r.rating for r in ratings.genus_retry(spark.createDataFrame(rows, "id long, genus long, rating string, ssu string, priority long")).collect()}
    assert retry == {1: "NORMAL", 2: "NORMAL", 3: "BAD_SSU", 5: "SINGLE_SSU", 6: "NCBI_REP", 7: "SHORT_SSU"}


def test_build_levels_nest(spark):
    rng = random.Random(7)
    bases = ["".join(rng.choice("ACDEFGHIKL") for _ in range(120)) for _ in range(6)]
    rows = []
    for i in range(40):
        b = list(bases[i % 6])
        for _ in range(rng.randrange(8)):
            b[rng.randrange(120)] = rng.choice("MNPQ")
        rows.append((i, "NORMAL" if i % 3 else "NCBI_REF", float(i % 7), "".join(b)))
    b = build.build(build.prioritised(spark.createDataFrame(rows, "id long, rating string, score double, protein string")), levels=(10, 50, 90))
    sets_by_level = {n: {r.id for r in b.representatives.where(F.col("level") == n).collect()} for n in b.levels}
    assert sets_by_level[10] <= sets_by_level[50] <= sets_by_level[90] and sets_by_level[10]
    grams = {i: {p[j : j + 8] for j in range(113)} for i, _, _, p in rows}
    for r in b.placements.collect():
        best = max(len(grams[r.id] & grams[k]) for k in sets_by_level[r.level])
        assert r.sim == best and r.represented == (best >= r.level)
    assert b.placements.where("NOT represented").count() == 0
    good = build.good_table(b)
    assert {"rep10", "rep50", "rep90"} <= set(good.columns) and good.count() == 40
    assert taxonomy.hierarchy_errors(good, [10, 50, 90]).columns == ["id", "level", "expected", "actual"]


def test_roles_and_sets(spark):
    feats = spark.createDataFrame([(1, "a", 10.0, "f1"), (1, "b", 5.0, None), (1, "b", 6.0, "f2"), (2, "a", 20.0, "f3"), (2, "b", 7.0, "f2")], "genome long, role string, length double, family string")
    got = {r.role: r for r in roles.universal_roles(feats, 100.0).collect()}
    assert set(got) == {"a"} and got["a"].mean_len == 15.0 and got["a"].families == "f1,f3"
    counts = roles.role_counts(spark.createDataFrame([("a",), ("c",)], "role string"), spark.createDataFrame([(1,), (2,), (3,)], "genome long"), feats)
    assert sorted((r.role, r.genome, r["count"], r.type) for r in counts.collect()) == [("a", 1, 1, "GOOD"), ("a", 2, 1, "GOOD"), ("a", 3, 0, "MISSING"), ("c", 1, 0, "MISSING"), ("c", 2, 0, "MISSING"), ("c", 3, 0, "MISSING")]
    rows = spark.createDataFrame([(i, f"k{i % 3}") for i in range(6)], "pos long, key string")
    order = [r.pos for r in sets.prioritize(rows, spark.createDataFrame([("k2",)], "key string"), "key", "pos").collect()]
    assert order == [2, 5, 0, 1, 3, 4]
    assert [r.pos for r in sets.after(rows, "pos", "key", "k1").orderBy("pos").collect()] == [2, 3, 4, 5]
    plan = {(r.key, r.action) for r in sets.sync_plan(rows.select("key"), spark.createDataFrame([("k1",), ("k9",), ("k9",)], "key string"), "key").collect()}
    assert plan == {("k0", "delete"), ("k2", "delete"), ("k9", "add")}
