"""Hierarchies of any depth against a walk, bitmaps against Python sets."""

import random

from loom.operators import ancestry, bitmaps


def walk(parents):
    out = {}
    for x in parents:
        seen, at = [x], x
        while parents.get(at) is not None and parents[at] in parents and parents[at] not in seen:
            at = parents[at]
            seen.append(at)
        up = parents[at]
        if up is None or up not in parents:
            out[x] = (at, len(seen) - 1, "below" if at != x else "root" if up is None else "orphan")
        else:
            out[x] = (None, None, "cycle" if up == x else "above cycle")
    return out


def test_ancestry(spark):
    rng = random.Random(3)
    parents = {i: i - 1 for i in range(2, 71)} | {1: None}  # a chain
    parents |= {100 + i: 100 + (i + 1) % 5 for i in range(5)}  # a cycle of five
    parents |= {110: 101, 111: 110, 112: 111, 120: 120, 121: 120, 130: 999, 131: 130}
    parents |= {200 + i: rng.choice([None, 201 + rng.randrange(60), 1, 103]) for i in range(60)}
    rows = [(k, v) for k, v in parents.items()] + [(None, 1), (2, 1), (131, None), (3, 2)]
    got = {r.id: (r.root, r.depth, r.state) for r in ancestry.ancestry(spark.createDataFrame(rows, "id long, parent long")).collect()}
    assert got == walk(parents)


def test_ancestry_of_nothing(spark):
    assert ancestry.ancestry(spark.createDataFrame([], "id long, parent long")).count() == 0


def test_bitmaps(spark):
    rng = random.Random(4)
    rows = [(rng.choice("abc"), rng.choice("xy"), rng.randrange(40_000) * 7) for _ in range(30_000)] + [("a", "x", 0)] * 50 + [("a", None, 7), ("d", "x", None), ("e", "y", 70)]
    df = spark.createDataFrame(rows, "k string, l string, m long")
    sets = bitmaps.bitmaps(df, ["k", "l"], "m", bitmaps.dense_ids(df, "m"))
    of = lambda *want: {r[2] for r in rows if r[2] is not None and r[: len(want)] == want}
    keys = {r[:2] for r in rows if r[2] is not None}
    assert {(r.k, r.l): r.n for r in bitmaps.counted(sets, ["k", "l"]).collect()} == {key: len(of(*key)) for key in keys}
    whole = bitmaps.merged(sets, ["k"])
    assert {r.k: r.n for r in bitmaps.counted(whole, ["k"]).collect()} == {k: len(of(k)) for k in "abce"}
    pairs = spark.createDataFrame([("a", "b"), ("a", "b"), ("a", "e"), ("c", "d"), ("c", "c"), (None, "a")], "p string, q string")
    got = {(r.p, r.q): r.n for r in bitmaps.in_common(pairs, whole, "k", "p", "q").collect()}
    assert got == {(p, q): len(of(p) & of(q)) for p, q in [("a", "b"), ("a", "e"), ("c", "d"), ("c", "c")]} | {(None, "a"): 0}
