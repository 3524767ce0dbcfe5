"""Near copies of the pipeline against all pairs of whole texts, and edited copies that radius 4 of a SimHash leaves."""

import random

import numpy as np
import pytest

import corpus_pipeline
from loom.llm import near_copies, simhash
from loom.llm.components import components
from tests.llm.test_first import table


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    sets, root = [shingles(t) for _, t in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a == b or 5 * len(a & b) >= 4 * len(a | b):
                one, two = sorted((root[i], root[j]))
                root = [one if r == two else r for r in root]
    return {rows[r][0] for r in root}


def edited(seed=4, groups=60):
    """Texts of 150 words and, of each, a copy with 1 to 3 words changed and one with 12, which is no near copy."""
    rng, rows = random.Random(seed), []
    for g in range(groups):
        base = [f"w{rng.randrange(900)}" for _ in range(150)]
        for n in (0, 1 + g % 3, 12):
            copy = base[:]
            for at in rng.sample(range(2, 148, 5), n):
                copy[at] = f"new{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(copy)))
    return rows


def test_edited_copies(spark):
    rows = edited()
    want = brute(rows)
    assert want == {i for i, _ in rows if i % 3 != 1}
    df = table(spark, rows)
    got = [r.doc_id for r in corpus_pipeline.one_of_each_group(spark, df, "").collect()]
    assert sorted(got) == sorted(want)
    assert simhash.keep_one(df).count() > len(want)  # the query's radius is another rule


def test_odd_rows(spark):
    rows = [(3, None), (1, ""), (2, " \t"), (4, "one Two"), (5, "one\ntwo"), (6, "two one"), (7, "word " * 5000), (8, "word " * 6000), (9, "zz yy xx"), (9, "zz yy xx"), (None, "zz yy xx"), (None, "only"), (10, "a b c d e f")]
    out = near_copies.keep_one(table(spark, rows))
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in out.collect()) == [(False, 1), (False, 4), (False, 6), (False, 7), (False, 9), (False, 10), (True, 0)]
    assert near_copies.keep_one(table(spark, [])).count() == 0


def test_large_cluster_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "BLOCK", 8)
    rng, base = random.Random(2), [f"w{i}" for i in range(150)]
    rows = []
    for i in range(90):  # copies lie within 0.8 of the base or of each other, or of nothing
        copy = base[:]
        for at in rng.sample(range(2, 148, 5), i % 6):
            copy[at] = f"x{i}"
        rows.append((i, " ".join(copy)))
    assert {r.doc_id for r in near_copies.keep_one(table(spark, rows)).collect()} == brute(rows)


@pytest.mark.parametrize("plan, slot", [((24, 16), 4096), ((42, 20), 4)])
def test_multi_index(spark, plan, slot, monkeypatch):
    """Candidates connect what pairs connect that are within one bit in a segment and within the radius; crowded slots too."""
    monkeypatch.setattr(near_copies, "SLOT", slot)
    (segments, width), rng = plan, np.random.default_rng(5)
    words = -(-segments * width // 64)
    bits = np.repeat(rng.integers(0, 2, (12, 64 * words)), 12, axis=0)
    bits ^= rng.random(bits.shape) < np.tile([0.02, 0.1, 0.15, 0.2], 36)[:, None]
    prints = np.packbits(bits.astype(np.uint8), axis=1, bitorder="little").view(np.int64)
    df = spark.createDataFrame([(k * 7, p) for k, p in enumerate(prints.tolist())], "key long, simhash array<long>")
    root = list(range(len(bits)))
    for i in range(len(bits)):
        apart = bits[i] != bits[:i]
        least = apart[:, : segments * width].reshape(i, segments, width).sum(axis=2).min(axis=1) if i else np.zeros(0)
        for j in np.flatnonzero((least <= 1) & (apart[:, : 64 * near_copies.WORDS].sum(axis=1) <= near_copies.RADIUS)):
            one, two = sorted((root[i], root[j]))
            root = [one if r == two else r for r in root]
    want, got = {}, {}
    for k, r in enumerate(root):
        want.setdefault(r, set()).add(k * 7)
    for r in components(near_copies.candidates(df, segments, width)).collect():
        got.setdefault(r.label, set()).add(r.node)
    assert sorted(map(sorted, got.values())) == sorted(sorted(x) for x in want.values() if len(x) > 1)


def test_pairs_at_the_limit(spark):
    """Pairs at a similarity of just 0.8, short ones too: 8 words of 9, 12 shingles in common of 15, 80 of 100."""
    rows = []
    for g in range(360):
        n, more = ((8, 1), (16, 3), (84, 20))[g % 3]
        base = [f"{g}x{i}" for i in range(n)]
        rows += [(2 * g, " ".join(base)), (2 * g + 1, " ".join(base + [f"{g}y{i}" for i in range(more)]))]
    assert all(5 * len(shingles(a[1]) & shingles(b[1])) == 4 * len(shingles(a[1]) | shingles(b[1])) for a, b in zip(rows[::2], rows[1::2]))
    assert {r.doc_id for r in near_copies.keep_one(table(spark, rows)).collect()} == set(range(0, 720, 2))


@pytest.mark.parametrize("slot", [4096, 32])
def test_edges_of_a_group_grow_with_its_members(spark, slot, monkeypatch):
    """A group of near copies gives edges in proportion to its members, though they share all slots and fill blocks of some."""
    monkeypatch.setattr(near_copies, "SLOT", slot)
    rng = np.random.default_rng(8)
    bits = rng.integers(0, 2, 384) ^ (rng.random((600, 384)) < 0.02)
    prints = np.packbits(bits.astype(np.uint8), axis=1, bitorder="little").view(np.int64)
    keys = rng.permutation(600) * 7
    df = spark.createDataFrame([(int(k), p) for k, p in zip(keys, prints.tolist())], "key long, simhash array<long>")
    edges = near_copies.candidates(df, 24, 16).cache()
    assert edges.count() <= 3 * 600 and edges.distinct().count() == edges.count()
    found = components(edges).collect()
    assert len(found) == 600 and len({r.label for r in found}) == 1


def test_links_of_a_cluster_in_blocks(spark, monkeypatch):
    """Two blocks that meet give no edge that either block has on its own: a cluster's links don't grow with its blocks."""
    monkeypatch.setattr(near_copies, "BLOCK", 8)
    base = [f"w{i}" for i in range(150)]
    df = table(spark, [(i, " ".join([*base[: i % 140], f"x{i}", *base[i % 140 + 1 :]])) for i in range(120)])
    nodes = near_copies.with_key(df, words=6).select("key", "n", "simhash").cache()
    edges = near_copies.links(df, nodes, 24, 16).cache()
    assert edges.count() <= 120 + 15 * 16 // 2  # a tree in each of 15 blocks, and one edge for every two of them
    assert len({r.label for r in components(edges).collect()}) == 1 and components(edges).count() == 120
