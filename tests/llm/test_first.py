"""Exact dedup, language ID and SimHash against brute force on small tables."""

import hashlib
import random
import re

import xxhash

from loom.llm import exact_dedup, language_id, simhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, label string, n long"


def table(spark, rows):
    return spark.createDataFrame([(i, t, None, None, None, "x", 1) for i, t in rows], SCHEMA)


ODD = [(3, None), (1, ""), (2, " \t "), (4, "a  b"), (5, "a\nb"), (6, "A b"), (7, "word " * 5000), (7, "word " * 5000), (None, "a b"), (None, "only"), (8, "a b")]


def test_exact(spark):
    got = exact_dedup.exact_groups(table(spark, ODD)).collect()
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    assert len(got) == len(ODD)
    for r in got:
        same = [(i, norm(t)) for i, t in ODD if hashlib.sha256(norm(t).encode()).hexdigest() == r.text_sha256]
        ids = [i for i, _ in same if i is not None]
        assert r.group_size == len(same) and r.keep_id == (min(ids) if ids else None)
    assert sum(r.kept for r in got) == len({norm(t) for _, t in ODD})
    assert exact_dedup.exact_groups(table(spark, [])).count() == 0


def brute_fp(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    sh = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute_components(fps, radius=4):
    ids = sorted(range(len(fps)))
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in ids:
        for j in ids[:i]:
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in ids]


def test_simhash(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}é" for i in range(400)]
    texts = [None, "", " ", "Ab", "aB", "one two three", "word " * 3000]
    for _ in range(40):
        base = [rng.choice(vocabulary) for _ in range(120)]
        texts.append(" ".join(base))
        for k in range(4):
            copy = base[:]
            for _ in range(k):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append("\n".join(copy))
    rows = list(enumerate(texts))
    got = {r.doc_id: r for r in simhash.near_duplicates(table(spark, rows)).collect()}
    fps = [brute_fp(t) for t in texts]
    assert [int(got[i].fingerprint, 16) for i, _ in rows] == fps
    assert [got[i].component_id for i, _ in rows] == brute_components(fps)
    kept = simhash.keep_one(table(spark, rows + rows[:3] + [(None, "zz yy")] * 2))
    assert kept.columns == SCHEMA.replace("long", "").replace("string", "").replace(" ", "").split(",")
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(set(brute_components(fps)))
    assert kept.where("doc_id IS NULL").count() == 1
    assert simhash.near_duplicates(table(spark, [])).count() == 0
    assert simhash.keep_one(table(spark, [])).count() == 0


def test_dense_cluster(spark):
    """One slot with several blocks: near fingerprints chained over many steps."""
    rng = random.Random(1)
    fps, x = {0}, 0
    for _ in range(3000):
        x = (x ^ 1 << rng.randrange(64)) if rng.random() < 0.5 else rng.getrandbits(64) & rng.getrandbits(64) & rng.getrandbits(64) & rng.getrandbits(64)
        fps.add(x)
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(i, f) for i, f in enumerate(signed)], "id long, h long")
    old, simhash.BLOCK = simhash.BLOCK, 16
    try:
        got = {r.fp: r.component_id for r in simhash.near_components(df, "id", "h").collect()}
    finally:
        simhash.BLOCK = old
    assert [got[f] for f in signed] == brute_components(fps)


def test_language(spark):
    words = {"aa": ["thing", "with", "ation", "the"], "bb": ["über", "schön", "ein", "und"], "cc": ["ñandú", "ción", "que", "los"]}
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(words[k]) for _ in range(30)), k) for i in range(300) for k in [("aa", "bb", "cc")[i % 3]]]
    df = spark.createDataFrame([(i, t, k, "s", 1.0, "x") for i, t, k in rows] + [(900, None, None, None, None, None), (901, "123 !!", "aa", None, None, None), (902, "", None, None, None, None), (None, "que los " * 20000, None, None, None, None)], "doc_id long, text string, lang string, source string, score double, lang_pred string")
    model = language_id.train(df)
    got = language_id.identify(df, model)
    assert got.columns == ["doc_id", "text", "lang", "source", "lang_pred", "score", "accepted"]
    out = got.collect()
    assert len(out) == 304
    for r in out:
        if r.doc_id is None:
            assert r.lang_pred == "cc"
        elif r.doc_id >= 900:
            assert (r.lang_pred, r.score, r.accepted) == ("und", 0.0, False)
        else:
            assert r.lang_pred == r.lang and 0 <= r.score <= 1
    empty = language_id.identify(df.limit(0), language_id.train(df.limit(0)))
    assert empty.count() == 0
    assert language_id.identify(df, language_id.train(df.limit(0))).where("lang_pred <> 'und'").count() == 0
