"""Quality and sharding against plain Python: measures, votes, expectation-maximisation, the lookup table and placements."""

import math
import random
from hashlib import blake2b
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash

from loom.llm import quality, sharding
from loom.llm.textnp import chunks

SPACE = " \t\n\x0b\x0c\r"


def plain_measures(text):
    """The labellers' measures as the docstrings say, over UTF-8 bytes."""
    data = (text or "").encode()
    is_letter = lambda b: 65 <= b <= 90 or 97 <= b <= 122 or b >= 128
    words = [bytes(g) for blank, g in groupby(data, lambda b: b in SPACE.encode()) if not blank]
    lines = [bytes(g) for end, g in groupby(data, lambda b: b == 10) if not end]
    ink = sum(b not in SPACE.encode() for b in data)
    letters, n = sum(map(is_letter, data)), len(words)
    odd = lambda b: not is_letter(b) and not 48 <= b <= 57 and b not in SPACE.encode() and b not in b".,;:!?'\")]"
    upper = lambda b: 65 <= b <= 90
    plain = lambda w: sum(map(is_letter, w)) >= max(1, len(w) - 1) and not (upper(w[0]) and upper(w[-1]) and len(w) > 1)
    part = lambda a, b: a / b if b else math.nan
    return {
        "words": n, "symbols": part(sum(map(odd, data)), ink), "capitals": part(sum(map(upper, data)), letters), "word_length": part(letters, n),
        "distinct_words": len(set(words)) / math.sqrt(n * min(n, 300)) if n >= 20 else math.nan,
        "word_again": sum(a == b for a, b in zip(words, words[1:])) / n if n >= 4 else math.nan,
        "repeated_lines": 1 - len(set(lines)) / len(lines) if len(lines) >= 2 else math.nan,
        "exclamations": part(data.count(b"!"), n), "digits": part(sum(48 <= b <= 57 for b in data), ink), "odd_endings": part(sum(odd(w[-1]) for w in words), n),
        "lone_marks": part(sum(not any(map(is_letter, w)) and not 48 <= w[0] <= 57 for w in words), n), "plain_words": part(sum(map(plain, words)), n),
    }


def texts():
    rng = random.Random(2)
    marks = ["word", "Ünï", "ABC", "x!", "12", "%%", "--", "a,", "same", "same", "\n", "\n\n", "(q)", "B", "9z"]
    return [None, "", "  \n ", "one", *[rng.choice([" ", "  ", "\t"]).join(rng.choice(marks) for _ in range(n)) for n in [*range(1, 60), 400]]]


def test_measures_and_votes():
    column = pa.array(texts())
    got = {name: np.concatenate([quality.measures(d, o)[name] for _, _, d, o in chunks(column)]) for name in quality.LABELLERS}
    votes = quality.patterns(column)
    for i, text in enumerate(texts()):
        want, pattern = plain_measures(text), 0
        for name, (bad_below, good_from, good_to, bad_above) in quality.LABELLERS.items():
            x = want[name]
            assert np.isclose(got[name][i], x, equal_nan=True), (name, text)
            pattern = pattern * 3 + (1 if x < bad_below or x > bad_above else 2 if good_from <= x <= good_to else 0)
        assert votes[i] == pattern


def plain_em(counts, rounds=200):
    """The same model, one pattern and one labeller at a time."""
    names = list(quality.LABELLERS)
    digits = {k: [k // 3**i % 3 for i in range(len(names) - 1, -1, -1)] for k in counts}
    p = {k: (1 + v.count(2)) / (2 + v.count(2) + 4 * v.count(1)) for k, v in digits.items()}
    for _ in range(rounds):
        total = sum(counts.values())
        prior = min(0.99, max(0.01, sum(counts[k] * p[k] for k in counts) / total))
        chance = []
        for i in range(len(names)):
            good, bad = ([1 + sum(counts[k] * q(p[k]) for k in counts if digits[k][i] == v) for v in range(3)] for q in (lambda x: x, lambda x: 1 - x))
            chance.append(([x / sum(good) for x in good], [x / sum(bad) for x in bad]))
        new = {}
        for k in counts:
            log = math.log(prior / (1 - prior)) + sum(math.log(g[digits[k][i]] / b[digits[k][i]]) for i, (g, b) in enumerate(chance))
            new[k] = 1 / (1 + math.exp(-max(-30, min(30, log))))
        done = max(abs(new[k] - p[k]) for k in counts) < 1e-9
        p = new
        if done:
            break
    return p, prior


def test_expectation_maximisation_recovers_labellers():
    rng = random.Random(5)
    counts, truth = {}, {}
    accuracy = {0: 0.95, 1: 0.9, 4: 0.8, 11: 0.85}  # the others abstain
    for _ in range(4000):
        good = rng.random() < 0.7
        pattern = 0
        for i in range(len(quality.LABELLERS)):
            vote = 0
            if i in accuracy and rng.random() < 0.8:
                vote = 2 if good == (rng.random() < accuracy[i]) else 1
            pattern = pattern * 3 + vote
        counts[pattern] = counts.get(pattern, 0) + 1
        truth.setdefault(pattern, []).append(good)
    posterior, found, prior = quality.expectation_maximisation(counts)
    want, want_prior = plain_em(counts)
    assert all(abs(posterior[k] - want[k]) < 1e-6 for k in counts) and abs(prior - want_prior) < 1e-6
    names = list(quality.LABELLERS)
    assert all(abs(found[names[i]] - a) < 0.05 for i, a in accuracy.items()) and abs(prior - 0.7) < 0.05
    right = sum((posterior[k] >= 0.5) == g for k, gs in truth.items() for g in gs)
    assert right >= 0.93 * 4000


def test_quality_keeps_clashing_columns(spark):
    df = spark.createDataFrame([(1, "Some plain words stand here. " * 9, "mine", 5.5), (1, "Some plain words stand here. " * 9, "mine", 5.5), (2, None, "mine", 5.5)], "doc_id long, text string, kept string, score double")
    out = quality.score(df, quality.train(df))
    assert out.columns == [*df.columns, "quality", "weak_posterior", "votes"]
    rows = out.collect()
    assert all(r.kept == "mine" and r.score == 5.5 for r in rows) and rows[0].quality == rows[1].quality


def plain_table(shards, slots):
    """Turns in a loop, every shard with its whole list of preferences."""
    number = lambda name, salt: int.from_bytes(blake2b(name.encode(), digest_size=8, salt=salt).digest())
    orders = [iter([(number(s, b"offset") + j * (number(s, b"skip") % (slots - 1) + 1)) % slots for j in range(slots)]) for s in shards]
    table = {}
    while len(table) < slots:
        for i, order in enumerate(orders):
            if len(table) < slots:
                table[next(x for x in order if x not in table)] = i
    return [table[x] for x in range(slots)]


def test_placements(spark):
    names = [f"shard-{i}" for i in range(5)]
    assert sharding.lookup_table(names, 211) == plain_table(names, 211)
    rows = [(i, f"t{i}") for i in range(400)] + [(None, "some text"), (None, None), (None, ""), (7, "again")]
    df = spark.createDataFrame([(*r, "mine", 3) for r in rows], "doc_id long, text string, source string, Shard long")
    out = sharding.place(df, shards=5, slots=211)
    assert out.columns == ["doc_id", "text", "source", "slot", "shard"]
    table = plain_table(names, 211)
    for r in out.collect():
        key = f"id:{r.doc_id}" if r.doc_id is not None else f"text:{r.text or ''}"
        h = xxhash.xxh64_intdigest(key.encode(), 42)
        slot = (h - (1 << 64) if h >> 63 else h) % 211
        assert (r.slot, r.shard) == (slot, table[slot])
