"""Decontamination: every pattern of changed tokens, brute force over all diagonals, and repetitive texts."""

import random
import re
import time
from itertools import combinations
from math import ceil

import numpy as np
import pytest

from loom.llm import decontaminate as dc


def hashed(*texts):
    raw = "".join(texts).encode()
    offs = np.concatenate(([0], np.cumsum([len(t.encode()) for t in texts])))
    return dc.tokens(np.frombuffer(raw, np.uint8), offs)


@pytest.mark.parametrize("length", range(1, 21))
def test_every_pattern_of_substitutions(length):
    """Overlaps that begin and end alike and differ in as many inner tokens as allowed are all found, whatever their places."""
    free = 0 if length < dc.WHOLE else length - ceil(0.8 * length - 1e-9)
    item = [f"w{i}" for i in range(length)]
    index = dc.build_index([(7, " ".join(item))])
    patterns = [p for n in range(free + 1) for p in combinations(range(1, length - 1), n)]
    texts = [" ".join(["before"] + ["other" if i in p else w for i, w in enumerate(item)] + ["after"]) + " " for p in patterns]
    found = dc.search(index, *hashed(*texts))
    assert len(found) == len(patterns)
    assert all(found[k] == (7, length - len(p), length, 1, 0) for k, p in enumerate(patterns))
    if length > 1:
        one_more = [p for p in combinations(range(length), free + 1)][:200]
        texts = [" ".join("other" if i in p else w for i, w in enumerate(item)) + " " for p in one_more]
        assert not {k for k in dc.search(index, *hashed(*texts)) if length <= dc.MIN_TOKENS}


def brute(text, items, least=13, part=0.8):
    """The longest overlap over all items and diagonals: (item, equal, span, doc_from, item_from) or None."""
    doc, best = re.findall(r"[a-z0-9]+", (text or "").lower()), None
    for i, (name, words) in enumerate(items):
        item = re.findall(r"[a-z0-9]+", words.lower())
        if not item:
            continue
        need, rate = min(least, len(item)), 1.0 if len(item) < dc.WHOLE else part
        for shift in range(-len(item), len(doc) + 1):
            lo, hi = max(0, -shift), min(len(item), len(doc) - shift)
            same = [j for j in range(lo, hi) if item[j] == doc[j + shift]]
            for a in range(len(same)):
                for b in range(a, len(same)):
                    span = same[b] + 1 - same[a]
                    if span >= need and b - a + 1 >= rate * span - 1e-9 and (best is None or span > best[2]):
                        best = (name, b - a + 1, span, same[a] + shift, same[a])
    return best


def test_against_all_diagonals(spark, monkeypatch):
    rng = random.Random(3)
    words = [f"t{i}" for i in range(60)]
    say = lambda n: [rng.choice(words) for _ in range(n)]
    items = [(i if i != 4 else None, " ".join(say(n))) for i, n in enumerate([2, 5, 7, 12, 13, 20, 20, 33, 9, 6])]
    items.append((5, items[5][1]))
    docs = [(0, None), (1, ""), (2, " ;. "), (3, "t1 " * 300)]
    for k in range(40):
        name, text = rng.choice(items)
        passage = text.split()
        for at in rng.sample(range(len(passage)), rng.randrange(0, 1 + len(passage) // 4)):
            passage[at] = "changed"
        cut = passage[rng.randrange(0, 3) :] if len(passage) > 16 else passage
        docs.append((10 + k, " ".join(say(rng.randrange(0, 9)) + cut + say(rng.randrange(0, 9)))))
    docs += docs[-2:] + [(None, items[7][1].upper())]
    ordered = sorted(items, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    want = sorted((str(d), brute(t, ordered)) for d, t in docs if t is not None)
    df = spark.createDataFrame([(d, t, "mine", 7, "x") for d, t in docs], "doc_id long, text string, contaminated string, __item_id long, item_id_ string")
    bench = spark.createDataFrame([*items, (50, None), (51, "")], "item_id long, text string")
    for limit in (2_000_000, 60):
        monkeypatch.setattr(dc, "INDEX_TOKENS", limit)
        out = dc.mark(df, bench)
        assert sorted(out.columns) == sorted(["doc_id", "text", "__item_id", "item_id_", "item_id", "equal_tokens", "span_tokens", "doc_from", "item_from", "contaminated"])
        rows = out.collect()
        assert all(r["__item_id"] == 7 and r.item_id_ == "x" for r in rows)
        got = sorted((str(r.doc_id), (r.item_id, r.equal_tokens, r.span_tokens, r.doc_from, r.item_from) if r.contaminated else None) for r in rows if r.text is not None)
        strip = lambda x: [(d, None if o is None else (o[0], o[2])) for d, o in x]  # of equal spans on several diagonals any place will do
        assert strip(got) == strip(want)


def test_repetitive_texts_take_no_time():
    index = dc.build_index([(1, "same " * 3000), (2, "one two " * 1500)])
    began = time.time()
    found = dc.search(index, *hashed("same " * 8000, "two one " * 4000))
    assert {k: x[:3] for k, x in found.items()} == {0: (1, 3000, 3000), 1: (2, 3000, 3000)}
    assert time.time() - began < 10
