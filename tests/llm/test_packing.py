"""Best-fit packing against plain best fit, whole-text tokenization and an exact round trip."""

import bisect
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from loom.llm import packing

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


def plain_best_fit(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        i = bisect.bisect_left(rooms, n)
        room = rooms.pop(i) if i < len(rooms) else capacity
        bisect.insort(rooms, room - n)
    return sorted(rooms)


@pytest.mark.parametrize("seed", range(8))
def test_plan_is_best_fit(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 64, 2048])
    lengths = [min(capacity, int(rng.expovariate(4 / capacity)) + 1) for _ in range(rng.choice([0, 1, 40, 3000]))]
    if seed % 2:
        lengths += [capacity // 3] * 1000 + [capacity] * 5
    counts = Counter(lengths)
    plan = packing.best_fit(counts, capacity)
    filled, parts = defaultdict(int), defaultdict(list)
    for n, c in counts.items():
        own = plan[plan[:, 0] == n]
        for rank in range(c):
            _, first, sequence, each, offset = own[np.searchsorted(own[:, 1], rank, "right") - 1]
            s, at = sequence + (rank - first) // each, offset + (rank - first) % each * n
            filled[s] += n
            parts[s].append((at, n))
    for s, own in parts.items():
        own.sort()
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:])) and filled[s] <= capacity
    assert sorted(filled) == list(range(len(filled)))
    assert sorted(capacity - x for x in filled.values()) == plain_best_fit(lengths, capacity)
    assert len(plan) <= 63 * 4 * (len(counts) + 1)


def texts():
    rng = random.Random(7)
    words = ["Hello", "it's", "WORLD", "ümläut", "é", "x1y2", "...", "<|endoftext|>", "日本語", "a b", "ΣΣ", "antidisestablishmentarianism", "'s", "I'LL", "fi", "🙂🙂", "\x00", " "]
    make = lambda n: "".join(rng.choice(words) + rng.choice([" ", "  ", "\n", "\t", "\r\n", "\x0b", "\x0c"]) for _ in range(n))
    return [None, "", " \n", "one", *[make(rng.choice([1, 3, 30, 500])) for _ in range(60)], make(3000), "w" * 50_000]


def test_ids_are_those_of_whole_texts(monkeypatch):
    from tokenizers import Tokenizer

    whole, own = Tokenizer.from_file(PATH), texts()
    for run, known in ((1 << 18, 300_000), (7, 3), (64, 0)):
        monkeypatch.setattr(packing, "_RUN", run)
        monkeypatch.setattr(packing, "_KNOWN", known)
        got, lasts = defaultdict(list), Counter()
        words = packing.WordIds(open(PATH, encoding="utf-8").read())
        for part in (own[:30], own[30:]):
            base = 0 if part is own or part == own[:30] else 30
            for row, ids, last in words.runs(pa.array(part, pa.string())):
                got[base + row] += ids.tolist()
                lasts[base + row] += last
        assert all(lasts[i] == 1 for i in range(len(own)))
        assert [got[i] for i in range(len(own))] == [whole.encode(t or "", add_special_tokens=False).ids for t in own]


@pytest.mark.parametrize("capacity", [16, 2048])
def test_pack(spark, capacity):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(PATH)
    own = list(enumerate(texts()))
    own += [(1000 + i, "the same text of these") for i in range(400)] + [(5, "again"), (5, "again"), (None, "none"), (None, None)]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in own], "doc_id long, text string, length int, ids string").repartition(5)
    packed = packing.pack(df, PATH, capacity, with_ids=True)
    rows = packed.collect()
    kinds = dict(packed.dtypes)
    assert kinds["piece"] == "int" and {kinds[c] for c in ("doc_id", "start", "length", "ids_crc32", "sequence_id", "offset")} == {"bigint"}
    want = Counter()
    for i, t in own:
        ids = [*whole.encode(t or "", add_special_tokens=False).ids, 0]
        for p, a in enumerate(range(0, len(ids), capacity)):
            part = ids[a : a + capacity]
            want[i, p, a, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), tuple(part)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, tuple(r.ids)) for r in rows) == want
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length, r.ids))
    for parts in by.values():
        parts.sort()
        assert [a for a, _, _ in parts] == [sum(n for _, n, _ in parts[:k]) for k in range(len(parts))] and sum(n for _, n, _ in parts) <= capacity
    assert len(by) == len(plain_best_fit([r.length for r in rows], capacity))
    full = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    assert full == {s: [i for _, _, ids in parts for i in ids] for s, parts in by.items()}
    assert packing.pack(df.limit(0), PATH, capacity).count() == 0
