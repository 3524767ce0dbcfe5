"""Language ID: scores against plain Python, held-out accuracy, rejection, long and repeated training texts."""

import math
import random

import pytest

from loom.llm import language_id as li

WORDS = {"aa": ["thing", "with", "ation", "the", "mand"], "bb": ["über", "schön", "ein", "und", "mandel"], "cc": ["ñandú", "ción", "que", "los", "mandar"]}
SCHEMA = "doc_id long, text string, lang string"


def say(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) for _ in range(n))


def plain_score(model, text):
    """Averages of table rows of all byte 2-, 3- and 4-grams within words, as the docstrings say."""
    low = bytes(b | 0x20 if 65 <= b <= 90 or 97 <= b <= 122 else b if b >= 128 else 32 for b in text.encode())
    b = b" " + low + b" "
    total, n = [0.0] * len(model.languages), 0
    for size in (2, 3, 4):
        for i in range(len(b) - size + 1):
            gram = b[i : i + size]
            if size == 2 and gram == b"  " or size > 2 and 32 in gram[1:-1]:
                continue
            code = 0
            for x in gram:
                code = (code * 257 + x) % 2**32
            bucket = (code * 2654435761 + size * 40503) % 2**32 >> 16
            n += 1
            for k in range(len(total)):
                total[k] += float(model.table[bucket, k])
    z = [(t / max(1, n) + float(c)) / model.temperature for t, c in zip(total, model.bias)]
    e = [math.exp(x - max(z)) for x in z]
    return (model.languages[z.index(max(z))], max(e) / sum(e)) if n else (None, 0.0)


def test_scores_against_plain_python(spark):
    rng = random.Random(2)
    train = [(i, say(rng, lang, 25), lang) for i in range(240) for lang in [("aa", "bb", "cc")[i % 3]]]
    model = li.train(spark.createDataFrame(train, SCHEMA))
    texts = [say(rng, rng.choice("aa bb cc".split()), n) for n in range(1, 40)] + ["The 12, Él--x", "Z", "é 1 2 b"]
    got = li.identify(spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], SCHEMA), model).collect()
    for r in got:
        lang, score = plain_score(model, r.text)
        assert r.lang_pred == lang and abs(r.score - score) < 1e-5
        assert r.accepted == (r.score >= model.threshold)


def test_held_out_accuracy_and_clean_documents_kept(spark):
    rng = random.Random(4)
    rows = [(i, say(rng, lang, rng.randrange(5, 60)), lang) for i in range(1500) for lang in [("aa", "bb", "cc")[i % 3]]]
    df = spark.createDataFrame(rows, SCHEMA)
    held = li.identify(df, li.train(df)).where(~li.training_row()).collect()
    assert len(held) > 200
    assert sum(r.lang_pred == r.lang for r in held) >= 0.99 * len(held)
    assert sum(r.accepted for r in held) >= 0.97 * len(held)


def test_wrong_labels_among_sure_texts_reject_little():
    rng = random.Random(6)
    langs = [("aa", "bb", "cc")[i % 3] for i in range(600)]
    texts = [say(rng, x, 30) for x in langs]
    noisy = [rng.choice(["aa", "bb"]) if rng.random() < 0.05 else x for x in langs]
    model = li.fit(texts, noisy)
    import pyarrow as pa

    best, score = li._scores(model, pa.array(texts))
    right = [s >= model.threshold for b, s, x in zip(best, score, langs) if model.languages[b] == x]
    assert sum(right) >= 0.95 * len(right)


def test_languages_of_long_or_repeated_texts_are_learned(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(i, say(rng, "aa", 30), "aa") for i in range(200)]
    rows += [(500 + i, say(rng, "bb", 9000), "bb") for i in range(6)]  # only texts beyond the bound
    rows += [(901, "los que ción " * 9, "cc")] * 3000 + [(901, say(rng, "cc", 20), "cc") for _ in range(400)]  # one id
    df = spark.createDataFrame(rows, SCHEMA)
    sizes = {}
    monkeypatch.setattr(li, "fit", lambda texts, langs, fit=li.fit: sizes.update({x: langs.count(x) for x in langs}, longest=max(map(len, texts))) or fit(texts, langs))
    model = li.train(df, per_language=100)
    assert model.languages == ["aa", "bb", "cc"]
    assert sizes["cc"] <= 100 and sizes["aa"] <= 100 and sizes["longest"] <= li.TRAIN_CHARS + li.STRETCHES
    probe = spark.createDataFrame([(1, say(rng, x, 20), x) for x in ("aa", "bb", "cc")], SCHEMA)
    assert all(r.lang_pred == r.lang for r in li.identify(probe, model).collect())
    assert li.train(df, max_languages=1).languages == ["cc"]
