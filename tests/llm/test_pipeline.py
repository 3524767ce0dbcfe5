"""The pipeline, stage by stage, against plain Python on a small fixture."""

import random
from collections import Counter

import corpus_pipeline
from tests.llm.test_near_copies import brute

WORDS = {"en": ["the", "thing", "with", "house", "water"], "de": ["über", "schön", "nicht", "wasser", "haus"], "fr": ["être", "maison", "avec", "eau", "très"]}


def test_pipeline(spark, tmp_path):
    rng = random.Random(11)
    say = lambda lang, n: [rng.choice(WORDS[lang]) + rng.choice("abcdefgh") * rng.randrange(1, 3) for _ in range(n)]
    items = [say("en", 20) for _ in range(5)]
    rows = []
    for i in range(240):
        lang = ("en", "de", "fr")[i % 3]
        rows.append((i, " ".join(say(lang, 60)), lang, f"s{i % 4}"))
    for i in range(240, 270):  # copies, and near copies by one word
        words = rows[i - 240][1].split()
        if i % 2:
            words[30] = "changed"
        rows.append((i, " ".join(words), rows[i - 240][2], "s1"))
    for i in range(270, 280):
        rows.append((i, " ".join(say("en", 30) + items[i % 5] + say("en", 30)), "en", "s2"))
    rows += [(280, None, "en", "s3"), (281, "", "en", None), (282, "12345 !!! 678", "en", "s0"), (283, " ".join(say("de", 5000)), "de", None)]
    docs = spark.createDataFrame([(*r, len(r[1]) if r[1] is not None else None) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    docs, kept = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        kept[name] = docs.collect()
        assert docs.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
    ids = {n: {r.doc_id for r in rs} for n, rs in kept.items()}
    assert ids["language ID"] == {r[0] for r in rows} - {280, 281, 282}
    assert ids["near-dedup"] == brute([r[:2] for r in rows if r[0] in ids["language ID"]])
    texts = {r[0]: r[1] for r in rows}
    assert ids["decontamination"] == {i for i in ids["near-dedup"] if not any(" ".join(x) in texts[i] for x in items)}
    sizes, taken = Counter(), Counter()
    for r in kept["decontamination"]:
        sizes[r.source] += len(r.text.split())
    for r in kept["mixing"]:
        taken[r.source] += len(r.text.split())
        assert Counter(r.text.split()) <= Counter(texts[r.doc_id].split()) and r.n_chars == len(r.text)
    assert all(taken[s] <= 2 * sizes[s] for s in sizes) and abs(sum(taken.values()) - 1.5 * sum(sizes.values())) < 20
    assert sorted((r.doc_id, r.text) for r in kept["sharding"]) == sorted((r.doc_id, r.text) for r in kept["mixing"])
    where = {}
    for r in kept["sharding"]:
        assert 0 <= r.shard < 64 and where.setdefault(r.doc_id, r.shard) == r.shard
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(kept["sharding"])


CLASHING = "doc_id long, text string, lang string, source string, n_chars long, score double, lang_pred string, accepted string, contaminated boolean, item_id string, __row long, key string, n int, __key int"


def test_odd_rows_and_clashing_columns(spark, tmp_path):
    """Users' columns pass untouched through all stages but the last; null and repeated ids, repeated rows and empty tables too."""
    rng = random.Random(3)
    say = lambda lang, n: " ".join(rng.choice(WORDS[lang]) + rng.choice("abcdefgh") * 2 for _ in range(n))
    texts = [(i, say(("en", "de", "fr")[i % 3], 40)) for i in range(60)] + [(7, say("en", 40)), (7, say("en", 40)), (None, say("fr", 40)), (None, say("de", 40)), (None, None), (90, "")]
    texts += [texts[-3], (60, texts[5][1]), (5, texts[5][1])]
    lang = lambda t: next((k for k, ws in WORDS.items() if t and any(t.startswith(w) for w in ws)), None)
    rows = [(i, t, lang(t), "s", None if t is None else len(t), 777.5, "mine", "yes", True, "own", 5, "k", 3, 4) for i, t in texts]
    df = spark.createDataFrame(rows, CLASHING)
    items = spark.createDataFrame([(1, say("en", 20))], "item_id long, text string")
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, df, str(tmp_path))
        assert out.columns[: len(df.columns)] == df.columns
        rest = out.select(df.columns[5:]).distinct().collect()
        assert [tuple(r) for r in rest] == [(777.5, "mine", "yes", True, "own", 5, "k", 3, 4)], name
        empty = stage(spark, df.limit(0), str(tmp_path))
        assert empty.count() == 0 and empty.columns == out.columns
        if name == "language ID":
            assert out.count() == len(rows) - 2
        if name == "near-dedup":
            got = Counter((r.doc_id, r.text) for r in out.collect())
            assert set(got.values()) == {1} and (60, texts[5][1]) not in got and (5, texts[5][1]) in got
            assert {t for _, t in got if t} == {t for _, t in texts if t}
        if name == "decontamination":
            assert out.count() == len(rows)
