"""Toxic words that only a beginning of six bytes, or of eight, tells from clean ones."""

import random

import pytest

from loom.llm import toxicity
from tests.llm.test_first import table


@pytest.mark.parametrize("bad, good", [("grimly", "grimlo"), ("grimlyab", "grimlyao")])
def test_each_length_counts(spark, bad, good):
    rng = random.Random(6)
    words, docs, truth = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)], [], {}
    for i in range(600):
        y = int(i % 10 == 0)
        tail = chr(97 + i // 10 % 26) + chr(97 + i % 26)
        docs.append((i, " ".join(rng.sample(words, 20) + [(bad if y else good) + tail])))
        truth[i] = y
    labels = [(i, 1, y) for i, y in truth.items()]
    df, lab = table(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = toxicity.score(df, toxicity.train(df, lab)).where(~toxicity.training_row()).collect()
    assert sum(truth[r.doc_id] for r in out) > 5
    assert all((r.toxicity >= toxicity.THRESHOLD) == truth[r.doc_id] for r in out)
