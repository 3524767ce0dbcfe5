"""Rejected rows and counts of one scan."""

import pytest
from pyspark.sql import functions as F

from loom.plans import observed


def test_audited(spark, tmp_path):
    rows = [(i, None if i % 7 == 0 else i * 10, "old") for i in range(50)] + [(3, 30, "old")] * 2
    spark.createDataFrame(rows, "id long, v long, reason string").write.parquet(str(tmp_path / "in"))
    df = spark.read.parquet(str(tmp_path / "in"))
    rules = {"large": F.col("v") > 400, "even": F.col("id") % 2 == 0}
    kept, rejected, counts = observed.audited(df, rules, {"most": F.max(observed.of_kept("v"))})
    of = lambda r: "large" if (r[1] or 0) > 400 else "even" if r[0] % 2 == 0 else None
    want = [of(r) for r in rows]
    assert counts == {"rows": 52, "kept": want.count(None), "large": want.count("large"), "even": want.count("even"), "most": max(r[1] or 0 for r in rows if of(r) is None)}
    assert sorted(r.id for r in kept.collect()) == sorted(r[0] for r in rows if of(r) is None) and kept.columns == ["id", "v"]
    assert sorted((r.id, r.reason) for r in rejected.collect()) == sorted((r[0], of(r)) for r in rows if of(r))
    assert not any(str(tmp_path / "in") in f for f in kept.inputFiles() + rejected.inputFiles())  # the source is not read again


def test_empty_and_wrong(spark):
    none = spark.createDataFrame([], "id long")
    kept, rejected, counts = observed.audited(none, {"bad": F.col("id") < 0})
    assert (kept.count(), rejected.count(), counts) == (0, 0, {"rows": 0, "kept": 0, "bad": 0})
    with pytest.raises(ValueError):
        observed.audited(none, {"kept": F.col("id") < 0})
