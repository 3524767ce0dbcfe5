"""Places without a window over everything."""

import random

from pyspark.sql import functions as F

from loom.operators import ranks


def test_places(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(["hot", "hot", "hot", "a", "b"]), rng.choice([None, *range(5)])) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, grp string, n int").repartition(7)
    key = lambda r: (-r[2] if r[2] is not None else 1, r[0])  # nulls last, as in a falling order
    want = {r[0]: p for p, r in enumerate(sorted(rows, key=key), 1)}
    out = ranks.ranked(df, F.desc("n"), F.col("id"))
    assert {r.id: r.place for r in out.collect()} == want and out.columns == ["id", "grp", "n", "place"]
    own = {}
    for g in ("hot", "a", "b"):
        own |= {r[0]: p for p, r in enumerate(sorted((r for r in rows if r[1] == g), key=key), 1)}
    assert {r.id: r.at for r in ranks.ranked_within(df, "grp", F.desc("n"), F.col("id"), name="at").collect()} == own
    assert ranks.ranked(df.limit(0), F.col("id")).count() == ranks.ranked_within(df.limit(0), "grp", F.col("id")).count() == 0
    dealt = out.select(F.spark_partition_id().alias("p")).distinct().count()
    assert dealt > 1  # not one task
