"""Order statistics against sorted lists, with intervals narrowed and with hot values."""

import random

import pytest
from pyspark.sql import functions as F

from loom.functions import stats
from loom.operators.selection import order_statistics


@pytest.mark.parametrize(("cells", "most"), [(1024, 65_536), (4, 3), (8, 1)])
def test_against_sorted_lists(spark, cells, most):
    rng = random.Random(5)
    values = {
        "even": [rng.random() for _ in range(300)],
        "ties": [rng.choice([0.5, 0.25, -3.0]) for _ in range(200)] + [7.0],
        "wide": [rng.choice([-1, 1]) * 10.0 ** rng.randint(-3, 3) for _ in range(60)] + [1.7e308, -1.7e308],
        "one": [2.0],
        "same": [1.5] * 50,
        None: [3.0, 1.0, 2.0],
    }
    rows = [(g, v) for g, vs in values.items() for v in vs] + [("even", None), ("void", None), ("even", float("nan")), ("one", float("inf"))]
    asked = [(g, r) for g, vs in values.items() for r in {1, 2, len(vs) // 2, len(vs), len(vs) + 1, 0}] + [("even", 1), ("nobody", 1), ("void", 1)]
    df, ranks = spark.createDataFrame(rows, "g string, v double"), spark.createDataFrame(asked, "g string, rank long")
    got = sorted((str(r.g), r.rank, r.v) for r in order_statistics(df, "g", "v", ranks, cells, most).collect())
    want = sorted({(str(g), r, sorted(values[g])[r - 1]) for g, r in asked if 1 <= r <= len(values.get(g, []))})
    assert got == want


def test_empty_and_wrong(spark):
    none = spark.createDataFrame([], "g long, v double")
    assert order_statistics(none, "g", "v", spark.createDataFrame([(1, 1)], "g long, rank long")).count() == 0
    with pytest.raises(ValueError):
        order_statistics(none, "g", "v", none.select("g", F.lit(1).alias("rank")), cells=1)


def test_percentile_ranks(spark):
    for n in (1, 2, 3, 4, 7, 100):
        values = [float(i * i) for i in range(1, n + 1)]
        for p in (0.25, 0.5, 0.75):
            low, high, part = stats.percentile_ranks(n, p)
            want = spark.range(1).select(stats.percentile(F.array(*[F.lit(v) for v in values]), p)).first()[0]
            assert values[low - 1] + part * (values[high - 1] - values[low - 1]) == pytest.approx(want)
