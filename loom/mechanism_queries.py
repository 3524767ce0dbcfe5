"""Registered queries of hierarchies of any depth, sets that merge, and counts beside the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loom import queries as q
from loom.operators import ancestry, bitmaps
from loom.plans import observed

#: Pairs of kinds that class_set_sizes compares.
KNOWN_PAIRS = [("click", "view"), ("error", "view"), ("click", "error"), ("click", "nothing")]


def hierarchy_depths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers under a customer up to three before them, every 97th without one; every 211th points back up, which makes cycles."""
    c, n = F.col("c_custkey"), F.col("c_nationkey")
    parent = F.when(c % 97 == 1, None).when(c % 211 == 5, c + 4).when(c % 499 == 0, -c).otherwise(c - 1 - n % 3)
    nodes = q.table(spark, sf_dir, "customer").select(c.alias("id"), parent.alias("parent"))
    return ancestry.ancestry(nodes)


def class_set_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users of each kind of event and family, of each kind, of all kinds, and of known pairs of kinds: unions and meetings of the same sets."""
    e = q.table(spark, sf_dir, "events").select("event_type", F.floor(F.col("value") / 20).cast("long").alias("family"), "user_id")
    fine = q.written(bitmaps.bitmaps(e, ["event_type", "family"], "user_id", bitmaps.dense_ids(e, "user_id")))
    kinds = q.written(bitmaps.merged(fine, ["event_type"]))
    pairs = spark.createDataFrame(KNOWN_PAIRS, "one string, two string")
    row = lambda d, part, one="event_type", two="family": d.select(F.lit(part).alias("part"),
        *[(F.col(c) if c else F.lit(None)).cast("string").alias(a) for a, c in (("one", one), ("two", two))], F.col("n").cast("long").alias("n"))
    return (row(bitmaps.counted(fine, ["event_type", "family"]), "family").unionByName(row(bitmaps.counted(kinds, ["event_type"]), "kind", two=None))
        .unionByName(row(bitmaps.counted(bitmaps.merged(kinds, []), []), "all", None, None))
        .unionByName(row(bitmaps.in_common(pairs, kinds, "event_type", "one", "two"), "both", "one", "two")))


def rejected_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that are no input, with the reason, beside the counts that the same scan made of all and of the kept ones."""
    rules = {"no text": F.coalesce(F.trim("text"), F.lit("")) == "", "no language": F.col("lang").isNull(), "short": F.col("n_chars") < 200}
    statistics = {"longest": F.max(observed.of_kept("n_chars")), "chars": F.sum(observed.of_kept("n_chars"))}
    _, rejected, counts = observed.audited(q.table(spark, sf_dir, "documents"), rules, statistics)
    beside = [F.lit(counts[k]).cast("long").alias(name) for k, name in (("rows", "rows_read"), ("kept", "rows_kept"), ("longest", "longest"), ("chars", "chars"))]
    return rejected.select("doc_id", "reason", *beside)


QUERIES = (hierarchy_depths, class_set_sizes, rejected_documents)
