"""Rejected rows and run statistics of the same single scan as the rows that stay."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from loom.plans.shared import written

REASON = "reason"


def audited(df: DataFrame, rules: dict[str, Column], statistics: dict[str, Column] | None = None) -> tuple[DataFrame, DataFrame, dict]:
    """(kept, rejected, counts): rejected rows with the first rule that they fail as `reason`, and what the scan observed.

    rules: reason -> condition that holds for rows to be rejected, null counting as false. statistics: name -> aggregate, over
    of_kept() columns where only kept rows count. counts has 'rows', 'kept', each reason and each statistic. The rows are
    written once, with their reason; df is read by that job alone and the counts come from its tasks. A column `reason` of df is replaced.
    An empty table gives empty ones, and counts of 0.
    """
    taken = {"rows", "kept"} & set(rules) | set(statistics or {}) & {"rows", "kept", *rules}
    if taken:
        raise ValueError(f"names used twice: {sorted(taken)}")
    reason = reduce(lambda rest, rule: F.when(F.coalesce(rule[1], F.lit(False)), rule[0]).otherwise(rest), reversed(rules.items()), F.lit(None).cast("string"))
    seen = Observation(f"loom-{uuid.uuid4().hex}")
    counts = [F.count(F.lit(1)).alias("rows"), F.count_if(F.col(REASON).isNull()).alias("kept"), *[F.count_if(F.col(REASON) == r).alias(r) for r in rules]]
    marked = df.withColumn(REASON, reason)
    out = written(marked.observe(seen, *counts, *[c.alias(n) for n, c in (statistics or {}).items()]))
    return out.where(F.col(REASON).isNull()).drop(REASON), out.where(F.col(REASON).isNotNull()), seen.get


def of_kept(column: str) -> Column:
    """A column of the kept rows, null in rejected ones, for the statistics of audited()."""
    return F.when(F.col(REASON).isNull(), F.col(column))
