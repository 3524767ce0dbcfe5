"""Filter interaction audit: every order of the filters is replayed on every document's flags."""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loom.llm.common import attach, materialize, ship
from loom.llm.textnp import chunks

#: The filters in the order of their bits: few words, repeated words, capitals, marks, copies.
FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS, MARKS = 200, 50, 3, "[#$%&*|]"


def text_failures(column: pa.Array) -> np.ndarray:
    """The filters A to D that each text fails, as bits 1, 2, 4, 8; null counts as empty."""
    texts = pc.fill_null(column, "")
    words = pc.list_flatten(lists := pc.ascii_split_whitespace(texts))
    row, real = np.asarray(pc.list_parent_indices(lists)), np.asarray(pc.binary_length(words)) > 0
    which = np.asarray(words.dictionary_encode().indices, dtype=np.int64)[real]
    row = row[real].astype(np.int64)
    n_words = np.bincount(row, minlength=len(texts))
    known = int(which.max()) + 1 if len(which) else 1
    distinct = np.bincount(np.unique(row * known + which) // known, minlength=len(texts))
    capitals = np.zeros(len(texts), np.int64)
    for i, j, data, offs in chunks(texts):
        at = np.flatnonzero((data >= 65) & (data <= 90))
        capitals[i:j] = np.diff(np.searchsorted(at, offs))
    points = np.asarray(pc.utf8_length(texts), dtype=np.int64)
    marked = np.asarray(pc.match_substring_regex(texts, MARKS).cast(pa.int8()), dtype=np.int64)
    return (n_words < MIN_WORDS) + 2 * (100 * distinct < MIN_DISTINCT * n_words) + 4 * (100 * capitals > MAX_CAPITALS * points) + 8 * marked


def failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(id, part, failed): a row for each row of docs, with the filters it fails as bits in the order of FILTERS.

    A text fails E if a smaller id has the identical text. Null text counts as empty, a null part as the empty string; a null id
    is neither smaller nor larger than another, and rows of one id and text don't fail for each other. Other columns are not
    read; an empty table gives an empty one. (id, SHA-256, bits) are written once. The first id of each text joins back on
    text and id together, which no text's copies make hot.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col), F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("sha"),
        text.alias("failed"))
    seen = materialize(attach(own, "failed", [T.StructField("failed", T.IntegerType())], lambda c: [pa.array(text_failures(c), pa.int32())]))
    first = seen.where(F.col("id").isNotNull()).groupBy("sha").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    copy = F.col("id").isNotNull() & F.col("first").isNull()
    return seen.join(first, ["sha", "id"], "left").select("id", "part", (F.col("failed") + F.when(copy, 16).otherwise(0)).alias("failed"))


def labelled(failed: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """failed with good and toxic: whether any label row of the id has quality 1, toxic 1. Unlabelled and null ids have neither."""
    own = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    return failed.join(own, "id", "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})


def replay(marked: DataFrame, filters: str = FILTERS) -> DataFrame:
    """A row per part, order of the filters and step: what the step keeps and removes when the filters run in that order.

    marked: (part, failed, good, toxic), failed as bits in the order of filters. Each row meets every order (n! of them,
    broadcast) and is exploded into the steps; the first filter of the order that it fails removes it. Sums are combined in
    the tasks before the shuffle, so no part is hot. shapley sums what a filter removes over all orders. An empty table gives an
    empty one; repeated rows count each.
    """
    ship(marked.sparkSession)
    n = len(filters)
    rows = [("".join(filters[i] for i in p), *[1 << i for i in p]) for p in permutations(range(n))]
    orders = marked.sparkSession.createDataFrame(rows, ", ".join(["filter_order string", *[f"bit{i + 1} int" for i in range(n)]]))
    first = F.lit(n + 1)
    for i in range(n, 0, -1):
        first = F.when(F.col("failed").bitwiseAND(F.col(f"bit{i}")) != 0, i).otherwise(first)
    step, own = F.explode(F.array(*[F.lit(i + 1) for i in range(n)])), F.lit(None).cast("int")
    for i in range(n, 0, -1):
        own = F.when(F.col("step") == i, F.col(f"bit{i}")).otherwise(own)
    steps = marked.crossJoin(F.broadcast(orders)).withColumn("first", first).withColumn("step", step).withColumn("own", own)
    count = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    removed: Column = F.col("first") == F.col("step")
    out = steps.groupBy("part", "filter_order", "step").agg(count(F.col("first") > F.col("step")).alias("kept"), count(removed).alias("removed"),
        count((F.col("failed").bitwiseAND(F.col("own")) != 0) & (F.col("first") < F.col("step"))).alias("redundant"),
        count(F.col("failed") == F.col("own")).alias("unique_fails"), count(removed & F.col("good")).alias("good_lost"),
        count(removed & F.col("toxic")).alias("toxic_lost"))
    letter = F.expr("substring(filter_order, step, 1)")
    total = out.groupBy("part", letter.alias("letter")).agg(F.sum("removed").alias("shapley"))
    return out.withColumn("letter", letter).join(total, ["part", "letter"]).drop("letter")
