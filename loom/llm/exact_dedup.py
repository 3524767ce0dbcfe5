"""Exact dedup: two passes over hashes find those that may repeat; only their rows are shuffled."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loom.llm.common import WORD_BREAK, bit_filter, filter_bits, materialize, maybe


def text_sha(text: Column) -> Column:
    """SHA-256 (lowercase hex) of the text with every run of blanks as one space; null counts as empty."""
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), WORD_BREAK, " "), 256)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are after each run of blanks became one space. The row with the smallest id stays; a null id
    counts as larger than any other, and of rows with the same id and text exactly one stays. Null text equals empty text. Other
    columns of docs are not read. An empty table gives an empty result.

    First pass: (id, SHA-256) of each text is written to the shared folder, 40 bytes a document, and folded into a bitmap of
    positions hit twice, of at most MAX_FILTER_BITS bits. Second pass: a hash with a position that was not hit twice is
    unique, and its row passes straight through. The rest, true copies and a few false alarms, are counted by hash with
    partial sums; the groups of two and more are written out, so that the join back to the rows has an exchange on both
    sides that adaptive execution can split where one text holds a third of the rows.
    """
    hashed = materialize(docs.select(F.col(id_col).alias("id"), F.unhex(text_sha(F.col(text_col))).alias("sha")).withColumn("row",
        F.monotonically_increasing_id()))
    bits = filter_bits(hashed.count())
    h = F.conv(F.hex(F.substring("sha", 1, 8)), 16, -10).cast("long")
    bitmap = hashed.sparkSession.sparkContext.broadcast(bit_filter(hashed.select(h.alias("h")), bits, repeated=True))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = np.frombuffer(b"".join(x[:8] for x in batch.column(1).to_pylist()), ">u8").astype(np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(maybe(bitmap.value, got, bits))], names=["id", "sha", "row", "maybe"])

    probed = hashed.mapInArrow(probe, T.StructType([*hashed.schema.fields, T.StructField("maybe", T.BooleanType())]))
    alone, candidates = probed.where(~F.col("maybe")), probed.where("maybe")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row"))
    groups = materialize(candidates.groupBy("sha").agg(first.alias("first"), F.count("*").alias("n")).where("n > 1"))
    joined = candidates.join(groups, "sha", "left").select("id", "sha",
        F.when(F.col("n") > 1, F.col("first.id")).otherwise(F.col("id")).alias("keep_id"), F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("first.row") == F.col("row"), F.lit(True)).alias("kept"))
    single = alone.select("id", "sha", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"))
    return single.unionByName(joined).select(F.col("id").alias(id_col), "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))
