"""K-mer sets of strings and the measures on them, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LONG = 4096


def kmer_array(seq: Column, k: int) -> Column:
    """The distinct k-mers of a string; none where it is null or shorter than k.

    substring() walks from the string's beginning, so long strings are read by one look-ahead match: linear in their length.
    """
    last = F.length(seq) - k + 1
    places = F.sequence(F.lit(1), last)
    short = F.transform(places, lambda i: F.substring(seq, i, F.lit(k)))
    long = F.regexp_extract_all(seq, F.lit(f"(?s)(?=(.{{{k}}}))"), 1)
    return F.when(last < 1, F.array().cast("array<string>")).when(last < LONG, F.array_distinct(short)).when(last >= LONG,
        F.array_distinct(long)).otherwise(F.array().cast("array<string>"))


def word_kmer_array(text: Column, k: int) -> Column:
    """The distinct runs of k words (between blanks) of a text, joined by one space."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    runs = F.transform(F.sequence(F.lit(0), F.size(words) - k), lambda i: F.array_join(F.slice(words, i + 1, k), " "))
    return F.when(F.size(words) >= k, F.array_distinct(runs)).otherwise(F.array().cast("array<string>"))


def kmer_index(df: DataFrame, id_col: str, seq_col: str, k: int) -> DataFrame:
    """(id, kmer): one row for each distinct k-mer of each sequence, the form that similarity joins work on."""
    return df.select(F.col(id_col).alias("id"), F.explode(kmer_array(F.col(seq_col), k)).alias("kmer"))


def similarity(a: Column, b: Column) -> Column:
    """The number of k-mers that two sets share."""
    return F.size(F.array_intersect(a, b)).cast("long")


def jaccard_distance(sim: Column, size_a: Column, size_b: Column) -> Column:
    """1 - shared / all; two empty sets are at distance 1."""
    union = size_a + size_b - sim
    return F.when(union > 0, 1.0 - sim / union).otherwise(1.0)


def inverse_similarity(sim: Column) -> Column:
    return 1.0 / (sim + 1)


def signal(size: Column, distance: Column) -> Column:
    return size * (1.0 - distance)
