"""Scalar expressions on sequences, features, roles and counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The letters of the twenty amino acids, delimiters between the roles of a function, the far gap.
AMINO_ACIDS = "ACDEFGHIKLMNPQRSTVWY"
ROLE_DELIMITERS = r"\s+/\s+|\s+@\s+|\s*;\s+"
FAR = 2_147_483_647
#: How an infinite similarity is stored.
INFINITE = 2_147_483_647


def genome_of_feature(fid: Column) -> Column:
    """'511145.12' of 'fig|511145.12.peg.7'; null for other text."""
    return F.nullif(F.regexp_extract(fid, r"fig\|(\d+\.\d+)\.", 1), F.lit(""))


def ambiguity_count(seq: Column, letter: str = "X") -> Column:
    return (F.length(seq) - F.length(F.replace(seq, F.lit(letter), F.lit("")))).cast("long")


def incomplete_reason(dna: Column, protein: Column) -> Column:
    """Why a seed sequence is refused, or null."""
    return F.when(dna.isNull(), "missing DNA").when(protein.isNull(), "missing protein").when(protein.contains("XX"), "ambiguous protein")


def valid_dna(seq: Column, run: int = 5) -> Column:
    """No run of that many ambiguity letters."""
    return ~F.coalesce(F.lower(seq), F.lit("n" * run)).rlike(f"[^acgtu]{{{run},}}")


def without_comment(function: Column) -> Column:
    return F.trim(F.regexp_replace(function, r"\s*#.*$", ""))


def roles_of_function(function: Column) -> Column:
    return F.filter(F.split(without_comment(function), ROLE_DELIMITERS), lambda r: r != "")


def hypothetical(role: Column) -> Column:
    return F.lower(role).rlike("^(hypothetical|putative|uncharacterized|unknown)( protein)?$")


def after_first_tab(comment: Column) -> Column:
    at = F.instr(comment, "\t")
    return F.when(at > 0, F.substring(comment, at + 1, F.length(comment))).otherwise("")


def canonical_pair(a: Column, b: Column) -> tuple[Column, Column]:
    return F.least(a, b), F.greatest(a, b)


def gap(same_strand: Column, left_a: Column, right_a: Column, left_b: Column, right_b: Column) -> Column:
    """Letters between two features, negative where they overlap; FAR on other strands or contigs."""
    return F.when(same_strand, F.greatest(left_b - right_a, left_a - right_b)).otherwise(F.lit(FAR)).cast("long")


def role_type(count: Column) -> Column:
    return F.when(count == 0, "MISSING").when(count == 1, "GOOD").otherwise("OVER_PRESENT")


def percent_threshold(percent: float, total: Column) -> Column:
    """The least whole count that reaches the percentage, in whole-number arithmetic."""
    return F.floor(F.floor(F.lit(float(percent)) * total + 99) / 100).cast("long")


def bucket_of(distance: Column, buckets: int) -> Column:
    """The first bucket whose upper limit (bucket + 1) / buckets exceeds the distance; null from 1 on."""
    limits = F.array(*[F.lit((i + 1) / buckets) for i in range(buckets)])
    first = F.array_position(F.transform(limits, lambda x: x > distance), F.lit(True)) - 1
    return F.when(first >= 0, first)


def triplet_index(protein: Column, at: Column) -> Column:
    """The place of three amino acids among all triplets, to the base 20; -1 where a letter is none of them."""
    digit = [F.instr(F.lit(AMINO_ACIDS), F.substring(protein, at + i, F.lit(1))) - 1 for i in range(3)]
    bad = reduce(lambda x, y: x | y, [(d < 0) | (F.length(F.substring(protein, at + i, F.lit(1))) == 0) for i, d in enumerate(digit)])
    return F.when(bad, -1).otherwise(digit[0] * 400 + digit[1] * 20 + digit[2]).cast("int")


def triplets() -> Column:
    """All triplets of amino acids as an array, in the order of triplet_index()."""
    letters = F.array(*[F.lit(x) for x in AMINO_ACIDS])
    return F.flatten(F.transform(letters, lambda a: F.flatten(F.transform(letters, lambda b: F.transform(letters, lambda c: F.concat(a, b, c))))))


def shown_similarity(sim: Column) -> Column:
    return F.when(sim == INFINITE, "MAX").otherwise(sim.cast("string"))


def last_mismatch(a: Column, b: Column) -> Column:
    """The right-most place (from 0) at which two arrays of the same length differ; null where they are equal."""
    return F.array_max(F.filter(F.sequence(F.lit(0), F.size(a) - 1), lambda i: ~F.get(a, i).eqNullSafe(F.get(b, i))))


def natural_id_key(genome_id: Column) -> Column:
    """Sorts '2.10' after '2.9'."""
    return F.transform(F.split(genome_id, r"\."), lambda x: F.coalesce(F.try_to_number(x, F.lit("999999999999")).cast("long"), F.lit(0)))


def genome_checksum(contig_md5s: Column) -> Column:
    """One MD5 for a genome: of the sorted MD5s of its contigs, joined by commas."""
    return F.md5(F.array_join(F.sort_array(contig_md5s), ","))
