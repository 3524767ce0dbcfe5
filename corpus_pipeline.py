"""The corpus pipeline: documents through language ID, near-dedup, decontamination, mixing and sharding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loom.llm import decontaminate, language_id, mixing, near_copies, sharding
from loom.llm.common import materialize, where_made


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model, trained on docs, accepts.

    Null and blank texts, and those without a letter, go; equal texts go or stay together, repeated rows and null ids too. An
    empty table, or one without a known language, gives an empty one. No column of docs is changed, whatever its name.
    """
    model = language_id.train(docs)
    return where_made(docs, lambda d: language_id.identify(d, model), ("lang_pred", "score", "accepted"), "accepted")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies: five-word shingles, Jaccard similarity 0.8 and more.

    Multi-index hashing of SimHashes finds the candidates, whole shingle sets decide.

    The smallest id stays, null last; of rows of one id the first by their shingles, then by the hash of all columns; of
    rows alike in all columns one. Texts without words are one group. An empty table gives an empty one. No column is changed.
    """
    return near_copies.keep_one(docs)


def clean_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage.

    Null and empty texts stay; equal rows go or stay together. Without benchmark items all stay; an empty table gives an empty
    one. No column of docs is changed, whatever its name.
    """
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    names = (*(f.name for f in decontaminate.FIELDS), "contaminated")
    return where_made(docs, lambda d: decontaminate.mark(d, items), names, "NOT contaminated")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each pass of the mix that takes words of a document, in the columns of docs.

    Texts without words are in no pass. Repeated rows are separate documents; null is a source of its own. An empty table
    gives an empty one. Only the text, and n_chars, of a document that is taken in part change.
    """
    return mixing.mixed_documents(docs)


def placed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with slot and shard; rows of one id meet, null ids are placed by their texts.

    Columns of these names are replaced; an empty table gives an empty one.
    """
    return sharding.place(docs)


STAGES = [("language ID", known_language), ("near-dedup", one_of_each_group), ("decontamination", clean_of_benchmarks), ("mixing", mixed), ("sharding", placed)]

#: SQL has no SimHash, no trained model and no spaced seeds.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each is written to the shared folder and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        docs = docs if k == len(STAGES) - 1 else materialize(docs)
    return docs
