"""Tab-separated tables, FASTA, genome documents and representative sets: readers and writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The columns of the four-column descriptor table, and of a genome document. Ids stay text: 562.10 is not 562.1.
DESCRIPTOR = "genome_id string, genome_name string, seed_protein string, ssu_rna string"
GENOME = (
    "id string, name string, domain string, lineage array<int>, taxonomy array<struct<rank:string,name:string>>, "
    "contigs array<struct<id:string,sequence:string>>, features array<struct<fid:string,function:string,contig:string,"
    "strand:string,left:bigint,right:bigint,pgfam:string,plfam:string,figfam:string,md5:string,protein:string,dna:string,"
    "subsystems:array<string>>>"
)


def read_tsv(spark: SparkSession, path: str, schema: str | None = None, header: bool = True) -> DataFrame:
    """Cells are trimmed text unless schema says otherwise; without a header, columns are those of schema or c1, c2, ..."""
    reader = spark.read.option("sep", "\t").option("header", header).option("quote", "").option("ignoreLeadingWhiteSpace",
        True).option("ignoreTrailingWhiteSpace", True).option("enforceSchema", False if header and schema else True)
    df = reader.schema(schema).csv(path) if schema else reader.csv(path)
    return df if header or schema else df.toDF(*[f"c{i + 1}" for i in range(len(df.columns))])


def find_column(df: DataFrame, spec: str) -> str:
    """A column by name, or by its number from 1."""
    if spec in df.columns:
        return spec
    if spec.isdigit() and 1 <= int(spec) <= len(df.columns):
        return df.columns[int(spec) - 1]
    raise ValueError(f"no column {spec!r} among {df.columns}")


def read_column(df: DataFrame, spec: str) -> DataFrame:
    """One column as a list with its place (file order): (position, value)."""
    return df.select(F.monotonically_increasing_id().alias("position"), F.col(find_column(df, spec)).alias("value"))


def flag(cell: Column) -> Column:
    """'Y' or '1' or 'true' is true, blank is false."""
    return F.coalesce(F.lower(F.trim(cell)).isin("y", "1", "true", "yes"), F.lit(False))


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(position, label, comment, sequence): one row a record, in file order, split by '>' at line starts, so in parallel.

    A label without a sequence has an empty one.
    """
    raw = spark.read.option("lineSep", "\n>").text(path)
    record = F.regexp_replace("value", "^>", "")
    head, body = F.substring_index(record, "\n", 1), F.regexp_extract(record, r"(?s)\n(.*)$", 1)
    first = F.regexp_extract(head, r"^(\S*)\s*(.*?)\s*$", 1)
    out = raw.where(F.trim("value") != "").select(F.monotonically_increasing_id().alias("position"), first.alias("label"),
        F.regexp_extract(head, r"^(\S*)\s?(.*?)\s*$", 2).alias("comment"), F.regexp_replace(body, r"\s", "").alias("sequence"))
    return out


def write_fasta(df: DataFrame, path: str, label: str = "label", comment: str = "comment", sequence: str = "sequence") -> None:
    text = F.concat(F.lit(">"), F.col(label), F.when(F.coalesce(F.col(comment), F.lit("")) != "", F.concat(F.lit(" "), F.col(comment))).otherwise(""),
        F.lit("\n"), F.coalesce(F.col(sequence), F.lit("")))
    df.select(text.alias("value")).write.mode("overwrite").text(path)


def write_tsv(df: DataFrame, path: str, formats: dict[str, str] | None = None) -> None:
    """Numbers are formatted here and only here; nulls are empty cells."""
    cols = [F.format_string(formats[c], F.col(c)).alias(c) if formats and c in formats else F.col(c) for c in df.columns]
    df.select(*cols).write.mode("overwrite").option("sep", "\t").option("header", True).option("emptyValue", "").option("quote",
        "").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def read_genomes(spark: SparkSession, path: str, kind: str = "DIR") -> DataFrame:
    """Genome documents: DIR, a folder of JSON files (MASTER: below it, also compressed), or TABLE, a Parquet table.

    Of documents with the same id the one with the smallest file name counts.
    """
    if kind == "TABLE":
        return spark.read.parquet(path)
    if kind not in ("DIR", "MASTER"):
        raise ValueError(f"unknown kind of genome source {kind!r}")
    docs = spark.read.schema(GENOME).option("multiLine", True).option("recursiveFileLookup", kind == "MASTER").option("pathGlobFilter",
        "*.gto*").json(path).withColumn("__file", F.input_file_name())
    return docs.groupBy("id").agg(F.min_by(F.struct(*[c for c in docs.columns if c not in ("id", "__file")]), "__file").alias("g")).select("id", "g.*")


def features_of(genomes: DataFrame) -> DataFrame:
    """One row a feature; only the fields that are used are read."""
    return genomes.select(F.col("id").alias("genome"), F.explode("features").alias("f")).select("genome", "f.*")


def seed_proteins(features: DataFrame, role_names: list[str]) -> DataFrame:
    """(genome, fid, protein, dna): the longest protein whose function has one of the roles, first of equals."""
    from loom.functions.sequences import roles_of_function
    from loom.operators.roles import longest_per_group

    wanted = F.array(*[F.lit(r) for r in role_names])
    own = features.where(F.arrays_overlap(roles_of_function(F.col("function")), wanted)).select("genome", "fid", "protein", "dna")
    return longest_per_group(own, "genome", "protein", "fid")


def save_representatives(reps: DataFrame, path: str) -> None:
    """(level, id, fid, name, protein): a folder a level."""
    reps.write.mode("overwrite").partitionBy("level").parquet(path)


def load_representatives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def list_representatives(reps: DataFrame) -> DataFrame:
    return reps.select(F.col("id").alias("genome_id"), F.col("name").alias("genome_name"))


def write_groups(df: DataFrame, path: str, group: str) -> None:
    """One folder a group."""
    df.write.mode("overwrite").partitionBy(group).option("sep", "\t").option("header", True).csv(path)


def append_pending(source: DataFrame, path: str, key: str) -> int:
    """Appends the rows of source whose key the table at path lacks; gives their number. A rerun after a stop adds the rest."""
    from loom.operators.sets import pending

    spark = source.sparkSession
    try:
        done = spark.read.schema(T.StructType([f for f in source.schema.fields if f.name == key])).parquet(path)
        done.isEmpty()
    except Exception as e:  # noqa: BLE001  no table yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        done = source.limit(0).select(key)
    from loom.plans.shared import written

    new = written(pending(source, done, key))
    new.write.mode("append").parquet(path)
    return new.count()
