"""The data sources for sequence files and genome documents."""

import gzip
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, Not, StringStartsWith

from loom.sources import files


def plain(text):
    """(label, comment, sequence) a line at a time."""
    out = []
    for line in text.split("\n"):
        if line.startswith(">"):
            label, comment = (line[1:].strip().split(None, 1) + ["", ""])[:2]
            out.append([label, comment.strip(), ""])
        elif out:
            out[-1][2] += "".join(line.split())
    return [tuple(r) for r in out]


def make(rng, n):
    parts = ["" if rng.random() < 0.5 else "no record\n"]
    for i in range(n):
        body = "".join(rng.choice("acgtACGT\n >\t") if rng.random() < 0.05 else rng.choice("acgt") for _ in range(rng.choice([0, 1, 5, 70, 900])))
        parts.append(f">g{i}{rng.choice(['', ' a comment', '  two  blanks '])}{rng.choice(['', chr(13)])}\n{body.replace(chr(10) + '>', chr(10))}\n")
    return "".join(parts)


@pytest.mark.parametrize("seed", range(6))
def test_every_cut_gives_each_record_once(seed, monkeypatch):
    rng = random.Random(seed)
    data = make(rng, rng.choice([0, 1, 12])).encode()
    monkeypatch.setattr(files, "_BLOCK", rng.choice([1, 2, 7, 64, 5000]))
    whole = [(at, r) for at, r in files.records(iter([data]), 0, 0, len(data))]
    assert [r for _, r in whole] == [data[a:b] for a, b in zip([at for at, _ in whole], [*[at for at, _ in whole][1:], len(data)])]
    for split in (1, 2, 3, 10, 97, 1000):
        got = []
        for start in range(0, max(1, len(data)), split):
            first = max(0, start - 1)
            blocks = (data[i : i + files._BLOCK] for i in range(first, len(data), files._BLOCK))
            got += files.records(blocks, first, start, min(len(data), start + split))
        assert got == whole


def test_one_large_file_by_several_tasks(spark, tmp_path):
    rng = random.Random(11)
    text = make(rng, 3000)
    (tmp_path / "a.fasta").write_text(text)
    (tmp_path / "b.fasta.gz").write_bytes(gzip.compress(b">z last\nAC GT\nA"))
    (tmp_path / "_hidden").write_text(">no\nA\n")
    files.register(spark)
    read = spark.read.format("fasta").option("splitBytes", 100_000).load(str(tmp_path))
    assert read.rdd.getNumPartitions() > 5
    rows = read.orderBy("file", "at").collect()
    assert [(r.label, r.comment, r.sequence) for r in rows] == [*plain(text), ("z", "last", "ACGTA")]
    few = read.where(F.col("label").isin("g7", "z") & (F.length("sequence") > 0))
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "Filter (length(sequence" in plan and not any("Filter (" in line and "label" in line for line in plan.splitlines())  # checked by the reader
    assert {r.label for r in few.collect()} == {r.label for r in rows if r.label in ("g7", "z") and r.sequence}
    heads = spark.read.format("fasta").schema("label string").load(str(tmp_path))
    assert sorted(r.label for r in heads.collect()) == sorted(r.label for r in rows)


def test_written_and_read_back(spark, tmp_path):
    files.register(spark)
    rows = [(f"id{i}", None if i % 3 else f"text {i}", "ACGT" * (i % 40) if i % 5 else None) for i in range(500)]
    df = spark.createDataFrame(rows, "label string, comment string, sequence string").repartition(3)
    for width, packed in ((0, None), (60, "gzip")):
        path = str(tmp_path / f"out{width}")
        for _ in range(2):
            df.write.format("fasta").option("width", width).option("compression", packed or "none").mode("overwrite").save(path)
        got = {(r.label, r.comment, r.sequence) for r in spark.read.format("fasta").load(path).collect()}
        assert got == {(a, b or "", c or "") for a, b, c in rows}
        assert spark.read.format("fasta").load(path).count() == 500
    df.limit(5).write.format("fasta").mode("append").save(path)
    assert spark.read.format("fasta").load(path).count() == 505
    for bad in ("two words", None, ""):
        with pytest.raises(Exception, match="no record of a sequence file"):
            spark.createDataFrame([(bad, "", "A")], "label string, comment string, sequence string").write.format("fasta").mode("append").save(path)
    assert spark.read.format("fasta").load(path).count() == 505 and not [p for p in (tmp_path / "out60").iterdir() if p.name.startswith("_")]


def test_filters_choose_files(tmp_path):
    for folder, name in (("a", "1.2"), ("b", "1.2"), ("b", "1.10"), ("b", "2.1")):
        (tmp_path / folder).mkdir(exist_ok=True)
        (tmp_path / folder / f"{name}.gto").write_text(f'{{"id": "{name}", "name": "{folder}"}}')
    (tmp_path / "b" / "notes.txt").write_text("no genome")
    opened = lambda *filters: _opened(str(tmp_path), filters)
    assert opened() == (["a/1.2", "b/1.10", "b/2.1"], 0)
    assert opened(In(("name",), ("1.2", "9"))) == (["a/1.2"], 0)
    assert opened(StringStartsWith(("name",), "1."), EqualTo(("name",), "1.10")) == (["b/1.10"], 0)
    assert opened(Not(EqualTo(("name",), "1.2"))) == (["a/1.2", "b/1.10", "b/2.1"], 1)
    assert opened(GreaterThan(("name",), "1.10")) == (["a/1.2", "b/1.10", "b/2.1"], 1)


def _opened(path, filters):
    from pyspark.sql import types as T

    reader = files.GenomeReader(path, T.StructType.fromDDL("name string, document string"), 30)
    left = list(reader.pushFilters(list(filters)))
    return sorted(r[0].removeprefix(path + "/").removesuffix(".gto") for p in reader.partitions() for r in p.ranges), len(left)


def test_genomes_written_and_looked_up(spark, tmp_path):
    files.register(spark)
    path = str(tmp_path / "genomes")
    df = spark.range(40).select(F.col("id").cast("string").alias("name"), F.to_json(F.struct(F.col("id").cast("string").alias("id"), (F.col("id") * 2).alias("n"))).alias("document"))
    for packed in ("none", "gzip"):
        df.repartition(3).write.format("genomes").option("compression", packed).mode("overwrite").save(path)
        assert len([p for p in (tmp_path / "genomes").iterdir() if ".gto" in p.name]) == 40
        got = files.genomes(spark, path, "id string, n long", ["3", "17", "none"])
        assert sorted(map(tuple, got.collect())) == [("17", "17", 34), ("3", "3", 6)]
    assert files.genomes(spark, path, "n long").agg(F.sum("n")).first()[0] == 40 * 39
