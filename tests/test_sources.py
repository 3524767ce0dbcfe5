"""Files in, files out, restarts and streams."""

import json

from pyspark.sql import functions as F

from loom.sources import tables
from loom.streaming import incremental


def test_fasta_round_trip(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">fig|1.2.peg.1 first one\nMKV\nLLA\n>two\n\n>three\tx\ty\nACGT\n")
    got = tables.read_fasta(spark, str(tmp_path / "a.fa")).orderBy("position").collect()
    assert [(r.label, r.comment, r.sequence) for r in got] == [("fig|1.2.peg.1", "first one", "MKVLLA"), ("two", "", ""), ("three", "x\ty", "ACGT")]
    tables.write_fasta(tables.read_fasta(spark, str(tmp_path / "a.fa")), str(tmp_path / "out"))
    again = tables.read_fasta(spark, str(tmp_path / "out"))
    assert {(r.label, r.comment, r.sequence) for r in again.collect()} == {(r.label, r.comment, r.sequence) for r in got}


def test_tsv(spark, tmp_path):
    (tmp_path / "t.tbl").write_text('genome_id\tscore\tgood\n562.10\t 1.5\tY\n562.1\t2\t\n"q\t3\tY\n')
    df = tables.read_tsv(spark, str(tmp_path / "t.tbl"))
    assert [r.genome_id for r in df.orderBy("score").collect()] == ["562.10", "562.1", '"q']
    assert df.where(tables.flag(F.col("good"))).count() == 2
    assert tables.find_column(df, "2") == "score" and tables.find_column(df, "good") == "good"
    bare = tables.read_tsv(spark, str(tmp_path / "t.tbl"), header=False)
    assert bare.columns == ["c1", "c2", "c3"] and bare.count() == 4
    tables.write_tsv(df.select("genome_id", F.col("score").cast("double").alias("score")), str(tmp_path / "o"), {"score": "%6.2f"})
    assert "562.10\t  1.50" in "".join(p.read_text() for p in (tmp_path / "o").glob("*.csv"))


def test_genomes(spark, tmp_path):
    for name, gid in (("a.gto", "1.1"), ("b.gto", "1.1"), ("c.gto", "2.2")):
        doc = {"id": gid, "name": name, "features": [{"fid": f"fig|{gid}.peg.{i}", "function": "Seed role / other" if i < 2 else "x", "protein": "M" * (5 + i)} for i in range(3)]}
        (tmp_path / name).write_text(json.dumps(doc, indent=1))
    genomes = tables.read_genomes(spark, str(tmp_path))
    assert {(r.id, r.name) for r in genomes.collect()} == {("1.1", "a.gto"), ("2.2", "c.gto")}
    seeds = tables.seed_proteins(tables.features_of(genomes), ["Seed role"])
    assert {(r.genome, len(r.protein)) for r in seeds.collect()} == {("1.1", 6), ("2.2", 6)}
    reps = seeds.select(F.lit(10).alias("level"), F.col("genome").alias("id"), "fid", F.lit("n").alias("name"), "protein")
    tables.save_representatives(reps, str(tmp_path / "reps"))
    assert tables.list_representatives(tables.load_representatives(spark, str(tmp_path / "reps"))).count() == 2


def test_restart_and_stream(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"n{i}") for i in range(10)], "id long, name string")
    out = str(tmp_path / "out")
    assert tables.append_pending(rows.where("id < 4"), out, "id") == 4
    assert tables.append_pending(rows, out, "id") == 6
    assert spark.read.parquet(out).count() == 10
    rows.union(rows.limit(2)).write.parquet(str(tmp_path / "in"))
    for expected in (10, 13):  # the second run finds three keys that are there and three new ones
        q = incremental.append_stream(spark, str(tmp_path / "in"), "id long, name string", str(tmp_path / "sink"), str(tmp_path / "cp"), "id")
        q.awaitTermination(120)
        assert spark.read.parquet(str(tmp_path / "sink")).count() == expected
        rows.withColumn("id", F.col("id") + 7).where("id BETWEEN 7 AND 12").write.mode("append").parquet(str(tmp_path / "in"))


def test_running_counts(spark, tmp_path):
    rows = spark.createDataFrame([("2024-01-01 00:10:00", "a"), ("2024-01-01 00:50:00", "a"), ("2024-01-01 01:10:00", "b")], "at string, kind string").withColumn("at", F.to_timestamp("at"))
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    q = incremental.running_counts(stream, "at", "kind").writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted((r.kind, r["count"]) for r in spark.sql("SELECT * FROM counts").collect()) == [("a", 2), ("b", 1)]
