"""Streams with keyed state: restarts, expiry, representatives."""

import random

import pytest
from pyspark.sql import functions as F

from loom.streaming import keyed

SCHEMA = "id long, key string, n long"


def write(spark, rows, path, name):
    """One file of the given name."""
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/{name}")


def run(spark, tmp_path, **more):
    q = keyed.append_once(spark, f"{tmp_path}/in/*", SCHEMA, f"{tmp_path}/out", f"{tmp_path}/cp", ["key"], ["id"], files_a_batch=1, **more)
    assert q.awaitTermination(120)
    return q


def test_killed_and_restarted(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, rng.choice(["a", "b", None, *[f"k{j}" for j in range(20)]]), i % 3) for i in range(80)]
    for part in range(4):
        write(spark, rows[part * 20 : part * 20 + 20], f"{tmp_path}/in", f"{part}")
    (tmp_path / "in" / "2x").mkdir()
    (tmp_path / "in" / "2x" / "part-broken.parquet").write_bytes(b"no file of this kind")  # stops the query in the midst of its batches
    with pytest.raises(Exception):  # noqa: B017, PT011
        run(spark, tmp_path)
    done = spark.read.schema(SCHEMA).parquet(f"{tmp_path}/out").count() if (tmp_path / "out" / "_spark_metadata").exists() else 0
    good = spark.createDataFrame([(999, "late", 0)], SCHEMA).coalesce(1)
    good.write.parquet(f"{tmp_path}/good")
    part = next((tmp_path / "good").glob("part-*.parquet"))
    (tmp_path / "in" / "2x" / "part-broken.parquet").write_bytes(part.read_bytes())
    for crc in (tmp_path / "in" / "2x").glob(".*.crc"):
        crc.unlink()
    run(spark, tmp_path)
    write(spark, [(1000, "a", 0), (1001, "new", 0), (1002, "new", 1)], f"{tmp_path}/in", "5")
    run(spark, tmp_path)
    out = spark.read.schema(SCHEMA).parquet(f"{tmp_path}/out").collect()
    keys = [r.key for r in out]
    assert len(keys) == len(set(keys)) and set(keys) == {k for _, k, _ in rows} | {"late", "new"} and len(keys) >= done
    assert next(r.id for r in out if r.key == "new") == 1001


def test_keys_are_forgotten(spark, tmp_path):
    schema = "id long, key string, ts timestamp"
    hours = [[(1, "a", 0), (2, "b", 0)], [(3, "b", 3), (4, "c", 6)], [(5, "a", 7), (6, "b", 7)], [(7, "c", 8)]]
    for part, rows in enumerate(hours):
        df = spark.createDataFrame([(i, k, 1_700_000_000 + 3600 * h) for i, k, h in rows], "id long, key string, h long")
        df.select("id", "key", F.timestamp_seconds("h").alias("ts")).coalesce(1).write.parquet(f"{tmp_path}/in/{part}")
        q = keyed.append_once(spark, f"{tmp_path}/in/*", schema, f"{tmp_path}/out", f"{tmp_path}/cp", ["key"], ["id"], time="ts", late="0 seconds", expiry_ms=4 * 3_600_000)
        assert q.awaitTermination(120)
    assert sorted(r.id for r in spark.read.schema(schema).parquet(f"{tmp_path}/out").collect()) == [1, 2, 4, 5]  # a is forgotten after 4 hours, b not
    assert (spark.conf.get(keyed._PROVIDER, None) or "HDFSBackedStateStoreProvider").endswith("HDFSBackedStateStoreProvider")


def plain(rows, k, level):
    kept, out = {}, []
    for grp, i, seq in rows:
        own = {seq[p : p + k] for p in range(len(seq or "") - k + 1)} if seq else set()
        sim, ref = max(((len(own & o), -r) for r, o in kept.get(grp, {}).items()), default=(0, 0))
        if sim < level:
            kept.setdefault(grp, {})[i] = own
            out.append((grp, i, i, 9999, 0.0, True))
        else:
            out.append((grp, i, -ref, sim, round(1 - sim / len(own | kept[grp][-ref]), 9), False))
    return out


def test_running_representatives(spark, tmp_path):
    rng = random.Random(6)
    roots = ["".join(rng.choice("ACGT") for _ in range(40)) for _ in range(3)]
    rows = [(rng.choice(["x", "y", None]), i, None if i % 17 == 0 else rng.choice(roots)[rng.randrange(12) : 40]) for i in range(60)]
    schema = "grp string, id long, seq string"
    for part in range(2):  # a restart between them; the second file repeats some of the first
        own = rows[: 30] if part == 0 else rows[20:]
        spark.createDataFrame(own, schema).coalesce(1).write.parquet(f"{tmp_path}/in/{part}")
        keyed.represent(spark, f"{tmp_path}/in/*", schema, f"{tmp_path}/out", f"{tmp_path}/cp", 5, 8).awaitTermination(120)
    got = spark.read.parquet(f"{tmp_path}/out").select("grp", "id", "ref_id", "sim", F.round("distance", 9), "added").collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == plain(rows, 5, 8)
