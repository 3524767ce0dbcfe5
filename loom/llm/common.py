"""What the training-data operators share: shared-folder tables, column attachment, mergeable bit filters."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loom.plans.shared import written

WORD_BREAK = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

#: Largest bit filter that is ever broadcast, in bits (16 MB); a fuller filter only passes more rows on.
MAX_FILTER_BITS = 1 << 27
_SEGMENT_BITS = 1 << 18


#: Bytes of an Arrow batch, unless the session sets its own: texts differ in length by orders of magnitude.
ARROW_BYTES, _ARROW_KEY, _ARROW_DEFAULT = 8 << 20, "spark.sql.execution.arrow.maxBytesPerBatch", ("67108864b", "67108864", "64MB")
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once a session, unless their path has it already; bounds Arrow batches.

    The bound is the session's setting of Arrow batch bytes, which becomes ARROW_BYTES where it has Spark's default, and stays so.
    """
    if spark.conf.get(_ARROW_KEY, _ARROW_DEFAULT[0]) in _ARROW_DEFAULT:
        spark.conf.set(_ARROW_KEY, str(ARROW_BYTES))
    root = Path(__file__).resolve().parents[2]
    if any(p and Path(p).resolve() == root for p in os.environ.get("PYTHONPATH", "").split(os.pathsep)):
        return
    session = spark.sparkContext.applicationId
    if session in _shipped:
        return
    path = Path(tempfile.mkdtemp(prefix="spark-loom-")) / "loom.zip"
    with zipfile.ZipFile(path, "w") as z:
        for file in sorted((root / "loom").rglob("*.py")):
            z.write(file, file.relative_to(root))
    spark.sparkContext.addPyFile(str(path))
    _shipped.add(session)


def materialize(df: DataFrame) -> DataFrame:
    """Writes df as Parquet below the shared folder and reads it again: lineage ends there, and it survives lost executors."""
    ship(df.sparkSession)
    return written(df)


def attach(df: DataFrame, column: str, fields: list[T.StructField], make: Callable[[pa.Array], list[pa.Array]]) -> DataFrame:
    """df and the columns that make() returns for each Arrow batch of column; columns of the same names are replaced."""
    ship(df.sparkSession)
    names = {f.name.lower() for f in fields}
    kept = [f for f in df.schema.fields if f.name.lower() not in names]
    places = [i for i, f in enumerate(df.schema.fields) if f.name.lower() not in names]
    at = df.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = make(batch.column(at))
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in places] + new, names=[f.name for f in kept] + [f.name for f in fields])

    return df.mapInArrow(run, T.StructType(kept + fields))


def fresh(df: DataFrame, *stems: str) -> list[str]:
    """Names for helper columns that no column of df has, whatever their case."""
    taken, out = {c.lower() for c in df.columns}, []
    for stem in stems:
        name = stem
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def where_made(docs: DataFrame, make: Callable[[DataFrame], DataFrame], names: tuple[str, ...], condition: str) -> DataFrame:
    """The rows of docs for which make(), which adds names, fulfils condition; docs' own columns, those of these names too."""
    clashing = [c for c in docs.columns if c.lower() in names]
    aside = dict(zip(clashing, fresh(docs, *[f"own_{c}" for c in clashing]), strict=True))
    out = make(docs.withColumnsRenamed(aside)).where(condition)
    return out.select(*[F.col(aside.get(c, c)).alias(c) for c in docs.columns])


def filter_bits(n: int, per_row: int = 16) -> int:
    """A power of two of bits for n rows, at most MAX_FILTER_BITS."""
    return int(min(MAX_FILTER_BITS, max(1 << 18, 1 << int(np.ceil(np.log2(max(2, n * per_row)))))))


def probes(h: np.ndarray, bits: int, k: int = 4) -> np.ndarray:
    """k bit positions for each 64-bit hash: shape (k, n)."""
    h = h.astype(np.uint64)
    low, high = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    return np.stack([((low + np.uint64(i) * high + np.uint64(i * i)) & np.uint64(bits - 1)).astype(np.int64) for i in range(k)])


def maybe(bitmap: np.ndarray, h: np.ndarray, bits: int) -> np.ndarray:
    """Whether all bits of each hash are set."""
    out = np.ones(len(h), bool)
    for p in probes(h, bits):
        out &= (bitmap[p >> 3] >> (p & 7).astype(np.uint8)) & 1 == 1
    return out


def bit_filter(hashes: DataFrame, bits: int, repeated: bool) -> np.ndarray:
    """A bitmap over the first column (64-bit hashes): bits hit at all, or, with repeated, bits hit by two rows or more.

    Each task folds its rows into one pair of bitmaps (hit once, hit again), sent on in segments; tasks that own segments
    merge them as they stream by, and the driver receives at most MAX_FILTER_BITS bits, in one job whatever the partitions.
    """

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, again = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for batch in batches:
            h = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for part in np.array_split(h, max(1, len(h) >> 20)):
                at, n = np.unique(probes(part, bits).ravel(), return_counts=True)
                byte, bit = at >> 3, (1 << (at & 7)).astype(np.uint8)
                hit = once[byte] & bit != 0
                np.bitwise_or.at(again, byte[hit | (n > 1)], bit[hit | (n > 1)])
                np.bitwise_or.at(once, byte, bit)
        yield from _segments({i: (a, b) for i, (a, b) in enumerate(zip(once.reshape(-1, _SEGMENT_BITS // 8), again.reshape(-1, _SEGMENT_BITS // 8),
            strict=True)) if a.any()})

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for s, a, b in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                a, b = np.frombuffer(a.as_buffer(), np.uint8), np.frombuffer(b.as_buffer(), np.uint8)
                if s in held:
                    once, again = held[s]
                    held[s] = once | a, again | b | (once & a)
                else:
                    held[s] = a.copy(), b.copy()
        yield from _segments(held)

    ship(hashes.sparkSession)
    schema = "segment int, once binary, again binary"
    merged = hashes.mapInArrow(fold, schema).repartition(max(1, min(64, bits // _SEGMENT_BITS)), "segment").mapInArrow(merge, schema)
    out = np.zeros((bits // _SEGMENT_BITS, _SEGMENT_BITS // 8), np.uint8)
    for row in merged.select("segment", F.col("again" if repeated else "once").alias("b")).collect():
        out[row.segment] |= np.frombuffer(row.b, np.uint8)
    return out.ravel()


def _segments(held: dict[int, tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    for s, (a, b) in held.items():
        yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([a.tobytes()], pa.binary()), pa.array([b.tobytes()], pa.binary())],
            names=["segment", "once", "again"])
