"""Streams with keyed state: each key admitted once, and representative sets of groups that grow as sequences come.

State lives in a RocksDB store below the query's checkpoint, a part of it in each task; a batch reads and writes the state of its own
keys, so its cost doesn't grow with what was admitted before. A query that was killed goes on from its checkpoint: the batch
that was running is done again from the state before it, and the file sink keeps only what was committed.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocks(spark: SparkSession) -> Iterator[None]:
    """Streams that start meanwhile keep their state in RocksDB; the session's own setting comes back."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, ROCKS)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


class Once(StatefulProcessor):
    """Lets the first row of a key pass, by the order of the given columns within the batch in which the key first comes.

    With a time column (naive, in the given zone, as pandas gets it), a key is forgotten when the stream's watermark is expiry_ms past its last row.
    """

    def __init__(self, order: list[str], time: str | None = None, expiry_ms: int = 0, zone: str = "UTC") -> None:
        self.order, self.time, self.expiry_ms, self.zone = order, time, expiry_ms, zone

    def _ms(self, at: pd.Timestamp) -> int:
        return 0 if pd.isna(at) else int(at.tz_localize(self.zone, ambiguous=False, nonexistent="shift_forward").timestamp() * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.seen = handle, handle.getValueState("seen", "rows long, last long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802, N803
        first, n, last = None, 0, 0
        for part in rows:
            n += len(part)
            last = max(last, self._ms(part[self.time].max())) if self.time else 0
            head = part if first is None else pd.concat([first, part])
            first = (head.sort_values(self.order, kind="stable") if self.order else head).head(1)
        known = self.seen.exists()
        before, latest = self.seen.get() if known else (0, 0)
        known_still = known and not (self.time and timerValues.getCurrentWatermarkInMs() >= latest + self.expiry_ms)  # its timer fires after these rows
        self.seen.update(((before if known_still else 0) + n, max(last, latest)))
        if self.time and last > latest:
            if known:
                self.handle.deleteTimer(latest + self.expiry_ms)
            self.handle.registerTimer(last + self.expiry_ms)
        if not known_still and first is not None:
            yield first

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802, N803
        self.seen.clear()
        yield from ()

    def close(self) -> None:
        pass


def admitted_once(stream: DataFrame, keys: list[str], order: list[str] | None = None, time: str | None = None, expiry_ms: int = 0) -> DataFrame:
    """The rows of a stream whose keys come for the first time, one a key; null is a key like any other.

    Of several rows of a key in one batch the first by order passes. With time (a column with a watermark) a key that hasn't come for
    expiry_ms of the stream's own time is forgotten and may pass again; rows behind the watermark are left out.
    """
    zone = stream.sparkSession.conf.get("spark.sql.session.timeZone")
    mode = "EventTime" if time else "None"
    return stream.groupBy(*keys).transformWithStateInPandas(Once(order or [], time, expiry_ms, zone), stream.schema, "Append", mode)


def append_once(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, keys: list[str], order: list[str] | None = None,
    files_a_batch: int | None = None, time: str | None = None, late: str = "1 hour", expiry_ms: int = 0) -> StreamingQuery:
    """Appends to the Parquet table at target the rows of files that come below source, each key once; stops when all there is is done.

    Start it again for what came later, or after it was killed: nothing is added twice, and nothing is lost. time, late (the
    watermark's delay) and expiry_ms let old keys go, see admitted_once().
    """
    reader = spark.readStream.schema(schema)
    reader = reader.option("maxFilesPerTrigger", files_a_batch) if files_a_batch else reader
    with rocks(spark):
        stream = reader.parquet(source)
        rows = admitted_once(stream.withWatermark(time, late) if time else stream, keys, order, time, expiry_ms)
        return rows.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class Representatives(StatefulProcessor):
    """Holds a group's representatives; a sequence that none of them resembles becomes one."""

    def __init__(self, k: int, level: int) -> None:
        self.k, self.level = k, level

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getMapState("representatives", "id long", "kmers array<string>")
        self.placed = handle.getMapState("placed", "id long", "ref_id long, sim long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802, N803
        whole = pd.concat(list(rows)).sort_values("id", kind="stable").drop_duplicates("id")
        kept = {k[0]: set(v[0]) for k, v in self.kept.iterator()} if self.kept.exists() else {}
        out = []
        for id_, seq in zip(whole["id"].tolist(), whole["seq"].tolist(), strict=True):
            if self.placed.containsKey((id_,)):
                continue  # it came before
            seq = seq or ""
            own = {seq[i : i + self.k] for i in range(len(seq) - self.k + 1)}
            sim, ref = max(((len(own & other), -r) for r, other in kept.items()), default=(0, 0))
            if sim < self.level:
                kept[id_] = own
                self.kept.updateValue((id_,), (sorted(own),))
                out.append((*key, id_, id_, 9999, 0.0, True))
            else:
                ref = -ref
                out.append((*key, id_, ref, sim, 1 - sim / len(own | kept[ref]), False))
            self.placed.updateValue((id_,), out[-1][2:4])
        if out:
            yield pd.DataFrame(out, columns=["grp", "id", "ref_id", "sim", "distance", "added"])

    def close(self) -> None:
        pass


def running_representatives(stream: DataFrame, k: int, level: int) -> DataFrame:
    """(grp, id, ref_id, sim, distance, added) of a stream (grp, id, seq): each sequence's nearest representative in its group so far.

    A sequence that shares fewer than level k-mers with each of them becomes a representative: its own row has sim 9999 and
    distance 0. Sequences of one batch go by id, batches as they come; an id that came before is left out; of equally near
    representatives the smallest id counts; null sequences have no k-mers. A group's state is its representatives and ids, and a
    task holds one group's representatives: groups are to be as fine as genera or species are.
    """
    schema = T.StructType([T.StructField("grp", stream.schema["grp"].dataType),
        *T.StructType.fromDDL("id long, ref_id long, sim long, distance double, added boolean").fields])
    return stream.groupBy("grp").transformWithStateInPandas(Representatives(k, level), schema, "Append", "None")


def represent(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, k: int, level: int,
    files_a_batch: int | None = None) -> StreamingQuery:
    """running_representatives() of the Parquet files (grp, id, seq) below source, appended to the table at target; restarts as append_once()."""
    reader = spark.readStream.schema(schema)
    reader = reader.option("maxFilesPerTrigger", files_a_batch) if files_a_batch else reader
    with rocks(spark):
        rows = running_representatives(reader.parquet(source).select("grp", "id", "seq"), k, level)
        return rows.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


cloudpickle.register_pickle_by_value(sys.modules[__name__])
