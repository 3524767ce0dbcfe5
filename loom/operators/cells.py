"""Similar pairs of sequences without a shuffle of k-mers or of pairs: stripes of sequences meet in cells, and a task counts a cell's pairs.

A join on k-mers shuffles a row for every k-mer that two sequences share, which grows with the square of the table. Here the texts are
packed, dealt into stripes, and each pair of stripes is a cell that gets both: what is shuffled are the texts, once for each stripe,
and stripes are as many as give CELLS cells a core. A task goes through a cell block by block, holds the counts of a few sequences at a time, and gives out
what is asked for: pairs, or their sums, or the best. Every pair is still counted, so seconds grow with the square.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loom.functions.grams import Block, Cell
from loom.plans.shared import written

#: Sequences of a packed row, such rows in a stripe of a small table, and letters of a block; cells for each core of the session.
BUCKET, ROWS, LETTERS, CELLS = 1024, 3, 1 << 22, 8


@dataclass(frozen=True)
class Packed:
    """Sequences in packed rows (bucket, grp, ids, owner, lengths, texts, size, chosen, marks), in about so many buckets.

    Only sequences of one grp meet. chosen lists the ids that count, where it isn't null, and marks a number for each of them.
    """

    rows: DataFrame
    buckets: int
    k: int

    @property
    def id_type(self) -> T.DataType:
        return self.rows.schema["ids"].dataType.elementType

    def sequences(self) -> DataFrame:
        """(id)."""
        return self.rows.select(F.explode("ids").alias("id"))

    def only(self, ids: DataFrame, buckets: int | None = None) -> Packed:
        """The same rows, of which only ids count: (id), with `bucket` where packed() was given it, and `mark` if they have one."""
        at = F.col("bucket") if "bucket" in ids.columns else _bucket(self.buckets)
        mark = F.col("mark").cast("int") if "mark" in ids.columns else F.lit(0)
        own = ids.select(at.alias("bucket"), F.struct("id", mark.alias("mark")).alias("c")).groupBy("bucket").agg(F.collect_list("c").alias("c"))
        own = own.select("bucket", F.col("c.id").alias("chosen"), F.col("c.mark").alias("marks"))
        return Packed(self.rows.drop("chosen", "marks").join(own, "bucket"), buckets or self.buckets, self.k)


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int")


def packed(seqs: DataFrame, k: int, group: str | None = None) -> Packed:
    """seqs (id, seq) packed and written. Rows without a k-mer, an id or, where they are asked for, a group meet nothing and are
    left out; rows of one id are one sequence.

    A column `bucket` says which sequences share a packed row; else their hash does.
    """
    given = "bucket" in seqs.columns
    own = seqs.select("id", "seq", (F.lit(None).cast("string") if group is None else F.col(group)).alias("grp"), *["bucket"] * given)
    own = own.where(F.col("id").isNotNull() & (F.length("seq") >= k) & (F.lit(group is None) | F.col("grp").isNotNull()))
    most = F.max("bucket") if given else F.lit(0)
    count, size, last = own.agg(F.count("*"), F.sum(F.length("seq").cast("long")), most).first()
    buckets = (last or 0) + 1 if given else max(1, ceil(count / BUCKET), ceil((size or 0) / (BUCKET << 9)))
    own = own if given else own.withColumn("bucket", _bucket(buckets))
    dealt = own.withColumn("bucket", F.col("bucket").cast("int")).repartition("bucket").sortWithinPartitions("bucket", "grp", "id")
    kind = seqs.schema["id"].dataType
    schema = _schema(bucket=T.IntegerType(), grp=T.StringType(), ids=T.ArrayType(kind), owner=T.ArrayType(T.IntegerType()),
        lengths=T.ArrayType(T.IntegerType()), texts=T.BinaryType(), size=T.LongType())
    rows = written(dealt.mapInArrow(_pack, schema))
    return Packed(rows.withColumns({"chosen": F.lit(None).cast(T.ArrayType(kind)), "marks": F.lit(None).cast("array<int>")}), buckets, k)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, rows in _runs(batches, ["bucket", "grp"]):
        ids = rows["id"].combine_chunks().dictionary_encode()
        found = rows["seq"].to_pylist()
        text = "".join(found).encode()
        yield pa.RecordBatch.from_pydict({
            "bucket": rows["bucket"].combine_chunks()[:1], "grp": rows["grp"].combine_chunks()[:1],
            "ids": _list(ids.dictionary), "owner": _list(ids.indices.cast(pa.int32())),
            "lengths": _list(pa.array([len(s) for s in found], pa.int32())),
            "texts": pa.array([pa.compress(text, "zstd", asbytes=True)], pa.binary()), "size": pa.array([len(text)], pa.int64()),
        })


def _list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """The rows of each run of equal keys."""
    now, held = None, []
    for batch in batches:
        found = list(zip(*[batch.column(batch.schema.get_field_index(c)).to_pylist() for c in keys], strict=True))
        first = 0
        for i, key in enumerate(found):
            if key != now:
                if i > first:
                    held.append(batch.slice(first, i - first))
                if held:
                    yield now, pa.Table.from_batches(held)
                now, held, first = key, [], i
        if len(found) > first:
            held.append(batch.slice(first))
    if held:
        yield now, pa.Table.from_batches(held)


@dataclass(frozen=True)
class Met:
    """Two blocks that meet, or one with itself, ids ascending; grp: their group; marks: those of b's ids; finer: by a second length of k-mers."""

    ids_a: pa.Array
    ids_b: pa.Array
    cell: Cell
    same: bool
    grp: str | None
    marks: np.ndarray
    finer: Cell | None = None
    ranks: tuple[np.ndarray, np.ndarray] = field(init=False)

    def __post_init__(self) -> None:
        ids = self.ids_a if self.same else pa.concat_arrays([self.ids_a, self.ids_b])
        rank = np.empty(len(ids), np.int64)
        rank[pc.sort_indices(ids).to_numpy()] = np.arange(len(ids))
        object.__setattr__(self, "ranks", (rank[: len(self.ids_a)], rank[len(ids) - len(self.ids_b) :]))

    def pairs(self, least: int = 1) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(i, j, sim) of the pairs that share `least` k-mers or more, each once."""
        for first, counts in self.cell.rows():
            i, j = np.nonzero(counts >= least)
            sim = counts[i, j]
            i += first
            if self.same:
                i, j, sim = (x[i < j] for x in (i, j, sim))
            yield i, j, sim

    def distance(self, i: np.ndarray, j: np.ndarray, sim: np.ndarray) -> np.ndarray:
        return 1.0 - sim / (self.cell.sizes_a[i] + self.cell.sizes_b[j] - sim)

    def distances(self) -> Iterator[tuple[int, list[np.ndarray]]]:
        """(first, distances by k and by the finer k): for some sequences of a, from first on, to all of b; of a sequence to itself 1."""
        both = [self.cell] if self.finer is None else [self.cell, self.finer]
        for parts in zip(*[c.rows() for c in both], strict=True):
            first, out = parts[0][0], []
            for c, (_, counts) in zip(both, parts, strict=True):
                union = c.sizes_a[first : first + len(counts), None] + c.sizes_b[None, :] - counts
                d = 1.0 - counts / np.maximum(union, 1)
                if self.same:
                    d[np.arange(len(d)), first + np.arange(len(d))] = 1.0
                out.append(d)
            yield first, out

    def ordered(self, i: np.ndarray, j: np.ndarray) -> tuple[pa.Array, pa.Array]:
        """The smaller and the larger id of each pair."""
        a, b = self.ids_a.take(pa.array(i)), self.ids_b.take(pa.array(j))
        turned = pa.array(self.ranks[0][i] > self.ranks[1][j])
        return pc.if_else(turned, b, a), pc.if_else(turned, a, b)


Each = Callable[[Met], Iterator[dict[str, pa.Array]]]


def met(a: Packed, b: Packed | None, each: Each, schema: T.StructType, finer: int | None = None) -> DataFrame:
    """What `each` gives for the blocks of a and b, or of a with itself, that meet: every two blocks once. finer: a second, larger k."""
    cores = a.rows.sparkSession.sparkContext.defaultParallelism
    n_a, n_b = (min(ceil((CELLS * cores * (2 if b is None else 1)) ** 0.5), ceil(p.buckets / ROWS)) for p in (a, b or a))
    first = a.rows.withColumn("at", F.col("bucket") % n_a)
    if b is None:
        low = first.select(F.col("at").alias("x"), F.explode(F.sequence("at", F.lit(n_a - 1))).alias("y"), F.lit(0).alias("side"), "*")
        high = first.where("at > 0").select(F.explode(F.sequence(F.lit(0), F.col("at") - 1)).alias("x"), F.col("at").alias("y"), F.lit(1).alias("side"), "*")
    else:
        second = b.rows.withColumn("at", F.col("bucket") % n_b)
        low = first.select(F.col("at").alias("x"), F.explode(F.sequence(F.lit(0), F.lit(n_b - 1))).alias("y"), F.lit(0).alias("side"), "*")
        high = second.select(F.explode(F.sequence(F.lit(0), F.lit(n_a - 1))).alias("x"), F.col("at").alias("y"), F.lit(1).alias("side"), "*")
    keys, k, alone = ["x", "y", "grp"], a.k, b is None
    cells = n_a * (n_a + 1) // 2 if alone else n_a * n_b
    dealt = low.unionByName(high).drop("at").repartition(cells, "x", "y").sortWithinPartitions(*keys, "side")
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (x, y, grp), rows in _runs(batches, keys):
            same = alone and x == y
            left, right = (_blocks(rows.filter(pc.equal(rows["side"], side))) for side in (0, 1))
            for i, one in enumerate(left):
                for other in [None, *left[i + 1 :]] if same else right:
                    meeting = _meeting(one, other, k, grp, finer)
                    if meeting:
                        for found in each(meeting):
                            yield pa.RecordBatch.from_pydict({c: found[c] for c in names})
                    del meeting

    return dealt.mapInArrow(run, schema)


def _blocks(rows: pa.Table) -> list[list[dict]]:
    """Packed rows in blocks of about LETTERS letters."""
    out, size = [], LETTERS
    for batch in rows.select(["ids", "owner", "lengths", "texts", "size", "chosen", "marks"]).to_batches():
        for i in range(batch.num_rows):
            one = {c: batch.column(c)[i] for c in batch.schema.names}
            if size + one["size"].as_py() > LETTERS:
                out.append([])
                size = 0
            out[-1].append(one)
            size += one["size"].as_py()
    return out


def _read(rows: list[dict]) -> tuple[pa.Array, Block, np.ndarray]:
    """(ids ascending, their block, their marks) of packed rows."""
    ids, owner, lengths, texts, marks = [], [], [], [], []
    before = 0
    for r in rows:
        own, of, size = r["ids"].values, r["owner"].values.to_numpy(), r["lengths"].values.to_numpy()
        text = pa.decompress(r["texts"].as_py(), r["size"].as_py(), "zstd", asbytes=True).decode()
        points, mark = np.frombuffer(text.encode("utf-32-le"), np.uint32), np.zeros(len(own), np.int32)
        if r["chosen"].is_valid:
            at = pc.fill_null(pc.index_in(own, value_set=r["chosen"].values), -1).to_numpy()
            counts = at >= 0
            points, new = points[np.repeat(counts[of], size)], np.cumsum(counts) - 1
            size, of = size[counts[of]], new[of[counts[of]]]
            own, mark = own.filter(pa.array(counts)), r["marks"].values.to_numpy()[at[counts]]
        ids.append(own)
        owner.append(of + before)
        lengths.append(size)
        texts.append(points)
        marks.append(mark)
        before += len(own)
    ids = pa.concat_arrays(ids)
    order = pc.sort_indices(ids)
    place = np.empty(len(ids), np.int64)
    place[order.to_numpy()] = np.arange(len(ids))
    own = Block(np.concatenate(texts), np.concatenate(lengths).astype(np.int64), place[np.concatenate(owner)].astype(np.uint32), len(ids))
    return ids.take(order), own, np.concatenate(marks)[order.to_numpy()]


def _meeting(one: list[dict], other: list[dict] | None, k: int, grp: str | None, finer: int | None) -> Met | None:
    """Nothing where a block is empty."""
    ids_a, a, marks = _read(one)
    ids_b, b, marks = (ids_a, None, marks) if other is None else _read(other)
    if not len(ids_a) or not len(ids_b):
        return None
    return Met(ids_a, ids_b, Cell(a, b, k), other is None, grp, marks, Cell(a, b, finer) if finer else None)


# --- what cells give ---------------------------------------------------------------------------------------------------


def pair_distances(seqs: Packed, least: int = 1, most: float = 1.0) -> DataFrame:
    """(id1, id2, sim, distance) of pairs id1 < id2 that share `least` k-mers or more, up to the distance `most`."""

    def each(m: Met) -> Iterator[dict[str, pa.Array]]:
        for i, j, sim in m.pairs(least):
            distance = m.distance(i, j, sim)
            if most < 1:
                near = distance <= most
                i, j, sim, distance = i[near], j[near], sim[near], distance[near]
            id1, id2 = m.ordered(i, j)
            yield {"id1": id1, "id2": id2, "sim": pa.array(sim), "distance": pa.array(distance)}

    return met(seqs, None, each, _schema(id1=seqs.id_type, id2=seqs.id_type, sim=T.LongType(), distance=T.DoubleType()))


def resembling(queries: Packed, references: Packed, least: int = 1, most: float = 1.0) -> DataFrame:
    """(id) of the queries that share `least` k-mers or more with a reference at the distance `most` or less; an id may stand several times."""

    def each(m: Met) -> Iterator[dict[str, pa.Array]]:
        for first, counts in m.cell.rows():
            near = counts >= least
            if most < 1:
                i, j = np.nonzero(near)
                near[i, j] = m.distance(i + first, j, counts[i, j]) <= most
            yield {"id": m.ids_a.take(pa.array(first + np.flatnonzero(near.any(axis=1))))}

    return met(queries, references, each, _schema(id=queries.id_type))


def best_by_level(queries: Packed, references: Packed, levels: tuple[int, ...]) -> DataFrame:
    """(id, level, ref_id, sim, distance, represented): the nearest reference at each level: of those whose mark is the level or less."""

    def each(m: Met) -> Iterator[dict[str, pa.Array]]:
        at_level = {n: np.flatnonzero(m.marks <= n) for n in levels}
        for first, counts in m.cell.rows():
            for n, known in at_level.items():
                if len(known):
                    at = known[counts[:, known].argmax(axis=1)] if len(known) < counts.shape[1] else counts.argmax(axis=1)
                    own = np.arange(len(counts))
                    sim = counts[own, at]
                    own, at, sim = (x[sim > 0] for x in (own, at, sim))
                    own += first
                    yield {"id": m.ids_a.take(pa.array(own)), "level": pa.array(np.full(len(own), n, np.int32)), "ref_id": m.ids_b.take(pa.array(at)),
                        "sim": pa.array(sim), "distance": pa.array(m.distance(own, at, sim))}

    schema = _schema(id=queries.id_type, level=T.IntegerType(), ref_id=references.id_type, sim=T.LongType(), distance=T.DoubleType())
    part = met(queries, references, each, schema)
    top = part.groupBy("id", "level").agg(F.min_by(F.struct("ref_id", "sim", "distance"), F.struct(-F.col("sim"), "ref_id")).alias("b"))
    return top.select("id", "level", "b.*", (F.col("b.sim") >= F.col("level")).alias("represented"))


def pair_sums(seqs: Packed) -> DataFrame:
    """(near, s, ss, d, dd): the number of pairs with a common k-mer, sums of their sim and 1 - distance, and of the squares; partial, some rows."""

    def each(m: Met) -> Iterator[dict[str, pa.Array]]:
        total = np.zeros(3, np.int64), np.zeros(2)
        for i, j, sim in m.pairs():
            u = 1 - m.distance(i, j, sim)
            total[0][:] += (len(sim), sim.sum(), (sim * sim).sum())
            total[1][:] += (u.sum(), (u * u).sum())
        yield {c: pa.array([v]) for c, v in zip(("near", "s", "ss", "d", "dd"), (*total[0].tolist(), *total[1].tolist()), strict=True)}

    return met(seqs, None, each, _schema(near=T.LongType(), s=T.LongType(), ss=T.LongType(), d=T.DoubleType(), dd=T.DoubleType()))


def end_sums(seqs: Packed) -> DataFrame:
    """(id, u, uu, least): of each sequence with a near one, the sums of 1 - distance and of its square over its pairs, and the least distance."""

    def each(m: Met) -> Iterator[dict[str, pa.Array]]:
        ends = [(ids, np.zeros(len(ids)), np.zeros(len(ids)), np.ones(len(ids))) for ids in ([m.ids_a] if m.same else [m.ids_a, m.ids_b])]
        for i, j, sim in m.pairs():
            u = 1 - m.distance(i, j, sim)
            for (_, sums, squares, least), at in ((ends[0], i), (ends[-1], j)):
                sums += np.bincount(at, u, len(sums))
                squares += np.bincount(at, u * u, len(sums))
                np.minimum.at(least, at, 1 - u)
        for ids, sums, squares, least in ends:
            yield {"id": ids, "u": pa.array(sums), "uu": pa.array(squares), "least": pa.array(least)}

    part = met(seqs, None, each, _schema(id=seqs.id_type, u=T.DoubleType(), uu=T.DoubleType(), least=T.DoubleType()))
    return part.groupBy("id").agg(F.sum("u").alias("u"), F.sum("uu").alias("uu"), F.min("least").alias("least")).where("u > 0")


def error_sums(seqs: Packed, finer: int) -> DataFrame:
    """(id, d, dd): of each sequence, the sums over all others of the difference of the distances by k and by the finer k, and of its square."""

    def each(m: Met) -> Iterator[dict[str, pa.Array]]:
        mine, theirs = np.zeros((2, len(m.ids_a))), np.zeros((2, len(m.ids_b)))
        for first, (coarse, fine) in m.distances():
            d = np.abs(fine - coarse)
            for n, x in enumerate((d, d * d)):
                mine[n, first : first + len(x)] = x.sum(axis=1)
                theirs[n] += x.sum(axis=0)
        for ids, sums in [(m.ids_a, mine)] if m.same else [(m.ids_a, mine), (m.ids_b, theirs)]:
            yield {"id": ids, "d": pa.array(sums[0]), "dd": pa.array(sums[1])}

    part = met(seqs, None, each, _schema(id=seqs.id_type, d=T.DoubleType(), dd=T.DoubleType()), finer)
    return part.groupBy("id").agg(F.sum("d").alias("d"), F.sum("dd").alias("dd"))


def least_distance(seqs: Packed) -> DataFrame:
    """(id, grp, distance): the least distance of each sequence to another of its group; nothing where it shares no k-mer with any."""

    def each(m: Met) -> Iterator[dict[str, pa.Array]]:
        mine, theirs = np.ones(len(m.ids_a)), np.ones(len(m.ids_b))
        for first, (d,) in m.distances():
            mine[first : first + len(d)] = d.min(axis=1)
            np.minimum(theirs, d.min(axis=0), out=theirs)
        for ids, least in [(m.ids_a, mine)] if m.same else [(m.ids_a, mine), (m.ids_b, theirs)]:
            yield {"id": ids, "grp": pa.array([m.grp] * len(ids), pa.string()), "distance": pa.array(least)}

    part = met(seqs, None, each, _schema(id=seqs.id_type, grp=T.StringType(), distance=T.DoubleType()))
    return part.where("distance < 1").groupBy("id", "grp").agg(F.min("distance").alias("distance"))


def best(queries: Packed, references: Packed, by_distance: bool = False) -> DataFrame:
    """(id, ref_id, sim, distance): each query's nearest reference by sim, or by distance; of equal ones that with the smallest id."""

    def each(m: Met) -> Iterator[dict[str, pa.Array]]:
        for first, counts in m.cell.rows():
            if by_distance:
                sizes = m.cell.sizes_a[first : first + len(counts), None] + m.cell.sizes_b[None, :]
                at = np.where(counts > 0, 1.0 - counts / (sizes - counts), 2.0).argmin(axis=1)
            else:
                at = counts.argmax(axis=1)
            own = np.arange(len(counts))
            sim = counts[own, at]
            own, at, sim = (x[sim > 0] for x in (own, at, sim))
            own += first
            yield {"id": m.ids_a.take(pa.array(own)), "ref_id": m.ids_b.take(pa.array(at)), "sim": pa.array(sim), "distance": pa.array(m.distance(own, at, sim))}

    part = met(queries, references, each, _schema(id=queries.id_type, ref_id=references.id_type, sim=T.LongType(), distance=T.DoubleType()))
    order = F.struct("distance", "ref_id") if by_distance else F.struct(-F.col("sim"), "ref_id")
    top = part.groupBy("id").agg(F.min_by(F.struct("ref_id", "sim", "distance"), order).alias("b"))
    return top.select("id", "b.*")


def _schema(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])
