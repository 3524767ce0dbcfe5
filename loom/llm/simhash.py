"""SimHash near-dedup: multi-index hashing over fingerprint segments, then connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loom.llm.common import attach, fresh, materialize
from loom.llm.components import components
from loom.llm.textnp import chunks, is_space, spans

SHINGLE, SEED, RADIUS = 4, 42, 4
#: Shingles that are worked on at once.
SHINGLES = 1 << 16
#: Fingerprints of one bucket are compared in blocks of about so many.
BLOCK = 512


def fingerprints(column: pa.Array, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """64-bit SimHash of each text: A-Z lower-cased, words between blanks, word shingles (repeats count), XXH64."""
    out = np.zeros(len(column), np.uint64)
    digest = xxhash.xxh64_intdigest
    for i, j, data, offs in chunks(column):
        data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
        blank = is_space(data)
        starts, ends, first = spans(~blank, offs)
        if not len(starts):
            continue
        before = starts[starts > 0] - 1
        keep = ~blank
        keep[before] = True
        data[before[blank[before]]] = 32
        place = np.concatenate(([0], np.cumsum(keep)))
        text, starts, ends = data[keep].tobytes(), place[starts], place[ends]
        words = np.diff(first)
        n = np.where(words >= shingle, words - shingle + 1, np.minimum(words, 1))
        doc = np.repeat(np.arange(j - i), n)
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + first[:-1][doc]
        to = np.minimum(at + shingle, first[1:][doc]) - 1
        a, b, total = starts[at], ends[to], np.zeros((j - i, 64), np.int64)
        for k in range(0, len(at), SHINGLES):
            some = slice(k, k + SHINGLES)
            h = np.fromiter((digest(text[x:y], seed) for x, y in zip(a[some].tolist(), b[some].tolist(), strict=True)), np.uint64, len(a[some]))
            own = np.flatnonzero(np.diff(doc[some], prepend=-1))
            bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            total[doc[some][own]] += np.add.reduceat(bits, own, axis=0, dtype=np.int64)
        has = np.flatnonzero(n)
        out[i + has] = np.packbits(total[has] * 2 > n[has, None], axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def with_fingerprint(docs: DataFrame, text_col: str = "text", name: str = "simhash") -> DataFrame:
    """docs and a long column with the fingerprint's 64 bits; null and blank texts have fingerprint 0."""
    return attach(docs, text_col, [T.StructField(name, T.LongType())], lambda c: [pa.array(fingerprints(c).view(np.int64))])


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _segments(n: int, radius: int) -> list[tuple[int, int, int]]:
    """(shift, width, radius) of each segment: about log2(n) bits wide, so that a table slot holds few fingerprints.

    With radius = m * r + a, two fingerprints within radius differ by at most r in one of the first a + 1 segments, or by at
    most r - 1 in one of the others.
    """
    m = min(4, max(2, 3 if n < 1 << 24 else 2))
    base, a = divmod(radius, m)
    widths = [64 // m + (i < 64 % m) for i in range(m)]
    out = [(sum(widths[:i]), w, base if i <= a else base - 1) for i, w in enumerate(widths)]
    return [x for x in out if x[2] >= 0]


def joined(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Least labels after links (i, j) have joined what root, the least label of each place, had apart."""
    a, b, root = root[i], root[j], root.copy()
    while True:  # least label over links, then over labels
        new = root.copy()
        np.minimum.at(new, a, root[b])
        np.minimum.at(new, b, root[a])
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _same_value(left: pa.Array, right: pa.Array, own: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what lies within radius across (or, where own, within) the two fingerprint lists of each row."""
    lists = []
    for c in (left, right):
        c = c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c
        offs = c.offsets.to_numpy().astype(np.int64)
        lists.append((c.values.to_numpy(zero_copy_only=False).view(np.uint64), offs[:-1], np.diff(offs)))
    (va, oa, na), (vb, ob, nb) = lists
    xs, ys = [], []
    small = na * nb <= 4096
    rows = np.flatnonzero(small)
    for part in np.array_split(rows, max(1, int((na * nb)[rows].sum() >> 20))):
        n = (na * nb)[part]
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        wide = np.repeat(nb[part], n)
        a, b = va[np.repeat(oa[part], n) + k // wide], vb[np.repeat(ob[part], n) + k % wide]
        near = (a != b) & (np.bitwise_count(a ^ b) <= radius) & ((a < b) | ~np.repeat(own[part], n))
        xs.append(a[near])
        ys.append(b[near])
    for r in np.flatnonzero(~small):
        a, b = va[oa[r] : oa[r] + na[r]], vb[ob[r] : ob[r] + nb[r]]
        i, j = np.nonzero(np.bitwise_count(a[:, None] ^ b[None, :]) <= radius)
        value = np.unique(np.concatenate([a, b]))
        i, j = np.searchsorted(value, a[i]), np.searchsorted(value, b[j])
        root = joined(np.arange(len(value)), i, j)
        off = root != np.arange(len(value))
        xs.append(value[off])
        ys.append(value[root[off]])
    return np.concatenate(xs) if xs else np.zeros(0, np.uint64), np.concatenate(ys) if ys else np.zeros(0, np.uint64)


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (x, y) between distinct fingerprints (column fp: long) with the same components as all pairs within radius.

    Every segment value is a table slot. A slot enumerates the small Hamming ball around its own value, meets the slots that
    exist (a join on unique keys, whatever a slot holds), and slots in blocks of about BLOCK fingerprints are then compared in
    full. A slot that holds many near copies becomes many block pairs spread over tasks, each of which emits a forest of at
    most 2 * BLOCK edges.
    """
    parts = _segments(fps.count(), radius)
    value = lambda shift, width: F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1))
    rows = fps.select("fp", F.explode(F.array(*[F.struct(F.lit(i).alias("seg"), value(s, w).alias("val")) for i,
        (s, w, _) in enumerate(parts)])).alias("e")).select("fp", "e.*")
    slots = materialize(rows.groupBy("seg", "val").agg(F.count("*").alias("n")).withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")))
    large = materialize(slots.where("blocks > 1").select("seg", "val", "blocks"))
    block = F.when(F.col("blocks") > 1, F.pmod(F.xxhash64("fp"), F.col("blocks"))).otherwise(0).cast("int")
    held = materialize(rows.join(large, ["seg", "val"], "left").select("seg", "val", block.alias("block"), "fp").repartition("seg", "val",
        "block").groupBy("seg", "val", "block").agg(F.collect_list("fp").alias("fps")))

    ball = F.array().cast("array<bigint>")
    for i, (_, width, r) in enumerate(parts):
        masks = [sum(1 << b for b in bits) for k in range(1, r + 1) for bits in combinations(range(width), k)]
        ball = F.when(F.col("seg") == i, F.array(*[F.lit(x).cast("long") for x in masks]).cast("array<bigint>")).otherwise(ball)
    ball = F.filter(F.transform(ball, lambda m: F.col("val").bitwiseXOR(m)), lambda v: v > F.col("val"))
    met = slots.select("seg", "val", "blocks", F.explode(ball).alias("val2")).join(slots.select("seg", F.col("val").alias("val2"),
        F.col("blocks").alias("blocks2")), ["seg", "val2"])
    met = met.select("seg", "val", "blocks", "val2", "blocks2").union(slots.where("n > 1").select("seg", "val", "blocks", "val", "blocks"))
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    met = met.withColumn("block", F.explode(upto("blocks"))).withColumn("block2", F.explode(upto("blocks2"))).where("val <> val2 OR block <= block2")
    pairs = met.select("seg", "val", "block", "val2", "block2").join(held.withColumnRenamed("fps", "a"), ["seg", "val", "block"])
    pairs = pairs.join(held.select("seg", F.col("val").alias("val2"), F.col("block").alias("block2"), F.col("fps").alias("b")), ["seg", "val2", "block2"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = _same_value(batch.column(0), batch.column(1), batch.column(2).to_numpy(zero_copy_only=False), radius)
            yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.array(y.view(np.int64))], names=["x", "y"])

    own = (F.col("val") == F.col("val2")) & (F.col("block") == F.col("block2"))
    return pairs.select("a", "b", own.alias("own")).mapInArrow(verify, "x long, y long").distinct()


def near_components(stamped: DataFrame, id_col: str, fp_col: str, radius: int = RADIUS) -> DataFrame:
    """(fp, component_id) for every fingerprint of stamped: component_id is the smallest id that links reach (null if all are)."""
    fps = materialize(stamped.groupBy(F.col(fp_col).alias("fp")).agg(F.min(id_col).alias("first")))
    label = components(materialize(links(fps.select("fp"), radius)))
    linked = fps.join(label.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("label", "fp").alias("label"))
    linked = materialize(linked)
    least = materialize(linked.groupBy("label").agg(F.min("first").alias("component_id")))
    return materialize(linked.join(least, "label").select("fp", "component_id", "label"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row per row of docs: id, fingerprint (16 hex digits), component_id.

    Null, empty and blank texts have fingerprint zero and link like any other; a text of fewer words than a shingle is one
    shingle. Null ids never name a component; where all ids of one are null, component_id is. Other columns are not read.
    """
    stamped = materialize(with_fingerprint(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))).select("id", "simhash"))
    found = near_components(stamped, "id", "simhash", radius)
    return stamped.join(found.withColumnRenamed("fp", "simhash"), "simhash").select(F.col("id").alias(id_col),
        as_hex(F.col("simhash")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """The rows of docs, all columns, that come first in their component: smallest id, null last; one row even among repeats.

    Ids and fingerprints are written out, texts are not; the texts of the chosen ids are then fetched by a join of the same
    kind at every size. Rows whose id is null or stands several times are told apart by their fingerprints, which are made
    again for those rows only. Null texts have fingerprint zero, as empty ones; an empty table gives an empty one; no column is
    changed, whatever its name.
    """
    slim = materialize(with_fingerprint(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))).select("id", "simhash"))
    found = near_components(slim, "id", "simhash", radius)
    slim = slim.withColumnRenamed("simhash", "key")
    return first_of_each(docs, slim, slim.join(found.select(F.col("fp").alias("key"), "label"), "key"), lambda d,
        name: with_fingerprint(d, text_col, name), id_col)


def first_of_each(docs: DataFrame, slim: DataFrame, found: DataFrame, stamp: Callable[[DataFrame, str], DataFrame], id_col: str) -> DataFrame:
    """The rows of docs that come first under their label. slim: (id, key); found: (id, key, label); stamp() makes the key again.

    Of rows with the same id and key, the first by the hashes of all columns stays.
    """
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key"))
    repeated = slim.groupBy("id").agg(F.count("*").alias("n")).where("n > 1 OR id IS NULL").select(F.col("id").alias("odd_id"), F.lit(True).alias("odd"))
    chosen = found.groupBy("label").agg(first.alias("first")).select("first.id", "first.key")
    chosen = materialize(chosen.join(repeated, F.col("id").eqNullSafe(F.col("odd_id")), "left").select("id", "key",
        F.coalesce("odd", F.lit(False)).alias("odd")))
    own_id, own_key, key, rank, row = fresh(docs, "__id", "__fp", "__key", "__rank", "__row")
    plain = chosen.where("NOT odd").select(F.col("id").alias(own_id))
    out = docs.join(plain.hint("merge"), F.col(id_col) == F.col(own_id), "left_semi")
    odd = chosen.where("odd").select(F.col("id").alias(own_id), F.col("key").alias(own_key))
    if odd.isEmpty():
        return out
    some = docs.join(odd.select(own_id).distinct(), F.col(id_col).eqNullSafe(F.col(own_id)), "left_semi")
    told = stamp(some, key).join(odd, F.col(id_col).eqNullSafe(F.col(own_id)) & (F.col(key) == F.col(own_key)), "left_semi")
    told = materialize(told.withColumn(row, F.monotonically_increasing_id()).withColumn(rank,
        F.struct(*[F.xxhash64(F.to_json(F.struct(*docs.columns)), F.lit(k)).alias(f"h{k}") for k in range(2)], row)))
    one = told.groupBy(id_col, key).agg(F.min(rank).alias(rank)).select(F.col(rank)[row].alias(own_id))
    return out.unionByName(told.join(one, F.col(row) == F.col(own_id), "left_semi").select(*docs.columns))
