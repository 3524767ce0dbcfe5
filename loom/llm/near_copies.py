"""Near copies by the Jaccard similarity of whole word-shingle sets: multi-index hashing of SimHashes finds clusters, full sets decide."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loom.llm.common import attach, bit_filter, filter_bits, materialize, maybe
from loom.llm.components import components
from loom.llm.simhash import first_of_each, joined
from loom.llm.textnp import chunks, is_space, mix, range_hashes, spans

#: Words of a shingle, and the least similarity of near copies as a fraction.
SHINGLE, LEAST = 5, (4, 5)
#: SimHash segments for up to so many sets: (sets, segments, bits of each). Values that differ in one bit at most meet, so a pair
#: at similarity 0.8 (15 % of its bits differ) meets in no segment in 0.04 % of cases.
PLANS = ((1 << 20, 24, 16), (1 << 24, 32, 18), (1 << 63, 42, 20))
#: The first 64-bit words of the fingerprints that meet are compared in full; more different bits are no candidate.
WORDS, RADIUS = 3, 55
#: Sets of so few shingles have a second fingerprint, as a shingle more or less changes more of their bits.
SHORT = 8
#: A slot with more fingerprints, and with twice its share, is dealt into blocks.
SLOT = 4096
#: Sets of a cluster are compared in blocks of about so many, of about so many shingles.
BLOCK, BLOCK_SHINGLES = 512, 1 << 18
#: Shingles (their bits are counted in bytes), and pairs of fingerprints, that are worked on at once.
CHUNK, SOME = 255, 1 << 18
#: Values that so many fingerprints of a slot share have so many pivots, which are held against all before all pairs are.
CROWD, PIVOTS = 128, 8

def shingle_sets(data: np.ndarray, offs: np.ndarray, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of the distinct shingles, sorted: A-Z lower-cased, words between blanks; a short text is one shingle."""
    low = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    starts, ends, first = spans(~is_space(low), offs)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    word, words = range_hashes(low, starts, ends), np.diff(first)
    n = np.where(words >= shingle, words - shingle + 1, np.minimum(words, 1))
    doc = np.repeat(np.arange(len(words)), n)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + first[:-1][doc]
    h = range_hashes(word, at, np.minimum(at + shingle, first[1:][doc]))
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.concatenate(([True], (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])))
    return doc[new], h[new]


def _keys(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents that have shingles, where their sets begin, and a 64-bit hash of each set."""
    begin = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1]))[: len(doc)])
    with np.errstate(over="ignore"):
        return doc[begin], begin, mix(np.add.reduceat(mix(h ^ np.uint64(0x3C6EF372FE94F82B)), begin)) if len(begin) else h


def simhashes(h: np.ndarray, begin: np.ndarray, words: int, salt: int = 0) -> np.ndarray:
    """SimHashes of the sets that begin there: a row of 64-bit words for each; a bit is 1 if set in over half the shingles' hashes."""
    out, end = np.zeros((len(begin), words), np.uint64), np.concatenate((begin[1:], [len(h)]))
    with np.errstate(over="ignore"):
        seeds = mix(np.arange(1, words + 1, dtype=np.uint64) + np.uint64(salt * words))
    for d, (a, b) in enumerate(zip(begin.tolist(), end.tolist(), strict=True)):
        ones = 0
        for k in range(a, b, CHUNK):
            bits = mix(h[k : min(b, k + CHUNK), None] ^ seeds)
            ones = ones + np.add.reduce(np.unpackbits(bits.view(np.uint8), axis=1, bitorder="little"), axis=0, dtype=np.uint8).astype(np.int64)
        out[d] = np.packbits(2 * ones > b - a, bitorder="little").view(np.uint64)
    return out


def with_key(docs: DataFrame, text_col: str = "text", name: str = "key", words: int = 0) -> DataFrame:
    """docs and a long that is equal for equal shingle sets (0 for none); with words, also n (shingles) and simhash.

    simhash has that number of 64-bit words; for sets of at most SHORT shingles a second fingerprint follows.
    """

    def make(column: pa.Array) -> list[pa.Array]:
        key, size, prints = np.zeros(len(column), np.uint64), np.zeros(len(column), np.int32), [None] * len(column)
        for i, _, data, offs in chunks(column):
            doc, h = shingle_sets(data, offs)
            has, begin, found = _keys(doc, h)
            key[i + has], size[i + has] = found, np.diff(np.concatenate((begin, [len(doc)])))
            if words and len(begin):
                one = simhashes(h, begin, words)
                for d, v in zip((i + has).tolist(), one.view(np.int64), strict=True):
                    prints[d] = v
                few = np.flatnonzero(size[i + has] <= SHORT)
                two = simhashes(h, begin, words, 1)[few].view(np.int64) if len(few) else one[:0]
                for d, v in zip((i + has[few]).tolist(), two, strict=True):
                    prints[d] = np.concatenate((prints[d], v))
        return [pa.array(key.view(np.int64))] + ([pa.array(size), pa.array(prints, pa.list_(pa.int64()))] if words else [])

    more = [T.StructField("n", T.IntegerType()), T.StructField("simhash", T.ArrayType(T.LongType()))] if words else []
    return attach(docs, text_col, [T.StructField(name, T.LongType()), *more], make)


def plan(sets: int) -> tuple[int, int]:
    """Segments, and the bits of each: wider for more sets, so that a slot holds few fingerprints by chance."""
    return next((segments, bits) for most, segments, bits in PLANS if sets <= most)


def _slots(prints: np.ndarray, segments: int, width: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """(slot, rest) of each fingerprint, for each segment and each half of it: what the slot fixes, and the half that may differ."""
    bits = np.unpackbits(np.ascontiguousarray(prints).view(np.uint8), axis=1, bitorder="little")[:, : segments * width]
    half = width // 2
    value = (bits.reshape(len(prints), 2 * segments, half) << np.arange(half)).sum(axis=2, dtype=np.int64)
    other = value.reshape(-1, segments, 2)[:, :, ::-1].reshape(len(prints), -1)
    table = np.arange(2 * segments) + 2 * segments * salt
    return (table << half) + value, other


def _met(at: np.ndarray, own: np.ndarray, masks: list[int], some: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places in at, sorted, whose values differ in just one of masks and whose roots differ, about SOME at a time.

    own: value and root in one number, sorted alike. With some, only pairs with these places.
    """
    all_places = np.arange(len(at))
    for mask in masks:
        i = all_places[at ^ mask >= at] if some is None else some
        want = at[i] ^ mask
        same = own[i] + (want - at[i]) * len(at)
        a, z = np.searchsorted(own, same, "right"), np.searchsorted(at, want, "right")
        if mask or some is not None:  # else the pairs with lesser roots are those of the other place
            a, z, i = (np.concatenate(x) for x in ((np.searchsorted(at, want, "left"), a), (np.searchsorted(own, same, "left"), z), (i, i)))
        n = z - a
        upto = np.cumsum(n)
        for k in range(0, int(upto[-1]) if len(n) else 0, SOME):
            x, y = np.searchsorted(upto, k, "right"), np.searchsorted(upto, min(k + SOME, upto[-1]), "left") + 1
            part = np.arange(k, min(k + SOME, int(upto[-1])))
            row = np.searchsorted(upto[x:y], part, "right") + x
            yield i[row], a[row] + part - (upto - n)[row]


def _linked(rest: np.ndarray, fp: list[np.ndarray], root: np.ndarray, masks: list[int]) -> np.ndarray:
    """root, the least label of each place, after all pairs have been linked that differ by masks in rest and lie within RADIUS.

    Some places of each crowded value are held against all first: near copies are mostly linked by these, and pairs that are
    linked already are not listed.
    """
    changed = True
    for some_masks, pivots in ((masks, True), *(([m], False) for m in masks)):
        if changed:
            order = np.argsort(rest * len(rest) + root, kind="stable")
            at, own = rest[order], (rest * len(rest) + root)[order]
        some, changed = None, False
        if pivots:
            begin = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
            size = np.diff(np.concatenate((begin, [len(at)])))
            begin, size = begin[size >= CROWD], size[size >= CROWD]
            some = (begin[:, None] + size[:, None] * np.arange(PIVOTS) // PIVOTS).ravel()
        for i, j in _met(at, own, some_masks, some):
            i, j = order[i], order[j]
            apart = root[i] != root[j]
            i, j = i[apart], j[apart]
            near = sum(np.bitwise_count(w[i] ^ w[j]).astype(np.int16) for w in fp) <= RADIUS
            if near.any():
                root, changed = joined(root, i[near], j[near]), True
    return root


def candidates(nodes: DataFrame, segments: int, width: int) -> DataFrame:
    """Edges (x, y) that connect what pairs of close fingerprints connect. nodes: (key, simhash), keys distinct.

    Multi-index hashing: each segment of a fingerprint is a table, and values of it within one bit meet. Such values agree in
    one half of the segment; that half is the slot, in which the ball of radius one around the other half is looked up.
    What meets is compared over WORDS words. A slot with many more fingerprints than its share is dealt into blocks, and
    every two blocks meet in a cell of their own. A cell gives a forest from its least keys, not its pairs, so that the slots of a
    group of near copies mostly give the same edges; a cell of two blocks gives only the edges between what either connects.
    """
    spark, half = nodes.sparkSession, width // 2
    words = -(-segments * width // 64)

    def tables(batch: pa.RecordBatch) -> Iterator[tuple]:
        """(key, fingerprint, slots, rests) of the first fingerprints of a batch, then of the second ones."""
        key, prints = batch.column(0).to_numpy(), batch.column(1)
        values, size = prints.flatten().to_numpy(), np.diff(prints.offsets.to_numpy())
        start = np.cumsum(size) - size
        for salt in (0, 1):
            has = np.flatnonzero(size > salt * words)
            for some in np.array_split(has, len(has) // 4096 + 1):
                if len(some):
                    fp = values[start[some][:, None] + salt * words + np.arange(words)]
                    yield key[some], fp, *_slots(fp, segments, width, salt)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(4 * segments << half, np.int64)
        for batch in batches:
            for _, _, slot, _ in tables(batch):
                total += np.bincount(slot.ravel(), minlength=len(total))
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(total)), pa.array(total[total > 0])], names=["slot", "n"])

    most = max(SLOT, 2 * (nodes.count() >> half))
    counted = nodes.select("key", "simhash").mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    blocks = np.ones(4 * segments << half, np.int64)
    for r in counted.where(F.col("n") > most).collect():  # a number for a slot, of which there are few
        blocks[r.slot] = -(-r.n // most)
    dealt = spark.sparkContext.broadcast(blocks)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, fp, slot, rest in tables(batch):
                n = dealt.value[slot].ravel()
                at = np.repeat(np.arange(n.size), n)
                partner = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
                doc = at // slot.shape[1]
                own = (mix(key[doc].view(np.uint64)) % n[at].astype(np.uint64)).astype(np.int64)
                cell = np.minimum(own, partner) * n[at] + np.maximum(own, partner)
                cols = [slot.ravel()[at], cell, rest.ravel()[at], key[doc], *fp[doc, :WORDS].T.copy()]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=names)

    names = ["slot", "cell", "rest", "key", *[f"w{k}" for k in range(WORDS)]]
    schema = "slot long, cell long, rest long, key long, " + ", ".join(f"w{k} long" for k in range(WORDS))

    def close(slot: int, rest: np.ndarray, key: np.ndarray, fp: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        by = np.argsort(key)
        rest, key, fp = rest[by], key[by], [w[by] for w in fp]
        block = mix(key.view(np.uint64)) % np.uint64(dealt.value[slot])
        masks = ([] if slot % 2 else [0]) + [1 << b for b in range(half)]  # equal values meet in the other half's slot
        place = np.arange(len(key))
        own = place.copy()
        if (block != block[0]).any():
            for b in np.unique(block):
                some = np.flatnonzero(block == b)
                own[some] = some[_linked(rest[some], [w[some] for w in fp], place[: len(some)], masks)]
        root = _linked(rest, fp, own, masks)
        off = np.flatnonzero((own == place) & (root != place))  # what a block connects is in its own cell's forest
        return key[off], key[root[off]]

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            new = [c.to_numpy() for c in batch.columns]
            held = new if held is None else [np.concatenate(x) for x in zip(held, new, strict=True)]
            begin = np.flatnonzero(np.concatenate(([True], (held[0][1:] != held[0][:-1]) | (held[1][1:] != held[1][:-1]))))
            yield from found(held, begin[:-1], begin[1:])
            held = [c[begin[-1] :] for c in held]  # the last slot may go on
        if held is not None:
            yield from found(held, np.zeros(1, np.int64), np.array([len(held[0])]))

    def found(c: list[np.ndarray], begin: np.ndarray, end: np.ndarray) -> Iterator[pa.RecordBatch]:
        edges = [close(int(c[0][a]), c[2][a:b], c[3][a:b], [w[a:b].view(np.uint64) for w in c[4:]]) for a, b in zip(begin, end, strict=True) if b - a > 1]
        if edges:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(e)) for e in zip(*edges, strict=True)], names=["x", "y"])

    met = nodes.select("key", "simhash").mapInArrow(rows, schema).repartition("slot", "cell").sortWithinPartitions("slot", "cell")
    return _to_least(met.mapInArrow(verify, "x long, y long"))


def _to_least(edges: DataFrame) -> DataFrame:
    """Edges that connect what edges (x, y) do: x goes to its least y only, its other ys go to that one too, and repeats are one.

    An x may have an edge for each slot that it is in; its ys are few, and shared by those that meet there.
    """
    least = edges.withColumn("least", F.min("y").over(Window.partitionBy("x")))
    return least.select(F.when(F.col("y") == F.col("least"), F.col("x")).otherwise(F.col("y")).alias("x"), F.col("least").alias("y")).distinct()


def _forest(keys: np.ndarray, block: np.ndarray, sets: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (x, y) from least keys that connect what pairs of sets at LEAST or more connect.

    sets: all members, one set after the other. Of members of two blocks, what a block connects is left out: it is in its own forest.
    """
    n, doc, two = len(keys), np.repeat(np.arange(len(keys)), size), bool((block != block[0]).any())
    _, term, count = np.unique(sets, return_inverse=True, return_counts=True)
    posting, start = doc[np.argsort(term, kind="stable")], np.cumsum(count) - count
    off, root, own = np.concatenate(([0], np.cumsum(size))), np.arange(n), np.arange(n)
    up, down = LEAST

    def join(root: np.ndarray, a: int, near: np.ndarray) -> None:
        for r in np.unique(root[near]):
            root[root == r] = root[a]

    for a in range(n - 1):
        apart = root[a + 1 :] != root[a]
        if two:
            apart |= (own[a + 1 :] != own[a]) & (block[a + 1 :] == block[a])
        if not apart.any():
            continue
        t = term[off[a] : off[a + 1]]
        wide = count[t]
        common = np.bincount(posting[np.repeat(start[t] - (np.cumsum(wide) - wide), wide) + np.arange(wide.sum())], minlength=n)
        near = np.flatnonzero((up + down) * common >= up * (size + size[a]))
        near = near[near > a]
        join(root, a, near)
        if two:
            join(own, a, near[block[near] == block[a]])
    x, y = (_least(keys, r) for r in (own, root))
    first = (keys == x) & (x != y)
    return x[first], y[first]


def _least(keys: np.ndarray, root: np.ndarray) -> np.ndarray:
    """The least key among those of the same root, for each."""
    out = np.full(len(keys), np.iinfo(np.int64).max)
    np.minimum.at(out, root, keys)
    return out[root]


def links(docs: DataFrame, nodes: DataFrame, segments: int, width: int, text_col: str = "text") -> DataFrame:
    """Edges (x, y) between keys, with the components of all pairs at LEAST or more within a cluster.

    nodes: (key, n, simhash), keys distinct. What candidates() connects, over any number of steps, is a cluster; its sets are dealt
    into blocks by the hash of the key, and every two blocks meet in a row of their own, so that a large cluster is spread
    over tasks and no list of pairs is made. The sets are made again from the texts, only where a bit filter lets a key through. Repeated texts
    have one key, so they count once; sets without shingles are in no cluster; without clusters there are no edges.
    """
    cluster = materialize(components(materialize(candidates(nodes, segments, width))))
    member = materialize(nodes.select("key", "n").join(cluster.withColumnRenamed("node", "key"), "key"))
    dealt = member.groupBy("label").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    member = materialize(member.join(dealt, "label").select("key", "label", "blocks", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int").alias("block")))
    bits = filter_bits(member.count())
    held = docs.sparkSession.sparkContext.broadcast(bit_filter(member.select("key"), bits, False))

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offs in chunks(batch.column(0)):
                doc, h = shingle_sets(data, offs)
                _, begin, key = _keys(doc, h)
                parts = np.split(h.view(np.int64), begin[1:]) if len(begin) else []
                some = np.flatnonzero(maybe(held.value, key, bits))
                yield pa.RecordBatch.from_arrays([pa.array(key[some].view(np.int64)), pa.array([parts[k] for k in some], pa.list_(pa.int64()))],
                    names=["key", "shingles"])

    made = docs.select(text_col).mapInArrow(wanted, "key long, shingles array<long>").groupBy("key").agg(F.first("shingles").alias("shingles"))  # copies first
    sets = materialize(made.join(member.select("key").hint("merge"), "key"))  # a semi-join would be put below the grouping
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    met = member.join(sets, "key").withColumn("other", other).select("label", F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"), "key", "block", "shingles")
    met = met.groupBy("label", "i", "j").agg(F.collect_list(F.struct("key", "block", "shingles")).alias("sets")).select("sets")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            edges = [(np.zeros(0, np.int64),) * 2]
            for row in batch.column(0):
                key, block, shingles = row.values.flatten()
                size = np.diff(shingles.offsets.to_numpy())
                edges.append(_forest(key.to_numpy(), block.to_numpy(), shingles.flatten().to_numpy(), size))
            x, y = (np.concatenate(e) for e in zip(*edges, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], names=["x", "y"])

    return met.mapInArrow(verify, "x long, y long").distinct()


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns, that come first in their group of near copies: smallest id, null last.

    Near copies have a Jaccard similarity of five-word shingles of 0.8 or more over the whole texts; groups are their connected
    components. Texts without words, null ones too, are one group. Of rows of one id one stays, rows alike in all columns included. No
    column is changed, whatever its name; an empty table gives an empty one.
    """
    segments, width = plan(docs.count())
    stamped = with_key(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), words=-(-segments * width // 64))
    slim = materialize(stamped.select("id", "key", "n", "simhash"))
    nodes = materialize(slim.where("n > 0").groupBy("key").agg(F.first("n").alias("n"), F.first("simhash").alias("simhash")))
    label = materialize(components(materialize(links(docs, nodes, segments, width, text_col))).withColumnRenamed("node", "key"))
    first = slim.groupBy("key").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id")).alias("first"))  # exact copies, before any join
    found = first.select("first.id", "key").join(label, "key", "left").select("id", "key", F.coalesce("label", "key").alias("label"))
    return first_of_each(docs, slim.select("id", "key"), found, lambda d, name: with_key(d, text_col, name), id_col)
