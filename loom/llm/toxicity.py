"""Toxicity: nearest labelled examples by exact TF-IDF cosine over a block-max inverted index."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loom.llm.common import attach, materialize
from loom.llm.textnp import chunks, hasher, is_space, mix, range_hashes, spans

#: Bounds of what is learned from: labelled rows read and examples in the index, of each label.
MAX_ROWS, MAX_EXAMPLES = 20_000, 6_000
#: A term is used when so many training documents have it and its log-likelihood ratio against the label, of documents and
#: of occurrences too (long documents have more of every word), exceeds twice the logarithm of the number of such terms,
#: about one false choice among all of them, and it is MIN_LIFT times as frequent under one label as under the other: in a
#: large sample the least difference passes a test of significance.
MIN_DOCUMENTS, MIN_LIFT = 4, 2
#: Minima of hashed word 4-grams that tell copies in the sample.
MARKS = 4
NEIGHBOURS, BLOCK, THRESHOLD = 10, 64, 0.3
#: Cosines count to this precision, so that ties don't depend on the order of sums.
PRECISION = 1e9
#: Queries that are searched at once, and vectors whose results a worker remembers.
QUERIES, REMEMBERED = 256, 20_000
#: Lengths of the word beginnings that are terms too, in bytes.
PREFIXES = (5, 6, 7, 8)


def training_row(id_col: str = "doc_id") -> Column:
    """Rows whose label may be learned from: crc32 of the id as text, modulo 4, is not 2."""
    return F.crc32(F.col(id_col).cast("string")) % 4 != 2


def occurrences(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, term) of every word (letters and non-ASCII bytes, A-Z lower-cased) and of its first bytes, hashed."""
    low = np.where((data >= 65) & (data <= 90), data + 32, data)
    starts, ends, first = spans((low >= 128) | ((low >= 97) & (low <= 122)), offs)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    doc, hashes = np.repeat(np.arange(len(offs) - 1), np.diff(first)), hasher(low)
    docs, terms = [doc], [hashes(starts, ends)]
    for n in PREFIXES:
        long = ends - starts > n
        docs.append(doc[long])
        terms.append(hashes(starts[long], starts[long] + n) ^ np.uint64(0x5555555555555555))
    return np.concatenate(docs), np.concatenate(terms)


def marks(column: pa.Array) -> pa.Array:
    """The least of each of MARKS hashes of a text's word 4-grams (a shorter text is one gram): near copies share most of them."""
    seeds = mix(np.arange(1, 2 * MARKS + 1, dtype=np.uint64)).reshape(2, MARKS)
    out = np.zeros((len(column), MARKS), np.uint64)
    for i, _, data, offs in chunks(column):
        starts, ends, first = spans(~is_space(data), offs)
        words = np.diff(first)
        n = np.where(words >= 4, words - 3, np.minimum(words, 1))
        doc, at = _expand(first[:-1], first[:-1] + n)
        if not len(at):
            continue
        h = range_hashes(range_hashes(data, starts, ends), at, np.minimum(at + 4, first[1:][doc]))
        has = np.flatnonzero(n)
        with np.errstate(over="ignore"):
            for k in range(MARKS):
                out[i + has, k] = np.minimum.reduceat((h ^ seeds[0, k]) * (seeds[1, k] | np.uint64(1)), (np.cumsum(n) - n)[has])
    return pa.array(list(out.view(np.int64)), pa.list_(pa.int64()))


def counted(doc: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, term, count), sorted."""
    order = np.lexsort((term, doc))
    doc, term = doc[order], term[order]
    new = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (term[1:] != term[:-1])))[: len(doc)])
    return doc[new], term[new], np.diff(np.concatenate((new, [len(doc)])))


@dataclass(frozen=True)
class Index:
    """Examples stand in blocks of BLOCK, alike ones together. Term t has the entries first[t] to first[t + 1]: an entry is a
    block, the largest weight of t in it, and the postings begin[e] to begin[e + 1] (places of examples and their weights)."""

    vocabulary: np.ndarray
    idf: np.ndarray
    ids: list
    labels: np.ndarray
    first: np.ndarray
    block: np.ndarray
    most: np.ndarray
    begin: np.ndarray
    place: np.ndarray
    weight: np.ndarray
    votes: np.ndarray
    chances: np.ndarray
    prior: float


@dataclass(frozen=True)
class Vectors:
    """Unit vectors one after the other: vector i has the terms begin[i] to begin[i + 1]."""

    begin: np.ndarray
    at: np.ndarray
    w: np.ndarray


def weigh(index: Index, begin: np.ndarray, at: np.ndarray, count: np.ndarray) -> Vectors:
    """Unit-length TF-IDF vectors of the counts of terms of the vocabulary; no vector is empty."""
    w = (1 + np.log(count)) * index.idf[at]
    norm = np.sqrt(np.add.reduceat(w * w, begin[:-1])) if len(w) else w
    return Vectors(begin, at, w / np.repeat(norm, np.diff(begin)) if len(w) else w)


def _expand(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ranges of whole numbers: which range, and the number, of all numbers in them."""
    n = end - begin
    which = np.repeat(np.arange(len(n)), n)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(n) - n - begin, n)


def nearest(index: Index, vectors: Vectors, k: int = NEIGHBOURS, leave: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(place, cosine), each (vectors, k), of the k examples of the largest cosine above 0, exactly; -1 where there are fewer.

    Of equal cosines (to PRECISION) those that come first count. A block's bound is the sum of the vector's weights times the
    block's maxima. Blocks are visited by falling bound, two, then four, eight and so on at once, until none is left whose
    bound exceeds the k-th cosine so far, or equals it at places before that one's. Only the postings of visited blocks are
    read. leave: an example each vector must not find.
    """
    queries, blocks = len(vectors.begin) - 1, -(-len(index.labels) // BLOCK)
    places, cosines = np.full((queries, k), -1), np.zeros((queries, k))
    if not queries or not blocks:
        return places, cosines
    query = np.repeat(np.arange(queries), np.diff(vectors.begin))
    term, entry = _expand(index.first[vectors.at], index.first[vectors.at + 1])
    cell = query[term] * blocks + index.block[entry]
    bound = np.bincount(cell, vectors.w[term] * index.most[entry], minlength=queries * blocks).reshape(queries, blocks)
    bound = np.floor(bound * PRECISION + 0.5 + 1e-4).astype(np.int64)
    order = np.argsort(-bound, axis=1, kind="stable")
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.broadcast_to(np.arange(blocks), order.shape), axis=1)
    best_q = best_s = best_p = np.zeros(0, np.int64)
    least, last = np.zeros(queries, np.int64), np.full(queries, -1)  # the k-th cosine and its place
    wanted, done, wide = bound > 0, 0, 2
    while wanted.any():
        visit = wanted & (rank < done + wide)
        done, wide = done + wide, 2 * wide
        if not visit.any():
            continue
        wanted &= ~visit
        pair = np.cumsum(visit.ravel()) - 1
        inside = visit.ravel()[cell]
        own, p = _expand(index.begin[entry[inside]], index.begin[entry[inside] + 1])
        slot = pair[cell[inside]][own] * BLOCK + index.place[p] % BLOCK
        score = np.bincount(slot, vectors.w[term[inside]][own] * index.weight[p], minlength=int(visit.sum()) * BLOCK)
        score = np.floor(score * PRECISION + 0.5).astype(np.int64)
        hit = np.flatnonzero(score > 0)
        of = np.flatnonzero(visit.ravel())[hit // BLOCK]
        q, place = of // blocks, of % blocks * BLOCK + hit % BLOCK
        if leave is not None:
            q, place, hit = (x[place != leave[q]] for x in (q, place, hit))
        keep = score[hit] >= least[q]
        best_q, best_s, best_p = np.concatenate((best_q, q[keep])), np.concatenate((best_s, score[hit][keep])), np.concatenate((best_p, place[keep]))
        o = np.lexsort((best_p, -best_s, best_q))
        best_q, best_s, best_p = best_q[o], best_s[o], best_p[o]
        n = np.bincount(best_q, minlength=queries)
        nth = np.arange(len(best_q)) - np.repeat(np.cumsum(n) - n, n)
        best_q, best_s, best_p, nth = (x[nth < k] for x in (best_q, best_s, best_p, nth))
        full = nth == k - 1
        least[best_q[full]], last[best_q[full]] = best_s[full], best_p[full]
        wanted &= (bound > least[:, None]) | ((bound == least[:, None]) & (np.arange(blocks) * BLOCK < last[:, None]))
    n = np.bincount(best_q, minlength=queries)
    nth = np.arange(len(best_q)) - np.repeat(np.cumsum(n) - n, n)
    places[best_q, nth], cosines[best_q, nth] = best_p, np.minimum(best_s / PRECISION, 1.0)
    return places, cosines


def vote(index: Index, places: np.ndarray, cosines: np.ndarray) -> np.ndarray:
    """The share of label 1 among the neighbours of each vector, each weighing the inverse of its distance; nan without any."""
    w = np.where(places >= 0, 1 / (1.05 - cosines), 0.0)
    total = w.sum(1)
    return np.divide((w * np.where(places >= 0, index.labels[places], 0.0)).sum(1), total, out=np.full(len(total), np.nan), where=total > 0)


def _calibrate(votes: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression (pool adjacent violators) of the labels on the votes."""
    order = np.argsort(votes, kind="stable")
    pools: list[list[float]] = []
    for v, y, w in zip(votes[order].tolist(), labels[order].tolist(), weights[order].tolist(), strict=True):
        pools.append([v, v, y * w, w])
        while len(pools) > 1 and (pools[-2][2] / pools[-2][3] >= pools[-1][2] / pools[-1][3] or pools[-2][1] == pools[-1][0]):
            last = pools.pop()
            pools[-1] = [pools[-1][0], last[1], pools[-1][2] + last[2], pools[-1][3] + last[3]]
    x = [p for pool in pools for p in (pool[0], pool[1])]
    y = [(pool[2] + 0.01) / (pool[3] + 0.02) for pool in pools for _ in range(2)]
    return np.array(x or [0.0]), np.array(y or [0.0])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_rows: int = MAX_ROWS,
        max_examples: int = MAX_EXAMPLES) -> Index:
    """Chooses the vocabulary from up to max_rows labelled training rows of each label and indexes up to max_examples of each.

    Rows without a label or id are not learned from. A label that stands several times for an id counts once, as 1 if any is
    1. The sample is drawn from ids and labels alone, by the hash of the id; its ids are broadcast, at most 2 * max_rows, so
    that no text is shuffled. Of copies and near copies in the sample (rows that share one of their marks) one is learned
    from: words of a text that is copied a thousand times would pass any test of significance. The vocabulary is every term that stands in MIN_DOCUMENTS of them, passes
    both tests of significance and is MIN_LIFT times as frequent under one label; other words count neither in products nor in
    norms. Document frequencies are counted over all of docs, which takes no label. Chances are weighed by how often each label stands among all labelled training
    rows. Null texts count as empty; extra columns are not read; without labels every text scores the prior.
    """
    marked = materialize(labels.select(F.col(id_col).alias("id"),
        F.col(label_col).cast("int").alias("label")).where("id IS NOT NULL AND label IN (0, 1)").where(training_row("id")).groupBy("id").agg(F.max("label").alias("label")))
    n = {r.label: r.n for r in marked.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n0, n1 = n.get(0, 0), n.get(1, 0)
    by_hash = F.xxhash64(F.col("id").cast("string"), F.lit("toxicity sample"))
    chosen_ids = marked.where("label = 0").orderBy(by_hash, "id").limit(max_rows).union(marked.where("label = 1").orderBy(by_hash, "id").limit(max_rows))
    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen_ids), "id").select("id", "label", "text")
    rows = materialize(attach(found.withColumn("row", F.monotonically_increasing_id()), "text", [T.StructField("marks", T.ArrayType(T.LongType()))],
        lambda c: [marks(c)]))
    order = F.struct(by_hash.alias("h"), "row")
    first = rows.select(F.posexplode("marks").alias("k", "mark"), order.alias("order")).groupBy("k", "mark").agg(F.min("order").alias("order"))
    alone = first.groupBy(F.col("order.row").alias("row")).agg(F.count("*").alias("n")).where(F.col("n") == MARKS).select("row")
    rows = materialize(rows.join(alone, "row", "left_semi").select("id", "label", "text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = batch.column(1).to_numpy(zero_copy_only=False)
            for i, j, data, offs in chunks(batch.column(2), 1 << 20):
                doc, term, times = counted(*occurrences(data, offs))
                one = y[i:j][doc] == 1
                value, place = np.unique(term, return_inverse=True)
                sums = [np.bincount(place[at], what[at], len(value)).astype(np.int64) for what in (np.ones(len(times)), times) for at in (~one, one)]
                yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), *map(pa.array, sums)],
                    names=["term", "zeros", "ones", "zero_times", "one_times"])

    have = {r.label: r.n for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    m0, m1 = have.get(0, 0), have.get(1, 0)
    weight = {0: n0 / max(1, m0), 1: n1 / max(1, m1)}
    sums = ("zeros", "ones", "zero_times", "one_times")
    counts = rows.mapInArrow(count, "term long, zeros long, ones long, zero_times long, one_times long").groupBy("term").agg(*[F.sum(c).alias(c) for c in sums])
    counts = materialize(counts)
    t0, t1 = counts.agg(F.sum("zero_times"), F.sum("one_times")).first()
    both = F.col("ones") + F.col("zeros")
    tested = counts.where((both >= MIN_DOCUMENTS) & (both < m0 + m1))
    limit = float(2 * np.log(max(1, tested.count())))
    lift = F.greatest("zero_times", F.lit(0.5)) * F.lit(t1 or 1) / (F.greatest("one_times", F.lit(0.5)) * F.lit(t0 or 1))
    passes = ((lift >= MIN_LIFT) | (lift <= 1 / MIN_LIFT)) & (_ratio(F.col("zeros"), F.col("ones"), m0, m1) > limit) & (_ratio(F.col("zero_times"),
        F.col("one_times"), t0, t1) > limit) if m0 and m1 and t0 and t1 else F.lit(False)
    chosen = tested.where(passes).select("term").collect()
    vocabulary = np.array(sorted(r.term & (1 << 64) - 1 for r in chosen), np.uint64)
    idf = _frequencies(docs.select(F.col(text_col).alias("text")), vocabulary)
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out_at, out_c = [[]] * len(batch), [[]] * len(batch)
            for d, t, c in _known(held.value, batch.column(2)):
                out_at[d], out_c[d] = t, c
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out_at, pa.list_(pa.int64())),
                pa.array(out_c, pa.list_(pa.int64()))], names=["id", "label", "at", "n"])

    kinds = [rows.schema["id"], rows.schema["label"], T.StructField("at", T.ArrayType(T.LongType())), T.StructField("n", T.ArrayType(T.LongType()))]
    vector = materialize(rows.mapInArrow(vectors, T.StructType(kinds)))
    blank = {r.label: r.n * weight[r.label] for r in vector.where(F.size("at") == 0).groupBy("label").agg(F.count("*").alias("n")).collect()}
    prior = (blank.get(1, 0) + 0.5 * n1 / max(1, n0 + n1)) / (blank.get(0, 0) + blank.get(1, 0) + 0.5)
    examples = [r for y in (0, 1) for r in vector.where((F.size("at") > 0) & (F.col("label") == y)).orderBy(by_hash, "id").limit(max_examples).collect()]
    return build_index(vocabulary, idf, examples, prior, {y: max(1.0, n.get(y, 0) - blank.get(y, 0)) for y in (0, 1)})


def _ratio(a: Column, b: Column, total_a: int, total_b: int) -> Column:
    """Twice the log-likelihood ratio of a of total_a and b of total_b against one common rate."""
    share = (a + b) / F.lit(float(total_a + total_b))
    part = lambda seen, expected: F.when(seen > 0, 2 * seen * F.log(seen / expected)).otherwise(0.0)
    return part(a, share * total_a) + part(b, share * total_b) + part(total_a - a, (1 - share) * total_a) + part(total_b - b, (1 - share) * total_b)


def _known(vocabulary: np.ndarray, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row, vocabulary places, counts) of each text that has terms of the vocabulary.

    A bitmap of their low bits spares most look-ups.
    """
    if not len(vocabulary):
        return
    low = np.uint64((1 << 20) - 1)
    some = np.zeros(1 << 20, bool)
    some[(vocabulary & low).astype(np.int64)] = True
    for i, _, data, offs in chunks(column):
        doc, term = occurrences(data, offs)
        near = some[(term & low).astype(np.int64)]
        doc, term = doc[near], term[near]
        at = np.minimum(np.searchsorted(vocabulary, term), len(vocabulary) - 1)
        known = vocabulary[at] == term
        doc, at, count = counted(doc[known], at[known])
        cut = np.flatnonzero(np.diff(doc)) + 1
        for d, t, c in zip(np.split(doc, cut), np.split(at, cut), np.split(count, cut), strict=True):
            if len(d):
                yield i + int(d[0]), t, c


def _frequencies(texts: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """The inverse document frequency of each term, over all texts: each task folds its rows into one count a term."""
    held = texts.sparkSession.sparkContext.broadcast(vocabulary)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, rows = np.zeros(len(held.value), np.int64), 0
        for batch in batches:
            rows += len(batch)
            for _, at, _ in _known(held.value, batch.column(0)):
                n[at] += 1
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(([-1], some))), pa.array(np.concatenate(([rows], n[some])))], names=["at", "n"])

    found, total = np.zeros(len(vocabulary)), 0
    if len(vocabulary):
        for r in texts.mapInArrow(fold, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
            if r.at < 0:
                total = r.n
            else:
                found[r.at] = r.n
    return np.log((1 + total) / (1 + found)) + 1


def build_index(vocabulary: np.ndarray, idf: np.ndarray, examples: list, prior: float, population: dict[int, float]) -> Index:
    """The index of examples (id, label, at, n: terms and counts) and the calibration of its votes.

    Each example votes without itself; isotonic regression of the labels on these votes, weighed to the population of each
    label, gives the chances.
    """
    none = np.zeros(0, np.int64)
    blank = Index(vocabulary, idf, [], np.zeros(0), np.zeros(len(vocabulary) + 1, np.int64), none, np.zeros(0), np.zeros(1, np.int64), none,
        np.zeros(0), np.zeros(1), np.zeros(1), prior)
    if not examples:
        return blank
    strongest = lambda r: r.at[int(np.argmax((1 + np.log(r.n)) * idf[r.at]))]
    examples = sorted(examples, key=lambda r: (strongest(r), tuple(r.at), tuple(r.n), str(r.id)))
    labels = np.array([r.label for r in examples], float)
    vectors = weigh(blank, np.concatenate(([0], np.cumsum([len(r.at) for r in examples]))), np.concatenate([r.at for r in examples]),
        np.concatenate([r.n for r in examples]))
    place = np.repeat(np.arange(len(examples)), np.diff(vectors.begin))
    order = np.lexsort((place, vectors.at))
    term, place, w = vectors.at[order], place[order], vectors.w[order]
    entry = np.flatnonzero(np.concatenate(([True], (term[1:] != term[:-1]) | (place[1:] // BLOCK != place[:-1] // BLOCK))))
    first = np.searchsorted(term[entry], np.arange(len(vocabulary) + 1))
    index = replace(blank, ids=[r.id for r in examples], labels=labels, first=first, block=place[entry] // BLOCK, most=np.maximum.reduceat(w, entry),
        begin=np.concatenate((entry, [len(place)])), place=place, weight=w)
    votes = np.concatenate([vote(index, *nearest(index, part, leave=np.arange(i, i + len(part.begin) - 1))) for i, part in _parts(vectors)])
    some = ~np.isnan(votes)
    truth = labels[some]
    have = {y: max(1, int((truth == y).sum())) for y in (0, 1)}
    x, y = _calibrate(votes[some], truth, np.where(truth == 1, population[1] / have[1], population[0] / have[0]))
    return replace(index, votes=x, chances=y)


def _parts(vectors: Vectors) -> Iterator[tuple[int, Vectors]]:
    """The vectors in runs of QUERIES, each with the number of its first."""
    for i in range(0, len(vectors.begin) - 1, QUERIES):
        begin = vectors.begin[i : i + QUERIES + 1]
        yield i, Vectors(begin - begin[0], vectors.at[begin[0] : begin[-1]], vectors.w[begin[0] : begin[-1]])


def score(docs: DataFrame, index: Index, text_col: str = "text") -> DataFrame:
    """docs with toxicity (0 to 1) and evidence (up to three examples: id, cosine, label); columns of these names are replaced.

    Every whole text is a query; label, language, source and id play no part. A text without a term of the vocabulary, an
    empty and a null one score the share of label 1 among training rows without one, with no evidence. Equal texts score
    alike; equal vectors are searched once. An empty table gives an empty result.
    """
    held = docs.sparkSession.sparkContext.broadcast(index)
    kind = pa.list_(pa.struct([("id", pa.string()), ("cosine", pa.float64()), ("label", pa.int32())]))
    known: dict[bytes, tuple[float, list[dict]]] = {}

    def search(index: Index, fresh: dict[bytes, tuple[np.ndarray, np.ndarray]]) -> None:
        if not fresh:
            return
        at, count = [x for x, _ in fresh.values()], [x for _, x in fresh.values()]
        vectors, keys = weigh(index, np.concatenate(([0], np.cumsum([len(x) for x in at]))), np.concatenate(at), np.concatenate(count)), iter(fresh)
        for _, part in _parts(vectors):
            places, cosines = nearest(index, part)
            votes = vote(index, places, cosines)
            chance = np.where(np.isnan(votes), index.prior, np.interp(votes, index.votes, index.chances))
            for c, ps, cs in zip(chance.tolist(), places[:, :3].tolist(), cosines[:, :3].tolist(), strict=True):
                known[next(keys)] = c, [{"id": str(index.ids[p]), "cosine": s, "label": int(index.labels[p])} for p, s in zip(ps, cs, strict=True) if p >= 0]

    def make(column: pa.Array) -> list[pa.Array]:
        index = held.value
        if len(known) > REMEMBERED:
            known.clear()
        keys: list[bytes | None] = [None] * len(column)
        fresh: dict[bytes, tuple[np.ndarray, np.ndarray]] = {}
        for d, at, count in _known(index.vocabulary, column):
            keys[d] = key = at.tobytes() + count.tobytes()
            if key not in known:
                fresh[key] = at, count
        search(index, fresh)
        found = [(index.prior, []) if key is None else known[key] for key in keys]
        return [pa.array([c for c, _ in found], pa.float64()), pa.array([e for _, e in found], kind)]

    fields = [T.StructField("toxicity", T.DoubleType()),
        T.StructField("evidence", T.ArrayType(T.StructType([T.StructField("id", T.StringType()), T.StructField("cosine", T.DoubleType()),
        T.StructField("label", T.IntegerType())])))]
    return attach(docs, text_col, fields, make)
