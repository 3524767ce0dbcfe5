"""Substring dedup: suffix automata over reference shards of candidate passages tell which word windows stand twice."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loom.llm.common import attach, bit_filter, filter_bits, fresh, materialize, maybe, ship
from loom.llm.textnp import chunks, is_space, mix, range_hashes, spans

WINDOW, GRAM = 35, 8
#: Different passages that one automaton reads at most; the passages of an anchor with more are cut smaller and dealt anew.
MAX_PASSAGES = 256
#: Bytes of text that are worked on at a time (a longer text is worked on whole).
CHUNK = 1 << 18
#: False alarms that are broadcast at most (8 bytes each); more are taken out by a join.
MAX_BROADCAST = 1_000_000


class Words:
    """The words of a run of documents, with a hash and an anchor of every window.

    A window's anchor is the least hash of its word GRAM-grams, the leftmost where several are least, so equal windows have
    equal anchors at equal places. runs: maximal runs of windows of a document that share an anchor and its place.
    """

    def __init__(self, data: np.ndarray, offs: np.ndarray, window: int):
        self.data, self.window = data, window
        self.starts, self.ends, self.first = spans(~is_space(data), offs)
        words = np.diff(self.first)
        n = np.maximum(words - window + 1, 0)
        doc = np.repeat(np.arange(len(words)), n)
        self.at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + self.first[:-1][doc]  # first word of each window
        self.doc = doc
        if len(self.at):
            self.hashes = range_hashes(data, self.starts, self.ends)

    def window_hashes(self, which: np.ndarray) -> np.ndarray:
        return range_hashes(self.hashes, self.at[which], self.at[which] + self.window) if len(which) else np.zeros(0, np.uint64)

    def anchors(self, barred: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(hash, word) of the anchor of each window. barred: for each document a hash that its anchors may not have, unless
        a window has no other."""
        if not len(self.at):
            return np.zeros(0, np.uint64), self.at
        gram = min(GRAM, self.window)
        m = len(self.hashes) - gram + 1
        g = range_hashes(self.hashes, np.arange(m), np.arange(m) + gram)
        low = np.uint64((1 << 24) - 1)
        ranked = (g & ~low) | (np.arange(m).astype(np.uint64) & low)
        if barred is not None:
            doc = np.searchsorted(self.first, np.arange(m), "right") - 1
            ranked[g == barred[doc]] |= ~low
        size = self.window - gram + 1
        pad = -m % size
        rows = np.concatenate([ranked, np.full(pad, np.iinfo(np.uint64).max)]).reshape(-1, size)
        ahead = np.minimum.accumulate(rows, axis=1).ravel()
        behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(behind[self.at], ahead[self.at + size - 1])
        place = self.at + ((least - self.at.astype(np.uint64)) & low).astype(np.int64)
        return g[place], place


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where a run of equal keys begins."""
    n = len(keys[0])
    new = np.ones(n, bool)
    if n:
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(new)


class Automaton:
    """A generalised suffix automaton over weighted word sequences; occurrences[s]: weighted end places of state s."""

    def __init__(self, sequences: list[tuple[list, int]]):
        self.next: list[dict] = [{}]
        self.link, self.length, self.occurrences = [-1], [0], [0]
        for words, weight in sequences:
            last = 0
            for word in words:
                last = self._extend(last, word)
                self.occurrences[last] += weight
        for s in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            self.occurrences[self.link[s]] += self.occurrences[s]

    def _split(self, p: int, q: int, word: object) -> int:
        clone = len(self.next)
        self.next.append(self.next[q].copy())
        self.link.append(self.link[q])
        self.length.append(self.length[p] + 1)
        self.occurrences.append(0)
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def _extend(self, p: int, word: object) -> int:
        q = self.next[p].get(word)
        if q is not None:
            return q if self.length[q] == self.length[p] + 1 else self._split(p, q, word)
        new = len(self.next)
        self.next.append({})
        self.link.append(0)
        self.length.append(self.length[p] + 1)
        self.occurrences.append(0)
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, word)
        return new

    def unique_windows(self, words: list, window: int) -> list[int]:
        """Starts of the windows of words that occur once only: matching statistics, cut to the window's length."""
        out, state, matched = [], 0, 0
        for i, word in enumerate(words):
            while state and word not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            state = self.next[state].get(word, 0)
            matched = matched + 1 if state else 0
            while state and self.length[self.link[state]] >= window:
                state = self.link[state]
            matched = min(matched, window) if self.length[state] >= window else matched
            if i + 1 >= window and (matched < window or self.occurrences[state] < 2):
                out.append(i + 1 - window)
        return out


def _column(df: DataFrame, schema: str, make) -> DataFrame:
    """make(Words) gives the columns of schema; df has the text alone."""
    ship(df.sparkSession)
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offs in chunks(batch.column(0), CHUNK):
                got = make(data, offs)
                if len(got[0]):
                    yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in got], names=names)

    return df.mapInArrow(run, schema)


def _repeated_filter(spark, counted: DataFrame):
    """A broadcast bitmap of the values that counted (value, n) has twice and more, their number, and the bitmap's size."""
    n = counted.count()
    bits = filter_bits(n)
    return spark.sparkContext.broadcast(bit_filter(counted.select("value"), bits, repeated=False)), bits


def _cut(w: Words, which: np.ndarray, value: np.ndarray, place: np.ndarray) -> list:
    """Runs of the given windows under one anchor at one place: the anchor's hash and the words, joined by one blank."""
    begin = _runs(w.doc[which], place[which], which - np.arange(len(which)))
    end = np.concatenate((begin[1:], [len(which)])) if len(which) else begin
    a, b = w.at[which[begin]], w.at[which[end - 1]] + w.window if len(which) else begin
    blank = is_space(w.data)
    raw, keep = w.data.copy(), ~blank
    before = w.starts[w.starts > 0] - 1
    keep[before] = True
    raw[before[blank[before]]] = 32
    at = np.concatenate(([0], np.cumsum(keep)))
    whole = raw[keep].tobytes()
    return [value[which[begin]].view(np.int64), pa.array([whole[x:y] for x,
        y in zip(at[w.starts[a]].tolist(), at[w.ends[b - 1]].tolist(), strict=True)], pa.binary())]


def _as_text(passages: list[bytes]) -> pa.Array:
    return pa.array(passages, pa.binary()).cast(pa.string())


def window_hashes_of(passages: list[bytes], window: int) -> list[np.ndarray]:
    """The hashes of the windows of each passage, in order."""
    out = []
    for i, j, data, offs in chunks(_as_text(passages)):
        w = Words(data, offs, window)
        out += np.split(w.window_hashes(np.arange(len(w.at))), np.searchsorted(w.doc, np.arange(1, j - i)))
    return out


def _all_windows(window: int):
    """(words, twice): all windows of passages of which the count has told."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                h, twice = window_hashes_of(batch.column(0).to_pylist(), window), batch.column(1).to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(h).view(np.int64)), pa.array(np.repeat(twice, [len(x) for x in h]))],
                    names=["value", "twice"])

    return run


def settle(group: list[tuple[bytes, int]], window: int) -> tuple[np.ndarray, np.ndarray]:
    """The windows of an anchor's passages (words, count), and whether the automaton of all finds them twice."""
    if len(group) == 1:
        h = window_hashes_of([group[0][0]], window)[0]
        return h.view(np.int64), np.full(len(h), group[0][1] > 1)
    split = [(words.split(b" "), n) for words, n in group]
    automaton, twice = Automaton(split), []
    for words, n in split:
        own = np.ones(len(words) - window + 1, bool)
        if n == 1:
            own[automaton.unique_windows(words, window)] = False
        twice.append(own)
    h = np.concatenate(window_hashes_of([words for words, _ in group], window))
    h, at = np.unique(h, return_index=True)
    return h.view(np.int64), np.concatenate(twice)[at]


def _by_automata(window: int):
    """(anchor, words, n), sorted by anchor: the windows of each anchor's passages, told by its automaton."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, group = None, []
        for batch in batches:
            done = []
            for anchor, words, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if anchor != held and group:
                    done.append(settle(group, window))
                    group = []
                held = anchor
                group.append((words, n))
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([h for h, _ in done])), pa.array(np.concatenate([t for _, t in done]))],
                    names=["value", "twice"])
        if group:
            yield pa.RecordBatch.from_arrays(list(map(pa.array, settle(group, window))), names=["value", "twice"])

    return run


def _recut(window: int, pieces):
    """Passages (anchor, words, n) cut smaller; pieces(Words, anchors) gives the hash and the words of each piece, and its passage."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            anchor, n = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 2))
            for i, j, data, offs in chunks(_as_text(batch.column(1).to_pylist()), CHUNK):
                w = Words(data, offs, window)
                value, words, doc = pieces(w, anchor[i:j].view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(value), words, pa.array(n[i:j][doc])], names=["anchor", "words", "n"])

    return run


def _next_anchor(window: int):
    """Runs of windows that share the next anchor too; both make the new one."""

    def pieces(w: Words, anchor: np.ndarray) -> tuple:
        value, place = w.anchors(barred=anchor)
        both = mix(value ^ mix(anchor[w.doc] + np.uint64(1)))
        doc = w.doc[_runs(w.doc, place, np.zeros(len(place)))]
        return *_cut(w, np.arange(len(w.at)), both, place), doc

    return _recut(window, pieces)


def _single_windows(window: int):
    """Single windows, each its own anchor."""

    def pieces(w: Words, anchor: np.ndarray) -> tuple:
        every = np.arange(len(w.at))
        return *_cut(w, every, w.window_hashes(every), every), w.doc

    return _recut(window, pieces)


def remove_repeats(docs: DataFrame, text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """docs with n_words, n_removed and kept_text: every word that a repeated window covers is taken out.

    A window is `window` consecutive words (runs of anything but blanks, unchanged) of one text; it is repeated when its
    words stand anywhere else in the input, the same text included. kept_text has the other words joined by one space. Null
    text has no words; shorter texts keep all. All windows are judged on the input; all copies go, none stays; repeated rows
    are texts of their own, whose windows of window words and more all go. Columns of these names are replaced, all others kept; an empty table gives an empty result.

    1. Anchors (about one for 14 words) are counted by hash; a bitmap keeps those that stand twice.
    2. Runs of windows under such anchors become passages, grouped word for word with their counts, then dealt to reference
       shards by anchor: windows that could be equal meet in one shard. Where an anchor has several different passages, a
       suffix automaton of all of them, weighted by their counts, reads them again, and its matching statistics tell which
       windows stand once. A passage that is alone under its anchor needs none: its count tells. Bitmaps of the anchors
       route the passages, so that only those of several are shuffled again.
    3. An anchor with more than MAX_PASSAGES different passages is split: they are cut into runs of windows that share the
       next anchor as well, grouped and dealt anew; where these are still too many, into single windows, whose counts tell.
    4. The windows found twice make a bitmap; those found once that it lets through are kept as false alarms. Documents
       stream once more: windows that both bitmaps let through, less the false alarms, are removed.

    The automata are built in the tasks that own a shard and not broadcast whole: they grow with the repeated text.
    """
    spark = docs.sparkSession
    text = docs.select(F.col(text_col).alias("text"))
    signed = lambda x: x.view(np.int64)

    def anchors(data: np.ndarray, offs: np.ndarray) -> list:
        w = Words(data, offs, window)
        value, place = w.anchors()
        return [signed(value[_runs(w.doc, place)])]

    twice = materialize(_column(text, "value long", anchors).groupBy("value").agg(F.count("*").alias("n")).where("n > 1").select("value"))
    first, first_bits = _repeated_filter(spark, twice)

    def under(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows whose anchor may stand twice, and all anchors."""
        value, place = w.anchors()
        begin = _runs(w.doc, place)
        ok = maybe(first.value, value[begin], first_bits)
        return np.flatnonzero(np.repeat(ok, np.diff(np.concatenate((begin, [len(value)]))))), value, place

    def passages(data: np.ndarray, offs: np.ndarray) -> list:
        w = Words(data, offs, window)
        which, value, place = under(w)
        return _cut(w, which, value, place)

    first_level = _column(text, "anchor long, words binary", passages).groupBy("anchor", "words").agg(F.count("*").alias("n"))
    level, judged = materialize(first_level), []
    for cut in (_next_anchor, _single_windows):
        sizes = materialize(level.groupBy("anchor").agg(F.count("*").alias("passages")).where("passages > 1").select(F.col("anchor").alias("value"),
            "passages"))
        hot = sizes.where(F.col("passages") > MAX_PASSAGES)
        crowded = not hot.isEmpty()
        filters = [_repeated_filter(spark, sizes.where(F.col("passages") <= MAX_PASSAGES)), *([_repeated_filter(spark, hot)] if crowded else [])]

        def routed(way: int, filters=filters):
            """The rows that go one way: alone (0), to the automata (1), to be cut (2). All passages of an anchor go together."""

            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    h = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
                    ways = np.zeros(len(h), np.int64)
                    for k, (bitmap, bits) in enumerate(filters, 1):
                        ways[maybe(bitmap.value, h, bits)] = k
                    yield batch.filter(pa.array(ways == way))

            return run

        judged.append(level.mapInArrow(routed(0), level.schema).select("words", (F.col("n") > 1).alias("twice")).mapInArrow(_all_windows(window),
            "value long, twice boolean"))
        shards = level.mapInArrow(routed(1), level.schema).repartition("anchor").sortWithinPartitions("anchor")
        judged.append(shards.mapInArrow(_by_automata(window), "value long, twice boolean"))
        if not crowded:
            break
        smaller = level.mapInArrow(routed(2), level.schema).mapInArrow(cut(window), "anchor long, words binary, n long")
        level = materialize(smaller.groupBy("anchor", "words").agg(F.sum("n").alias("n")))
    else:
        judged.append(level.select("words", (F.col("n") > 1).alias("twice")).mapInArrow(_all_windows(window), "value long, twice boolean"))
    windows = judged[0]
    for more in judged[1:]:
        windows = windows.union(more)
    windows = materialize(windows)
    second, second_bits = _repeated_filter(spark, windows.where("twice").select("value"))

    def positive(w: Words) -> tuple[np.ndarray, np.ndarray]:
        which, _, _ = under(w)
        h = w.window_hashes(which)
        ok = maybe(second.value, h, second_bits)
        return which[ok], h[ok]

    def let_through(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(h[maybe(second.value, h.view(np.uint64), second_bits)])], names=["value"])

    false = materialize(windows.where("NOT twice").select("value").mapInArrow(let_through, "value long").distinct())
    known = false.count()
    alarms = spark.sparkContext.broadcast(np.sort(np.array([r.value for r in false.collect()], np.int64)) if known <= MAX_BROADCAST else np.zeros(0, np.int64))

    def drop(data: np.ndarray, offs: np.ndarray, lost: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Words, words removed and kept text of each document; lost: windows to spare, by document."""
        w = Words(data, offs, window)
        cover = np.zeros(len(w.starts) + 1, np.int64)
        if len(w.at):
            which, h = positive(w)
            if len(alarms.value):
                p = np.minimum(np.searchsorted(alarms.value, signed(h)), len(alarms.value) - 1)
                which, h = (x[alarms.value[p] != signed(h)] for x in (which, h))
            for doc, values in lost.items():
                spare = (w.doc[which] == doc) & np.isin(signed(h), values)
                which, h = which[~spare], h[~spare]
            cover[w.at[which]] += 1
            cover[w.at[which] + window] -= 1
        gone = np.cumsum(cover[:-1]) > 0
        n, removed = np.diff(w.first), np.diff(np.concatenate(([0], np.cumsum(gone)))[w.first])
        # the bytes of kept words, each with one blank behind it
        step = np.zeros(len(data) + 1, np.int64)
        step[w.starts[~gone]] += 1
        step[w.ends[~gone]] -= 1
        keep = np.cumsum(step)[:-1] > 0
        size = (w.ends - w.starts)[~gone] + 1
        out = np.full(int(size.sum()), 32, np.uint8)
        to = np.ones(len(out), bool)
        to[np.cumsum(size) - 1] = False
        out[to] = data[keep]
        kept = np.concatenate(([0], np.cumsum(np.where(gone, 0, w.ends - w.starts + 1))))[w.first]
        raw = out.tobytes()
        return n, removed, [raw[a : max(a, b - 1)] for a, b in zip(kept[:-1].tolist(), kept[1:].tolist(), strict=True)]

    fields = [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())]

    def make(column: pa.Array, lost: list | None = None) -> list[pa.Array]:
        n, gone, kept = [], [], [pa.array([], pa.string())]
        for i, j, data, offs in chunks(column, CHUNK):
            a, b, c = drop(data, offs, {d - i: np.array(lost[d]) for d in range(i, j) if lost[d]} if lost else {})
            n.append(a)
            gone.append(b)
            kept.append(pa.array(c, pa.binary()).cast(pa.string()))
        none = np.zeros(0, np.int64)
        return [pa.array(np.concatenate([none, *n])), pa.array(np.concatenate([none, *gone])), pa.concat_arrays(kept)]

    if known <= MAX_BROADCAST:
        return attach(docs, text_col, fields, make)
    return _with_join(docs, text_col, fields, make, positive, false, window)


def _with_join(docs: DataFrame, text_col: str, fields: list[T.StructField], make, positive, false: DataFrame, window: int) -> DataFrame:
    """As attach, with false alarms brought to their documents by a join: for more of them than may be broadcast."""
    own, spare = fresh(docs, "__row", "__lost")
    named = materialize(docs.withColumn(own, F.monotonically_increasing_id()))

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0).to_numpy(zero_copy_only=False)
            for i, _, data, offs in chunks(batch.column(1)):
                w = Words(data, offs, window)
                if len(w.at):
                    which, h = positive(w)
                    yield pa.RecordBatch.from_arrays([pa.array(rows[i + w.doc[which]]), pa.array(h.view(np.int64))], names=["row", "value"])

    lost = named.select(own, text_col).mapInArrow(values, "row long, value long").join(false,
        "value").groupBy(F.col("row").alias(own)).agg(F.collect_set("value").alias(spare))
    joined = named.join(lost, own, "left").drop(own)
    names = {f.name.lower() for f in fields}
    kept = [f for f in docs.schema.fields if f.name.lower() not in names]
    places, at = [i for i, f in enumerate(docs.schema.fields) if f.name.lower() not in names], docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = make(batch.column(at), batch.column(len(docs_columns)).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in places] + new, names=[f.name for f in kept] + [f.name for f in fields])

    docs_columns = list(docs.columns)
    return joined.mapInArrow(run, T.StructType(kept + fields))
