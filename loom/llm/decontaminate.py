"""Benchmark decontamination by spaced seeds: fixed masks, a join on hashes, verification along the diagonal."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loom.llm.common import attach, fresh
from loom.llm.textnp import chunks, mix, range_hashes, spans

#: Token positions that count (1) and that may differ (0). Each has six that count; between them they meet every overlap of
#: 13 tokens and more of which four in five agree (tests/llm/test_decontaminate.py goes through all patterns).
MASKS = ("111111", "1111011", "110111011", "1011110001", "11001101001", "111000000111", "11101011")
MIN_TOKENS, SIMILARITY = 13, 0.8
#: Items of fewer tokens must stand in the document exactly.
WHOLE = 6
#: Benchmark tokens that one broadcast index holds at most (one item more, if it is longer); larger sets go in several passes.
INDEX_TOKENS = 1_000_000


def tokens(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens (runs of ASCII letters, digits and non-ASCII bytes, A-Z lower-cased), and where documents begin."""
    low = np.where((data >= 65) & (data <= 90), data + 32, data)
    inside = (low >= 128) | ((low >= 97) & (low <= 122)) | ((low >= 48) & (low <= 57))
    starts, ends, first = spans(inside, offs)
    return (range_hashes(low, starts, ends) if len(starts) else np.zeros(0, np.uint64)), first


def seeds(h: np.ndarray, mask: str) -> np.ndarray:
    """The hash of the counting positions of each window of token hashes."""
    n = len(h) - len(mask) + 1
    out = np.zeros(max(0, n), np.uint64)
    if n > 0:
        with np.errstate(over="ignore"):
            for j in (j for j, c in enumerate(mask) if c == "1"):
                out = out * np.uint64(0x9E3779B97F4A7C15) + h[j : j + n]
        out = mix(out)
    return out


def least_equal(length: int, similarity: float) -> int:
    """Tokens that must agree of a stretch of so many."""
    return length if length < WHOLE else ceil(similarity * length - 1e-9)


def item_masks(length: int, similarity: float) -> list[str]:
    """Masks over a whole short item. With e tokens that may differ, of e + 1 parts of its inner tokens one has none of them."""
    free = length - least_equal(length, similarity)
    if not free:
        return ["1" * length]
    cuts = [1 + (length - 2) * i // (free + 1) for i in range(free + 2)]
    return ["1" + "".join("1" if a <= j < b else "0" for j in range(1, length - 1)) + "1" for a, b in zip(cuts, cuts[1:])]


@dataclass(frozen=True)
class Seeds:
    """The seeds of one mask, sorted; where they begin; which begin a run of equal seeds; a bitmap of their low bits.

    before: the seed one place before each, in the same item and also indexed (0 where there is none).
    """

    mask: str
    value: np.ndarray
    place: np.ndarray
    begins: np.ndarray
    before: np.ndarray
    near: np.ndarray


@dataclass(frozen=True)
class Index:
    """The items' ids, where each begins, their tokens, and the seeds of each mask."""

    items: list[int | None]
    first: np.ndarray
    tokens: np.ndarray
    seeds: list[Seeds]
    min_tokens: int
    similarity: float


_BITS = 22
#: Hits that are worked on at once.
_HITS = 1 << 20


def build_index(items: list[tuple[int | None, str]], min_tokens: int = MIN_TOKENS, similarity: float = SIMILARITY) -> Index:
    """Items of min_tokens tokens and more have seeds of MASKS at every place, shorter ones those of item_masks at their first.

    Null and empty texts have none.
    """
    own = [np.zeros(0, np.uint64)]
    for _, text in items:
        raw = np.frombuffer((text or "").encode(), np.uint8)
        own.append(tokens(raw, np.array([0, len(raw)]))[0])
    size = np.array([len(h) for h in own[1:]], np.int64)
    first, flat, kept = np.concatenate(([0], np.cumsum(size))).astype(np.int64), np.concatenate(own), []

    def keep(mask: str, at: np.ndarray) -> None:
        s = seeds(flat, mask)[at]
        before, follows = np.zeros(len(at), np.uint64), np.diff(at) == 1
        follows &= np.searchsorted(first, at[1:], "right") == np.searchsorted(first, at[:-1], "right")
        before[1:] = np.where(follows, s[:-1], 0)
        run = np.concatenate(([False], follows & (s[1:] == s[:-1])))[: len(at)]
        order, bits = np.argsort(s, kind="stable"), np.zeros(1 << _BITS, bool)
        bits[(s & np.uint64((1 << _BITS) - 1)).astype(np.int64)] = True
        if len(at):
            kept.append(Seeds(mask, s[order], at[order], ~run[order], before[order], bits))

    for mask in MASKS:
        item = np.repeat(np.arange(len(size)), size)
        place = np.arange(len(flat))
        keep(mask, place[(size[item] >= min_tokens) & (place + len(mask) <= first[item + 1])])
    for length in sorted({int(n) for n in size if 0 < n < min_tokens}):
        for mask in item_masks(length, similarity):
            keep(mask, first[:-1][size == length])
    return Index([i for i, _ in items], first, flat, kept, min_tokens, similarity)


def _longest(same: np.ndarray, similarity: float) -> tuple[int, int, int]:
    """(from, to, equal) of the longest stretch that begins and ends with equal tokens and of which the given part is equal."""
    at = np.flatnonzero(same)
    if not len(at):
        return 0, 0, 0
    k = np.arange(len(at))
    ahead = k - similarity * at  # equal tokens ahead of the required rate
    lowest = np.minimum.accumulate(ahead)
    i = np.minimum(np.searchsorted(-lowest, -(ahead + 1 - similarity + 1e-9)), k)
    j = int(np.argmax(at - at[i]))
    return int(at[i[j]]), int(at[j]) + 1, j - int(i[j]) + 1


def _matches(own: np.ndarray, s: np.ndarray, p: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place among s, place in own) of all equal seeds, about _HITS at a time; own is sorted."""
    lo = np.searchsorted(own, s)
    n = np.searchsorted(own, s, "right") - lo
    p, lo, n = p[n > 0], lo[n > 0], n[n > 0]
    i, total = 0, np.cumsum(n)
    while i < len(p):
        j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + _HITS, "right")))
        k = np.arange(n[i:j].sum()) - np.repeat(np.cumsum(n[i:j]) - n[i:j], n[i:j])
        yield np.repeat(p[i:j], n[i:j]), np.repeat(lo[i:j], n[i:j]) + k
        i = j


def _diagonals(index: Index, h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Rows of (document, item, shift) on which seeds meet.

    Only the first hit of a stretch of hits on a diagonal counts. Where a run of equal seeds meets another, it stands at the
    beginning of one of them, so that no more than these are looked at.
    """
    pair, shift = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    doc_of = np.repeat(np.arange(len(first) - 1), np.diff(first))
    for one in index.seeds:
        s = seeds(h, one.mask)
        if not len(s):
            continue
        p = np.flatnonzero(one.near[(s & np.uint64((1 << _BITS) - 1)).astype(np.int64)])
        p = p[p + len(one.mask) <= first[doc_of[p] + 1]]
        before = np.where(p > first[doc_of[p]], s[np.maximum(p, 1) - 1], np.uint64(1))
        follows = before == s[p]
        for some, own in ((~follows, np.arange(len(one.value))), (follows, np.flatnonzero(one.begins))):
            for k, j in _matches(one.value[own], s[p[some]], np.flatnonzero(some)):
                start = before[k] != one.before[own[j]]
                at, q = p[k[start]], one.place[own[j[start]]]
                item = np.searchsorted(index.first, q, "right") - 1
                pair.append(doc_of[at] * len(index.items) + item)
                shift.append(at - first[doc_of[at]] - q + index.first[item])
    pair, shift = np.concatenate(pair), np.concatenate(shift)
    order = np.lexsort((shift, pair))
    pair, shift = pair[order], shift[order]
    new = np.ones(len(pair), bool)
    new[1:] = (pair[1:] != pair[:-1]) | (shift[1:] != shift[:-1])
    items = max(1, len(index.items))
    return np.stack([pair[new] // items, pair[new] % items, shift[new]], axis=1)


def search(index: Index, h: np.ndarray, first: np.ndarray) -> dict[int, tuple[int | None, int, int, int, int]]:
    """The longest overlap of each document that has one: item, equal tokens, length, place in the document, place in the item.

    Of equally long ones the first item's counts, then the one of the least shift. Diagonals are verified by falling length,
    and those too short to beat what was found are passed over.
    """
    found = _diagonals(index, h, first)
    if not len(found):
        return {}
    doc, item, shift = found.T
    n, m = np.diff(first)[doc], np.diff(index.first)[item]
    lo, hi = np.maximum(0, -shift), np.minimum(m, n - shift)
    need = np.minimum(index.min_tokens, m)
    out: dict[int, tuple] = {}
    for r in np.lexsort((shift, item, lo - hi, doc)):
        d, i, a, b = int(doc[r]), int(item[r]), int(lo[r]), int(hi[r])
        rank = (i, int(shift[r]))
        if b - a < need[r] or d in out and (b - a, out[d][0]) < (out[d][1], rank):
            continue
        d0, i0 = first[d] + int(shift[r]), index.first[i]
        same = h[d0 + a : d0 + b] == index.tokens[i0 + a : i0 + b]
        if np.count_nonzero(same) < least_equal(int(need[r]), index.similarity):
            continue
        x, y, equal = _longest(same, index.similarity if m[r] >= WHOLE else 1.0)
        if y - x >= need[r] and (d not in out or (y - x, out[d][0]) > (out[d][1], rank)):
            out[d] = rank, y - x, (index.items[i], equal, y - x, a + x + int(shift[r]), a + x)
    return {d: x[2] for d, x in out.items()}


FIELDS = [T.StructField("item_id", T.LongType()), T.StructField("equal_tokens", T.IntegerType()), T.StructField("span_tokens", T.IntegerType()),
    T.StructField("doc_from", T.IntegerType()), T.StructField("item_from", T.IntegerType())]


def mark(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
        min_tokens: int = MIN_TOKENS, similarity: float = SIMILARITY) -> DataFrame:
    """docs with contaminated and the longest overlap: item_id, equal_tokens, span_tokens, doc_from, item_from (else null).

    A document is contaminated when it shares with an item a stretch of min_tokens tokens or more (a shorter item: all of its
    tokens) of which the given part agrees, place by place; an item of under WHOLE tokens must agree in all, so that an item of
    one token marks every document with that token. Null and empty
    items match nothing; null and empty documents are clean. Of equally long overlaps the first item by id counts, a null id
    last. Columns of these names are replaced, all others kept; equal rows get equal results; empty tables give empty ones.
    No overlap is missed at the given defaults. With min_tokens below 13 or a lower similarity MASKS may miss long items'.

    The benchmark is read in blocks of at most INDEX_TOKENS tokens by its measured size, each of which is indexed, broadcast
    and held against every document in one scan without a shuffle.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(item_text_col).alias("text")).where("text IS NOT NULL")
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-size // (2 * INDEX_TOKENS)))
    out = docs
    for k in range(blocks):
        block = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k)
        rows = sorted(((r.item, r.text) for r in block.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        held = spark.sparkContext.broadcast(build_index(rows, min_tokens, similarity))

        def make(column: pa.Array, held=held) -> list[pa.Array]:
            rows: list[tuple | None] = [None] * len(column)
            for i, _, data, offs in chunks(column):
                h, first = tokens(data, offs)
                for doc, x in search(held.value, h, first).items():
                    rows[i + doc] = x
            return [pa.array([None if r is None else r[c] for r in rows], pa.int64() if c == 0 else pa.int32()) for c in range(5)]

        names = [f.name for f in FIELDS]
        more = names if k == 0 else fresh(out, *names)
        out = attach(out, text_col, [T.StructField(name, f.dataType) for name, f in zip(more, FIELDS, strict=True)], make)
        if k:
            span, old, item, old_item = F.col(more[2]), F.col("span_tokens"), F.col(more[0]), F.col("item_id")
            first = item.isNotNull() & (old_item.isNull() | (item < old_item))
            better = span.isNotNull() & (old.isNull() | (span > old) | ((span == old) & first))
            out = out.withColumns({n: F.when(better, F.col(m)).otherwise(F.col(n)) for n, m in zip(names, more, strict=True)}).drop(*more)
    return out.withColumn("contaminated", F.col("span_tokens").isNotNull())
