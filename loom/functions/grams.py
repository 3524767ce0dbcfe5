"""The k-mers that two blocks of sequences share, counted in numpy: what a task does with one cell of a similarity join."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

#: Counts held at once, k-mers at most that a matrix product counts, and the share of pairs (1 in so many) from which it does.
COUNTS, DENSE, OFTEN = 1 << 18, 1024, 400
#: Codes up to which a table numbers those that occur.
TABLE = 1 << 23


@dataclass(frozen=True)
class Block:
    """Texts laid end to end as code points, each text's length and sequence (from 0 to count - 1); a sequence may have several texts."""

    points: np.ndarray
    lengths: np.ndarray
    owner: np.ndarray
    count: int


def codes(points: np.ndarray, k: int) -> tuple[np.ndarray, int]:
    """A number for each run of k code points, equal for equal runs only, and a bound of these numbers."""
    if len(points) < k:
        return np.zeros(0, np.uint64), 1
    unit, out = (*_dense(points, int(points.max()) + 1), 1), None
    while k:
        if k & 1:
            out = unit if out is None else _joined(out, unit)
        k >>= 1
        if k:
            unit = _joined(unit, unit)
    return out[0], out[1]


def _joined(a: tuple[np.ndarray, int, int], b: tuple[np.ndarray, int, int]) -> tuple[np.ndarray, int, int]:
    """(code, bound, length) of runs of a's length followed by runs of b's."""
    if a[1] * b[1] >= 1 << 63:
        a, b = (*ranks(a[0]), a[2]), (*ranks(b[0]), b[2])
    size = a[1] * b[1]
    kind = np.uint32 if size < 1 << 32 else np.uint64
    code = a[0][: max(len(a[0]) - b[2], 0)].astype(kind)
    code *= kind(b[1])
    code += b[0][a[2] :]
    return (*(_dense(code, size) if size <= TABLE else (code, size)), a[2] + b[2])


def _dense(code: np.ndarray, size: int) -> tuple[np.ndarray, int]:
    """Codes below size, numbered without gaps, by a table of that size."""
    known = np.zeros(size, bool)
    known[code] = True
    table = np.cumsum(known, dtype=np.uint32)
    return table[code] - np.uint32(1), int(table[-1]) if size else 1


def ranks(values: np.ndarray) -> tuple[np.ndarray, int]:
    """Each value's rank among the different ones, and their number."""
    order = np.argsort(values)
    ordered = values[order]
    out = np.zeros(len(values), np.uint64)
    out[order[1:]] = np.cumsum(ordered[1:] != ordered[:-1], dtype=np.uint64)
    return out, (int(out[order[-1]]) + 1 if len(values) else 1)


class Cell:
    """Two blocks, or one with itself: sizes_a, sizes_b are the numbers of distinct k-mers, rows() the numbers of shared ones."""

    def __init__(self, a: Block, b: Block | None, k: int):
        parts = [a] if b is None else [a, b]
        points, lengths = np.concatenate([p.points for p in parts]), np.concatenate([p.lengths for p in parts])
        owner = a.owner if b is None else np.concatenate([a.owner, b.owner + np.uint32(a.count)])
        count = sum(p.count for p in parts)
        key, size = codes(points, k)
        ends = np.cumsum(lengths)
        whole = np.ones(len(points), bool)  # places at which a run of k stays in its own text
        for back in range(1, k):
            at = ends - back
            whole[at[at >= ends - lengths]] = False
        whole = whole[: len(key)]
        key, bits = key[whole].astype(np.uint64, copy=False), count.bit_length()
        if size.bit_length() + bits > 64:
            key, size = ranks(key)
        key <<= np.uint64(bits)
        key |= np.repeat(owner, lengths)[: len(whole)][whole]
        key.sort()
        if len(key):
            key = key[np.concatenate([[True], key[1:] != key[:-1]])]
        seqs = (key & np.uint64((1 << bits) - 1)).astype(np.int32)
        key >>= np.uint64(bits)
        n = np.bincount(seqs, minlength=count)
        self.rows_a, self.columns, self.sizes_a, self.sizes_b = a.count, parts[-1].count, n[: a.count], n[count - parts[-1].count :]
        start = np.flatnonzero(np.concatenate([[True] * (len(key) > 0), key[1:] != key[:-1]]))
        total = np.diff(np.append(start, len(key)))
        if b is None:
            first, n_a, n_b = start, total, total
        else:
            upto = np.concatenate([[0], np.cumsum(seqs < a.count)])
            n_a = upto[start + total] - upto[start]
            first, n_b = start + n_a, total - n_a
            seqs[seqs >= a.count] -= a.count
        kept = (n_a > 0) & (n_b > 0) if b is not None else total > 1
        self.seqs, self.at_a, self.n_a, self.at_b, self.n_b = seqs, start[kept], n_a[kept], first[kept], n_b[kept]

    def rows(self) -> Iterator[tuple[int, np.ndarray]]:
        """(first, counts): for some sequences of a, from first on, a row each of the numbers of k-mers shared with those of b.

        Rare k-mers are counted along their sequences, frequent ones by a product of 0-1 matrices; both are exact.
        """
        often = np.flatnonzero(self.n_a * self.n_b * OFTEN > self.rows_a * self.columns)
        if len(often) > DENSE:
            often = often[np.argsort(-(self.n_a * self.n_b)[often], kind="stable")[:DENSE]]
        left, right = np.zeros((self.rows_a, len(often)), np.float32), np.zeros((len(often), self.columns), np.float32)
        for h, i in enumerate(often):
            left[self.seqs[self.at_a[i] : self.at_a[i] + self.n_a[i]], h] = 1
            right[h, self.seqs[self.at_b[i] : self.at_b[i] + self.n_b[i]]] = 1
        rare = np.ones(len(self.n_a), bool)
        rare[often] = False
        at_a, n_a, at_b, n_b = self.at_a[rare], self.n_a[rare], self.at_b[rare], self.n_b[rare]
        key = self.seqs[np.repeat(at_a - (np.cumsum(n_a) - n_a), n_a) + np.arange(n_a.sum())].astype(np.uint64)
        key <<= np.uint64(32)
        key |= np.repeat(np.arange(len(n_a), dtype=np.uint64), n_a)
        key.sort()
        own, kmer = (key >> np.uint64(32)).astype(np.int32), (key & np.uint64(0xFFFFFFFF)).astype(np.int32)
        del key
        start = np.searchsorted(own, np.arange(self.rows_a + 1))
        some = max(1, COUNTS // max(self.columns, 1))
        for first in range(0, self.rows_a, some):
            last = min(first + some, self.rows_a)
            of = kmer[start[first] : start[last]]
            length = n_b[of]
            upto = np.cumsum(length)
            place = np.repeat(at_b[of] - (upto - length), length)
            place += np.arange(len(place))
            cell = np.repeat((own[start[first] : start[last]].astype(np.int64) - first) * self.columns, length)
            cell += self.seqs[place]
            counts = np.bincount(cell, minlength=(last - first) * self.columns).reshape(last - first, self.columns)
            if len(often):
                counts += np.rint(left[first:last] @ right).astype(np.int64)
            yield first, counts
