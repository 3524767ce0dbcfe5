"""Words and hashes of whole Arrow batches of texts, in numpy without a loop over documents."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_B = 0x9E3779B97F4A7C55  # odd, so it has an inverse modulo 2**64
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def chunks(column: pa.Array, limit: int = 1 << 18) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows of about limit bytes; null counts as empty, no text is cut."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    n = len(column)
    if n == 0:
        return
    _, offs, data = column.buffers()
    offs = np.frombuffer(offs, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = min(n, max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1))
        yield i, j, data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
        i = j


def is_space(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def spans(inside: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of inside that don't cross a document, and the first run of each document (n + 1)."""
    n = len(inside)
    if n == 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(offs), np.int64)
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0], before[1:] = True, ~inside[:-1]
    after[-1], after[:-1] = True, ~inside[1:]
    before[offs[:-1][offs[:-1] < n]] = True
    after[offs[1:][offs[1:] > 0] - 1] = True
    starts, ends = np.flatnonzero(inside & before), np.flatnonzero(inside & after) + 1
    return starts, ends, np.searchsorted(starts, offs)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    size = 1 << max(16, int(n).bit_length())
    if size not in _powers:
        inverse = pow(_B, -1, 1 << 64)
        both = []
        for base in (_B, inverse):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            with np.errstate(over="ignore"):
                both.append(np.multiply.accumulate(factors))
        _powers[size] = both[0], both[1]
    return _powers[size]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads 64-bit values."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


#: Values that one prefix sum covers; more are worked on in runs, so that memory and the table of powers stay small.
_RUN = 1 << 20


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of values[start:end] for each range, equal for equal ranges wherever they stand; starts and ends rise."""
    return hasher(values)(starts, ends)


def hasher(values: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """range_hashes of values for several sets of ranges: the prefix sum is made once where values are few."""
    if len(values) <= _RUN:
        return _summed(values)

    def in_runs(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out, i = np.zeros(len(starts), np.uint64), 0
        while i < len(starts):
            j = max(i + 1, int(np.searchsorted(ends, starts[i] + _RUN, "right")))
            out[i:j] = _summed(values[starts[i] : ends[j - 1]])(starts[i:j] - starts[i], ends[i:j] - starts[i])
            i = j
        return out

    return in_runs


def _summed(values: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    up, down = powers(len(values) + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(len(values) + 1, np.uint64)
        np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[: len(values)], out=total[1:])

    def hashes(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))

    return hashes
