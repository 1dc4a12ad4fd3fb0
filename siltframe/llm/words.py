"""Words of whole Arrow text columns as 64-bit numbers, found and hashed without a Python loop over words.

A word is a maximal run of bytes other than ``[\\x20\\x09-\\x0D]``, with A-Z lower-cased. Its number is a polynomial
over a fixed random byte table, taken from prefix sums modulo 2**64, then mixed together with its length. Two
different words get the same number with a chance near 2**-64.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 17
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit over the whole number (splitmix64)."""
    x = np.asarray(x, _U)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def stream(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    return mix((np.arange(1, n + 1, dtype=_U) + _U(seed << 32)) * _U(0x9E3779B97F4A7C15))


_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_BYTE = stream(1, 256)
_BYTE[65:91] = _BYTE[97:123]
_BASE = 0x9E3779B97F4A7C15 | 1
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(PIECE_BYTES, 1 << (n - 1).bit_length())
    if size not in _powers:
        def table(base: int) -> np.ndarray:
            out = np.full(size, base, _U)
            out[0] = 1
            return np.multiply.accumulate(out)

        _powers.clear()
        _powers[size] = table(_BASE), table(pow(_BASE, -1, 1 << 64))
    return _powers[size]


def unique(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values (a plain sort is several times faster than numpy's hashing for these)."""
    x = np.sort(x)
    return x[np.concatenate(([True], x[1:] != x[:-1]))] if len(x) else x


class Words(NamedTuple):
    """Words of a column: ``number``, ``start`` and ``end`` by word; text i has words ``bound[i]:bound[i + 1]``."""

    number: np.ndarray
    start: np.ndarray
    end: np.ndarray
    bound: np.ndarray
    data: np.ndarray

    def of(self, i: int) -> np.ndarray:
        return self.number[self.bound[i] : self.bound[i + 1]]


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, one after the other, and the n + 1 places between them; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, places, data = column.buffers()
    off = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[off[0] : off[-1]], off - off[0]


def _pieces(data: np.ndarray, off: np.ndarray):
    """Ranges of about PIECE_BYTES that cut no word; a word longer than that is a range of its own."""
    a, n = 0, len(data)
    while a < n:
        b = min(n, a + PIECE_BYTES)
        if b < n:
            edge = off[np.searchsorted(off, b, "right") - 1]
            if edge > a:
                b = int(edge)
            else:
                stop = int(off[np.searchsorted(off, b, "right")])
                gaps = np.flatnonzero(_SPACE[data[a:b]])
                if len(gaps):
                    b = a + int(gaps[-1]) + 1
                else:
                    while b < stop and not _SPACE[data[b]]:
                        step = data[b : min(stop, b + PIECE_BYTES)]
                        gaps = np.flatnonzero(_SPACE[step])
                        b += int(gaps[0]) if len(gaps) else len(step)
        yield a, b
        a = b


def words(column: pa.Array) -> Words:
    data, off = raw(column)
    numbers, starts, ends = [], [], []
    for a, b in _pieces(data, off):
        part = data[a:b]
        n = b - a
        gap = _SPACE[part]
        first = np.zeros(n + 1, bool)
        first[off[np.searchsorted(off, a) : np.searchsorted(off, b, "right")] - a] = True
        first[0] = first[n] = True
        before, after = first[:n].copy(), first[1:].copy()
        before[1:] |= gap[:-1]
        after[:-1] |= gap[1:]
        s, e = np.flatnonzero(before & ~gap), np.flatnonzero(after & ~gap)
        up, down = _power_tables(n)
        value = _BYTE[part] * up[:n]
        total = np.cumsum(value, dtype=_U)
        number = (total[e] - total[s] + value[s]) * down[s]
        numbers.append(mix(number ^ ((e - s + 1).astype(_U) * _U(0xD6E8FEB86659FD93))))
        starts.append(s + a)
        ends.append(e + a + 1)
    join = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
    start = join(starts, np.int64)
    return Words(join(numbers, _U), start, join(ends, np.int64), np.searchsorted(start, off), data)


def shingles(number: np.ndarray, width: int) -> np.ndarray:
    """Distinct ``width``-word shingles, sorted; fewer words make one shingle of the whole sequence, none make none."""
    n = len(number)
    if n == 0:
        return number
    size = min(n, width)
    out = number[: n - size + 1].copy()
    for k in range(1, size):
        out = mix(out * _U(0xC2B2AE3D27D4EB4F) + number[k : n - size + 1 + k])
    return unique(out + _U(size))
