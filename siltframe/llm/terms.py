"""Terms of whole Arrow text columns, cut at given bytes and numbered by an exact dictionary of each batch."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa

from .words import raw

RANGE_BYTES = 1 << 20
#: Rows that ``combined`` holds before it adds equal keys up.
HELD_ROWS = 400_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def byte_set(values: Iterable[int]) -> np.ndarray:
    """A table of 256 flags, true for the given bytes."""
    table = np.zeros(256, bool)
    table[list(values)] = True
    return table


class Terms(NamedTuple):
    """Terms of a column: ``code`` (place in ``values``), ``text`` and ``piece`` by term, in order.

    ``piece`` never falls; two neighbours share it if they are of one text with no break between them.
    """

    code: np.ndarray
    values: pa.Array
    text: np.ndarray
    piece: np.ndarray


def _ranges(off: np.ndarray, data: np.ndarray, gap: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about RANGE_BYTES that cut no term; a longer term makes a longer range."""
    a, n = 0, len(data)
    while a < n:
        b = min(n, a + RANGE_BYTES)
        while b < n:
            gaps = np.flatnonzero(gap[data[a:b]])
            edge = off[np.searchsorted(off, b, "right") - 1]
            cut = max(int(edge) if edge > a else a, a + int(gaps[-1]) + 1 if len(gaps) else a)
            if cut > a:
                b = cut
                break
            b = min(n, b + RANGE_BYTES)
        yield a, b
        a = b


def terms(column: pa.Array, gap: np.ndarray, breaks: np.ndarray | None = None) -> Terms:
    """The maximal runs of bytes outside ``gap`` in every text, A-Z lower-cased; null has none.

    ``breaks`` are gap bytes that end a piece as well.
    """
    data, off = raw(column)
    data = _LOWER[data]
    starts, lengths, kept, broken = [], [], [], []
    seen = 0
    for a, b in _ranges(off, data, gap):
        part = data[a:b]
        inside = ~gap[part]
        edge = np.zeros(b - a + 1, bool)
        edge[off[np.searchsorted(off, a) : np.searchsorted(off, b, "right")] - a] = True
        edge[0] = edge[-1] = True
        opens, closes = inside.copy(), inside.copy()
        opens[1:] &= edge[1:-1] | ~inside[:-1]
        closes[:-1] &= edge[1:-1] | ~inside[1:]
        s = np.flatnonzero(opens)
        starts.append(s + a)
        lengths.append(np.flatnonzero(closes) + 1 - s)
        kept.append(part[inside])
        if breaks is not None:
            count = np.cumsum(breaks[part], dtype=np.int64)
            broken.append(count[s] + seen)
            seen += int(count[-1])
    join = lambda parts, t: np.concatenate(parts) if parts else np.zeros(0, t)
    start, length = join(starts, np.int64), join(lengths, np.int64)
    places = np.zeros(len(start) + 1, np.int64)
    np.cumsum(length, out=places[1:])
    listed = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(places), pa.py_buffer(join(kept, np.uint8))])
    coded = listed.dictionary_encode()
    text = np.repeat(np.arange(len(off) - 1), np.diff(np.searchsorted(start, off)))
    piece = text if breaks is None else text + join(broken, np.int64)
    return Terms(coded.indices.to_numpy().astype(np.int64), coded.dictionary, text, piece)


def runs(values: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order and how often each occurs, or the sum of its weights."""
    if not len(values):
        return values, np.zeros(0, np.int64)
    order = None if weight is None else np.argsort(values, kind="stable")
    values = np.sort(values) if order is None else values[order]
    first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    if order is not None:
        return values[first], np.add.reduceat(weight[order], first)
    return values[first], np.diff(np.append(first, len(values)))


def combined(
    batches: Iterable[pa.RecordBatch], keys: Sequence[str], sums: Sequence[str], held: int = HELD_ROWS
) -> Iterator[pa.RecordBatch]:
    """``batches`` with the sums of equal keys added up as far as ``held`` rows reach; ahead of a shuffle."""
    waiting, size, schema = [], 0, None

    def added() -> pa.Table:
        table = pa.Table.from_batches(waiting).group_by(list(keys)).aggregate([(c, "sum") for c in sums])
        return table.rename_columns([c.removesuffix("_sum") if c.removesuffix("_sum") in sums else c for c in table.column_names]).select(schema.names).cast(schema)

    for batch in batches:
        schema = schema or batch.schema
        waiting.append(batch)
        size += len(batch)
        if size > held:
            waiting = added().combine_chunks().to_batches()
            size = sum(map(len, waiting))
            if 2 * size > held:
                yield from waiting
                waiting, size = [], 0
    if waiting:
        yield from added().combine_chunks().to_batches()
