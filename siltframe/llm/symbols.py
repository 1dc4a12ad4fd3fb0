"""Texts as sequences of small numbers: whole code points for hashed n-grams, or planes of 32 symbols for dense tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SYMBOLS, PLANES = 32, 2
#: Characters looked at together; bounds memory for very long texts.
BLOCK_CHARS = 1 << 19
#: Numbers of characters beyond ASCII start here: 0 is white space, 1-26 are a-z, 27 is other ASCII.
BEYOND = 28
#: The last code point of Latin letters, and the range of general punctuation and signs.
LATIN_LAST, SIGNS_FIRST, SIGNS_LAST = 0x24F, 0x2000, 0x2BFF
_OF = np.full(128, 27, np.int32)
_OF[[32, 9, 10, 11, 12, 13]] = 0
_OF[97:123] = _OF[65:91] = np.arange(1, 27)


def characters(text: str) -> Iterator[np.ndarray]:
    """Numbers of the lower-cased characters by block (BEYOND + code point beyond ASCII), runs of white space and of other
    ASCII shortened to one."""
    last = 0
    for at in range(0, len(text), BLOCK_CHARS):
        code = np.frombuffer(text[at : at + BLOCK_CHARS].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        out = np.where(code < 128, _OF[np.minimum(code, 127)], BEYOND + code.astype(np.int32)).astype(np.int32)
        before = np.concatenate(([last], out[:-1]))
        last = int(out[-1]) if len(out) else last
        yield out[(out != before) | ((out != 0) & (out != 27))]


def planes(row: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and planes of character numbers. Plane 0: white space, ASCII, and Latin letters and signs beyond ASCII as four
    symbols. Plane 1: letters of all other scripts, 31 symbols, told apart within 31 neighbouring code points and shifted
    from one range of 128 to the next. White space and punctuation stay in the plane of the character before."""
    code = row - BEYOND
    sign = (code >= SIGNS_FIRST) & (code <= SIGNS_LAST)
    other = (code > LATIN_LAST) & ~sign
    symbol = np.where(row < BEYOND, row, 28 + (code & 3))
    symbol = np.where(other, 1 + (code + 13 * (code >> 7)) % 31, symbol)
    letter = other | ((row != 0) & (row != 27) & ~sign)
    at = np.maximum.accumulate(np.where(letter, np.arange(len(row)), -1))
    return symbol.astype(np.int32), np.where(at >= 0, other[at], start).astype(np.int32)


def grams(text: str | None, width: int) -> Iterator[np.ndarray]:
    """Numbers below PLANES * SYMBOLS ** width of all n-grams, in order; the text is led by white space and closed by one.

    An n-gram belongs to the plane of its last symbol; symbols of the other plane in it are white space.
    """
    tail, tail_plane = np.zeros(width - 1, np.int32), np.zeros(width - 1, np.int32)
    for part in characters((text or "") + " "):
        symbol, plane = planes(part, int(tail_plane[-1]))
        row, of = np.concatenate((tail, symbol)), np.concatenate((tail_plane, plane))
        n = len(row) - width + 1
        out = of[width - 1 :].copy()
        for k in range(width):
            out = out * SYMBOLS + np.where(of[k : k + n] == of[width - 1 :], row[k : k + n], 0)
        yield out
        tail, tail_plane = row[n:], of[n:]


def spans(text: str | None, width: int) -> Iterator[np.ndarray]:
    """Rows of ``width`` neighbouring character numbers, in order; the text is led by white space and closed by one."""
    tail = np.zeros(width - 1, np.int32)
    for part in characters((text or "") + " "):
        row = np.concatenate((tail, part))
        if len(part):
            yield np.lib.stride_tricks.sliding_window_view(row, width)
        tail = row[len(row) - width + 1 :]
