"""Token ids of texts from those of their words.

The vocabulary drops white space before its words are formed, so ids of a text are those of its space-separated parts one
after the other. The different parts of many texts are told apart by Arrow and looked up once each. Of those not seen
before, letters and a run of marks behind them are words of their own and looked up apart, so letters go to the merges
once, whatever stands behind them. Letters of Latin-1 go there without the tokeniser's normalisation, which only
lower-cases them, if that gives the same ids for a few probes.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words, letters or marks whose ids a worker remembers, and as many from before those.
MEMO_WORDS = 500_000
#: Bytes of text whose different words are looked up together.
GROUP_BYTES = 8 << 20

#: Letters that only change by lower-casing, and one run of ASCII marks behind them that forms a word of its own.
_STEM = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\\[-`{-~]*)")
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
_LATIN = "".join(x for x in map(chr, range(256)) if _LETTERS.fullmatch(x))
_MARKS = "".join(x for x in map(chr, range(128)) if _STEM.fullmatch("x" + x) and not x.isalpha())
_NOTHING = pa.scalar(b"", pa.large_binary())
_PROBES = ("the", "The", "Été", "größe.", "niño,", "ÆØÅ", "x", "so!)", 'end";')


def _byte_signs() -> dict[int, str]:
    """Signs that stand for bytes in byte-level vocabularies: printable Latin-1 for itself, the rest from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(256 + k) for k, b in enumerate(rest)}


class _Words(dict):
    """Ids of words as bytes; a word that is asked for first is encoded then."""

    def __init__(self, vocabulary: str, kind: np.dtype):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer, self.kind, self.code = Tokenizer.from_str(vocabulary), kind, {2: "H", 4: "I"}[kind.itemsize]
        self.merges, self.signs, self.before = self.tokenizer.model, _byte_signs(), {}
        probes = ((x, *_STEM.fullmatch(x).groups()) for x in _PROBES)
        self.direct = all(self.letters(stem) + (self.full(stop) if stop else b"") == self.full(x) for x, stem, stop in probes)

    def full(self, text: str) -> bytes:
        """Ids by the whole tokeniser."""
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind).tobytes()

    def letters(self, stem: str) -> bytes:
        """Ids of Latin-1 letters by the merges alone."""
        low = stem.lower()
        signs = low if low.isascii() else low.encode().decode("latin-1").translate(self.signs)
        return array(self.code, [t.id for t in self.merges.tokenize(signs)]).tobytes()

    def __missing__(self, word: str) -> bytes:
        ids = self.before.get(word) if word else b""
        if ids is None:
            ids = self.letters(word) if self.direct and _LETTERS.fullmatch(word) else self.full(word)
        self[word] = ids
        return ids

    def age(self) -> None:
        """Keep what was asked for since the last time, if it has become many words."""
        if len(self) > MEMO_WORDS:
            self.before = dict(self)
            self.clear()

    def of(self, column: pa.Array) -> pa.Array:
        """Ids of every word of ``column``."""
        found = column.dictionary_encode()
        words = found.dictionary.to_numpy(zero_copy_only=False).tolist()
        return pa.array([self[x] for x in words], pa.large_binary()).take(found.indices)


class WordEncoder:
    """Ids of texts, as little-endian numbers of ``kind``."""

    def __init__(self, vocabulary: str, kind: str = "<u4"):
        self.words = _Words(vocabulary, np.dtype(kind))

    def __call__(self, texts: pa.Array | list[str | None]) -> list[bytes]:
        self.words.age()
        raw = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        # Special tokens are told from other words by case.
        parts = pc.ascii_split_whitespace(pc.if_else(pc.match_substring(raw, "<|"), raw, pc.ascii_lower(raw)))
        found = parts.values.dictionary_encode()
        ids = pa.ListArray.from_arrays(parts.offsets, self._ids(found.dictionary).take(found.indices))
        return pc.binary_join(ids, _NOTHING).to_pylist()

    def _ids(self, parts: pa.Array) -> pa.Array:
        if not self.words.direct:
            return self.words.of(parts)
        letters, marks = pc.utf8_rtrim(parts, _MARKS), pc.utf8_ltrim(parts, _LATIN)
        # The two make up a part only if it is letters and then marks.
        split = pc.equal(pc.add(pc.binary_length(letters), pc.binary_length(marks)), pc.binary_length(parts))
        stems, stops = pc.if_else(split, letters, parts), pc.if_else(split, marks, "")
        return pc.binary_join_element_wise(self.words.of(stems), self.words.of(stops), _NOTHING)


def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in batches of up to GROUP_BYTES of text; a larger one stays as it is."""
    held, size = [], 0
    for batch in batches:
        more = batch.column("text").nbytes
        if held and size + more > GROUP_BYTES:
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(batch)
        size += more
    if held:
        yield pa.concat_batches(held)
