import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from siltframe.llm import words as w

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAbÉé \t\n\r\x0b\x0c\x1c.", max_size=60)), max_size=8)


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.sampled_from([4, 16, 1 << 17]))
def test_words_are_those_of_a_plain_split(texts, piece):
    before, w.PIECE_BYTES = w.PIECE_BYTES, piece
    w._powers.clear()
    try:
        found = w.words(pa.array(texts, pa.string()))
    finally:
        w.PIECE_BYTES = before
        w._powers.clear()
    numbers = {}
    for i, text in enumerate(texts):
        expected = (text or "").encode().lower().split()
        assert [bytes(found.data[a:b]).lower() for a, b in zip(found.start[found.bound[i] : found.bound[i + 1]], found.end[found.bound[i] : found.bound[i + 1]])] == expected
        for word, number in zip(expected, found.of(i)):
            assert numbers.setdefault(word, number) == number
    assert len(set(numbers.values())) == len(numbers)


def test_shingles_of_short_sequences():
    a = np.array([1, 2], np.uint64)
    assert len(w.shingles(a[:0], 2)) == 0
    assert len(w.shingles(a[:1], 2)) == 1 == len(w.shingles(a, 2))
    assert w.shingles(a[:1], 2)[0] != w.shingles(a, 2)[0]
