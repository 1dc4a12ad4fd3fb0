import re
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_samples import LONG

from siltframe.llm import divergence as dv

WORDS = "Ähre über cat Cat dog sun moon tea x1y a-b".split()
SCHEMA = "doc_id long, text string, lang string, source string, term string, value int, rank int, place int"


@pytest.fixture(scope="module")
def tables(frame):
    return lambda *rows: frame(SCHEMA, *[(1, text, lang, source, "t", 0, 0, 0) for text, lang, source in rows])


def brute(rows, min_docs, top):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(lower))
        groups[lang].add(source)
        counts[lang, source].update(found)
        docs[lang].update(set(found))
    out = set()
    for lang, sources in groups.items():
        kept = sorted(t for t, n in docs[lang].items() if n >= min_docs)
        whole = sum((counts[lang, s] for s in sources), Counter())

        def prices(c):
            total = sum(c[t] for t in kept) + 5 * len(kept)
            return [1 + 10**9 * (c[t] + 5) // total for t in kept]

        own, q = {s: prices(counts[lang, s]) for s in sources}, prices(whole)
        for s in sources:
            pair = [(o, sum(abs(a - b) for a, b in zip(own[s], own[o]))) for o in sources if o != s]
            term = [(t, a - b) for t, a, b in zip(kept, own[s], q) if a > b and counts[lang, s][t]]
            for part, found in (("pair", pair), ("term", term)):
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, item, value, k) for k, (item, value) in enumerate(ranked, 1) if part == "pair" or k <= top}
    return out


def test_all_groups_against_brute_force(tables):
    rows = []
    for k, (lang, source) in enumerate(product(["en", "de", None], ["a", "b", "c", "d", None])):
        for i in range(4):
            rows.append((" ".join(WORDS[(i * k + j * j) % (3 + k % 7)] for j in range(5 + i + k)), lang, source))
    rows += [(None, "en", "a"), ("", "fr", "a"), ("12 !", "fr", "z"), (LONG, "en", "b"), rows[0], rows[0]]
    want = brute(rows, 3, 2)
    for block, tile in ((2, 2), (1 << 16, 16)):
        got = [tuple(r) for r in dv.divergence(tables(*rows), 3, 2, block, tile).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    assert ("fr", "a", "pair", "z", 0, 1) in want


def test_no_rows_and_no_kept_terms(tables):
    assert dv.divergence(tables()).count() == 0
    assert [tuple(r) for r in dv.divergence(tables(("a b", "en", "s"), ("c", "en", "t"))).orderBy("source").collect()] == [
        ("en", "s", "pair", "t", 0, 1), ("en", "t", "pair", "s", 0, 1)
    ]


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 400)), st.sets(st.integers(0, 4000)), st.integers(1, 9))
def test_gallop_finds_every_shared_value(a, b, run):
    short, long = np.array(sorted(a), np.int64), np.array(sorted(b), np.int64)
    here, there = dv.gallop(short, long, run)
    assert short[here].tolist() == sorted(a & b) and long[there].tolist() == sorted(a & b)


@given(st.lists(st.integers(0, 10**14), min_size=1), st.integers(1, 9 * 10**15))
def test_prices_are_exact_beyond_64_bits(counts, total):
    total = max(total, max(counts) + 5)
    assert dv.price(np.array(counts), total).tolist() == [1 + 10**9 * (c + 5) // total for c in counts]
