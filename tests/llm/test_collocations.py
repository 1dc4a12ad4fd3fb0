import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_samples import LONG

from siltframe.llm import collocations as co

SCHEMA = "doc_id long, text string, lang string, source string, phrase string, n int, key int, a string"


@pytest.fixture(scope="module")
def tables(frame):
    return lambda *rows: frame(SCHEMA, *[(1, text, lang, "s", "p", 0, 0, "a") for text, lang in rows])


def counts_of(rows, longest=5):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    counts = {}
    for text, lang in rows:
        mine = counts.setdefault(lang or "und", Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, longest + 1):
                mine.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    return counts


def brute(rows, min_count, top, longest=5):
    out = set()
    for lang, f in counts_of(rows, longest).items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        scored = []
        for p, a in found.items():
            if any(len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in found.items()):
                continue
            score, _, left, right = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), left, right))
        for k, (score, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.add((lang, k, p.decode(), -a, left, right, n, -score))
    return out


def sample(seed=3):
    rng = random.Random(seed)
    words = ["the", "The", "new", "york", "times", "été", "ab", "a", "b", "of", "rare"]
    rows = []
    for i in range(120):
        text = ""
        for _ in range(rng.randrange(40)):
            text += rng.choice(["New York times", "a a a", *words, "of the"]) + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", " \v"])
        rows.append((text, rng.choice(["en", "en", "de", None])))
    return [*rows, (None, "en"), ("", "de"), (LONG, "en"), *rows[:5] * 2, ("und", "und")]


@pytest.mark.parametrize("head", [1 << 17, 4, 0])
def test_phrases_against_brute_force(tables, head):
    rows = sample()
    got = [tuple(r) for r in co.collocations(tables(*rows), 9, top=40, head=head).collect()]
    want = brute(rows, 9, 40)
    assert len(want) > 40 and len(got) == len(want) and set(got) == want


def test_cap_on_words_and_empty_tables(tables):
    rows = [("one two three four five six " * 12, "en")]
    assert {tuple(r) for r in co.collocations(tables(*rows), 10).collect()} == brute(rows, 10, 2000)
    assert co.collocations(tables()).count() == 0
    assert co.collocations(tables(("a b", "en"), (None, None))).count() == 0


def test_scores_are_exact_beyond_64_bits(spark, monkeypatch):
    n, a, left, right = 10**15 + 7, 10**12 + 1, 3 * 10**12 + 1, 10**12 + 11
    unit = lambda words, a, heads, tails: spark.createDataFrame(
        [("en", 1, words, a, heads, tails, 2, 3)],
        "lang string, key long, words array<string>, a long, heads array<long>, tails array<long>, left long, right long",
    )
    levels = [unit(["x"], n, [n], [n]), unit(["x", "y"], a, [left, a], [right, a])]
    totals = spark.createDataFrame([("en", n)], "lang string, n long")
    monkeypatch.setattr(co, "frequent_phrases", lambda *args: (levels, totals))
    (row,) = co.collocations(None).collect()
    assert (row.l, row.r, row.score) == (left, right, 1000 * a * n // (left * right))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=300), st.integers(0, 31), st.integers(1, 9), st.sampled_from([0, 1, 10**9]))
def test_tiles_count_every_pair(pairs, head, tile, dense):
    key = co.mix(np.arange(31))
    ranks = co.Head(key[:head], ["en" if k % 3 else "de" for k in range(head)], np.arange(head) % 7)
    pairs = [(a, b) for a, b in pairs if (a % 3 == 0) == (b % 3 == 0)]  # of one language, as in a text
    left, right = (key[[p[i] for p in pairs]] if pairs else key[:0] for i in (0, 1))
    got = co.tiled(left, right, ranks, tile, dense)
    want = Counter(zip(left.tolist(), right.tolist()))
    assert len(got[0]) == len(want) and {(a, b): n for a, b, n in zip(*(x.tolist() for x in got))} == want
