import random
from collections import Counter

import numpy as np

from llm_samples import LONG, docs  # noqa: F401

from siltframe.llm import minhash
from siltframe.llm.words import stream


def brute(texts, width=2):
    sets = []
    for text in texts:
        words = (text or "").encode().lower().split()
        size = min(width, len(words))
        sets.append({tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set())
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [(i, len(s), root(i), root(i) == i) for i, s in enumerate(sets)]


def test_components_equal_all_pairs(docs):
    chance = random.Random(1)
    base = [f"v{i}" for i in range(60)]
    texts = [None, "", "  ", "one", "ONE", "one two", "x", LONG, LONG + " end"]
    for _ in range(60):  # a group in which only some are similar enough, many to none
        words = list(base)
        for _ in range(chance.randrange(6)):
            words[chance.randrange(60)] = f"r{chance.randrange(10**6)}"
        texts.append(" ".join(words))
    texts += [" ".join(chance.choices(base, k=12)) for _ in range(30)] + texts[20:24]
    got = sorted(tuple(r) for r in minhash.near_duplicates(docs(*texts)).collect())
    assert got == brute(texts)


def test_empty_null_and_repeated_ids(docs):
    assert minhash.near_duplicates(docs()).count() == 0
    got = minhash.near_duplicates(docs("a b c", "a b c", "a b c", None, ids=[5, 5, None, 7])).collect()
    assert Counter(tuple(r) for r in got) == Counter({(5, 2, 5, True): 2, (None, 2, None, True): 1, (7, 0, 7, True): 1})


def test_minima_and_maxima_estimate_the_similarity():
    factors = (stream(7, 400) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    x = stream(3, 1000)
    a, b = (minhash.signature(s, factors) for s in (x[:900], x[100:]))
    for one, other in zip(a, b):
        assert abs((one == other).mean() - 0.8) < 0.08
