import random

from siltframe.llm.graph import components
from siltframe.llm.store import sieve


def test_components_of_chains_stars_and_loops(frame):
    chance = random.Random(2)
    edges = [(i, i + 1) for i in range(20)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (None, 3), (3, None)]
    edges += [(chance.randrange(200, 300), chance.randrange(200, 300)) for _ in range(60)] + [(-5, 4), (4, -5)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    got = components(frame("a long, b long", *edges)).collect()
    assert sorted(map(tuple, got)) == sorted((x, root(x)) for x in parent)
    assert components(frame("a long, b long")).count() == 0


def test_sieve_loses_no_key(frame):
    rows = frame("k long, v string", *[(i, str(i)) for i in range(500)], (None, "n"))
    keys = frame("id long", *[(i,) for i in range(0, 500, 7)], (None,))
    for bits, most in ((1 << 24, 75), (64, 501)):
        got = {r["k"] for r in sieve(keys, rows, "k", bits).collect()}
        assert set(range(0, 500, 7)) <= got and len(got) <= most
