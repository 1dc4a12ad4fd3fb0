import math
import random
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from llm_samples import LONG, docs  # noqa: F401

from siltframe.llm import brown


def held_out(i):
    return zlib.crc32(str(i).encode()) % 7 == 2


@pytest.mark.parametrize("head", [1 << 20, 5])
def test_base_scores_equal_brute_force_and_classes_help(docs, head):
    chance = random.Random(4)
    texts = [None, "", " ", "New words only", LONG]
    for i in range(200):
        kind = "abcdefghij" if i % 2 else "qrstuvwxyz"
        texts.append(" ".join(chance.choices(kind, k=1)[0] * chance.randrange(1, 4) for _ in range(40)))
    texts.append(texts[-1])
    tokens = [[*(t or "").encode().lower().split(), None] for t in texts]
    counts = Counter(w for i, t in enumerate(tokens) if not held_out(i) for w in t)
    total, distinct = sum(counts.values()), len(counts)
    got = {r["doc_id"]: r for r in brown.scores(docs(*texts), classes=8, head=head).collect()}
    gain = 0.0
    for i, own in enumerate(tokens):
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in own)
        row = got[i]
        assert (row["held_out"], row["n_tokens"], row["train_tokens"]) == (held_out(i), len(own), total)
        assert row["n_known"] == sum(counts[w] > 0 for w in own)
        assert math.isclose(row["base_score"], base, rel_tol=1e-9) and row["score"] < 0
        gain += (row["score"] - base) * (i >= 5 and held_out(i))
    assert gain > 0


def test_null_repeated_and_no_ids(docs):
    kept = next(i for i in range(1, 9) if not held_out(i))
    got = brown.scores(docs("a b", "a b", None, ids=[kept, kept, None]), classes=4).collect()
    assert sorted((r["doc_id"] or 0, r["n_tokens"], r["train_tokens"]) for r in got) == [(0, 1, 7), (kept, 3, 7), (kept, 3, 7)]
    assert brown.scores(docs(), classes=4).count() == 0


def test_exchange_never_lowers_the_likelihood():
    chance = np.random.default_rng(1)
    pairs = chance.poisson(0.3, (40, 40)).astype(float)
    pairs[:20, :20] += chance.poisson(3, (20, 20))
    pairs[20:, 20:] += chance.poisson(3, (20, 20))

    def likelihood(of, classes):
        one = np.eye(classes)[of]
        table = one.T @ pairs @ one
        return brown._xlogx(table).sum() - brown._xlogx(table.sum(0)).sum() - brown._xlogx(table.sum(1)).sum()

    of = brown.exchange(pairs, 2)
    start = np.empty(40, int)
    start[np.argsort(-(pairs.sum(0) + pairs.sum(1)), kind="stable")] = np.arange(40) % 2
    assert likelihood(of, 2) >= likelihood(start, 2)
    assert len(set(of[:20])) == 1 == len(set(of[20:])) and of[0] != of[39]


def test_best_class_equals_brute_force():
    chance, classes = np.random.default_rng(3), 4
    pairs = chance.poisson(0.8, (12, 12)).astype(float)
    of = chance.integers(0, classes, 12)

    def table_of(of):
        one = np.eye(classes)[of]
        return one.T @ pairs @ one

    bound, code, n = [0], [], []
    for u in range(12):
        off = np.arange(12) != u
        after, before = (np.bincount(of[off], x[off], classes) for x in (pairs[u], pairs[:, u]))
        row = np.concatenate((after, before, pairs[u, u : u + 1]))
        code += list(np.flatnonzero(row))
        n += list(row[row > 0])
        bound.append(len(code))
    got = brown.best_classes(table_of(of), of, np.array(bound), np.array(code), np.array(n))
    for u in range(12):
        ways = [brown.likelihood(table_of(np.where(np.arange(12) == u, k, of))) for k in range(classes)]
        assert math.isclose(ways[got[u]], max(ways), rel_tol=1e-12)


@pytest.mark.parametrize("head", [1 << 20, 10])
def test_rare_words_get_the_class_of_their_neighbours(docs, monkeypatch, head):
    # Few words are units of their own; endings say nothing about the two kinds of words.
    monkeypatch.setattr(brown, "UNITS", 16)
    monkeypatch.setattr(brown, "GROUPS", 7)
    chance = random.Random(5)
    left, right = ([f"{c}{i:03d}" for i in range(60)] for c in "lr")
    texts = []
    for _ in range(400):
        words = []
        for _ in range(12):
            words += [chance.choice("the a one".split()), chance.choice(left), chance.choice("and or but".split()), chance.choice(right)]
        texts.append(" ".join(words))
    kept, cluster = [], brown.cluster
    monkeypatch.setattr(brown, "cluster", lambda *a, **b: kept.append(cluster(*a, **b)) or kept[-1])
    probe = [" ".join(f"the {a} and {b}" for a, b in pairs) for pairs in (zip(left, right), zip(right, left))]
    rows = {r["doc_id"]: r for r in brown.scores(docs(*texts, *probe, ids=[*range(400), 1002, 1002 + 1]), classes=8, head=head).collect()}
    model, far, moves, _ = kept[0]
    of = dict(zip(model["head"].tolist(), model["classes"].tolist()))
    of |= {r["word"] % (1 << 64): r["class"] for r in (far.collect() if far is not None else [])}
    sides = [[of[x] for x in brown.words(pa.array([" ".join(side)])).number.tolist()] for side in (left, right)]
    common = [Counter(side).most_common(1)[0] for side in sides]
    assert common[0][0] != common[1][0] and not set(sides[0]) & set(sides[1])
    assert rows[1002]["n_tokens"] == rows[1003]["n_tokens"] and rows[1002]["score"] > rows[1003]["score"]
    tokens = sum(len(t.split()) + 1 for i, t in [*enumerate(texts), *enumerate(probe, 1002)] if not held_out(i))
    assert moves.sum() == tokens == rows[0]["train_tokens"]


def test_texts_are_cut_into_words_three_times(docs, monkeypatch):
    """To count, for the places of all passes over pairs, and to score; each time costs about a tenth of the whole."""
    texts, kind = docs("a b", "c"), type(docs("a"))
    run, seen = kind.mapInArrow, []
    monkeypatch.setattr(kind, "mapInArrow", lambda self, *a, **b: seen.append("text" in self.columns) or run(self, *a, **b))
    assert brown.scores(texts, classes=4).count() == 2 and sum(seen) == 3


def test_finder_equals_a_search_and_grouped_an_order():
    chance = np.random.default_rng(6)
    ends = np.array([0, 1, (1 << 64) - 1], np.uint64)
    for size in (0, 1, 3000):
        head = np.unique(np.concatenate((chance.integers(0, 1 << 64, size, np.uint64), np.arange(size // 10, dtype=np.uint64) + np.uint64(7), ends[:size])))
        asked = np.concatenate((head, chance.integers(0, 1 << 64, 500, np.uint64), ends, np.arange(2000, dtype=np.uint64)))
        assert (brown.finder(head)(asked) == brown._places_in(head, asked)).all()
    for number in (asked[:0], chance.integers(0, 1 << 64, 200, np.uint64)[chance.integers(0, 200, 5000)], chance.integers(0, 50, 5000, np.uint64)):
        order, first = brown.grouped(number)
        assert sorted(order) == list(range(len(number)))
        got = Counter()
        for x, n in zip(number[order[first]].tolist(), np.diff(np.append(first, len(order))).tolist()):
            got[x] += n
        assert got == Counter(number.tolist())


def test_bigrams_of_stored_places_equal_brute_force(monkeypatch):
    monkeypatch.setattr(brown, "PLACES", 7)
    texts, frequent = ["a b c a", "", "rare a b", None, "b other c rare"], ["a", "b"]
    column = pa.array(texts, pa.string())
    w = brown.words(column)
    number_of = lambda x: int(brown.words(pa.array([x])).number[0])
    group = dict(zip(w.number.tolist(), brown.endings(w).tolist()))
    head = np.sort(np.array([number_of(x) for x in "abc"], np.uint64))
    top = np.sort(np.array([number_of(x) for x in frequent], np.uint64))

    def unit(x):
        at = np.flatnonzero(top == np.uint64(number_of(x)))
        return int(at[0]) + 1 if len(at) else brown.UNITS - brown.GROUPS + group[number_of(x)]

    want, before = Counter(), 0
    for text in texts:
        for u in [*(unit(x) for x in (text or "").split()), 0]:
            want[before * brown.UNITS + u] += 1
            before = u
    batch = pa.RecordBatch.from_arrays([column], ["text"])
    rows = list(brown._cut_once(SimpleNamespace(value=head))(iter([batch])))
    units = np.array([unit("abc"[[number_of(x) for x in "abc"].index(int(h))]) for h in head] + [0], np.int32)
    places = [x.select(["places"]) for x in rows if x.column("places").null_count == 0]
    got = pa.Table.from_batches(brown._bigrams(SimpleNamespace(value=units))(iter(places)))
    assert len(places) > 1 and dict(zip(got["pair"].to_pylist(), got["n"].to_pylist())) == want


def test_a_word_over_two_batches_keeps_its_first_class(monkeypatch):
    monkeypatch.setattr(brown, "ROWS", 1)
    monkeypatch.setattr(brown, "best_classes", lambda table, own, *rest: own)
    none = np.zeros(0, np.uint64)
    model = {"k": 2, "head": np.array([5], np.uint64), "classes": np.array([1]), "frequent": none, "end_class": 1, "table": np.ones((2, 2))}
    own = brown._own_kinds(2)(iter([pa.RecordBatch.from_arrays([pa.array([9]), pa.array([0], pa.int32())], ["word", "class"])]))
    near = brown._packed(np.array([9]), np.array([0, 1]), np.array([1]), np.array([3]))
    chosen = pa.Table.from_batches(brown._choose(SimpleNamespace(value=model))(iter([*own, *near])))
    assert chosen.select(["word", "class"]).to_pylist() == [{"word": 9, "class": 0}]
