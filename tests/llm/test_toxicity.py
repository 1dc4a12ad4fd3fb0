import random
import zlib

import numpy as np

from llm_samples import LONG

from siltframe.llm import toxicity
from siltframe.llm.symbols import SYMBOLS, grams


PLAIN, BAD = ["the", "river", "runs", "over", "stones", "and", "under", "trees"], ["zugmax", "zugbold", "zugrine"]


def corpus(n, plain=PLAIN, bad=BAD):
    chance = random.Random(3)
    rows = []
    for i in range(n):
        toxic = int(i % 4 == 0)
        words = chance.choices(plain, k=chance.randrange(20, 80))
        for _ in range(3 * toxic):
            words.insert(chance.randrange(len(words)), chance.choice(bad))
        rows.append((i, " ".join(words), toxic))
    return rows


def test_held_out_documents(frame):
    rows = corpus(600)
    docs = frame("doc_id long, text string, toxic int, x string", *[(i, t, 1 - y, "c") for i, t, y in rows], (900, None, 0, ""), (901, "", 0, ""), (902, LONG, 0, ""), (None, "zugmax", 0, ""))
    labels = frame("doc_id long, quality int, toxic int, text string", *[(i, 0, y, "") for i, _, y in rows], (900, 0, None, ""), (None, 0, 1, ""), (0, 0, 1, ""))
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs, labels).collect()}
    assert len(got) == 604 and all(0 <= r["score"] <= 1 for r in got.values())
    held = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(got[i]["held_out"] == (i in held) for i, _, _ in rows)
    assert all(got[i]["predicted"] == rows[i][2] for i in held)
    assert got[900]["score"] == got[901]["score"] and got[900]["predicted"] == 0


def test_without_labels_or_documents(frame):
    docs = frame("doc_id long, text string", (1, "a b"), (2, None))
    labels = frame("doc_id long, toxic int")
    assert [r["score"] for r in toxicity.toxicity(docs, labels).collect()] == [0.0, 0.0] or all(r["score"] < 1e-9 for r in toxicity.toxicity(docs, labels).collect())
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0


def test_kneser_ney_is_a_distribution():
    counts = np.zeros(SYMBOLS**3, np.int64)
    for block in grams("the cat sat on the mat and the dog sat too", 3):
        np.add.at(counts, block, 1)
    shared = toxicity.continuations(toxicity.continuations(counts))
    p = toxicity.kneser_ney(counts, shared, order=3)
    assert np.allclose(p.reshape(-1, SYMBOLS).sum(1), 1) and (p > 0).all()


def test_grams_do_not_depend_on_blocks(monkeypatch):
    text = "Été  à la   mer!! 12 -- \n «мир, война» ok 世界。 " * 9
    whole = np.concatenate(list(grams(text, 3)))
    monkeypatch.setattr("siltframe.llm.symbols.BLOCK_CHARS", 7)
    assert (np.concatenate(list(grams(text, 3))) == whole).all()


def test_scripts_beyond_latin(frame):
    """The same words letter by letter in another script, also between Latin ones, are told apart as well."""
    moved = str.maketrans({chr(97 + k): chr(0x430 + k) for k in range(26)})
    rows = corpus(600, [w.translate(moved) for w in PLAIN[:6]] + PLAIN[6:], [w.translate(moved) for w in BAD])
    labels = frame("doc_id long, toxic int", *[(i, y) for i, _, y in rows])
    got = toxicity.toxicity(frame("doc_id long, text string", *[r[:2] for r in rows]), labels).collect()
    assert all(r["predicted"] == rows[r["doc_id"]][2] for r in got if r["held_out"])


def test_planes_keep_scripts_apart():
    latin, other = (np.concatenate(list(grams(t, 4))) for t in ("abc, abc", "абв, абв"))
    assert (latin < SYMBOLS**4).all() and len(set(latin) & set(other)) <= 1  # the leading white space
    letters = np.concatenate(list(grams("абвгдежзийклмнопрстуфхцчшщъыьэюя", 2))) % SYMBOLS
    assert len(set(letters[:-1])) == 31


def test_kneser_ney_equals_brute_force():
    """Absolutely discounted counts over continuation counts, word for word from the definition."""
    text, order = " the cat sat on the mat and the dog sat", 3
    found = np.concatenate(list(grams(text, order)))
    counts = np.bincount(found, minlength=SYMBOLS**order)
    digits = lambda g, n: tuple(g // SYMBOLS**k % SYMBOLS for k in reversed(range(n)))
    count = [{digits(g, order): int(n) for g, n in enumerate(counts) if n}]
    for _ in range(order - 1):
        ends: dict = {}
        for g in count[-1]:
            ends[g[1:]] = ends.get(g[1:], 0) + 1
        count.append(ends)
    shared = np.zeros(SYMBOLS)
    for (s,), n in count[-1].items():
        shared[s] = n

    def p(gram):
        if len(gram) == 1:
            return (shared[gram[0]] + 0.5) / (shared + 0.5).sum()
        of = {g: n for g, n in count[order - len(gram)].items() if g[:-1] == gram[:-1]}
        if not of:
            return p(gram[1:])
        return (max(of.get(gram, 0) - 0.75, 0) + 0.75 * len(of) * p(gram[1:])) / sum(of.values())

    got = toxicity.kneser_ney(counts, shared, order)
    for g in [*set(found.tolist()), 0, 5, 1000, 20_000, SYMBOLS**order - 1]:
        assert np.isclose(got[g], p(digits(g, order)))
