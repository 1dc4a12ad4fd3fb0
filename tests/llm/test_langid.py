import random
import zlib

import numpy as np

from llm_samples import LONG

from siltframe.llm import langid

PARTS = {"aa": "ka mi to ru", "ab": "ka mi to re", "ba": "schlu grem drau", "bb": "schlu grem brie"}


def test_held_out_languages(frame):
    chance = random.Random(5)
    rows = []
    for i in range(400):
        lang = list(PARTS)[i % 4]
        rows.append((i, " ".join("".join(chance.choices(PARTS[lang].split(), k=3)) for _ in range(15)), lang))
    odd = [(900, None, "aa"), (901, "", "aa"), (902, " 12 .. ", "ab"), (903, LONG, None), (None, "kamito", None)]
    schema = "doc_id long, text string, lang string, lang_pred int, score string"
    docs = frame(schema, *[(*r, 1, "x") for r in rows + odd])
    got = {r["doc_id"]: r for r in langid.languages(docs).collect()}
    assert len(got) == 405 and all(0 <= r["score"] <= 1 for r in got.values())
    for i, _, lang in rows:
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert got[i]["lang_pred"] == lang
    assert [got[i]["lang_pred"] for i in (900, 901, 902)] == ["und"] * 3
    assert got[903]["lang_pred"] in PARTS and got[None]["lang_pred"] in ("aa", "ab")
    assert langid.languages(docs.limit(0)).count() == 0


def test_nothing_to_learn_from(frame):
    docs = frame("doc_id long, text string, lang string", (1, "abc", None), (1, "abc", None))
    assert [tuple(r)[2:] for r in langid.languages(docs).collect()] == [("und", 0.0)] * 2


def test_families_join_similar_languages():
    centres = np.array([[1, 0.1, 0], [0, 1, 0.2], [1, 0.2, 0], [0, 1, 0.1]])
    assert sorted(map(sorted, langid.families(centres))) == [[0, 2], [1, 3]]


def _words(chance, start, letters, weights):
    """Fifteen words of letters from a script that begins at ``start``, drawn with ``weights``."""
    draw = lambda: "".join(chr(start + k) for k in chance.choices(letters, weights, k=chance.randrange(2, 8)))
    return " ".join(draw() for _ in range(15))


def test_languages_beyond_latin_letters(frame):
    """Two languages of one script, and the same words in scripts whose code points are equal modulo 4 and 32."""
    chance, rows = random.Random(9), []
    common, letters = [9] * 4 + [1] * 12, range(16)
    kinds = {"ca": (0x430, common), "cb": (0x430, common[::-1]), "ga": (0x10D0, common), "ta": (0xE10, common), "ha": (0x4E10, common)}
    for i in range(600):
        lang = list(kinds)[i % len(kinds)]
        start, weights = kinds[lang]
        rows.append((i, _words(chance, start, letters, weights), lang, 1))
    got = {r["doc_id"]: r for r in langid.languages(frame("doc_id long, text string, lang string, score int", *rows)).collect()}
    held = [r for r in rows if got[r[0]]["held_out"]]
    assert len(held) > 100
    assert np.mean([got[i]["lang_pred"] == lang for i, _, lang, _ in held]) >= 0.95


def test_machine_reaches_the_optimum():
    """The weights minimise the squared hinge loss: no step along any axis or at random lowers it."""
    chance = np.random.default_rng(4)
    x = chance.normal(size=(60, 4)).astype(np.float32)
    y = np.where(x[:, 0] + 0.5 * chance.normal(size=60) > 0.3, 1.0, -1.0)
    cost = np.where(y > 0, 60 / (2 * (y > 0).sum()), 60 / (2 * (y < 0).sum()))
    rows = np.c_[x, np.ones(60)]

    def loss(w):
        return 0.5 * w @ w + (cost * np.maximum(1 - y * (rows @ w), 0) ** 2).sum()

    w = langid.machine(x, y, cost=1.0, rounds=500)
    steps = [*np.eye(5), *-np.eye(5), *chance.normal(size=(50, 5))]
    assert all(loss(w + 0.02 * s) >= loss(w) - 1e-6 for s in steps)


def test_vectors_do_not_depend_on_blocks(monkeypatch):
    text = "Été  à la   мир!! 世界 12 -- \n ok " * 9
    whole = langid.vector(text)
    monkeypatch.setattr("siltframe.llm.symbols.BLOCK_CHARS", 3)
    assert np.allclose(langid.vector(text), whole)


def test_machines_of_many_languages_are_fitted_in_tasks(frame):
    draw = random.Random(5)
    letters = {f"l{k}": "".join(draw.sample("abcdefghijklmnopqrstuvwxyz", 9)) for k in range(9)}
    rows = [(i, " ".join("".join(draw.choices(letters[name], k=5)) for _ in range(25)), name) for i, name in enumerate(sorted(letters) * 40)]
    docs = frame("doc_id long, text string, lang string", *rows)
    model = langid.learn(docs, 30)
    assert sorted(sum(model.groups, [])) == list(range(9)) and len(model.groups) == 3 and len(model.weights) == len(model.pairs)
    x = {name: np.stack([langid.vector(t) for _, t, lang in rows if lang == name]) for name in letters}
    for (kind, a, b), w in zip(model.pairs, model.weights, strict=True):
        for group, side in ((a, 1), (b, -1)):
            for k in model.groups[group] if kind == "f" else [group]:
                assert (np.sign(x[model.names[k]] @ w[:-1] + w[-1]) == side).mean() >= 0.9
    got = {r["doc_id"]: r for r in langid.languages(docs, 30).collect()}
    held = [(i, name) for i, _, name in rows if got[i]["held_out"]]
    assert len(held) > 50 and sum(got[i]["lang_pred"] == name for i, name in held) >= 0.95 * len(held)


def test_an_id_on_many_rows_keeps_the_sample_small(frame):
    rows = [(1, "abc def ghi", "a"), (3, "xyz uvw rst", "b")] * 400 + [(k, f"abc{k} dea", "a") for k in range(10, 40)]
    docs = frame("doc_id long, text string, lang string", *rows)
    first, second = langid.learn(docs, 20), langid.learn(docs.repartition(7), 20)
    assert first.names == second.names and first.groups == second.groups and (first.weights == second.weights).all()
