import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from llm_samples import LONG, docs  # noqa: F401

from siltframe.llm import packing
from siltframe.llm.queries import tokenizer_path

PATH = tokenizer_path("word_bpe_49k.json")
TEXTS = [None, "", "The Größe, été. niño", "a<|endoftext|>b <|ENDOFTEXT|>", "don't 12.5 … á İ ΣΑΣ", LONG, "x y " * 3000, "The the", "The the"]


def test_pieces_and_places(docs):
    got = packing.packed(docs(*TEXTS), PATH, shard_pieces=4).toPandas()
    tokenizer = Tokenizer.from_file(PATH)
    assert sorted(got["doc_id"].unique()) == list(range(len(TEXTS)))
    for doc, rows in got.sort_values("piece").groupby("doc_id"):
        ids = np.array([*tokenizer.encode(TEXTS[doc] or "", add_special_tokens=False).ids, 1], "<u4")
        cuts = range(0, len(ids), 4096)
        assert list(zip(rows["piece"], rows["start"], rows["length"], rows["ids_crc32"])) == [
            (k, a, len(ids[a : a + 4096]), zlib.crc32(ids[a : a + 4096].tobytes())) for k, a in enumerate(cuts)
        ]
    for _, rows in got.sort_values("offset").groupby("sequence_id"):
        assert rows["length"].sum() <= 4096 and list(rows["offset"]) == list(np.cumsum(rows["length"]) - rows["length"])
    assert packing.packed(docs(), PATH).count() == 0


def test_repeated_rows_are_packed_once_each(docs):
    got = packing.packed(docs("a", "a", "b", ids=[1, 1, None]), PATH).collect()
    assert sorted((r["doc_id"] or 0, r["length"]) for r in got) == [(0, 2), (1, 2), (1, 2)]
    assert len({(r["sequence_id"], r["offset"]) for r in got}) == 3


@pytest.mark.parametrize("lengths, best", [([6, 6, 6, 4, 4, 4], 3), ([5, 5, 4, 4, 3, 3, 3, 3], 3), ([7, 7, 3, 3], 2), ([6, 6, 6], 3), ([], 0)])
def test_small_packings(lengths, best):
    sizes = np.array(lengths, np.int64)
    assert len([b for b in packing.local_search(packing.best_fit(sizes, 10), sizes, 10) if b]) == best


def test_local_search_empties_sequences_and_keeps_all_pieces():
    sizes = np.array([5, 5, 4, 4, 6, 6])
    start = [[0, 2], [1, 3], [4], [5]]  # 9, 9, 6 and 6 of 10: four sequences, three suffice
    done = packing.local_search(start, sizes, 10)
    assert sorted(i for b in done for i in b) == list(range(6)) and len(done) == 3
    chance = np.random.default_rng(0)
    for low, high in ((1, 4096), (1200, 2800), (600, 900)):
        sizes = chance.integers(low, high, 800)
        first = packing.best_fit(sizes, 4096)
        done = packing.local_search(first, sizes, 4096)
        assert sorted(i for b in done for i in b) == list(range(800)) and len(done) <= len(first)
        assert max(sizes[b].sum() for b in done) <= 4096


def test_rows_without_an_id_spread_over_shards(docs):
    """Repeated texts without an id are as one key in every column; no shard may get most of them."""
    texts = ["some words " * 150] * 600
    got = packing.packed(docs(*texts, ids=[None] * len(texts)), PATH, shard_pieces=100).toPandas()
    assert len(got) == 600 and (got["length"] == got["length"].iloc[0]).all()
    sequences = got["sequence_id"].to_numpy()
    _, rows_of = np.unique(sequences[sequences >> 58 == 0] >> 24, return_counts=True)
    assert len(rows_of) == 6 and rows_of.max() <= 200
    for _, rows in got.sort_values("offset").groupby("sequence_id"):
        assert rows["length"].sum() <= 4096 and list(rows["offset"]) == list(np.cumsum(rows["length"]) - rows["length"])


def test_letters_go_to_the_merges_once_whatever_stands_behind_them():
    with open(PATH, encoding="utf-8") as file:
        encode = packing.WordEncoder(file.read())
    tokenizer, texts = Tokenizer.from_file(PATH), ['Größndhain größndhain! größndhain) größndhain;" größndhain.', *(x for x in TEXTS if x)]
    full, letters, words = [], [], encode.words
    run, direct = words.full, words.letters
    words.full = lambda x: full.append(x) or run(x)
    words.letters = lambda x: letters.append(x) or direct(x)
    for k, text in enumerate(texts):
        ids = np.frombuffer(encode([text])[0], "<u4").tolist()
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids
        if not k:
            assert len(set(full)) == len(full) and set(full) == {"!", ")", ';"', "."} and len(letters) <= 2
