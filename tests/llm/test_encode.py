from collections import Counter

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from siltframe.llm import encode as en
from siltframe.llm.queries import tokenizer_path

PATH = tokenizer_path("word_bpe_49k.json")


def encoder():
    with open(PATH, encoding="utf-8") as file:
        return en.WordEncoder(file.read())


def library(texts):
    tokenizer = Tokenizer.from_file(PATH)
    return [np.array(tokenizer.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_a_word_is_looked_up_once_for_many_texts(monkeypatch):
    asked = Counter()

    class Noted(en._Words):
        def __getitem__(self, word):
            asked[word] += 1
            return super().__getitem__(word)

    monkeypatch.setattr(en, "_Words", Noted)
    texts = ["the cat, the dog. The cat", "a cat"] * 50
    assert encoder()(texts) == library(texts)
    assert max(asked.values()) == 1


def test_batches_are_joined_up_to_a_size(monkeypatch):
    monkeypatch.setattr(en, "GROUP_BYTES", 400)
    texts = [*["x"] * 100, "y" * 1000, "z", None]
    batches = [pa.record_batch({"doc_id": [k], "text": pa.array([x], pa.string())}) for k, x in enumerate(texts)]
    groups = list(en.grouped(iter(batches)))
    assert [x for g in groups for x in g.column("text").to_pylist()] == texts
    assert [x for g in groups for x in g.column("doc_id").to_pylist()] == list(range(len(texts)))
    assert len(groups) < 10 and all(g.column("text").nbytes <= 400 or g.num_rows == 1 for g in groups)
    assert list(en.grouped(iter([]))) == []


def test_white_space_marks_and_letters_of_other_scripts():
    texts = [None, "", " \t", *[f"{chr(c)}Ab{chr(c)}é.{chr(c)} <|{chr(c)}" for c in range(0x250)], "İx漢.Σ!", " a　b\xa0C", "B <|endoftext|>, B"]
    encode = encoder()
    assert encode(texts) == library(texts)
    assert encode(pa.array(["cut off", *texts], pa.string()).slice(1)) == library(texts)
    assert encode([]) == []


def test_remembered_words_are_bounded_and_keep_their_ids(monkeypatch):
    monkeypatch.setattr(en, "MEMO_WORDS", 5)
    encode = encoder()
    texts = [f"word{k}, the Größe{chr(97 + k)}." for k in range(20)]
    for k in (*range(20), *range(20)):
        assert encode(texts[k : k + 1]) == library(texts[k : k + 1])
        assert len(encode.words) + len(encode.words.before) < 20


def test_vocabulary_whose_letters_do_not_stand_alone():
    encode, texts = encoder(), ["The cat, don't", "größe. x"]
    encode.words.direct = False
    assert encode(texts) == library(texts)
