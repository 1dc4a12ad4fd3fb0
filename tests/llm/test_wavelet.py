import os
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm_samples import LONG, docs  # noqa: F401

from siltframe.llm import wavelet as wv
from siltframe.llm.queries import tokenizer_path
from siltframe.session import scratch_path

PATH = tokenizer_path("word_bpe_49k.json")
TEXTS = [
    None, "", "The Größe, été. niño", "a<|endoftext|>b <|ENDOFTEXT|>", "don't 12.5 … á İ ΣΑΣ l' x--- y/.", LONG, "x y " * 3000,
    "The the", "The the", "word&&& w0rd!! ÄÖÜ, (419) rock'n'roll 's 'S",
]


def encoded(texts):
    tokenizer = Tokenizer.from_file(PATH)
    return [np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for t in texts]


def test_documents_read_back_from_the_files(spark, docs, tmp_path):
    ids = [9, 3, None, 4, 0, 7, 6, 3, 3, None]
    path = str(tmp_path / "shards")
    manifest = wv.write_shards(docs(*TEXTS, ids=ids), PATH, path, shard_tokens=5000, task_tokens=9000)
    got = wv.documents(spark, path, manifest).orderBy("start").collect()
    want = sorted(zip(ids, encoded(TEXTS)), key=lambda x: (x[0] is None, x[0] or 0))
    assert [r.doc_id for r in got] == [doc for doc, _ in want]
    assert [r.start for r in got] == np.cumsum([0, *[r.n_tokens for r in got[:-1]]]).tolist()
    assert sorted((r.doc_id or -1, r.n_tokens, r.ids_crc32) for r in got) == sorted((doc or -1, len(x), zlib.crc32(x.tobytes())) for doc, x in want)
    files = os.listdir(path)
    assert manifest.count() == len([f for f in files if f.endswith(".swm")]) > 2


def test_files_that_no_manifest_names_do_not_count(spark, docs, tmp_path):
    path = str(tmp_path)
    manifest = wv.write_shards(docs("a b", "c"), PATH, path)
    first = next(f for f in os.listdir(path) if f.endswith(".swm"))
    with open(f"{path}/{first}", "rb") as file, open(f"{path}/0000000-00000-again.swm", "wb") as again:
        again.write(file.read())
    assert wv.documents(spark, path, manifest).count() == 2


def test_occurrences_and_counts(spark, docs):
    path = scratch_path(spark, "occurrences")
    texts = ["the cat the", "dog the", None, "cat"]
    manifest = wv.write_shards(docs(*texts), PATH, path, shard_tokens=3)
    the, cat = (int(encoded([w])[0][0]) for w in ("the", "cat"))
    found = wv.occurrences(spark, path, manifest, [the, cat, 2, 60000])
    assert sorted(tuple(r) for r in found.where(f"token = {the}").collect()) == [(the, 0, 0, 0), (the, 0, 2, 2), (the, 1, 1, 5)], manifest.collect()
    assert sorted(tuple(r) for r in found.where(f"token = {cat}").collect()) == [(cat, 0, 1, 1), (cat, 3, 0, 8)]
    counts = {r.token: r.n for r in wv.token_counts(spark, path, manifest, [the, cat, 2, 60000]).collect()}
    assert counts == {the: 3, cat: 2, 2: 4, 60000: 0}


def test_empty_table(docs):
    assert wv.round_trip(docs(), PATH).collect() == []


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=1500), st.integers(0, 1 << 16), st.sampled_from(["<u2", "<u4"]))
def test_matrix_against_the_list(few, spread, kind):
    ids = np.array([(x * spread) % (1 << 16) for x in few], kind)
    matrix = wv.WaveletMatrix.of(ids, 16)
    assert matrix.ids().tolist() == ids.tolist() and matrix.access(np.arange(len(ids))).tolist() == ids.tolist()
    for token in {*ids[:5].tolist(), 0, 65535}:
        places = np.flatnonzero(ids == token)
        assert matrix.occurrences(token).tolist() == places.tolist() and matrix.count(token) == len(places)
        for end in (0, len(ids) // 3, len(ids)):
            assert matrix.rank(token, end) == (places < end).sum()
    with pytest.raises(IndexError):
        matrix.select(7, np.array([len(ids)]))
    ends = np.array([len(ids) // 2, len(ids)])
    shard = wv.Shard.from_bytes(wv.Shard(matrix, pa.array([5, None], pa.int64()), ends).to_bytes())
    assert shard.document(0).tolist() == ids[: ends[0]].tolist() and shard.document(1).tolist() == ids[ends[0] :].tolist()
    assert shard.doc_ids.to_pylist() == [5, None]


def test_words_with_marks_encode_as_the_library_does():
    with open(PATH, encoding="utf-8") as file:
        encode = wv.WordEncoder(file.read())
    marks = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
    texts = [f"{stem}{a}{b}" for stem in ("ab", "Été", "x") for a in marks for b in ("", ".", "-")] + TEXTS
    want = [x[:-1].tobytes() for x in encoded(texts)]
    assert encode(texts) == want and encode(texts[::-1]) == want[::-1]
