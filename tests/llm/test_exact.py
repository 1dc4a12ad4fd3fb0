import hashlib
import re
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from llm_samples import LONG, docs  # noqa: F401

from siltframe.llm import exact


def brute(rows):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = defaultdict(list)
    for i, t in rows:
        groups[norm(t)].append(i)
    out = []
    for i, t in rows:
        ids = groups[norm(t)]
        keep = min((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
    return sorted(out, key=repr)


TEXTS = ["a b", "a  b", "a\tb ", " a b", None, "", "  ", "\n", LONG, LONG.replace(" ", "\n"), "a b", "é", "É"]


def test_groups_equal_brute_force(docs):
    rows = list(enumerate(TEXTS))
    assert sorted(map(tuple, exact.exact_duplicates(docs(*TEXTS)).collect()), key=repr) == brute(rows)
    assert exact.exact_duplicates(docs()).count() == 0


def test_colliding_fingerprints_are_told_apart(docs):
    texts = [f"{a}{b}" for a in "abcdef" for b in "abcdef"] * 2
    got = exact.exact_duplicates(docs(*texts), primes=(2, 3)).collect()
    assert sorted(map(tuple, got), key=repr) == brute(list(enumerate(texts)))


def test_null_and_repeated_ids(docs):
    ids = [None, 3, 3, None]
    texts = ["a", "a", "a", "b"]
    got = exact.exact_duplicates(docs(*texts, ids=ids)).select("doc_id", "keep_id", "group_size", "kept").collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(None, None, 1, True), (3, 3, 2, True), (3, 3, 2, True), (None, None, 1, True)], key=repr)


@settings(max_examples=50, deadline=None)
@given(st.binary(max_size=200), st.integers(0, 200), st.integers(1, 50))
def test_any_cut_gives_the_same_fingerprint(data, at, chunk):
    whole = exact.Fingerprint()(data)
    assert exact.Fingerprint(chunk_bytes=chunk)(data) == whole
    for k, prime in enumerate(exact.PRIMES):
        part = lambda x: (exact.Fingerprint()(x) >> (31 * (1 - k)) & (1 << 31) - 1, len(x))  # noqa: B023, E731
        assert exact.combine(part(data[:at]), part(data[at:]), prime) == part(data)


def test_an_id_may_have_several_texts(docs):
    rows = [(1, "alpha beta"), (2, "alpha  beta"), (2, "other text"), (3, "other text"), (2, "alpha beta"), (None, "other text")]
    got = exact.exact_duplicates(docs(*[t for _, t in rows], ids=[i for i, _ in rows])).select("doc_id", "keep_id", "group_size", "kept").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(
        [(1, 1, 3, True), (2, 1, 3, False), (2, 1, 3, False), (2, 2, 2, True), (3, 2, 2, False), (None, None, 1, True)], key=repr
    )


def test_colliding_texts_under_one_id(docs):
    rows = [(i % 3, f"{a}{b}") for i, (a, b) in enumerate((a, b) for a in "abcd" for b in "abcd")] * 2
    got = exact.exact_duplicates(docs(*[t for _, t in rows], ids=[i for i, _ in rows]), primes=(2, 3)).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)
