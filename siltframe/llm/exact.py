"""Exact duplicates by composable polynomial fingerprints.

A text is normalised (every run of ``[\\x20\\x09-\\x0D]`` becomes one space) and cut into chunks. The fingerprint of a
chunk is a polynomial in its bytes modulo two primes of 31 bits; the fingerprint of two neighbours is
``left * BASE ** len(right) + right``, so chunks are hashed independently of each other and folded afterwards, and any
cut gives the same number. Texts of equal fingerprint and length are then compared chunk by chunk with the smallest
id of their group; those that differ after all are grouped anew until none is left.

Null text counts as empty. An id may stand on several rows, with one text or with many: every row belongs to the group
of its own text. Rows of a group that share its smallest doc_id all stay. Rows without a doc_id cannot be named by one:
they are grouped among themselves and all stay. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import prepare, sieve, stored

CHUNK_BYTES = 1 << 16
PRIMES = (2147483647, 2147483629)
BASE = 1_000_003
#: Members compared with one copy of their group's first text.
COMPANY = 64
#: Hexadecimal digits of its SHA-256 that tell the texts under one id apart.
OWN_DIGITS = 15
#: Columns of a text that is compared: its leader, their share of the leader's company, and the text itself.
ROLE = ["leader", "leader_own", "part", "member", "doc_id", "own"]
_SPACES = b" \t\n\r\x0b\x0c"


def normalised(text: str | None) -> bytes:
    data = (text or "").encode()
    out = b" ".join(data.split())
    if not out:
        return b" " if data else b""
    return b" " * (data[0] in _SPACES) + out + b" " * (data[-1] in _SPACES)


def combine(left: tuple[int, int], right: tuple[int, int], prime: int) -> tuple[int, int]:
    """Fingerprint and length of two neighbouring parts."""
    return (left[0] * pow(BASE, right[1], prime) + right[0]) % prime, left[1] + right[1]


class Fingerprint:
    def __init__(self, primes: tuple[int, int] = PRIMES, chunk_bytes: int = CHUNK_BYTES):
        self.primes, self.chunk_bytes = primes, chunk_bytes
        self.powers = []
        for prime in primes:
            table = [1]
            for _ in range(chunk_bytes - 1):
                table.append(table[-1] * BASE % prime)
            self.powers.append(np.array(table[::-1], np.uint64))

    def chunk(self, data: np.ndarray, k: int) -> int:
        return int(np.dot(data, self.powers[k][len(self.powers[k]) - len(data) :]) % np.uint64(self.primes[k]))

    def __call__(self, data: bytes) -> int:
        values = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
        out = []
        for k, prime in enumerate(self.primes):
            total = (0, 0)
            for at in range(0, len(values), self.chunk_bytes):
                part = values[at : at + self.chunk_bytes]
                total = combine(total, (self.chunk(part, k), len(part)), prime)
            out.append(total[0])
        return out[0] << 31 | out[1]


def _hasher(primes: tuple[int, int]):
    def hashed(batches):
        mark = Fingerprint(primes)
        for batch in batches:
            texts = [normalised(x) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([mark(x) for x in texts], pa.int64()),
                    pa.array([len(x) for x in texts], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in texts], pa.string()),
                ],
                ["doc_id", "mark", "n_bytes", "text_sha256"],
            )

    return hashed


def _cut(batches):
    """Chunks of the normalised texts; of the texts under one id those that are meant."""
    for batch in batches:
        for i, (text, own) in enumerate(zip(batch.column("text").to_pylist(), batch.column("own").to_pylist())):
            data = normalised(text)
            if int(hashlib.sha256(data).hexdigest()[:OWN_DIGITS], 16) != own:
                continue
            cuts = range(0, max(len(data), 1), CHUNK_BYTES)
            rest = [pa.array([batch.column(c)[i].as_py()] * len(cuts), batch.column(c).type) for c in ROLE]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array(range(len(cuts)), pa.int32()), pa.array([data[a : a + CHUNK_BYTES] for a in cuts], pa.binary())],
                [*ROLE, "chunk", "data"],
            )


def _differing(batches):
    """Members with a chunk unlike their leader's; rows come by leader, part and chunk, the leader's first."""
    head = None
    for batch in batches:
        members, chunks = batch.column("member").to_pylist(), batch.column("data")
        out = []
        for i, member in enumerate(members):
            if not member:
                head = chunks[i].as_py()
            elif chunks[i].as_py() != head:
                out.append(i)
        yield batch.select(["doc_id", "own"]).take(pa.array(out, pa.int64()))


def _unequal(members: DataFrame, docs: DataFrame) -> DataFrame:
    """Those of ``members`` (doc_id, own, leader, leader_own) whose text is not the leader's."""
    wanted = members.select("doc_id").union(members.select("leader")).distinct()
    texts = sieve(wanted, docs, "doc_id")
    busy = members.groupBy("leader", "leader_own").agg(F.ceil(F.count("*") / COMPANY).alias("groups"))
    dealt = members.join(busy, ["leader", "leader_own"]).select(
        "leader", "leader_own", F.expr("pmod(xxhash64(doc_id, own), groups)").alias("part"), F.lit(True).alias("member"), "doc_id", "own"
    )
    heads = dealt.select("leader", "leader_own", "part").distinct()
    roles = dealt.union(heads.select("*", F.lit(False), F.col("leader"), F.col("leader_own")))
    rows = texts.join(roles.hint("merge"), "doc_id")  # by id at every size: how many roles there are is not known ahead
    rows = rows.select(*ROLE, "text")
    chunks = rows.mapInArrow(_cut, "leader long, leader_own long, part long, member boolean, doc_id long, own long, chunk int, data binary")
    ordered = chunks.repartition("leader", "leader_own", "part").sortWithinPartitions("leader", "leader_own", "part", "chunk", "member")
    return ordered.mapInArrow(_differing, "doc_id long, own long").distinct()


def exact_duplicates(docs: DataFrame, primes: tuple[int, int] = PRIMES) -> DataFrame:
    """One row per row of ``docs`` (doc_id long, text): doc_id, keep_id, group_size, kept, text_sha256."""
    prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    hashed = docs.mapInArrow(_hasher(primes), "doc_id long, mark long, n_bytes long, text_sha256 string")
    own = F.conv(F.substring("text_sha256", 1, OWN_DIGITS), 16, 10).cast("long").alias("own")
    hashed = stored(hashed.select("*", own), "hashed")
    mark, row, settled = ["mark", "n_bytes"], ["doc_id", "own"], None
    open_rows = hashed.where("doc_id is not null").select(*row, *mark)
    while True:
        one = F.struct(*row)
        groups = open_rows.groupBy(*mark).agg(F.min(one).alias("first"), F.max(one).alias("last")).where("first < last")
        groups = groups.select(*mark, F.col("first.doc_id").alias("leader"), F.col("first.own").alias("leader_own"))
        members = open_rows.join(groups, mark).where("doc_id > leader or own <> leader_own").distinct()
        members = stored(members, "members", narrow=True)
        unequal = stored(_unequal(members, docs), "unequal", narrow=True)
        same = members.join(unequal, row, "left_anti")
        settled = same if settled is None else settled.union(same)
        if unequal.isEmpty():
            break
        open_rows = members.join(unequal, row, "left_semi").select(*row, *mark)
    found = (
        hashed.join(settled, [*row, *mark], "left")
        .select(*row, *mark, "text_sha256", F.coalesce("leader", "doc_id").alias("keep_id"), F.coalesce("leader_own", "own").alias("keep_own"))
    )
    group = [*mark, "keep_id", "keep_own"]
    sizes = found.groupBy(*group).agg(F.count("*").alias("group_size"))
    return (
        found.alias("f").join(sizes.alias("s"), [F.col(f"f.{c}").eqNullSafe(F.col(f"s.{c}")) for c in group])
        .select("f.doc_id", "f.keep_id", "s.group_size", F.col("f.doc_id").eqNullSafe(F.col("f.keep_id")).alias("kept"), "f.text_sha256")
    )
