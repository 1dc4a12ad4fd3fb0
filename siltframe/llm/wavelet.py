"""Token ids of a corpus as wavelet matrices, one compressed file per shard.

Documents are tokenised, closed with an end id and written in ascending order of doc_id (rows without one last, repeated
ids by length and content). A shard is a run of whole documents of about ``shard_tokens`` ids. Its file holds a wavelet
matrix: for every bit of an id, from the highest, one plane of bits, after which the zeros of the plane go before its
ones. With counts of ones every BLOCK bits, a file answers from its planes which id stands at a place (``access``), how
often an id occurs before a place (``rank``, ``count``) and where it occurs (``select``, ``occurrences``), without
spelling out the ids.

Files are written by the tasks to a hidden name and then moved, so a task that is run again leaves at most a file that
no manifest names; the manifest is the table that Spark commits. ``path`` may be local or anything pyarrow opens by its
scheme. Files are read back by Spark.

File: MAGIC, a JSON header with its length in front (ids, documents, planes, zeros of each plane, length of every
section), then the sections, each compressed by zstd: the planes, the counts, the documents' ids, their null flags and
the ends of the documents.

Null text is an empty document: the end id alone. Repeated rows are kept once each. Extra columns are ignored. An empty
table gives no file and no rows.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .encode import WordEncoder, grouped
from .store import prepare, stored

END_ID = 2
#: Ids in a shard and in the rows that one task writes.
SHARD_TOKENS, TASK_TOKENS = 1 << 22, 1 << 26
#: Bits between two counts of ones.
BLOCK = 512
MAGIC = b"SWM1"
_U = np.uint64
_WORDS = BLOCK // 64

class Plane(NamedTuple):
    """Bits of a plane in 64-bit words, ones before every BLOCK bits, and the number of zeros."""

    words: np.ndarray
    ones: np.ndarray
    zeros: int

    @classmethod
    def of(cls, bits: np.ndarray) -> Plane:
        size = -(-(len(bits) + 1) // BLOCK) * BLOCK // 8  # a block follows every place up to the end
        packed = np.zeros(size, np.uint8)
        packed[: -(-len(bits) // 8)] = np.packbits(bits, bitorder="little")
        words = packed.view("<u8")
        ones = np.zeros(len(words) // _WORDS + 1, np.uint32)
        ones[1:] = np.cumsum(np.bitwise_count(words).reshape(-1, _WORDS).sum(axis=1, dtype=np.int64))
        return cls(words, ones, len(bits) - int(bits.sum()))

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(_U)) & _U(1) == 1

    def rank1(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word, out = at >> 6, self.ones[at // BLOCK].astype(np.int64)
        first = at // BLOCK * _WORDS
        for k in range(_WORDS - 1):
            inside = first + k < word
            if not inside.any():
                break
            out += np.where(inside, np.bitwise_count(self.words[first + k]), 0)
        below = (_U(1) << (at & 63).astype(_U)) - _U(1)
        return out + np.bitwise_count(self.words[word] & below)

    def select(self, bit: int, number: np.ndarray) -> np.ndarray:
        """The place of each bit of the kind with that many before it."""
        before = self.ones.astype(np.int64)
        if not bit:
            before = np.arange(len(before)) * BLOCK - before
        block = np.searchsorted(before, number, "right") - 1
        left, word = number - before[block], block * _WORDS
        found = np.zeros(len(number), bool)
        for k in range(_WORDS):
            words = self.words[block * _WORDS + k]
            here = np.bitwise_count(words if bit else ~words).astype(np.int64)
            passed = ~found & (left >= here)
            found |= ~passed
            left, word = np.where(passed, left - here, left), np.where(passed, word + 1, word)
        words = self.words[word] if bit else ~self.words[word]
        place = np.zeros(len(number), np.int64)
        for width in (32, 16, 8, 4, 2, 1):
            low = words >> place.astype(_U) & _U((1 << width) - 1)
            here = np.bitwise_count(low).astype(np.int64)
            up = left >= here
            left, place = np.where(up, left - here, left), np.where(up, place + width, place)
        return word * 64 + place


class WaveletMatrix:
    def __init__(self, n: int, planes: list[Plane]):
        self.n, self.planes = n, planes

    @classmethod
    def of(cls, ids: np.ndarray, depth: int) -> WaveletMatrix:
        planes = []
        for k in range(depth - 1, -1, -1):
            bits = ids & ids.dtype.type(1 << k) != 0
            planes.append(Plane.of(bits))
            ids = np.concatenate([ids.compress(~bits), ids.compress(bits)])
        return cls(len(ids), planes)

    def _bits(self):
        """(bit of the id, plane) from the highest bit."""
        return [(len(self.planes) - 1 - k, plane) for k, plane in enumerate(self.planes)]

    def access(self, at: np.ndarray) -> np.ndarray:
        """Ids at the places ``at``."""
        at, out = np.asarray(at, np.int64), np.zeros(len(at), np.uint32)
        for k, plane in self._bits():
            ones, bit = plane.rank1(at), plane.get(at)
            out |= bit.astype(np.uint32) << np.uint32(k)
            at = np.where(bit, plane.zeros + ones, at - ones)
        return out

    def _range(self, token: int, end: int) -> tuple[int, int]:
        """Where the occurrences of ``token`` before ``end`` lie below the last plane."""
        span = np.array([0, end if token >> len(self.planes) == 0 else 0], np.int64)
        for k, plane in self._bits():
            ones = plane.rank1(span)
            span = plane.zeros + ones if token >> k & 1 else span - ones
        return int(span[0]), int(span[1])

    def rank(self, token: int, end: int) -> int:
        low, high = self._range(token, end)
        return high - low

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, number: np.ndarray) -> np.ndarray:
        """Places of the occurrences with that many occurrences before them."""
        low, high = self._range(token, self.n)
        at = low + np.asarray(number, np.int64)
        if len(at) and (at.min() < low or at.max() >= high):
            raise IndexError("no such occurrence")
        for k, plane in reversed(self._bits()):
            bit = token >> k & 1
            at = plane.select(bit, at - plane.zeros if bit else at)
        return at

    def occurrences(self, token: int) -> np.ndarray:
        return self.select(token, np.arange(self.count(token)))

    def ids(self) -> np.ndarray:
        """All ids, by undoing the planes from the last to the first."""
        out = np.zeros(self.n, np.uint32)
        for k, plane in reversed(self._bits()):
            bits = np.unpackbits(plane.words.view(np.uint8), count=self.n, bitorder="little").view(bool)
            above = np.empty(self.n, np.uint32)
            above[np.flatnonzero(~bits)] = out[: plane.zeros]
            above[np.flatnonzero(bits)] = out[plane.zeros :] | np.uint32(1 << k)
            out = above
        return out


class Shard(NamedTuple):
    """A wavelet matrix with the ids of its documents (None for rows without one) and where each of them ends."""

    matrix: WaveletMatrix
    doc_ids: pa.Array
    ends: np.ndarray

    def starts(self) -> np.ndarray:
        return np.concatenate([[0], self.ends[:-1]]).astype(np.int64)

    def document(self, number: int) -> np.ndarray:
        """Ids of one document, read from the planes."""
        return self.matrix.access(np.arange(self.starts()[number], self.ends[number]))

    def to_bytes(self) -> bytes:
        numbers = self.doc_ids.fill_null(0).to_numpy()
        sections = [*[p.words for p in self.matrix.planes], *[p.ones for p in self.matrix.planes]]
        sections += [numbers.astype("<i8"), np.asarray(self.doc_ids.is_null()), self.ends.astype("<i8")]
        codec, raw = pa.Codec("zstd", compression_level=1), [np.ascontiguousarray(s).tobytes() for s in sections]
        packed = [codec.compress(x, asbytes=True) if x else b"" for x in raw]
        head = {"ids": self.matrix.n, "documents": len(self.ends), "planes": len(self.matrix.planes),
                "zeros": [p.zeros for p in self.matrix.planes], "sections": [[len(a), len(b)] for a, b in zip(packed, raw)]}
        text = json.dumps(head).encode()
        return b"".join([MAGIC, len(text).to_bytes(4, "little"), text, *packed])

    @classmethod
    def from_bytes(cls, data: bytes) -> Shard:
        if data[:4] != MAGIC:
            raise ValueError("not a shard file")
        size = int.from_bytes(data[4:8], "little")
        head, at, codec, parts = json.loads(data[8 : 8 + size]), 8 + size, pa.Codec("zstd"), []
        for packed, raw in head["sections"]:
            parts.append(codec.decompress(data[at : at + packed], raw, asbytes=True) if raw else b"")
            at += packed
        n = head["planes"]
        words, ones = ([np.frombuffer(x, t) for x in part] for part, t in ((parts[:n], "<u8"), (parts[n : 2 * n], "<u4")))
        ids, null, ends = np.frombuffer(parts[-3], "<i8"), np.frombuffer(parts[-2], bool), np.frombuffer(parts[-1], "<i8")
        return cls(WaveletMatrix(head["ids"], [Plane(*p) for p in zip(words, ones, head["zeros"])]), pa.array(ids, mask=null), ends)


def _encoder(vocabulary, end_id: int, kind: str):
    def encoded(batches):
        held, end = vocabulary.value, np.array([end_id], kind).tobytes()
        if "encoder" not in held:  # a worker keeps what it was sent, so its next tasks find the words it knows
            held["encoder"] = WordEncoder(held["text"], kind)
        encode = held["encoder"]
        for batch in grouped(batches):
            ids = [x + end for x in encode(batch.column("text"))]
            sizes, marks = [len(x) // np.dtype(kind).itemsize for x in ids], [zlib.crc32(x) for x in ids]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(marks, pa.int64()), pa.array(ids, pa.binary())],
                ["doc_id", "n_tokens", "mark", "ids"],
            )

    return encoded


def _opened(path: str):
    """The file system of ``path`` and the path in it."""
    from pyarrow import fs

    plain = re.sub(r"^file:/+", "/", path)
    return (fs.LocalFileSystem(), plain) if plain.startswith("/") else fs.FileSystem.from_uri(plain)


_MANIFEST = "file string, task int, shard int, n_documents long, n_tokens long"


def _writer(path: str, shard_tokens: int, depth: int, kind: str):
    def written(batches):
        system, folder = _opened(path)
        system.create_dir(folder, recursive=True)
        task, shard = TaskContext.get().partitionId(), 0
        docs, ids, sizes = [], [], []

        def write():
            name = f"{task:07d}-{shard:05d}-{uuid.uuid4().hex}.swm"
            values = np.frombuffer(b"".join(ids), kind)
            made = Shard(WaveletMatrix.of(values, depth), pa.array(docs, pa.int64()), np.cumsum(sizes, dtype=np.int64))
            with system.open_output_stream(f"{folder}/_{name}") as out:
                out.write(made.to_bytes())
            system.move(f"{folder}/_{name}", f"{folder}/{name}")
            columns = [pa.array([v], t) for v, t in ((name, pa.string()), (task, pa.int32()), (shard, pa.int32()), (len(docs), pa.int64()), (len(values), pa.int64()))]
            return pa.RecordBatch.from_arrays(columns, ["file", "task", "shard", "n_documents", "n_tokens"])

        held = 0
        for batch in batches:
            for doc, size, part in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n_tokens", "ids"))):
                docs.append(doc)
                sizes.append(size)
                ids.append(part)
                held += size
                if held >= shard_tokens:
                    yield write()
                    docs, ids, sizes, held, shard = [], [], [], 0, shard + 1
        if docs:
            yield write()

    return written


def write_shards(
    docs: DataFrame, vocabulary_path: str, path: str, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS, task_tokens: int = TASK_TOKENS
) -> DataFrame:
    """Write the files of ``docs`` (doc_id, text) to the folder ``path``; returns the manifest.

    The manifest has a row for each shard: file, task, shard, n_documents, n_tokens and start, the number of ids in all
    shards before it.
    """
    spark = prepare(docs.sparkSession)
    with open(vocabulary_path, encoding="utf-8") as file:
        text = file.read()
    from tokenizers import Tokenizer

    largest = max(end_id, *Tokenizer.from_str(text).get_vocab(with_added_tokens=True).values())
    depth, kind = max(1, largest.bit_length()), "<u2" if largest < 1 << 16 else "<u4"
    vocabulary = spark.sparkContext.broadcast({"text": text})
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    encoded = stored(rows.mapInArrow(_encoder(vocabulary, end_id, kind), "doc_id long, n_tokens long, mark long, ids binary"), "token_ids")
    total = encoded.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    tasks = max(-(-total // task_tokens), min(spark.sparkContext.defaultParallelism, -(-total // shard_tokens)), 1)
    keys = [F.col("doc_id").asc_nulls_last(), F.col("n_tokens").asc(), F.col("mark").asc()]
    ordered = encoded.repartitionByRange(tasks, *keys).sortWithinPartitions(*keys).select("doc_id", "n_tokens", "ids")
    # Not narrow: the number of a task is the place of its range, which a coalesced plan would give up.
    shards = stored(ordered.mapInArrow(_writer(path, shard_tokens, depth, kind), _MANIFEST), "manifest")
    # One row per task, and in a task one row per shard: no window holds more.
    before = lambda *keys: F.coalesce(F.sum("n_tokens").over(Window.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    by_task = shards.groupBy("task").agg(F.sum("n_tokens").alias("n_tokens")).select("task", before("task").alias("first"))
    placed = shards.withColumn("own", before("task", "shard")).join(by_task, "task")
    return stored(placed.select(*shards.columns, (F.col("first") + F.col("own")).alias("start")), "shards", narrow=True)


def _read(spark: SparkSession, path: str, manifest: DataFrame, task, schema: str) -> DataFrame:
    """What ``task`` makes of every file (columns file, content) that the manifest names, with the shard's start."""
    if manifest.isEmpty():
        return spark.createDataFrame([], schema).join(manifest.select("file", "start"), "file")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.swm").load(path)
    named = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    # Files are opened before the join: their contents are never shuffled, and rows of an unnamed file drop out.
    return named.mapInArrow(task, schema).join(manifest.select("file", "start"), "file")


def _documents(batches):
    for batch in batches:
        for name, content in zip(batch.column("file").to_pylist(), batch.column("content")):
            shard = Shard.from_bytes(content.as_py())
            ids, starts = shard.matrix.ids().astype("<u4", copy=False), shard.starts()
            sums = [zlib.crc32(ids[a:b].data) for a, b in zip(starts, shard.ends)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(sums), pa.string()), shard.doc_ids, pa.array(starts), pa.array(shard.ends - starts), pa.array(sums, pa.int64())],
                ["file", "doc_id", "place", "n_tokens", "ids_crc32"],
            )


def documents(spark: SparkSession, path: str, manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and crc32 of the ids of every document, read from the files."""
    found = _read(spark, path, manifest, _documents, "file string, doc_id long, place long, n_tokens long, ids_crc32 long")
    return found.select("doc_id", (F.col("start") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")


def _finder(tokens: list[int]):
    def found(batches):
        for batch in batches:
            for name, content in zip(batch.column("file").to_pylist(), batch.column("content")):
                shard = Shard.from_bytes(content.as_py())
                for token in tokens:
                    at = shard.matrix.occurrences(token)
                    doc = np.searchsorted(shard.ends, at, "right")
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(at), pa.string()), pa.array([token] * len(at), pa.int64()), shard.doc_ids.take(pa.array(doc)),
                         pa.array(at), pa.array(at - shard.starts()[doc])],
                        ["file", "token", "doc_id", "place", "offset"],
                    )

    return found


def occurrences(spark: SparkSession, path: str, manifest: DataFrame, tokens: list[int]) -> DataFrame:
    """Where the given ids occur: token, doc_id, offset in the document and place among the ids of the corpus."""
    found = _read(spark, path, manifest, _finder(tokens), "file string, token long, doc_id long, place long, offset long")
    return found.select("token", "doc_id", "offset", (F.col("start") + F.col("place")).alias("place"))


def _counter(tokens: list[int]):
    def counted(batches):
        for batch in batches:
            for name, content in zip(batch.column("file").to_pylist(), batch.column("content")):
                matrix = Shard.from_bytes(content.as_py()).matrix
                sums = pa.array([matrix.count(t) for t in tokens], pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(tokens), pa.string()), pa.array(tokens, pa.int64()), sums], ["file", "token", "n"])

    return counted


def token_counts(spark: SparkSession, path: str, manifest: DataFrame, tokens: list[int]) -> DataFrame:
    """How often the given ids occur in the corpus: token, n."""
    found = _read(spark, path, manifest, _counter(tokens), "file string, token long, n long")
    return found.groupBy("token").agg(F.sum("n").alias("n"))


def round_trip(docs: DataFrame, vocabulary_path: str, path: str | None = None) -> DataFrame:
    """Write ``docs`` as files, below ``spark.checkpoint.dir`` unless a path is given, and describe them from there."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "wavelet")
    return documents(spark, path, write_shards(docs, vocabulary_path, path))
