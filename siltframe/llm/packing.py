"""Packing of tokenised documents into sequences of bounded length.

Documents are tokenised and closed with an end id; only documents longer than a sequence are cut. Pieces are dealt by
hash into shards of bounded size. In a shard, pieces are placed by best fit, longest first; then a local search works
on the underfull sequences: it moves pieces, exchanges one for one or two for one, always from the emptier to the
fuller sequence, so the sum of squared fills grows until sequences are empty. Sequences that stay underfull are packed
again together with those of other shards until they fit into one shard or no longer become fewer.

Null text is an empty document: the end id alone. Repeated rows are packed once each. Null ids are kept. Extra columns
are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .encode import WordEncoder, grouped
from .store import prepare, stored

CAPACITY, END_ID = 4096, 1
#: Pieces that one task packs at a time.
SHARD_PIECES = 30_000
#: A sequence with more free places than this is packed again with those of other shards.
OPEN_FREE = 16
#: Exchanges with two pieces look at sequences of so many pieces at most, and the search at so many stuck sequences.
PAIR_PIECES, PATIENCE = 16, 8
_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PACKED = f"{_PIECE}, sequence_id long, offset long, free int"


def _cutter(vocabulary, capacity: int, end_id: int):
    def cut(batches):
        encode, end, width = WordEncoder(vocabulary.value), np.array([end_id], "<u4").tobytes(), 4 * capacity
        for batch in grouped(batches):
            rows = []
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encode(batch.column("text"))):
                ids += end
                for k, at in enumerate(range(0, len(ids), width)):
                    part = ids[at : at + width]
                    rows.append((doc, k, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*rows)) or [()] * 5
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return cut


def pieces(docs: DataFrame, vocabulary_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length and crc32 of the ids of every piece of every row of ``docs`` (doc_id, text)."""
    spark = prepare(docs.sparkSession)
    with open(vocabulary_path, encoding="utf-8") as file:
        vocabulary = spark.sparkContext.broadcast(file.read())
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_cutter(vocabulary, capacity, end_id), _PIECE)


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Places (indexes into ``lengths``) of every sequence: longest first, each into the fullest sequence that fits."""
    bins: list[list[int]] = []
    by_free: dict[int, list[int]] = {}
    mask = 0
    for i in np.argsort(-lengths, kind="stable"):
        size = int(lengths[i])
        fits = mask >> size
        if fits:
            free = size + ((fits & -fits).bit_length() - 1)
            b = by_free[free].pop()
            if not by_free[free]:
                mask ^= 1 << free
            bins[b].append(int(i))
        else:
            free, b = capacity, len(bins)
            bins.append([int(i)])
        left = free - size
        if left:
            by_free.setdefault(left, []).append(b)
            mask |= 1 << left
    return bins


def _pairs(pieces_: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of pieces that share a sequence of PAIR_PIECES pieces at most."""
    ordered = pieces_[np.argsort(owner[pieces_], kind="stable")]
    _, first, count = np.unique(owner[ordered], return_index=True, return_counts=True)
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for k in range(2, PAIR_PIECES + 1):
        rows = ordered[first[count == k][:, None] + np.arange(k)]
        a, b = np.triu_indices(k, 1)
        left.append(rows[:, a].ravel())
        right.append(rows[:, b].ravel())
    return np.concatenate(left), np.concatenate(right)


def local_search(bins: list[list[int]], lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Empty sequences by moves and exchanges that take tokens from the emptiest sequence to fuller ones.

    Every step makes the emptiest sequence emptier, so the search ends. A sequence that cannot be emptied stays; the
    search gives up once PATIENCE of them in turn could not be emptied, or when no packing can have fewer sequences.
    """
    need = -(-int(lengths.sum()) // capacity)
    free = np.array([capacity - int(lengths[b].sum()) for b in map(np.array, bins)] or [0])
    owner = np.empty(len(lengths), np.int64)
    for k, b in enumerate(bins):
        owner[b] = k
    alive = len(bins)
    pool = np.flatnonzero(free[owner] > 0)

    def give(x: tuple[int, ...], y: tuple[int, ...], victim: int, target: int) -> None:
        owner[list(x)], owner[list(y)] = target, victim
        moved = int(lengths[list(x)].sum()) - int(lengths[list(y)].sum()) if y else int(lengths[list(x)].sum())
        free[victim] += moved
        free[target] -= moved

    def step(victim: int) -> bool:
        own = pool[owner[pool] == victim]
        others = pool[(owner[pool] != victim) & (free[owner[pool]] > 0)]
        room, size = free[owner[others]], lengths[others]
        order = own[np.argsort(-lengths[own], kind="stable")]
        order = order[np.concatenate(([True], np.diff(lengths[order]) != 0))] if len(order) else order
        for x in order:
            fit = np.where(room >= lengths[x], -room, -capacity - 1)
            if len(fit) and fit.max() >= -capacity:
                give((x,), (), victim, int(owner[others[fit.argmax()]]))
                return True
        for x in order:
            gain = lengths[x] - size
            gain = np.where((gain > 0) & (gain <= room), gain, 0)
            if len(gain) and gain.max() > 0:
                give((x,), (others[gain.argmax()],), victim, int(owner[others[gain.argmax()]]))
                return True
        few = order[:PAIR_PIECES]
        for k, a in enumerate(few):  # two of the emptiest sequence for one of a fuller one
            for b in few[:k]:
                gain = lengths[a] + lengths[b] - size
                gain = np.where((gain > 0) & (gain <= room), gain, 0)
                if len(gain) and gain.max() > 0:
                    give((a, b), (others[gain.argmax()],), victim, int(owner[others[gain.argmax()]]))
                    return True
        left, right = _pairs(others, owner)  # one for two
        two, room = lengths[left] + lengths[right], free[owner[left]]
        for x in order if len(two) else ():
            gain = lengths[x] - two
            gain = np.where((gain > 0) & (gain <= room), gain, 0)
            if gain.max() > 0:
                k = gain.argmax()
                give((x,), (left[k], right[k]), victim, int(owner[left[k]]))
                return True
        return False

    tried: set[int] = set()
    while alive > need and len(tried) < PATIENCE:
        filled = np.unique(owner[pool])
        open_bins = [int(k) for k in filled if free[k] > 0 and int(k) not in tried]
        if not open_bins:
            break
        victim = max(open_bins, key=lambda k: free[k])
        while free[victim] < capacity and step(victim):
            pass
        if free[victim] == capacity:
            free[victim] = 0
            alive -= 1
            tried.clear()
        else:
            tried.add(victim)
    out: dict[int, list[int]] = {}
    for i, k in enumerate(owner):
        out.setdefault(int(k), []).append(i)
    return list(out.values())


def _packer(capacity: int, level: int):
    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=False, kind="stable").reset_index(drop=True)
        lengths = rows["length"].to_numpy()
        bins = local_search(best_fit(lengths, capacity), lengths, capacity)
        sequence, offset, free = (np.zeros(len(rows), np.int64) for _ in range(3))
        for k, b in enumerate(bins):
            sequence[b], free[b] = k, capacity - lengths[b].sum()
            offset[b] = np.cumsum(lengths[b]) - lengths[b]
        shard = int(rows["shard"].iloc[0])
        return rows.drop(columns="shard").assign(sequence_id=(level << 58) + (shard << 24) + sequence, offset=offset, free=free.astype(np.int32))

    return pack


def packed(
    docs: DataFrame, vocabulary_path: str, capacity: int = CAPACITY, end_id: int = END_ID, shard_pieces: int = SHARD_PIECES
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece of ``docs`` (doc_id, text)."""
    todo = stored(pieces(docs, vocabulary_path, capacity, end_id), "pieces")
    done, level, count = None, 0, todo.count()
    while True:
        shards = max(1, -(-count // shard_pieces))
        # Rows of a stored table are dealt by their place too, so that repeated rows and rows without an id spread.
        place = F.monotonically_increasing_id()
        deal = F.pmod(F.xxhash64("doc_id", "piece", "start", "length", "ids_crc32", place, F.lit(level)), F.lit(shards)).alias("shard")
        out = stored(todo.select("*", deal).groupBy("shard").applyInPandas(_packer(capacity, level), _PACKED), "packed")
        closed = out.where(f"free <= {OPEN_FREE}") if shards > 1 else out
        done = closed if done is None else done.union(closed)
        if shards == 1:
            break
        todo = out.where(f"free > {OPEN_FREE}").select("doc_id", "piece", "start", "length", "ids_crc32")
        left = todo.count()
        if left * 10 > count * 9:
            done = done.union(out.where(f"free > {OPEN_FREE}"))
            break
        count, level = left, level + 1
        if not count:
            break
    return done.drop("free")
