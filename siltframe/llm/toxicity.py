"""Toxicity by class-conditional Kneser-Ney models of character n-grams.

Two models, of toxic and of ordinary documents, are learned from a bounded sample of labelled rows. Each interpolates
absolutely discounted counts of ORDER-grams with continuation counts of shorter ones; at the bottom both share the
continuation counts of all sampled documents, so that rare expressions count alike in both. The difference of the log
likelihoods is taken at every place of the whole text and averaged over its length. Letters of scripts other than Latin
have tables of their own, over 31 symbols that neighbouring letters of a script do not share. The mean is taken once as it is and once over what
exceeds each of EXCESS (a few telling places in a long text). A logistic curve, fitted on a quarter of the sample that
the models have not seen and weighted to the share of toxic rows among all labels, turns these means into a score.

Null and empty texts are scored like a text of one space. Repeated labels of a document count as toxic if one is.
Without labels of both classes every score is the share of toxic labels, or 0. Null ids are never learned from. Extra
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import fold, prepare, stored
from .symbols import PLANES, SYMBOLS, grams

ORDER, DISCOUNT = 4, 0.75
#: Labelled rows of each class to learn from; every fourth of them fits the curve.
SAMPLE_ROWS = 6000
EXCESS = (1.0, 2.5)
FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.7


def continuations(counts: np.ndarray) -> np.ndarray:
    """Of every n-gram without its first symbol: how many n-grams end in it."""
    return (counts.reshape(SYMBOLS, -1) > 0).sum(0)


def kneser_ney(counts: np.ndarray, shared: np.ndarray, order: int = ORDER, discount: float = DISCOUNT) -> np.ndarray:
    """P(last symbol | symbols before) for every n-gram, given n-gram ``counts`` and the ``shared`` symbol counts."""
    levels = [counts]
    for _ in range(order - 1):
        levels.append(continuations(levels[-1]))
    p = ((shared + 0.5) / (shared + 0.5).sum()).reshape(1, SYMBOLS)
    for level in levels[-2::-1]:
        c = level.reshape(-1, SYMBOLS).astype(float)
        total, types = c.sum(1, keepdims=True), (c > 0).sum(1, keepdims=True)
        lower = np.tile(p, (len(c) // len(p), 1))
        p = np.where(total > 0, (np.maximum(c - discount, 0) + discount * types * lower) / np.maximum(total, 1), lower)
    return p.reshape(-1)


def log_ratios(ordinary: np.ndarray, toxic: np.ndarray, order: int = ORDER) -> np.ndarray:
    """``log_ratio`` of each plane of symbols, one after the other."""
    return np.concatenate([log_ratio(o, t, order) for o, t in zip(ordinary.reshape(PLANES, -1), toxic.reshape(PLANES, -1))])


def log_ratio(ordinary: np.ndarray, toxic: np.ndarray, order: int = ORDER) -> np.ndarray:
    """Difference of the log likelihoods of the last symbol of every n-gram of one plane."""
    shared = ordinary + toxic
    for _ in range(order - 1):
        shared = continuations(shared)
    return np.log(kneser_ney(toxic, shared, order) / kneser_ney(ordinary, shared, order)).astype(np.float32)


def features(text: str | None, table: np.ndarray, order: int = ORDER) -> list[float]:
    total, n = np.zeros(1 + len(EXCESS)), 0
    for block in grams(text, order):
        gain = table[block]
        total += [gain.sum(dtype=float), *(np.maximum(gain - x, 0).sum(dtype=float) for x in EXCESS)]
        n += len(gain)
    return list(total / max(n, 1))


def fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 0.5, rounds: int = 50) -> np.ndarray:
    """Coefficients of a ridge logistic regression (the last one is constant) by Newton's method."""
    mean, spread = x.mean(0), x.std(0) + 1e-9
    z = np.c_[(x - mean) / spread, np.ones(len(x))]
    b, ridge = np.zeros(z.shape[1]), np.r_[np.full(x.shape[1], penalty), 1e-9]
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
        slope = z.T @ (weight * (p - y)) + ridge * b
        step = np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + np.diag(ridge), slope)
        b -= step * min(1.0, 5 / max(np.abs(step).max(), 1e-12))
    slopes = b[:-1] / spread
    return np.r_[slopes, b[-1] - slopes @ mean]


def _counter(order: int):
    def count(batches):
        total = np.zeros((2, PLANES * SYMBOLS**order), np.int32)
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                for block in grams(text, order):
                    slot, n = np.unique(block, return_counts=True)
                    total[toxic, slot] += n.astype(np.int32)
        slots = np.flatnonzero(total.any(0))
        for at in range(0, len(slots), 1 << 16):
            part = slots[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.astype(np.int32)), pa.array(total[0, part].astype(np.int64)), pa.array(total[1, part].astype(np.int64))], ["slot", "ordinary", "toxic"]
            )

    return count


def _features(table, order: int):
    def found(batches):
        for batch in batches:
            rows = [features(x, table.value, order) for x in batch.column("text").to_pylist()]
            keep = [batch.column(c) for c in batch.schema.names if c != "text"]
            names = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(rows, pa.list_(pa.float64()))], [*names, "x"])

    return found


def toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, order: int = ORDER) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted. ``labels`` has doc_id and toxic."""
    spark = prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = (
        labels.where("toxic in (0, 1) and doc_id is not null").where(fold(F.col("doc_id"), FOLDS) != HELD_OUT)
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    )
    known = stored(known, "labelled", narrow=True)
    share = known.agg(F.avg("toxic")).first()[0]
    place = F.xxhash64(F.lit("sample"), "doc_id")
    sample = [known.where(F.col("toxic") == c).orderBy(place, "doc_id").limit(sample_rows) for c in (0, 1)]
    part = F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(4)) == 0
    sample = stored(sample[0].union(sample[1]).withColumn("curve", part), "sample", narrow=True)  # 2 x sample_rows rows at most
    texts = docs.where("text is not null").join(F.broadcast(sample), "doc_id")
    counts = (
        texts.where("not curve").select("toxic", "text").mapInArrow(_counter(order), "slot int, ordinary long, toxic long")
        .groupBy("slot").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic")).toArrow()
    )
    full = np.zeros((2, PLANES * SYMBOLS**order), np.int64)
    for k, name in enumerate(("ordinary", "toxic")):
        full[k, counts["slot"].to_numpy()] = counts[name].to_numpy()
    table = spark.sparkContext.broadcast(log_ratios(full[0], full[1], order))
    rows = texts.where("curve").select("toxic", "text").mapInArrow(_features(table, order), "toxic int, x array<double>").toArrow()
    y = rows["toxic"].to_numpy()
    if len(y) and 0 < y.mean() < 1:
        x = np.array(rows["x"].to_pylist())
        curve = fit_curve(x, y, np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean())))
    else:
        rate = min(max(share or 0.0, 0.0), 1.0)
        curve = np.r_[np.zeros(1 + len(EXCESS)), np.log(max(rate, 1e-12) / max(1 - rate, 1e-12))]
    terms = sum((F.col("x")[k] * float(c) for k, c in enumerate(curve[:-1])), F.lit(float(curve[-1])))
    return (
        docs.mapInArrow(_features(table, order), "doc_id long, x array<double>")
        .select("doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), (1 / (1 + F.exp(-terms))).alias("score"))
        .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
    )
