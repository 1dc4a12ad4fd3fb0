"""Language identification in two steps: the family first, then one-versus-one linear machines inside it.

A text is the vector of its hashed groups of two and three characters, as square roots of shares, over the whole text.
Characters beyond ASCII count by their whole code points, so any script can be told apart. Up to SAMPLE_ROWS rows of each language teach it. Families are found from the mean vectors of the languages by average
linkage until the square root of their number is left. Linear support vector machines (squared hinge loss, dual
coordinate descent) separate the families one against another; in the family chosen, one machine per pair of languages
votes, and the sum of margins breaks ties. The score is the product of the chance of the family and of the language,
each the smallest logistic value of the winner's margins. Every machine is fitted in a task of its own, from sparse vectors;
the driver sees one mean vector a language and one vector a machine.

Null text and text without a letter are ``und`` with score 0, as is everything when no language could be learned.
Repeated rows are judged alike and teach once, but take a place each in the ranking of the sample. Null ids are judged too. Extra columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .store import fold, prepare, stored
from .symbols import BEYOND, spans

#: Places of a vector: pairs of ASCII symbols, hashed other pairs up to PAIRS, hashed triples.
BUCKETS, PAIRS, PLAIN = 4096, 1280, BEYOND * BEYOND
SAMPLE_ROWS = 300
#: Groups of partitions in which the sample of a language is ranked first.
SLICES = 64
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"


def _mix(number: np.ndarray) -> np.ndarray:
    """Numbers scattered over 32 bits."""
    number = (number ^ number >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15)
    return (number ^ number >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(32)


def vector(text: str | None) -> np.ndarray:
    counts = np.zeros(BUCKETS)
    for span in spans(text, 3):
        first, second, third = (span[:, k].astype(np.uint64) for k in range(3))
        pair, triple = second << np.uint64(21) | third, first << np.uint64(42) | second << np.uint64(21) | third
        plain = np.maximum(second, third) < BEYOND
        two = np.where(plain, second * np.uint64(BEYOND) + third, PLAIN + _mix(pair) % np.uint64(PAIRS - PLAIN))
        counts += np.bincount((PAIRS + _mix(triple) % np.uint64(BUCKETS - PAIRS)).astype(np.int64), minlength=BUCKETS)
        counts[:PAIRS] += np.bincount(two.astype(np.int64), minlength=PAIRS)
    out = np.sqrt(counts).astype(np.float32)
    return out / max(float(np.linalg.norm(out)), 1e-9)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def machine(x: np.ndarray, y: np.ndarray, cost: float = 10.0, rounds: int = 30) -> np.ndarray:
    """Weights of a linear support vector machine for y in -1, 1; the last weight is constant."""
    x = np.c_[x, np.ones(len(x), np.float32)]
    cost_of = np.where(y > 0, cost * len(y) / (2 * max((y > 0).sum(), 1)), cost * len(y) / (2 * max((y < 0).sum(), 1)))
    w, a, square = np.zeros(x.shape[1]), np.zeros(len(x)), (x * x).sum(1) + 0.5 / cost_of
    order = np.random.default_rng(0)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(x)):
            slope = y[i] * float(x[i] @ w) - 1 + a[i] * 0.5 / cost_of[i]
            new = max(a[i] - slope / square[i], 0.0)
            if new != a[i]:
                w += (new - a[i]) * y[i] * x[i]
                moved = max(moved, abs(new - a[i]))
                a[i] = new
        if moved < 1e-3:
            break
    return w


def families(centres: np.ndarray) -> list[list[int]]:
    """Rows of ``centres`` in about the square root of their number of groups, by average linkage of cosines."""
    unit = centres / np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-9)
    like, groups = unit @ unit.T, [[i] for i in range(len(centres))]
    while len(groups) > max(1, round(len(centres) ** 0.5)):
        a, b = max(combinations(range(len(groups)), 2), key=lambda p: like[np.ix_(groups[p[0]], groups[p[1]])].mean())
        groups[a] += groups.pop(b)
    return groups


class Hierarchy:
    """Families of languages and the machines between and inside them."""

    def __init__(self, names: list[str], centres: np.ndarray):
        self.names, self.groups = names, families(centres)
        self.pairs = [("f", a, b) for a, b in combinations(range(len(self.groups)), 2)]
        self.pairs += [("l", a, b) for g in self.groups for a, b in combinations(sorted(g), 2)]
        self.weights = np.zeros((len(self.pairs), BUCKETS + 1), np.float32)

    def sides(self) -> list[tuple[int, str, float]]:
        """(pair, language, side) for every machine and every language it learns from."""
        members = {"f": self.groups, "l": [[k] for k in range(len(self.names))]}
        return [
            (number, self.names[k], side)
            for number, (kind, a, b) in enumerate(self.pairs) for side, group in ((1.0, a), (-1.0, b)) for k in members[kind][group]
        ]

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        margin = x @ self.weights[:, :-1].T + self.weights[:, -1] if len(self.pairs) else np.zeros((len(x), 0))
        chance = 1 / (1 + np.exp(-2 * np.clip(margin, -20, 20)))

        def winner(row: int, kind: str, items: list[int]) -> tuple[int, float]:
            votes, sums, least = dict.fromkeys(items, 0), dict.fromkeys(items, 0.0), dict.fromkeys(items, 1.0)
            for k, (what, a, b) in enumerate(self.pairs):
                if what == kind and a in votes and b in votes:
                    m, p = margin[row, k], chance[row, k]
                    votes[a if m >= 0 else b] += 1
                    sums[a], sums[b] = sums[a] + m, sums[b] - m
                    least[a], least[b] = min(least[a], p), min(least[b], 1 - p)
            best = max(items, key=lambda i: (votes[i], sums[i], -i))
            return best, least[best]

        names, scores = [], np.empty(len(x))
        for row in range(len(x)):
            family, p = winner(row, "f", list(range(len(self.groups))))
            language, q = winner(row, "l", sorted(self.groups[family]))
            names.append(self.names[language])
            scores[row] = p * q
        return names, scores


def _vectors(batches):
    """Vectors as their places and values other than 0."""
    for batch in batches:
        rows = [vector(x) for x in batch.column("text").to_pylist()]
        at = [np.flatnonzero(x).astype(np.uint16) for x in rows]
        values = [x[a].tobytes() for x, a in zip(rows, at)]
        arrays = [*map(batch.column, ("doc_id", "lang")), pa.array([a.tobytes() for a in at], pa.binary()), pa.array(values, pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "lang", "at", "x"])


def _dense(rows: pd.DataFrame) -> tuple[np.ndarray, pd.DataFrame]:
    """Vectors in an order that depends on the rows alone, and those rows."""
    rows = rows.sort_values(["lang", "at", "x"], kind="stable")
    out = np.zeros((len(rows), BUCKETS), np.float32)
    for k, (at, x) in enumerate(zip(rows["at"], rows["x"])):
        out[k, np.frombuffer(at, np.uint16)] = np.frombuffer(x, np.float32)
    return out, rows


def _centre(rows: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"lang": rows["lang"].iloc[:1], "x": [_dense(rows)[0].mean(0).tobytes()]})


def _fit(rows: pd.DataFrame) -> pd.DataFrame:
    x, rows = _dense(rows)
    return pd.DataFrame({"pair": rows["pair"].iloc[:1], "w": [machine(x, rows["side"].to_numpy()).astype(np.float32).tobytes()]})


def _judge(learned):
    """``learned`` broadcasts the plain parts of a Hierarchy, or nothing."""

    def judge(batches):
        model = None
        if learned.value:
            model = Hierarchy.__new__(Hierarchy)
            vars(model).update(learned.value)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            rows = [i for i, x in enumerate(texts) if model is not None and has_letter(x)]
            if rows:
                found, sure = model.predict(np.stack([vector(texts[i]) for i in rows]))
                scores[rows] = sure
                for i, name in zip(rows, found):
                    names[i] = name
            keep = batch.schema.names
            yield pa.RecordBatch.from_arrays([*map(batch.column, keep), pa.array(names, pa.string()), pa.array(scores)], [*keep, "lang_pred", "score"])

    return judge


def learn(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Hierarchy | None:
    """Learn from ``sample_rows`` rows of each language outside the held-out fold, those with the smallest hashed ids."""
    known = docs.where("lang is not null and text is not null and doc_id is not null")
    known = known.where(fold(F.col("doc_id"), FOLDS) != HELD_OUT)
    known = known.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text", F.xxhash64("text").alias("mark"))
    # First within slices of the partitions, so that the last ranking of a language sees SLICES x sample_rows ids at any size.
    order = [F.xxhash64(F.lit("sample"), "doc_id"), F.col("doc_id"), F.col("mark")]
    ids = known.select("doc_id", "lang", "mark", F.pmod(F.spark_partition_id(), F.lit(SLICES)).alias("slice"))
    for group in (["lang", "slice"], ["lang"]):
        ids = ids.withColumn("n", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("n") <= sample_rows)
    ids = ids.select("doc_id", "lang", "mark").distinct()  # sample_rows x languages at most
    sample = known.join(F.broadcast(ids), ["doc_id", "lang", "mark"]).select("doc_id", "lang", "text")
    rows = sample.mapInArrow(_vectors, "doc_id long, lang string, at binary, x binary").distinct()  # an id may stand on many rows
    rows = stored(rows.drop("doc_id"), "sample", narrow=True)
    centres = rows.groupBy("lang").applyInPandas(_centre, "lang string, x binary").toArrow().to_pylist()  # one vector a language
    if not centres:
        return None
    centres.sort(key=lambda r: r["lang"])
    model = Hierarchy([r["lang"] for r in centres], np.stack([np.frombuffer(r["x"], np.float32) for r in centres]))
    if model.pairs:
        sides = rows.sparkSession.createDataFrame(model.sides(), "pair int, lang string, side double")
        fitted = rows.join(F.broadcast(sides), "lang").groupBy("pair").applyInPandas(_fit, "pair int, w binary")
        for r in fitted.toArrow().to_pylist():  # one vector a machine
            model.weights[r["pair"]] = np.frombuffer(r["w"], np.float32)
    return model


def tagged(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` (doc_id, text, lang and more) with lang_pred and score, which replace columns of those names."""
    spark = prepare(docs.sparkSession)
    model = learn(docs, sample_rows)
    learned = spark.sparkContext.broadcast(vars(model) if model else {})
    rows = docs.drop("lang_pred", "score")
    schema = StructType([*rows.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return rows.mapInArrow(_judge(learned), schema)


def languages(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, lang): doc_id, held_out, lang_pred, score."""
    return tagged(docs.select("doc_id", "text", "lang"), sample_rows).select(
        "doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score"
    )
