"""How far the sources of a language diverge in the terms they use.

Terms are maximal runs of ASCII letters and characters beyond ASCII, with A-Z lower-cased. A language keeps the terms
that at least ``min_docs`` of its rows hold. A group, the rows of one language and source, gives a kept term the price
``1 + floor(10**9 * (count + 5) / (N + 5 * V))``, with N its occurrences of kept terms and V the number of kept terms.

Pairs of groups are compared by pair tasks: kept terms get ids in the order of their text, a group is a sorted array of
(term id, count) for every block of BLOCK ids, and groups are dealt to tiles of TILE. A task co-groups two tiles for
one block and merges every unordered pair of them sparsely: the ids of the shorter array gallop through the longer one;
terms of both groups, of one alone and of neither are priced apart, the latter by their number. The value holds for
both directions. Arrays hold BLOCK ids at most, whatever the vocabulary, and an array is sent once per tile, not per pair.

Null text, lang and source are ''. Every row is a document, whether ids repeat or not. A language without kept terms
gives its pairs the value 0. Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ids import with_position
from .store import prepare, stored
from .terms import byte_set, combined, runs, terms

MIN_DOCS, TOP = 30, 50
#: Prices are whole numbers of 1 / SCALE; every kept term counts SMOOTH times more than it occurs.
SCALE, SMOOTH = 10**9, 5
#: Term ids in an array, and groups in a tile.
BLOCK, TILE = 1 << 16, 16

_GAP = byte_set([*range(0x00, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_COUNTED = "lang string, source string, term string, count long, docs long"


def _term_counts(batches):
    """lang, source, term, occurrences and documents; equal keys of a task are mostly added up."""

    def parts():
        for batch in batches:
            t = terms(batch.column("text"), _GAP)
            groups = pa.StructArray.from_arrays([batch.column("lang"), batch.column("source")], ["lang", "source"])
            listed = {}
            group = np.array([listed.setdefault((g["lang"], g["source"]), len(listed)) for g in groups.to_pylist()], np.int64)
            n = max(len(t.values), 1)
            key, count = runs(group[t.text] * n + t.code)
            held, _ = runs(t.text * n + t.code)
            _, docs = runs(group[held // n] * n + held % n)
            names = list(listed)
            of = lambda i: pa.array([x[i] for x in names], pa.string()).take(pa.array(key // n))
            term = t.values.take(pa.array(key % n)).cast(pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([of(0), of(1), term, pa.array(count), pa.array(docs)], ["lang", "source", "term", "count", "docs"])

    return combined(parts(), ["lang", "source", "term"], ["count", "docs"])


def price(count: np.ndarray, total: int) -> np.ndarray:
    """``1 + floor(SCALE * (count + SMOOTH) / total)`` in 64 bits, by long division in three digits of a thousand."""
    whole, left = np.divmod(np.asarray(count, np.int64) + SMOOTH, np.int64(total))
    for _ in range(3):
        digit, left = np.divmod(left * 1000, np.int64(total))
        whole = whole * 1000 + digit
    return whole + 1


def gallop(short: np.ndarray, long: np.ndarray, run: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Places in both sorted arrays of the values they share.

    ``run`` values of the shorter array at a time: from the last place on, steps through the longer one double until
    they are past the run, and the run is searched for in that stretch only.
    """
    places, at = [np.zeros(0, np.int64)], 0
    for k in range(0, len(short), run):
        values, step = short[k : k + run], run
        while at + step < len(long) and long[at + step] < values[-1]:
            step *= 2
        found = at + np.searchsorted(long[at : at + step + 1], values)
        places.append(found)
        at = int(found[-1])
    place = np.concatenate(places)
    hit = place < len(long)
    hit[hit] = long[place[hit]] == short[hit]
    return np.flatnonzero(hit), place[hit]


def priced(ids: tuple[np.ndarray, np.ndarray], prices: tuple[np.ndarray, np.ndarray], absent: tuple[int, int]) -> tuple[int, int]:
    """Sum of the differences over the terms that either group has, and the number of these terms."""
    a, b = (0, 1) if len(ids[0]) <= len(ids[1]) else (1, 0)
    here, there = gallop(ids[a], ids[b])
    both = np.abs(prices[a][here] - prices[b][there]).sum()
    one = [np.abs(prices[k] - absent[1 - k]) for k in (a, b)]
    alone = one[0].sum() - one[0][here].sum() + one[1].sum() - one[1][there].sum()
    return int(both + alone), len(ids[0]) + len(ids[1]) - len(here)


_PRICED = "lang string, source string, item string, priced long, present long"


def _merge(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """All unordered pairs of two tiles, or of one, in one block of term ids."""

    def side(rows: pd.DataFrame):
        for row in rows.itertuples(index=False):
            ids, counts = (np.asarray(x if x is not None else [], np.int64) for x in (row.ids, row.counts))
            absent = int(price(np.zeros(1), row.total)[0]) if row.total else 0
            yield row.place, row.source, ids, price(counts, row.total) if len(ids) else counts, absent

    mine, others, out = list(side(left)), list(side(right)), []
    for place, source, ids, prices, absent in mine:
        for place_b, item, ids_b, prices_b, absent_b in others:
            if place < place_b:
                out.append((left["lang"].iloc[0], source, item, *priced((ids, ids_b), (prices, prices_b), (absent, absent_b))))
    return pd.DataFrame(out, columns=["lang", "source", "item", "priced", "present"])


def _price(count: Column, total: Column) -> Column:
    whole = (count + SMOOTH).cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.call_function("div", whole, total.cast("decimal(19,0)")) + 1


def _pairs(counts: DataFrame, groups: DataFrame, block: int, tile: int) -> DataFrame:
    """lang, source, item and value of every ordered pair of groups of a language."""
    arrays = counts.groupBy("lang", "source", F.floor(F.col("term_id") / block).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("term_id", "count"))).alias("cells")
    )
    blocks = F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(F.col("kept") / block) - 1, F.lit(0).cast("long")))
    cells = (
        groups.withColumn("block", F.explode(blocks)).join(arrays, ["lang", "source", "block"], "left")
        .select("*", F.floor(F.col("place") / tile).alias("tile"), F.floor((F.col("members") - 1) / tile).alias("last"))
        .select("lang", "source", "block", "place", "total", "tile", "last", F.col("cells.term_id").alias("ids"), F.col("cells.count").alias("counts"))
    )
    lower = cells.withColumn("a", F.col("tile")).withColumn("b", F.explode(F.sequence("tile", "last")))
    upper = cells.select(*[F.col(c).alias(c) for c in cells.columns])  # columns of their own, as both sides are co-grouped
    upper = upper.withColumn("b", F.col("tile")).withColumn("a", F.explode(F.sequence(F.lit(0).cast("long"), "tile")))
    key = ["lang", "block", "a", "b"]
    merged = lower.groupBy(*key).cogroup(upper.groupBy(*key)).applyInPandas(_merge, _PRICED)
    summed = merged.groupBy("lang", "source", "item").agg(F.sum("priced").alias("priced"), F.sum("present").alias("present"))
    absent = groups.select("lang", "source", "kept", F.when(F.col("total") > 0, _price(F.lit(0).cast("long"), F.col("total"))).otherwise(0).alias("p0"))
    known = summed.join(absent, ["lang", "source"]).join(
        absent.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0")), ["lang", "item"]
    )
    value = F.col("priced") + (F.col("kept") - F.col("present")) * F.abs(F.col("p0") - F.col("q0"))
    both = F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))
    return known.select("lang", value.alias("value"), F.explode(both).alias("way")).select("lang", "way.source", "way.item", "value")


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, block: int = BLOCK, tile: int = TILE) -> DataFrame:
    """lang, source, part, item, value and rank for ``docs`` (text, lang, source).

    Part ``pair``: every other source of the language and the sum of the price differences over all kept terms. Part
    ``term``: the ``top`` kept terms that the group prices higher than its language does.
    """
    prepare(docs.sparkSession)
    docs = docs.select("text", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")])
    found = docs.mapInArrow(_term_counts, _COUNTED).groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))
    found = stored(found, "term_counts")
    kept = found.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("count").alias("in_lang")).where(F.col("docs") >= min_docs)
    numbered = stored(with_position(kept.drop("docs"), ["term"], "term_id", ["lang"]).withColumn("term_id", F.col("term_id") - 1), "kept_terms", narrow=True)
    langs = numbered.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("in_lang").alias("lang_count"))
    counts = stored(found.drop("docs").join(numbered, ["lang", "term"]), "kept_counts")
    placed = with_position(docs.select("lang", "source").distinct(), ["source"], "place", ["lang"]).withColumn("place", F.col("place") - 1)
    members = placed.groupBy("lang").agg(F.count("*").alias("members"))
    sums = counts.groupBy("lang", "source").agg(F.sum("count").alias("own"))
    smoothed = lambda n: F.coalesce(n, F.lit(0)) + SMOOTH * F.coalesce("kept", F.lit(0))
    groups = (
        placed.join(members, "lang").join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
        .select("lang", "source", "place", "members", F.coalesce("kept", F.lit(0)).alias("kept"),
                smoothed(F.col("own")).alias("total"), smoothed(F.col("lang_count")).alias("lang_total"))
    )
    groups = stored(groups, "groups", narrow=True)
    own = counts.join(groups.select("lang", "source", "total", "lang_total"), ["lang", "source"])
    higher = own.select("lang", "source", F.col("term").alias("item"), (_price(F.col("count"), F.col("total")) - _price(F.col("in_lang"), F.col("lang_total"))).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda rows: rows.withColumn("rank", F.row_number().over(order))
    term = ranked(higher.where("value > 0")).where(F.col("rank") <= top)
    pair = ranked(_pairs(counts, groups, block, tile))
    columns = lambda rows, part: rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
    return columns(pair, "pair").union(columns(term, "term"))
