"""Phrases of two to five words that occur together more often than their parts suggest.

Texts are split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and these into words ``[^\\x20\\x09]+``, with A-Z lower-cased. A
phrase lies within a piece; occurrences may overlap. All figures are per language, null being ``und``.

Counting goes by direct-address tiles. The frequent units of a level (first words, then phrases of two words and so on)
are ranked by frequency in their language; a phrase of the next level is a pair of overlapping neighbours that are both
frequent. A task splits the pairs it meets by rank into tiles of TILE x TILE cells. A well-filled tile is counted by
``bincount`` over its cells, a sparse one as sorted coordinates. What reaches ``min_count`` after the tasks' counts have
been added up is ranked again and counted in the same way, up to the longest phrase.

The ranks of the HEAD most frequent units go to the tasks. All other frequent units are counted too: a bit table of
fixed size lets them pass, and their pairs are coordinates of 64-bit numbers in place of ranks. The result does not
depend on HEAD. A number that two frequent units share stops the job.

Null text has no words. Repeated rows count once each. Extra columns are ignored. A table without a candidate, or an
empty one, gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import prepare, stored
from .terms import byte_set, combined, runs, terms
from .words import mix

MIN_COUNT, LONGEST, TOP = 100, 5, 2000
#: A candidate goes if a longer one that holds it occurs at least so often in a hundred.
WITHIN_PERCENT = 100
#: Units whose ranks are sent to tasks, ranks on a side of a tile, bits of the table for all other units.
HEAD, TILE, BITS = 1 << 17, 1 << 10, 1 << 24
#: A tile is counted by its cells if one in so many is hit.
DENSE = 16
#: Pairs that a task holds before it counts them.
HELD_PAIRS = 1 << 21
UNKNOWN = "und"

_U = np.uint64
_BREAK = byte_set([*b".,;:!?", *range(0x0A, 0x0E)])
_GAP = _BREAK | byte_set([0x20, 0x09])


def _number(values: list[bytes]) -> np.ndarray:
    from xxhash import xxh64_intdigest

    return np.array([xxh64_intdigest(x) for x in values], _U)


def word_keys(words: np.ndarray, langs: np.ndarray) -> np.ndarray:
    """Numbers of words in their languages from the numbers of both."""
    return mix(words + mix(langs))


def phrase_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Numbers of phrases from those of their first and last words but one."""
    return mix(left * _U(0xC2B2AE3D27D4EB4F) + right)


def _word_counts(batches):
    """lang, word and occurrences; a null word carries all occurrences of its language."""

    def parts():
        for batch in batches:
            t = terms(batch.column("text"), _GAP, _BREAK)
            langs = batch.column("lang").dictionary_encode()
            n = len(t.values) + 1
            lang = langs.indices.to_numpy().astype(np.int64)[t.text]
            key, count = runs(np.concatenate([lang * n + t.code, runs(lang)[0] * n + n - 1]))
            whole = key % n == n - 1
            count[whole] = runs(lang)[1]
            word = t.values.take(pa.array(key % n, mask=whole)).cast(pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([langs.dictionary.take(pa.array(key // n)), word, pa.array(count)], ["lang", "word", "n"])

    return combined(parts(), ["lang", "word"], ["n"])


def _keyed_words(batches):
    for batch in batches:
        encoded = lambda c: _number([x.encode() for x in batch.column(c).to_pylist()])
        yield batch.append_column("key", pa.array(word_keys(encoded("word"), encoded("lang")).view(np.int64)))


def _keyed_pairs(batches):
    for batch in batches:
        side = [batch.column(c).to_numpy().view(_U) for c in ("left", "right")]
        yield batch.append_column("key", pa.array(phrase_keys(*side).view(np.int64)))


class Head:
    """Ranks of the most frequent units: numbers in order, and for each its language and rank there."""

    def __init__(self, key: np.ndarray, lang: list[str], count: np.ndarray):
        _, lang = np.unique(np.array(lang, object), return_inverse=True) if len(key) else (None, np.zeros(0, np.int64))
        order = np.lexsort((key, -count, lang))
        rank = np.empty(len(key), np.int64)
        rank[order] = np.arange(len(key)) - np.searchsorted(lang[order], lang[order])
        by_key = np.argsort(key)
        self.key, self.lang, self.rank = key[by_key], lang[by_key].astype(np.int64), rank[by_key]
        self.order, self.first = np.argsort(self.lang * (len(key) + 1) + self.rank), np.searchsorted(np.sort(self.lang), np.arange(self.lang.max(initial=-1) + 2))

    def find(self, key: np.ndarray) -> np.ndarray:
        """Places of ``key``, -1 for units beyond the head."""
        if not len(self.key):
            return np.full(len(key), -1)
        place = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[place] == key, place, -1)

    def named(self, lang: np.ndarray, rank: np.ndarray) -> np.ndarray:
        return self.key[self.order[self.first[lang] + rank]]


def tiled(left: np.ndarray, right: np.ndarray, head: Head, tile: int = TILE, dense: int = DENSE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of numbers and how often each occurs."""
    a, b = head.find(left), head.find(right)
    known = (a >= 0) & (b >= 0)
    out = []
    if known.any():
        lang, x, y = head.lang[a[known]], head.rank[a[known]], head.rank[b[known]]
        side = -(-int(head.rank.max() + 1) // tile)
        number = (lang * side + x // tile) * side + y // tile
        cell = (x % tile) * tile + y % tile
        order = np.argsort(number, kind="stable")
        number, cell = number[order], cell[order]
        first = np.flatnonzero(np.concatenate(([True], number[1:] != number[:-1])))
        for at, end in zip(first, np.append(first[1:], len(number))):
            if (end - at) * dense >= tile * tile:
                counts = np.bincount(cell[at:end], minlength=tile * tile)
                cells = np.flatnonzero(counts)
                counts = counts[cells]
            else:
                cells, counts = runs(cell[at:end])
            block, column = divmod(int(number[at]), side)
            of, row = divmod(block, side)
            of = np.full(len(cells), of)
            out.append((head.named(of, row * tile + cells // tile), head.named(of, column * tile + cells % tile), counts))
    if not known.all():
        left, right = left[~known], right[~known]
        order = np.lexsort((right, left))
        left, right = left[order], right[order]
        first = np.flatnonzero(np.concatenate(([True], (left[1:] != left[:-1]) | (right[1:] != right[:-1]))))
        out.append((left[first], right[first], np.diff(np.append(first, len(left)))))
    if not out:
        return left[:0], right[:0], np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out))


def _pair_counts(level: int, head, table, held: int):
    """left, right and n of the phrases of ``level`` words, as pairs of frequent units of one word less."""

    def parts(batches):
        ranks, passes = Head.__new__(Head), table.value
        ranks.__dict__.update(head.value)
        waiting, size = [], 0

        def counted():
            left, right, n = tiled(np.concatenate([w[0] for w in waiting]), np.concatenate([w[1] for w in waiting]), ranks)
            return pa.RecordBatch.from_arrays([pa.array(left.view(np.int64)), pa.array(right.view(np.int64)), pa.array(n)], ["left", "right", "n"])

        for batch in batches:
            t = terms(batch.column("text"), _GAP, _BREAK)
            langs = batch.column("lang").dictionary_encode()
            lang = _number([x.encode() for x in langs.dictionary.to_pylist()])[langs.indices.to_numpy()]
            key = word_keys(_number(t.values.to_pylist())[t.code], lang[t.text])
            for _ in range(level - 2):
                key = phrase_keys(key[:-1], key[1:])
            if len(key) < 2:
                continue
            place = key & _U(BITS - 1)
            frequent = (passes[(place >> _U(6)).astype(np.int64)] >> (place & _U(63))) & _U(1) == 1
            whole = t.piece[: len(key) - 1] == t.piece[level - 1 : level - 1 + len(key) - 1]
            at = np.flatnonzero(whole & frequent[:-1] & frequent[1:])
            waiting.append((key[at], key[at + 1]))
            size += len(at)
            if size > held:
                yield counted()
                waiting, size = [], 0
        if size:
            yield counted()

    return lambda batches: combined(parts(batches), ["left", "right"], ["n"])


def _shipped(units: DataFrame, head: int):
    """The ranks and the bit table of a level, of bounded size both."""
    sc = units.sparkSession.sparkContext
    most = units.orderBy(F.desc("a"), "key").limit(head).select("key", "lang", "a").toArrow()
    place = F.col("key").bitwiseAND(F.lit(BITS - 1))
    bit = F.expr("shiftleft(1L, CAST(key & 63L AS INT))")
    found = units.groupBy(F.shiftright(place, 6).alias("at")).agg(F.bit_or(bit).alias("bits")).toArrow()
    table = np.zeros(BITS // 64, np.int64)
    table[found["at"].to_numpy()] = found["bits"].to_numpy()
    ranks = Head(most["key"].to_numpy().view(_U), most["lang"].to_pylist(), most["a"].to_numpy())
    return sc.broadcast(vars(ranks)), sc.broadcast(table.view(_U))  # arrays alone: tasks need no copy of this package


def _unique(units: DataFrame) -> DataFrame:
    if not units.groupBy("key").count().where("count > 1").isEmpty():
        raise RuntimeError("two frequent units share a number")
    return units


def frequent_phrases(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, head: int = HEAD) -> tuple[list[DataFrame], DataFrame]:
    """Tables of the frequent units of one word, two words and so on, and all occurrences of words by language.

    A unit has its language, its words, its count ``a``, and the counts of its beginnings (``heads``) and of its
    endings (``tails``) by their number of words, itself last; from two words on also the numbers of its two parts.
    """
    prepare(docs.sparkSession)
    docs = docs.select("text", F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"))
    counted = docs.mapInArrow(_word_counts, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    counted = stored(counted.where(F.col("word").isNull() | (F.col("n") >= min_count)), "frequent_words", narrow=True)
    totals = counted.where("word is null").select("lang", "n")
    words = counted.where("word is not null").mapInArrow(_keyed_words, "lang string, word string, n long, key long")
    one = words.select("lang", "key", F.array("word").alias("words"), F.col("n").alias("a"), F.array("n").alias("heads"), F.array("n").alias("tails"))
    levels = [_unique(stored(one, "units_1", narrow=True))]
    for level in range(2, longest + 1):
        units = levels[-1]
        if units.isEmpty():
            break
        shipped = _shipped(units, head)
        pairs = docs.mapInArrow(_pair_counts(level, *shipped, HELD_PAIRS), "left long, right long, n long")
        pairs = pairs.groupBy("left", "right").agg(F.sum("n").alias("a")).where(F.col("a") >= min_count)
        pairs = stored(pairs.mapInArrow(_keyed_pairs, "left long, right long, a long, key long"), f"pairs_{level}", narrow=True)
        for x in shipped:
            x.destroy()
        first = units.select(F.col("key").alias("left"), "lang", "words", "heads")
        last = units.select(F.col("key").alias("right"), F.element_at("words", -1).alias("word"), "tails")
        joined = pairs.join(first, "left").join(last, "right").select(
            "lang", "key", F.concat("words", F.array("word")).alias("words"), "a", F.concat("heads", F.array("a")).alias("heads"),
            F.concat("tails", F.array("a")).alias("tails"), "left", "right",
        )
        levels.append(_unique(stored(joined, f"units_{level}", narrow=True)))
    return levels, totals


def _whole(x: Column) -> Column:
    return x.cast("decimal(18,0)")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, top: int = TOP, within: int = WITHIN_PERCENT, head: int = HEAD) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the ``top`` phrases of every language of ``docs`` (text, lang)."""
    levels, totals = frequent_phrases(docs, min_count, longest, head)
    rows = None
    for k, units in enumerate(levels[1:], 2):
        if k < len(levels):
            longer = levels[k]
            holder = longer.select(F.col("left").alias("key"), F.col("a").alias("longer")).union(longer.select("right", "a"))
            units = units.join(holder.groupBy("key").agg(F.max("longer").alias("longer")), "key", "left")
            units = units.where(F.col("longer").isNull() | (100 * F.col("longer") < within * F.col("a")))
        part = units.select("lang", "words", "a", "heads", "tails")
        rows = part if rows is None else rows.union(part)
    if rows is None:
        rows = levels[0].select("lang", "words", "a", "heads", "tails").where("false")
    product = F.lit(1000).cast("decimal(4,0)") * _whole(F.col("a")) * _whole(F.col("n"))

    def cut(k: Column) -> Column:
        left, right = F.element_at("heads", k), F.element_at("tails", F.size("words") - k)
        score = F.call_function("div", product, _whole(left) * _whole(right))
        return F.struct(score.alias("score"), k.alias("k"), left.alias("l"), right.alias("r"))

    best = rows.join(totals, "lang").withColumn("cut", F.array_min(F.transform(F.sequence(F.lit(1), F.size("words") - 1), cut)))
    scored = best.select("lang", F.array_join("words", " ").alias("phrase"), "a", "cut.l", "cut.r", "n", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
