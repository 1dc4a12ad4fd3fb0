"""Benchmark passages in documents, also with other numbers, names and units.

Texts are brought to a canonical form in which numbers, units behind numbers and runs of capitalised words inside a
sentence are typed placeholders, so that a name of three words may stand for a name of one. The canonical words of items
and documents are cut into windows of WINDOW words, whose hashes are joined. An item needs ``threshold`` of its windows,
so a document that holds it holds one of its rarest, by the number of documents: only those bring candidates, and all
windows of a candidate are counted then. Where enough are found, the slots behind the placeholders are compared along
each alignment: a value of the item must stand for one and the same value of the document throughout, else that
alignment does not count. A document holds an item when the windows of consistent alignments make up at least
``threshold`` of the item's. At the start of a text or a sentence, behind a quote, a bracket or a line break, a capitalised
word may be a name or not, so texts have two forms: there it is a word in the first and a placeholder in the second, and
either form suffices. Everything is DataFrame expressions.

Items of fewer words than a window are found where all their words stand in a row with the same values, if they have
SHORTEST words or more. Besides, a text of fewer words than a window is one window as a whole, which only an item that is
the same whole text can match, also with other values. Null and empty texts hold and match nothing. Every text is judged
on its own, also where a doc_id (or an item_id) is null or on several rows; the result has one row for each pair of ids,
with the best of their texts. Null item_ids are ignored. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import prepare, stored

WINDOW, THRESHOLD = 5, 0.8
#: Shorter items say too little to be looked for inside a longer text.
SHORTEST = 3
#: Words for units, when they follow a number.
UNITS = (
    "mm cm m km in ft yd mi inch inches feet foot yards miles mile meters metres meter metre kilometers kilometres mg g kg lb lbs oz grams "
    "kilograms pounds ounces tons ml l liters litres liter litre gallons s sec min h hr hrs second seconds minute minutes hour hours day days "
    "week weeks month months year years percent dollars dollar cents euros euro pounds usd eur gbp mph kmh degrees"
)
# Possessive: a text of numbers or capitalised words alone must not take a stack frame for each of them.
_NUMBER = r"\d++(?:[.,:]\d++)*+"
_UNIT = "(?:" + "|".join(sorted(set(UNITS.split()), key=lambda u: (-len(u), u))) + r")(?![\p{L}\p{N}])"
#: What stands before a capitalised word: inside a sentence; anywhere.
_STARTS = (r"(?<=[\p{Ll}\p{N},;] )", r"(?<![\p{L}\p{N}§])")
_CAPITALISED = r"\p{Lu}\p{Ll}++"
_NOISE = r"[^\p{L}\p{N}§\s]+"
FORMS = range(len(_STARTS))
#: The form of items that are shorter than a window.
_SHORT = len(_STARTS)


def _words(text: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.lower(F.regexp_replace(text, _NOISE, "")), r"\s+", " ")), " ")


def _marked(text: Column) -> Column:
    """Numbers and their units as placeholders."""
    return F.regexp_replace(F.regexp_replace(text, _NUMBER, "§n"), rf"(?i)(?<=§n ?){_UNIT}", "§u")


def _valued(text: Column) -> Column:
    """As ``_marked``, with the values between the sign and the letter."""
    return F.regexp_replace(F.regexp_replace(text, _NUMBER, "§$0n"), rf"(?i)(?<=\dn ?){_UNIT}", "§$0u")


def _signs(marked: Column, form: int) -> Column:
    return _words(F.regexp_replace(marked, f"{_STARTS[form]}{_CAPITALISED}(?: {_CAPITALISED})*+", "§p"))


def _values(valued: Column, form: int) -> Column:
    """A value for every word of ``_signs``: the words of a name, which is one placeholder, are one."""
    return _words(F.regexp_replace(valued, rf"{_STARTS[form]}({_CAPITALISED}) (?=\p{{Lu}}\p{{Ll}})", "$1§"))


def forms(rows: DataFrame, keys: list[str], values: bool = False) -> DataFrame:
    """keys, form and the canonical ``words`` of both forms of ``text``, with their ``values`` if asked for."""
    marks = rows.select(*keys, _marked(F.col("text")).alias("marked"), *([_valued(F.col("text")).alias("valued")] if values else []))
    both = [
        F.struct(F.lit(k).alias("form"), _signs(F.col("marked"), k).alias("words"), *([_values(F.col("valued"), k).alias("values")] if values else []))
        for k in FORMS
    ]
    return marks.select(*keys, F.inline(F.array(*both)))


def windows(rows: DataFrame, keys: list[str], width: int = WINDOW) -> DataFrame:
    """keys, the first word ``at`` and the hash of every window of the canonical ``words`` of a ``form``."""
    n = F.size("words")
    starts = F.when(n >= width, F.sequence(F.lit(0), n - width)).when((n > 1) | (F.col("words")[0] != ""), F.array(F.lit(0)))
    whole = F.xxhash64("form", F.array_join("words", " "), n)
    hashed = F.when(n >= width, F.xxhash64("form", *(F.expr(f"words[at + {k}]") for k in range(width)))).otherwise(whole)
    return rows.select(*keys, "form", "words", F.explode(starts).alias("at")).select(*keys, "form", "at", hashed.alias("window"))


def _same(left: str, right: str, *columns: str) -> Column:
    """Equal columns, null ids too."""
    same = F.lit(True)
    for c in columns:
        same = same & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return same


def leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, width: int = WINDOW) -> DataFrame:
    """One row per document and item that it holds: doc_id, item_id, n_windows, n_found, containment, changed.

    ``docs`` has (doc_id, text), ``items`` (item_id, text). ``changed`` tells whether a slot has another value.
    """
    prepare(docs.sparkSession)
    # A text is told by its id and its hash: texts without an id are not one document, nor one key.
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), "text").where("text is not null")
    items = (
        items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id is not null and text is not null")
        .distinct().select("item_id", F.xxhash64("item_id", "text").alias("unit"), "text")
    )
    found = _long(docs, items, threshold, width)
    short = _short(docs, items, width)
    if short is not None:
        found = found.unionByName(short)
    columns = ["n_windows", "n_found", "containment", "changed"]
    best = F.min_by(F.struct(*columns), F.struct("form", -F.col("containment"), "changed", "n_windows")).alias("best")  # the first form first
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", *(f"best.{c}" for c in columns))


def _short(docs: DataFrame, items: DataFrame, width: int) -> DataFrame | None:
    """Items of SHORTEST words or more that are shorter than a window, where their words stand in a row."""
    plain = lambda rows, *keys: rows.select(*keys, F.lit(_SHORT).alias("form"), _words(F.col("text")).alias("words"))

    few = plain(items, "item_id").where(F.size("words").between(SHORTEST, width - 1))
    lengths = sorted(r["n"] for r in few.select(F.size("words").alias("n")).distinct().collect())  # fewer than ``width`` numbers
    parts = []
    for n in lengths:
        own = windows(few.where(F.size("words") == n), ["item_id"], n).select("item_id", "window").distinct()
        long_enough = plain(docs, "doc_id").where(F.size("words") >= n)
        parts.append(windows(long_enough, ["doc_id"], n).join(own, "window").select("doc_id", "item_id").distinct())
    if not parts:
        return None
    both = parts[0]
    for part in parts[1:]:
        both = both.union(part)
    one = F.lit(1).cast("long")
    return both.select(
        "doc_id", "item_id", F.lit(_SHORT).alias("form"), one.alias("n_windows"), one.alias("n_found"),
        F.lit(1.0).alias("containment"), F.lit(False).alias("changed"),
    )


def _likely(docs: DataFrame, own: DataFrame, threshold: float, width: int) -> DataFrame:
    """Documents and items that share enough windows, whatever their places: doc_id, mark, unit, form, n_windows."""
    asked = own.select("window").distinct()
    seen = stored(
        windows(forms(docs, ["doc_id", "mark"]), ["doc_id", "mark"], width).join(asked, "window", "left_semi").select("doc_id", "mark", "window").distinct(),
        "seen",
    )
    # Windows of an item by the documents that hold them: one that holds the item holds one of the first, until those left are too few.
    spread = seen.groupBy("window").agg(F.count("*").alias("n_docs"))
    counted = own.groupBy("item_id", "unit", "form", "window").agg(F.count("*").alias("n_places")).join(spread, "window", "left")
    item = Window.partitionBy("unit", "form")
    left = F.sum("n_places").over(item.orderBy(F.coalesce("n_docs", F.lit(0)).desc(), "window").rowsBetween(Window.unboundedPreceding, 0))
    ranked = stored(counted.withColumns({"n_windows": F.sum("n_places").over(item), "left": left}), "ranked", narrow=True)
    rare = ranked.where(F.col("n_docs").isNotNull() & (F.col("left") >= F.lit(threshold) * F.col("n_windows")))
    pairs = seen.join(rare.select("window", "unit", "form"), "window").select("doc_id", "mark", "unit", "form").distinct()
    wanted = pairs.join(ranked.where("n_docs is not null"), ["unit", "form"])
    held = wanted.alias("w").join(seen.alias("s"), _same("w", "s", "doc_id", "mark", "window"), "left_semi")
    return (
        held.groupBy("doc_id", "mark", "item_id", "unit", "form", "n_windows").agg(F.sum("n_places").alias("n_found"))
        .where(F.col("n_found") >= F.lit(threshold) * F.col("n_windows")).drop("n_found")
    )


def _long(docs: DataFrame, items: DataFrame, threshold: float, width: int) -> DataFrame:
    """What ``leaks`` returns and the form, from the windows of both forms."""
    own = stored(windows(forms(items, ["item_id", "unit"]), ["item_id", "unit"], width), "windows", narrow=True)
    likely = stored(_likely(docs, own, threshold, width), "likely", narrow=True)

    # Alignments of the likely pairs, by the places of their shared windows.
    wanted = docs.alias("d").join(likely.select("doc_id", "mark").distinct().alias("w"), _same("d", "w", "doc_id", "mark"), "left_semi")
    texts = stored(forms(wanted.distinct(), ["doc_id", "mark"], values=True), "texts")
    lined = windows(texts, ["doc_id", "mark"], width).alias("t").join(likely.alias("l"), _same("t", "l", "doc_id", "mark", "form"))
    lined = lined.select("t.doc_id", "t.mark", "unit", "item_id", "l.form", "n_windows", "at", "window")
    places = own.select("unit", "window", F.col("at").alias("place"))
    placed = stored(lined.join(places, ["unit", "window"]).withColumn("shift", F.col("at") - F.col("place")).drop("at", "window"), "placed")

    # Slots of the likely pairs: a value for every placeholder in a shared window.
    pair = ["doc_id", "mark", "unit", "form", "shift"]
    spread = placed.select(*pair, F.explode(F.sequence(F.col("place"), F.col("place") + width - 1)).alias("word")).distinct()
    slots = (
        forms(items.join(likely.select("unit").distinct(), "unit", "left_semi"), ["unit"], values=True)
        .select("unit", "form", F.posexplode(F.arrays_zip(F.col("words").alias("sign"), F.col("values").alias("value"))).alias("word", "s"))
        .where(F.col("s.sign").contains("§")).select("unit", "form", "word", F.col("s.value").alias("mine"))
    )
    asked = spread.join(slots, ["unit", "form", "word"]).select(*pair, "mine", (F.col("word") + F.col("shift")).alias("at"))
    answered = (
        asked.alias("a").join(texts.alias("t"), _same("a", "t", "doc_id", "mark", "form"))
        .select(*(f"a.{c}" for c in pair), "mine", F.get("values", "at").alias("theirs"))
    )
    judged = answered.groupBy(*pair, "mine").agg(F.min("theirs").alias("low"), F.max("theirs").alias("high"))
    judged = stored(
        judged.groupBy(*pair)
        .agg(F.max(F.col("low") != F.col("high")).alias("torn"), F.max((F.col("low") != F.col("mine")) | (F.col("high") != F.col("mine"))).alias("changed")),
        "slots", narrow=True,
    )
    kept = placed.alias("p").join(judged.alias("j"), _same("p", "j", *pair), "left").where("not coalesce(torn, false)")
    return (
        kept.groupBy("p.doc_id", "p.mark", "p.item_id", "p.unit", "p.form", "n_windows")
        .agg(F.count_distinct("place").alias("n_found"), F.max(F.coalesce("changed", F.lit(False))).alias("changed"))
        .where(F.col("n_found") >= F.lit(threshold) * F.col("n_windows"))
        .select("doc_id", "item_id", "form", "n_windows", "n_found", (F.col("n_found") / F.col("n_windows")).alias("containment"), "changed")
    )
