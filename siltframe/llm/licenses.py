"""Licence statements by an exact set-similarity join with templates, next to phrases found word by word.

A text block is a sentence, which goes on over line ends and stops at a blank line, so a wrapped notice is one block. Its
tokens are its distinct words; a block matches a template when it holds at least ``threshold`` of the template's distinct
tokens. It gets the labels of all templates it matches, but for those of which it only holds tokens that it also holds
of a better one: one held by a larger share, or by the same share and more tokens. The join is exact: tokens of all templates are put in order of
their frequency over all blocks, rarest first; a block that reaches the threshold must hold one of the first
``size - need + 1`` tokens of the template (prefix filter) and at least ``need`` template tokens (length filter), and
what is left in both orders from the matched token on must suffice (positional filter). What remains is verified on
the full sets. Everything is DataFrame expressions.

Phrases are places where the phrase's words stand consecutively, across blocks too. Null text is empty: no words, no
labels, score 0. Every row is judged on its own, repeated or not. Null ids are judged too. Extra columns are ignored.
The score is 1 with a phrase, else the largest containment of a matching block, else 0.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import literal_table
from .store import prepare, stored

#: Phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Notices that licences ask for or are commonly stated by.
TEMPLATES = [
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("public-domain", "This work has been released into the public domain"),
    ("reserved", "Copyright. All rights reserved"),
]
THRESHOLD = 0.8
_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
_BLOCK = r"(?<=[.!?])[ \t\r\n]+|\n[ \t\r]*\n"


def _tokens(text: str) -> list[str]:
    return list(dict.fromkeys(re.findall(_WORD + "+", text.lower())))


def _phrase_pattern(phrases: dict[str, str]) -> str:
    options = "|".join((_GAP + "+").join(p.split()) for p in phrases)
    return f"(?i)(?<!{_WORD})(?:{options})(?!{_WORD})"


def _n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(_WORD + "+"))


def _read(docs: DataFrame, vocabulary: list[str], least: int, phrases: dict[str, str]) -> DataFrame:
    """Phrases of every document, and of its blocks the template tokens, where there are at least ``least``."""
    known = F.array(*map(F.lit, vocabulary))
    text = F.coalesce("text", F.lit(""))
    words = lambda b: F.array_intersect(F.split(F.lower(b), _GAP + "+"), known)
    blocks = F.filter(F.transform(F.split(text, _BLOCK), words), lambda t: F.size(t) >= least)
    pattern = _phrase_pattern(phrases)
    hit = text.rlike(pattern)
    parts, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), 0)
    one = lambda c: F.array_join(F.filter(F.split(F.lower(c), _GAP + "+"), lambda w: w != ""), " ")
    rows = docs.select(
        "doc_id", _n_words(text).cast("long").alias("n_words"), blocks.alias("blocks"),
        F.when(hit, parts).alias("parts"), F.when(hit, F.transform(found, one)).alias("found"),
    )
    matched = F.coalesce("found", F.array().cast("array<string>"))
    label = F.create_map(*(F.lit(x) for item in phrases.items() for x in item))
    last = _n_words(F.element_at("parts", -1)) + F.size(F.split(F.element_at("found", -1), " "))
    return rows.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "n_words", "blocks",
        F.size(matched).cast("long").alias("n_base"),
        _n_words(F.col("parts")[0]).cast("long").alias("first_word"), (F.col("n_words") - last).alias("last_word"),
        F.array_sort(F.array_distinct(F.transform(matched, lambda p: label[p]))).alias("base"),
    )


def scanned(
    docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD, phrases: dict[str, str] = PHRASES
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    spark = prepare(docs.sparkSession)
    sets = [(label, _tokens(text)) for label, text in templates]
    need = [-(-round(threshold * 1000) * len(tokens) // 1000) for _, tokens in sets]
    vocabulary = sorted({t for _, tokens in sets for t in tokens})
    read = stored(_read(docs.select("doc_id", "text"), vocabulary, min(need), phrases), "blocks")
    blocks = read.select("row", F.posexplode("blocks").alias("block", "tokens"))

    counted = blocks.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    often = {r["token"]: r["n"] for r in counted.collect()}  # the templates' own tokens at most
    rank = {t: k for k, t in enumerate(sorted(vocabulary, key=lambda t: (often.get(t, 0), t)))}
    rows = []
    for k, ((label, tokens), least) in enumerate(zip(sets, need)):
        ranks = sorted(rank[t] for t in tokens)
        rows += [(ranks[p], k, label, p, least, ranks) for p in range(len(ranks) - least + 1)]
    prefixes = literal_table(spark, rows, "rank int, template int, label string, place int, need int, ranks array<int>")

    ranked = F.create_map(*(F.lit(x) for item in rank.items() for x in item))
    blocks = blocks.select("row", "block", F.array_sort(F.transform("tokens", lambda t: ranked[t])).alias("own"))
    pairs = blocks.select("row", "block", "own", F.posexplode("own").alias("at", "rank")).join(prefixes, "rank")
    enough = F.least(F.size("ranks") - F.col("place"), F.size("own") - F.col("at")) >= F.col("need")
    first = F.size(F.array_intersect(F.slice("own", 1, F.col("at")), "ranks")) == 0  # each pair once, at its first token
    held = F.array_intersect("own", "ranks")
    verified = pairs.where(enough & first).select("row", "block", "need", "label", held.alias("held"), (F.size(held) / F.size("ranks")).alias("share"))
    verified = verified.where(F.size("held") >= F.col("need"))
    # A block has at most as many rows here as there are templates.
    matches = verified.groupBy("row", "block").agg(F.max("share").alias("share"), F.collect_set(F.struct("label", "held", "share")).alias("all"))

    def inside(x: Column, y: Column) -> Column:
        more = (y["share"] > x["share"]) | ((y["share"] == x["share"]) & (F.size(y["held"]) > F.size(x["held"])))
        return more & (F.size(F.array_except(x["held"], y["held"])) == 0)

    kept = F.filter("all", lambda x: ~F.exists("all", lambda y: inside(x, y)))
    named = F.transform(kept, lambda x: x["label"])
    found = (
        matches.select("row", "share", F.explode(named).alias("label"))
        .groupBy("row").agg(F.collect_set("label").alias("more"), F.max("share").alias("share"))
    )
    joined = read.drop("blocks").join(found, "row", "left")
    labels = F.array_sort(F.array_union("base", F.coalesce("more", F.array().cast("array<string>"))))
    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )
