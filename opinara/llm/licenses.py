"""License scan: phrases by place, and an exact set-similarity join of text blocks with license templates.

A block is a window of ``WINDOW`` words, every ``STRIDE`` words, as the set of its words, so a
notice is found however its lines are wrapped or commented, and words far apart are not
taken for one; any ``STRIDE`` words in a row lie in one block, and no template is longer.  A
block carries a template's label when it contains at least ``percent`` of its words.  Template words are ordered by their
number of documents in the whole table, rarest first.  A block that contains enough of a
template has one of the template's first ``size - needed + 1`` words (prefix filter), has
enough template words at all (length filter), and has enough of them left after the first
common one (positional filter).  Everything is DataFrame functions.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Phrases with their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Customary wordings of license notices.
TEMPLATES = [
    ("agpl", "licensed under the gnu affero general public license"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("mpl", "subject to the terms of the mozilla public license v 2 0"),
]
PERCENT = 90
WINDOW, STRIDE = 80, 40  # words; no template has more than STRIDE
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PHRASE = "(?<= )(?:" + "|".join(PHRASES) + ")(?= )"


def spaced(text: Column) -> Column:
    """Words in lower case (A-Z), one space before, between and after them."""
    words = F.regexp_replace(F.translate(text, _UPPER, _LOWER), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")
    return F.concat(F.lit(" "), F.trim(words), F.lit(" "))


def _words(text: Column) -> Column:
    """Number of words of a spaced text or of a part of one that begins and ends with a space."""
    return F.when(text.isin(" ", "  "), F.lit(0)).otherwise(F.octet_length(text) - F.octet_length(F.translate(text, " ", "")) - 1)


def phrase_columns(text: Column) -> dict[str, Column]:
    """Places of the phrases in a spaced text; overlaps of phrases cannot occur."""
    any_phrase = functools.reduce(operator.or_, (text.contains(p) for p in PHRASES))
    found = F.regexp_extract_all(text, F.lit(_PHRASE), F.lit(0))
    parts = F.split(text, _PHRASE, -1)
    n, last = F.size(found), F.element_at(found, -1)
    there = any_phrase & (n > 0)
    before = F.element_at(parts, 1)
    after = F.element_at(parts, -1)
    last_words = F.octet_length(last) - F.octet_length(F.translate(last, " ", "")) + 1
    label = lambda p: functools.reduce(lambda c, kv: c.when(p == kv[0], kv[1]), PHRASES.items(), F)
    return {
        "n_base": F.when(there, n).otherwise(0).cast("long"),
        "first_word": F.when(there, _words(before)).cast("long"),
        "last_word": F.when(there, _words(text) - _words(after) - last_words).cast("long"),
        "base": F.when(there, F.array_sort(F.array_distinct(F.transform(found, label)))).otherwise(F.array().cast("array<string>")),
    }


def template_table(docs: DataFrame, percent: int = PERCENT) -> tuple[list[tuple[str, list[str], int]], list[str]]:
    """Templates as (label, words rarest first, words needed), and all words in that order.

    One aggregation over the whole table counts the documents of every template word; its
    result has one row per template word.
    """
    words = sorted({w for _, t in TEMPLATES for w in t.split()})
    known = F.array(*map(F.lit, words))
    counted = (
        docs.select(F.explode(F.array_intersect(F.split(spaced(F.col("text")), " "), known)).alias("word"))
        .groupBy("word").count().collect()
    )
    count = {r["word"]: r["count"] for r in counted}
    order = sorted(words, key=lambda w: (count.get(w, 0), w))
    rows = []
    for label, text in TEMPLATES:
        tokens = sorted(set(text.split()), key=order.index)
        rows.append((label, tokens, -(-percent * len(tokens) // 100)))
    return rows, order


def scan(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per document row: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    ``labels`` holds the base labels and those of all templates that a block contains
    enough of; both lists are distinct, sorted and joined by commas.  ``score`` is 1 with a phrase, else the best
    share of a template found, else 0.  Null and empty texts have no words and no labels.
    """
    templates, order = template_table(docs, percent)
    prefixes = sorted({w for _, tokens, needed in templates for w in tokens[: len(tokens) - needed + 1]})
    known = F.array(*map(F.lit, order))
    table = docs.select("doc_id", spaced(F.coalesce("text", F.lit(""))).alias("spaced"))
    table = table.withColumn("words", F.split(F.trim("spaced"), " "))
    maybe = F.arrays_overlap("words", F.array(*map(F.lit, prefixes)))
    starts = F.sequence(F.lit(1), F.greatest(F.size("words"), F.lit(1)), F.lit(STRIDE))
    blocks = F.transform(starts, lambda i: F.array_intersect(known, F.slice("words", i, WINDOW)))

    def matches(block: Column) -> Column:
        """Templates contained in a block, given as its template words in the common order."""
        found = []
        for label, tokens, needed in templates:
            prefix, all_tokens = (F.array(*map(F.lit, t)) for t in (tokens[: len(tokens) - needed + 1], tokens))
            first = F.element_at(F.array_intersect(block, prefix), 1)
            left = F.size(block) - F.array_position(block, first) + 1
            common = F.size(F.array_intersect(block, all_tokens))
            enough = (F.size(block) >= needed) & F.arrays_overlap(block, prefix) & (left >= needed)
            share = F.when(enough, F.when(common >= needed, common / F.lit(len(tokens))))
            found.append(F.struct(F.lit(label).alias("label"), share.alias("share")))
        return F.filter(F.array(*found), lambda x: x["share"].isNotNull())

    empty = F.array().cast("array<struct<label:string,share:double>>")
    found = F.when(maybe, F.flatten(F.transform(F.filter(blocks, lambda b: F.size(b) > 0), matches))).otherwise(empty)
    columns = phrase_columns(F.col("spaced"))
    out = table.select("doc_id", _words(F.col("spaced")).cast("long").alias("n_words"), *(c.alias(k) for k, c in columns.items()), found.alias("found"))
    labels = F.array_sort(F.array_union("base", F.transform("found", lambda x: x["label"])))
    return out.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce(F.array_max(F.transform("found", lambda x: x["share"])), F.lit(0.0))).alias("score"),
    )
